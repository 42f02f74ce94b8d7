"""Models on prefix features with MLlib, leave-one-group-out validation, metrics by SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, PolynomialExpansion, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from ..runtime import FileSystem, cut


def preprocessor(numeric: list[str], categorical: list[str], rows: int = 0, interact: list[str] | None = None) -> list:
    """Standardised numbers, products of all pairs of ``interact`` (after scaling), and one-hot categories; an unseen category is all zeros.

    MLlib divides by the sample's deviation; ``rows`` (of the training side) turns that into the population's.
    """
    stages = [VectorAssembler(inputCols=numeric, outputCol="__num"), StandardScaler(inputCol="__num", outputCol="__sample", withMean=True)]
    scale = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    stages.append(ElementwiseProduct(scalingVec=[scale] * len(numeric), inputCol="__sample", outputCol="__scaled"))
    chosen = [numeric.index(c) for c in interact or [] if c in numeric]
    products = []
    if len(chosen) > 1:
        # the expansion of degree 2 lists x_j, x_0 x_j, ..., x_j x_j for each j; only products of different ones are kept
        crossed = [j * (j + 3) // 2 + 1 + i for j in range(len(chosen)) for i in range(j)]
        stages += [VectorSlicer(inputCol="__scaled", outputCol="__few", indices=chosen), PolynomialExpansion(degree=2, inputCol="__few", outputCol="__all"), VectorSlicer(inputCol="__all", outputCol="__products", indices=crossed)]
        products = ["__products"]
    if categorical:
        stages += [StringIndexer(inputCols=categorical, outputCols=[f"__i_{c}" for c in categorical], handleInvalid="keep"), OneHotEncoder(inputCols=[f"__i_{c}" for c in categorical], outputCols=[f"__o_{c}" for c in categorical], dropLast=True)]
    return [*stages, VectorAssembler(inputCols=["__scaled", *products, *[f"__o_{c}" for c in categorical]], outputCol="features")]


#: Features whose pairwise products the logistic model also reads, besides the slope of its horizon.
INTERACT = ("energy_moving_std_5_at_k", "num_qubits", "init_strategy_random")


def logistic(rows: int, label: str = "label", weight: str = "weight") -> LogisticRegression:
    """L2 with C = 1; the penalty is scaled by the sum of the weights, ``rows`` for balanced ones."""
    return LogisticRegression(labelCol=label, weightCol=weight, regParam=1.0 / max(1, rows), elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-8)


def forest(label: str = "label", weight: str = "weight", trees: int = 200, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, weightCol=weight, numTrees=trees, maxDepth=12, minInstancesPerNode=2, seed=seed)


def boosted(label: str = "label", weight: str = "weight", rounds: int = 300, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(labelCol=label, weightCol=weight, maxIter=rounds, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, seed=seed)


def ridge(rows: int, label_std: float, alpha: float = 1.0, label: str = "label") -> LinearRegression:
    """Closed-form ridge; MLlib divides the penalty by the label's deviation, so it is multiplied by it here."""
    return LinearRegression(labelCol=label, regParam=alpha / max(1, rows) * label_std, elasticNetParam=0.0, standardization=False, solver="normal")


def boosted_regressor(label: str = "label", rounds: int = 300, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=6, stepSize=0.05, seed=seed)


#: Training rows of a partition: fewer partitions make the many small jobs of a fit cheaper.
ROWS_PER_PARTITION = 100_000


def training_frame(df: DataFrame) -> tuple[DataFrame, int]:
    """(rows, count): the frame written once, then cached in as many partitions as its size needs.

    A fit plans dozens of jobs; on a written table their plans are small.
    """
    table = cut(df, "training")
    n = table.count()
    return table.coalesce(max(1, -(-n // ROWS_PER_PARTITION))).persist(), n


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """Add weight: rows / (2 x rows of the class)."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = df.count()
    return df.join(F.broadcast(n), label).withColumn("weight", F.lit(float(total)) / (2 * F.col("__n"))).drop("__n")  # two classes


def positives_weighted(df: DataFrame, label: str = "label") -> DataFrame:
    """Add weight: negatives / positives for positive rows, 1 for the others."""
    neg, pos = df.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(neg / pos if pos else 1.0)).otherwise(F.lit(1.0)))


@dataclass
class Fitted:
    """Fold metrics, fold predictions and the models fitted on all rows, by name."""

    folds: list[dict] = field(default_factory=list)
    models: dict[str, PipelineModel] = field(default_factory=dict)
    scored: list[DataFrame] = field(default_factory=list)

    def summary(self, spark, order: list[str] | None = None) -> DataFrame:
        """One row per fold, in order of ``order`` (e.g. held_out and model) if given."""
        out = spark.createDataFrame(self.folds)
        return out.orderBy(*order) if order else out

    def predictions(self) -> DataFrame:
        """(model, held_out, key, label, score): what each fold's model said of the rows it had not seen."""
        return reduce(DataFrame.unionByName, self.scored)

    def best(self, metric: str, higher: bool = True) -> str | None:
        """The model of best mean ``metric`` over its folds; ties by name."""
        means: dict[str, list[float]] = {}
        for f in self.folds:
            if f.get(metric) is not None:
                means.setdefault(f["model"], []).append(f[metric])
        return min(means, key=lambda m: ((-1 if higher else 1) * sum(means[m]) / len(means[m]), m), default=None)

    def text(self, metrics: list[str]) -> str:
        """A line per model: folds, and mean of each metric."""
        lines = []
        for name in sorted({f["model"] for f in self.folds}):
            rows = [f for f in self.folds if f["model"] == name]
            means = {m: [f[m] for f in rows if f.get(m) is not None] for m in metrics}
            lines.append(f"{name}: {len(rows)} folds, " + ", ".join(f"{m} {sum(v) / len(v):.4f}" if v else f"{m} -" for m, v in means.items()))
        return "\n".join(lines)


def save_models(fitted: Fitted, path: str) -> list[str]:
    """Every model under ``path``/<name>; older ones of the name are replaced."""
    for name, model in fitted.models.items():
        model.write().overwrite().save(f"{path}/{name}")
    return sorted(fitted.models)


def load_models(spark, path: str) -> dict[str, PipelineModel]:
    return {name: PipelineModel.load(f"{path}/{name}") for name in FileSystem(spark, path).subdirs(path)}


def _made(model, train: DataFrame, label: str):
    """An estimator as it is, or made from the rows and the label's deviation of what it is fitted on."""
    if not callable(model):
        return model
    n, std = train.agg(F.count(F.lit(1)), F.coalesce(F.stddev_pop(label), F.lit(1.0))).first()
    return model(n, std)


def _side_by_side(rows: DataFrame, jobs: list[Callable]) -> list:
    """Results in order; fits are many small Spark jobs, so as many run at a time as there are cores."""
    with ThreadPool(max(1, min(len(jobs), rows.sparkSession.sparkContext.defaultParallelism))) as pool:
        return pool.map(lambda job: job(), jobs, chunksize=1)


def fit_classifiers(features: DataFrame, numeric: list[str], categorical: list[str], group: str, key: str, label: str = "label", estimators: dict | None = None, suffix: str = "", min_train: int = 5, min_rows: int = 10, interact: list[str] | None = None, refit: bool = True) -> Fitted:
    """Leave one group out for each estimator, then fit on everything.

    Folds with fewer than ``min_train`` training rows, no test rows or one class in training are passed
    over; fewer than ``min_rows`` rows or two groups is an error.  Groups (molecules) are few.  An
    estimator may also be a function of the training rows and the label's deviation among them.  Missing
    numbers become the medians of a fold's training rows.  Boosted trees weigh positives only, the others balance the
    classes; the logistic model also reads the products of the pairs of ``interact``.  Without ``refit`` only the folds
    are fitted.
    """
    rows, n = training_frame(features.na.drop(subset=[label, group]))
    try:
        groups = [r[0] for r in rows.select(group).distinct().orderBy(group).collect()]
        if n < min_rows or len(groups) < 2:
            raise ValueError(f"{n} rows in {len(groups)} groups are too few")
        made = estimators or {"boosted": boosted(label), "forest": forest(label), "logistic": lambda n, _: logistic(n, label)}
        sizes = {g: (train.count(), train.select(label).distinct().count()) for g in groups for train in [rows.where(F.col(group) != g)]}
        usable = [g for g in groups if sizes[g][0] >= min_train and sizes[g][1] == 2]
        medians = _side_by_side(rows, [lambda g=g: metrics.exact_medians(rows.where(F.col(group) != g) if g is not None else rows, numeric) for g in (*usable, None)])
        medians = dict(zip((*usable, None), medians, strict=True))

        def fit(train: DataFrame, model, size: int) -> PipelineModel:
            known = _made(model, train, label)
            weighted = positives_weighted(train, label) if isinstance(known, GBTClassifier) else balanced(train, label)
            products = interact if isinstance(known, LogisticRegression) else None
            return Pipeline(stages=[*preprocessor(numeric, categorical, size, products), known]).fit(weighted)

        def fold(g, name: str, model) -> tuple[dict, DataFrame]:
            filled = metrics.median_impute(rows, numeric, medians[g])  # medians of the training side
            scored = fit(filled.where(F.col(group) != g), model, sizes[g][0]).transform(filled.where(F.col(group) == g))
            scored = scored.select(key, F.col(label).cast("double").alias("label"), vector_to_array("probability")[1].alias("score"))
            found = metrics.classification_metrics(scored).first()
            row = {"model": name + suffix, "held_out": g, **{k: float(v) if v is not None else None for k, v in found.asDict().items()}}
            return row, scored.select(F.lit(name + suffix).alias("model"), F.lit(g).alias("held_out"), key, "label", "score")

        folds = [lambda g=g, m=m: fold(g, *m) for g in usable for m in made.items()]
        whole = metrics.median_impute(rows, numeric, medians[None])
        done = _side_by_side(rows, [*folds, *[lambda m=m: fit(whole, m, n) for m in made.values() if refit]])
        return Fitted([r for r, _ in done[: len(folds)]], {name + suffix: m for name, m in zip(made if refit else (), done[len(folds) :], strict=True)}, [d for _, d in done[: len(folds)]])
    finally:
        rows.unpersist()


def fit_regressors(features: DataFrame, numeric: list[str], categorical: list[str], group: str, label: str = "label", estimators: dict | None = None, suffix: str = "", key: str | None = None, refit: bool = True) -> Fitted:
    """The same for a continuous target; ``key`` names the rows of the kept predictions."""
    rows, n = training_frame(features.na.drop(subset=[label, group]))
    try:
        groups = [r[0] for r in rows.select(group).distinct().orderBy(group).collect()]
        made = estimators or {"ridge": lambda n, std: ridge(n, std, label=label), "boosted": boosted_regressor(label)}
        held_out = groups if len(groups) > 1 else []
        medians = dict(zip((*held_out, None), _side_by_side(rows, [lambda g=g: metrics.exact_medians(rows.where(F.col(group) != g) if g is not None else rows, numeric) for g in (*held_out, None)]), strict=True))

        def fit(train: DataFrame, model) -> PipelineModel:
            return Pipeline(stages=[*preprocessor(numeric, categorical, train.count()), _made(model, train, label)]).fit(train)

        def fold(g, name: str, model) -> tuple[dict, DataFrame]:
            filled = metrics.median_impute(rows, numeric, medians[g])
            scored = fit(filled.where(F.col(group) != g), model).transform(filled.where(F.col(group) == g))
            found = metrics.regression_metrics(scored, label, "prediction").first()
            row = {"model": name + suffix, "held_out": g, **{k: float(v) if v is not None else None for k, v in found.asDict().items()}}
            kept = [F.col(key)] if key else []
            return row, scored.select(F.lit(name + suffix).alias("model"), F.lit(g).alias("held_out"), *kept, F.col(label).cast("double").alias("label"), F.col("prediction").alias("score"))

        folds = [lambda g=g, m=m: fold(g, *m) for g in held_out for m in made.items()]
        whole = metrics.median_impute(rows, numeric, medians[None])
        done = _side_by_side(rows, [*folds, *[lambda m=m: fit(whole, m) for m in made.values() if refit]])
        return Fitted([r for r, _ in done[: len(folds)]], {name + suffix: m for name, m in zip(made if refit else (), done[len(folds) :], strict=True)}, [d for _, d in done[: len(folds)]])
    finally:
        rows.unpersist()


def predict(model: PipelineModel, features: DataFrame, key: str) -> DataFrame:
    """(key, prediction, probability where the model has one)."""
    out = model.transform(features)
    extra = [vector_to_array("probability")[1].alias("probability")] if "probability" in out.columns else []
    return out.select(key, "prediction", *extra)
