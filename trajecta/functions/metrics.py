"""Model metrics and column statistics as aggregates."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def classification_metrics(df: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None) -> DataFrame:
    """ROC AUC (mid-ranks), average precision, Brier score, Matthews correlation at 0.5; null where one class is missing.

    Rows are first reduced to counts per distinct score, so the ordered windows run over distinct scores.
    """
    by = by or []
    keys = by or ["__all"]
    base = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    base = base if by else base.withColumn("__all", F.lit(1))
    hit = F.col(score) >= 0.5
    tally = base.groupBy(*keys, F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count(F.lit(1)).alias("n"),
        F.sum((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("sq"),
        F.count_if(hit & (F.col(label) == 1)).alias("tp"), F.count_if(hit & (F.col(label) == 0)).alias("fp"),
    )
    # running counts by buckets of scores: only a bucket's distinct scores are ever put in order in one task
    tally = tally.withColumn("__b", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("s"))) * SCORE_BUCKETS).cast("int"))
    sums = tally.groupBy(*keys, "__b").agg(F.sum("p").alias("bp"), F.sum("n").alias("bn"))
    lower = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # over SCORE_BUCKETS + 1 rows
    higher = Window.partitionBy(*keys).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__b").alias("__k"), *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for c, w, n in (("bn", lower, "o_below"), ("bp", higher, "o_cp"), ("bn", higher, "o_cn"))])
    up = Window.partitionBy(*keys, "__b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys, "__b").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys], F.col("__b") == F.col("__k"))
    ranked = tally.withColumns({"below": F.coalesce(F.sum("n").over(up), F.lit(0)), "cp": F.sum("p").over(down), "cn": F.sum("n").over(down)}).join(offsets, same).withColumns(
        {"below": F.col("below") + F.col("o_below"), "cp": F.col("cp") + F.col("o_cp"), "cn": F.col("cn") + F.col("o_cn")}
    )
    out = ranked.groupBy(*keys).agg(
        F.sum("p").alias("pos"), F.sum("n").alias("n"), F.sum(F.col("p") * (F.col("below") + (F.col("n") + 1) / 2)).alias("ranks"),
        F.sum(F.col("p") * F.col("cp") / F.col("cn")).alias("ap"), F.sum("sq").alias("sq"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
    )
    neg = F.col("n") - F.col("pos")
    fn, tn = F.col("pos") - F.col("tp"), neg - F.col("fp")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    both = (F.col("pos") > 0) & (neg > 0)
    return out.select(
        *by, F.col("n").alias("n_rows"),
        F.when(both, (F.col("ranks") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * neg)).alias("roc_auc"),
        F.when(both, F.col("ap") / F.col("pos")).alias("average_precision"), (F.col("sq") / F.col("n")).alias("brier"),
        F.when(both, F.coalesce(F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), F.lit(0.0))).alias("mcc"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and R2 (null for one row or a constant target)."""
    e, y = F.col(actual) - F.col(predicted), F.col(actual)
    rows = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    total = F.var_pop(y) * F.count(F.lit(1))
    return (rows.groupBy(*by) if by else rows.groupBy()).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(F.count(F.lit(1)) > 1, 1 - F.try_divide(F.sum(e * e), total)).alias("r2"),
    )


#: Buckets of scores (between 0 and 1) whose running counts are offsets.
SCORE_BUCKETS = 4096
#: Values whose medians the engine's own exact median takes; it gathers a column's distinct values in one task.
ONE_TASK_VALUES = 1_000_000


def exact_medians(df: DataFrame, columns: list[str], one_task: int = ONE_TASK_VALUES, digits: int = 64) -> dict[str, float | None]:
    """The exact median of each column; None where all values are null or NaN.

    Beyond ``one_task`` rows the middle ranks are found by counting: a round splits each rank's range of values into
    ``digits`` equal parts, counts them in a partial aggregate and keeps the part that holds the rank, until
    the part holds few values or one.  Nothing is sorted; a round collects at most 2 x ``digits`` counts for each column.
    """
    clean = [F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double")) for c in columns]
    if df.count() <= one_task:
        row = df.select(*[c.alias(f"c{i}") for i, c in enumerate(clean)]).agg(*[F.median(f"c{i}") for i in range(len(columns))]).first()
        return dict(zip(columns, row, strict=True))
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), c.alias("v")) for i, c in enumerate(clean)])
    values = df.select(F.explode(pairs).alias("p")).select("p.c", "p.v").where("v is not null")
    found: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple[float, float, int]] = {}  # (column, which middle) -> lo, hi, rank inside
    for r in values.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        for which, rank in enumerate({(r["n"] - 1) // 2, r["n"] // 2}):
            open_[r["c"], which] = (r["lo"], r["hi"], rank)
    while open_:
        spots = values.sparkSession.createDataFrame([(c, w, lo, hi) for (c, w), (lo, hi, _) in open_.items()], "c int, w int, lo double, hi double")
        inside = values.join(F.broadcast(spots), "c").where("v between lo and hi")  # two rows a column
        part = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(digits - 1), F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * digits)).cast("int")).otherwise(0)
        rows = inside.groupBy("c", "w", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        for key, (_, _, rank) in list(open_.items()):
            for r in sorted((r for r in rows if (r["c"], r["w"]) == key), key=lambda r: r["part"]):
                if rank < r["n"]:
                    open_[key] = (r["lo"], r["hi"], rank)
                    if r["lo"] == r["hi"]:
                        found[key] = r["lo"]
                        del open_[key]
                    break
                rank -= r["n"]
    out = {}
    for i, c in enumerate(columns):
        middle = [v for (k, _), v in found.items() if k == i]
        out[c] = sum(middle) / len(middle) if middle else None
    return out


def median_impute(df: DataFrame, columns: list[str], medians: dict[str, float | None] | None = None) -> DataFrame:
    """Nulls and NaN become the column's exact median, 0 where all values are missing.

    ``medians`` may come from other rows (those a model is trained on); else they are those of ``df``, computed now.
    """
    known = exact_medians(df, columns) if medians is None else medians
    value = lambda c: F.coalesce(F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double")), F.lit(float(known[c] or 0.0)))
    return df.withColumns({c: value(c) for c in columns})


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns minus mean, over the population standard deviation; a constant column becomes 0."""
    stats = df.agg(*[f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])  # one row
    scaled = {c: F.coalesce(F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")), F.when(F.col(c).isNotNull(), F.lit(0.0))) for c in columns}
    return df.crossJoin(F.broadcast(stats)).withColumns(scaled).drop(*[f"__{n}_{c}" for c in columns for n in "ms"])


def one_hot(column: str, values: list[str]) -> list[Column]:
    """0/1 columns; a value that isn't listed is all zeros."""
    return [F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}".replace(" ", "_").lower()) for v in values]


def interactions(columns: list[str]) -> list[Column]:
    """Products of all pairs of different columns."""
    return [(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for i, a in enumerate(columns) for b in columns[i + 1 :]]


def best_by(df: DataFrame, metric: str, carry: list[str], higher: bool = True) -> DataFrame:
    """The row of best ``metric``; ties by the carried columns."""
    row = F.struct(F.col(metric) if not higher else -F.col(metric), *carry)
    return df.where(F.col(metric).isNotNull() & ~F.isnan(metric)).agg(F.min_by(F.struct(metric, *carry), row).alias("b")).select("b.*")


def class_balance(df: DataFrame, label: str, by: list[str]) -> DataFrame:
    """(by, n_pos, n_neg, pos_weight); weight 1 without positives."""
    return df.groupBy(*by).agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg")).withColumn(
        "pos_weight", F.coalesce(F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos")), F.lit(1.0))
    )


def complex_buckets(df: DataFrame, key: str, label: str, real: str, imaginary: str, threshold: float = 1e-2) -> DataFrame:
    """(key, term, real_sum, imaginary_sum, magnitude_sum, mean_phase, n): terms up to the threshold in size are gathered as Other."""
    size = F.hypot(F.col(real), F.col(imaginary))
    term = F.when(size > threshold, F.col(label)).otherwise("Other")
    return df.groupBy(key, term.alias("term")).agg(F.sum(real).alias("real_sum"), F.sum(imaginary).alias("imaginary_sum"), F.sum(size).alias("magnitude_sum"), F.avg(F.atan2(F.col(imaginary), F.col(real))).alias("mean_phase"), F.count(F.lit(1)).alias("n"))


def gate_histogram(df: DataFrame, key: str, qasm: str) -> DataFrame:
    """(key, gate, n): gate names of OpenQASM text, declarations and directives left out."""
    words = F.regexp_extract_all(F.col(qasm), F.lit(r"(?m)(?:^|;)\s*([a-z][a-z0-9_]*)\s*(?:\([^)]*\))?\s+[a-z_$][\w\[\]$,\s]*(?=;)"), F.lit(1))
    drop = F.array(*[F.lit(w) for w in ("include", "qubit", "bit", "qreg", "creg", "gate", "barrier", "input", "output", "float")])
    return df.select(key, F.explode(words).alias("gate")).where(~F.array_contains(drop, F.col("gate"))).groupBy(key, "gate").agg(F.count(F.lit(1)).alias("n"))


def circuit_features(df: DataFrame, key: str, qasm: str) -> DataFrame:
    """(key, qubits, clbits, depth, n_gates) of OpenQASM text.

    Depth is the longest chain of gates that share a bit, measured text by text in Arrow batches; gates
    over whole registers touch all their bits.  Null text gives nulls.
    """

    @F.pandas_udf("struct<qubits: int, clbits: int, depth: int, n_gates: int>")
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_circuit(t) for t in texts], columns=["qubits", "clbits", "depth", "n_gates"]).astype("Int32")

    return df.select(key, measure(qasm).alias("f")).select(key, "f.*")


_DECLARED = re.compile(r"^(qubit|bit|qreg|creg)\s*(?:\[(\d+)\])?\s*([A-Za-z_]\w*)\s*(?:\[(\d+)\])?$")
_NO_GATES = ("include", "OPENQASM", "gate", "barrier", "input", "output", "float", "def", "opaque")


def _circuit(text: str | None) -> tuple:
    if text is None:
        return (None, None, None, None)
    plain = re.sub(r"/\*.*?\*/|//[^\n]*", " ", text, flags=re.S)
    plain = re.sub(r"\bgate\b[^{;]*\{[^}]*\}", " ", plain)
    sizes: dict[str, int] = {}
    counts, level, gates = {"q": 0, "c": 0}, {}, 0
    for statement in (x.strip() for x in plain.split(";")):
        m = _DECLARED.match(statement)
        if m:
            n = int(m[2] or m[4] or 1)
            sizes[m[3]] = n
            counts["q" if m[1].startswith("q") else "c"] += n
        elif statement and not statement.startswith(_NO_GATES):
            args = re.sub(r"^[^\s(]+\s*(?:\([^)]*\))?", "", statement) if "=" not in statement else statement
            bits = [b for name, i in re.findall(r"([A-Za-z_]\w*)\s*(?:\[(\d+)\])?", args) if name in sizes for b in ([(name, int(i))] if i else [(name, j) for j in range(sizes[name])])]
            if bits:
                gates += 1
                depth = 1 + max(level.get(b, 0) for b in bits)
                level.update(dict.fromkeys(bits, depth))
    return counts["q"], counts["c"], max(level.values(), default=0), gates


def coordinate_bounds(df: DataFrame, key: str, coords: str, padding: float = 0.3) -> DataFrame:
    """(key, axis, min_coord, max_coord, mean_coord, low, high): bounds with padding, equally wide on all axes of a key.

    The half width is half the widest axis' range, padded by ``padding`` of it.
    """
    rows = df.select(key, F.explode(coords).alias("p")).select(key, F.posexplode("p").alias("axis", "x"))
    axes = rows.groupBy(key, "axis").agg(F.min("x").alias("min_coord"), F.max("x").alias("max_coord"), F.avg("x").alias("mean_coord"))
    half = F.max(F.col("max_coord") - F.col("min_coord")).over(Window.partitionBy(key)) / 2.0
    return axes.withColumn("__h", half * (1 + padding)).select(key, "axis", "min_coord", "max_coord", "mean_coord", (F.col("mean_coord") - F.col("__h")).alias("low"), (F.col("mean_coord") + F.col("__h")).alias("high"))


def atom_sizes(masses: Column, base: float = 500.0) -> Column:
    """base x (1 + ln(mass / least mass)) for each element of an array of masses; null for a null array."""
    return F.transform(masses, lambda m: base * (1 + F.log(m / F.array_min(masses))))


def parse_complex(column: Column) -> Column:
    """struct(real, imaginary) of text like (0.5-1.2j); null if it isn't one."""
    number = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
    whole = F.regexp_extract(column, rf"^\(?({number})([+-](?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)j\)?$", 1)
    imaginary = F.regexp_extract(column, rf"^\(?({number})([+-](?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)j\)?$", 2)
    return F.when(whole != "", F.struct(whole.cast("double").alias("real"), imaginary.cast("double").alias("imaginary")))


def reshape_points(flat: Column) -> Column:
    """Flat coordinates as an array of arrays of three; a rest of fewer than three is left out."""
    n = F.floor(F.size(flat) / 3).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(flat, i * 3 + 1, 3))).otherwise(F.when(flat.isNotNull(), F.array().cast("array<array<double>>")))
