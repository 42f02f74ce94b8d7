"""Per-iteration and per-run features of ordered trajectories.

Input: one row per (run, step) with an energy; ``run_id`` and ``step`` name the columns.  All window
columns of a function share one specification, so Catalyst plans one exchange and one sort for them;
summaries are conditional aggregates over the same exchange instead of joins of several aggregates.
Steps of a run are unique (``deduplicate_steps``); a run is bounded by its iterations, so no window
grows with the table.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLLING, HEAD, TAIL = 5, 10, 10
TOLERANCE = 1e-8


def ordered(run: str = "run_id", step: str = "step"):
    return Window.partitionBy(run).orderBy(step)


def running(run: str = "run_id", step: str = "step"):
    return ordered(run, step).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_steps(df: DataFrame, run: str, order: list[str]) -> DataFrame:
    """Add ``step``: 1-based place of the row in its run."""
    return df.withColumn("step", F.row_number().over(Window.partitionBy(run).orderBy(*order)).cast("bigint"))


def deduplicate_steps(df: DataFrame, run: str = "run_id", step: str = "step", prefer: list[str] | None = None) -> DataFrame:
    """One row for each (run, step): the first in order of ``prefer``, else any."""
    if not prefer:
        return df.dropDuplicates([run, step])
    names = [c for c in df.columns if c not in (run, step)]
    first = F.min_by(F.struct(*names), F.struct(*prefer)).alias("__r")
    return df.groupBy(run, step).agg(first).select(run, step, *[F.col(f"__r.`{c}`").alias(c) for c in names])


def with_deltas(df: DataFrame, energy: str = "energy") -> DataFrame:
    """Add energy_delta (null on the first step), cumulative_min_energy."""
    return df.withColumns({"energy_delta": F.col(energy) - F.lag(energy).over(ordered()), "cumulative_min_energy": F.min(energy).over(running())})


def vector_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long vectors; null if either is."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def with_parameter_norms(df: DataFrame, parameters: str = "parameters") -> DataFrame:
    """Add parameter_delta_norm: distance of the parameter vector from the previous step's."""
    return df.withColumn("parameter_delta_norm", vector_distance(F.col(parameters), F.lag(parameters).over(ordered())))


def with_improvement(df: DataFrame) -> DataFrame:
    """Add is_new_minimum, steps_since_improvement and convergence_iteration.

    A new minimum is a strict fall of cumulative_min_energy; the first step is one, as is every step
    whose predecessor has no minimum.  convergence_iteration is the run's last new minimum.
    """
    before = F.lag("cumulative_min_energy").over(ordered())
    flagged = df.withColumn("is_new_minimum", F.when(before.isNull(), True).when(F.col("cumulative_min_energy") < before, True).otherwise(False))
    last = F.max(F.when(F.col("is_new_minimum"), F.col("__rn"))).over(running())
    numbered = flagged.withColumn("__rn", F.row_number().over(ordered()))
    return numbered.withColumns({
        "steps_since_improvement": (F.col("__rn") - last).cast("bigint"),
        "convergence_iteration": F.max(F.when(F.col("is_new_minimum"), F.col("step"))).over(Window.partitionBy("run_id")),
    }).drop("__rn")


def iteration_features(df: DataFrame, rolling: int = ROLLING) -> DataFrame:
    """All per-step features.

    Needs run_id, step, energy, energy_delta, parameter_delta_norm, cumulative_min_energy and
    total_iterations.  Divisions by zero give null, except normalized_energy, which is 0 where the minimum
    is 0 or null.
    """
    recent = ordered().rowsBetween(-(rolling - 1), 0)
    return with_improvement(df).withColumns({
        "relative_iteration": F.try_divide(F.col("step").cast("double"), F.col("total_iterations")),
        f"energy_moving_avg_{rolling}": F.avg("energy").over(recent),
        f"energy_moving_std_{rolling}": F.stddev("energy").over(recent),
        "mean_param_change": F.try_divide(F.sum("parameter_delta_norm").over(running()), F.col("step")),
        "energy_improvement_rate": F.try_divide(F.first("energy").over(ordered()) - F.col("cumulative_min_energy"), F.col("step")),
        "normalized_energy": F.when(F.col("cumulative_min_energy") != 0, F.abs(F.col("energy") - F.col("cumulative_min_energy")) / F.abs(F.col("cumulative_min_energy"))).otherwise(F.lit(0.0)),
    })


def with_ends(df: DataFrame) -> DataFrame:
    """Add rn_asc and rn_desc (1-based from either end) with one sort."""
    n = F.count(F.lit(1)).over(Window.partitionBy("run_id"))
    return df.withColumn("rn_asc", F.row_number().over(ordered())).withColumn("rn_desc", n - F.col("rn_asc") + 1)


def head_tail_columns(head: int = HEAD, tail: int = TAIL) -> list[Column]:
    """Aggregates over the first and last steps; a slope needs two points, else null."""
    first = F.col("rn_asc") <= head
    return [
        F.avg(F.when(first, F.col("energy"))).alias(f"first_{head}_mean_energy"),
        F.regr_slope(F.when(first, F.col("energy")), F.col("step").cast("double")).alias(f"first_{head}_energy_slope"),
        F.avg(F.when(F.col("rn_desc") <= tail, F.col("energy"))).alias(f"last_{tail}_mean_energy"),
    ]


def run_summary(features: DataFrame, groups: list[str], head: int = HEAD, tail: int = TAIL) -> DataFrame:
    """One row per run (and values of ``groups``): 11 aggregates, head and tail, time per iteration if vqe_time is a group."""
    aggregates = [
        F.avg("energy_delta").alias("mean_energy_delta"), F.stddev("energy_delta").alias("std_energy_delta"),
        F.min("energy").alias("min_energy"), F.max("energy").alias("max_energy"), (F.max("energy") - F.min("energy")).alias("energy_range"),
        F.avg("parameter_delta_norm").alias("mean_param_delta_norm"), F.stddev("parameter_delta_norm").alias("std_param_delta_norm"),
        F.sum("parameter_delta_norm").alias("total_param_distance"), F.count_if("is_new_minimum").alias("num_new_minima"),
        F.max("steps_since_improvement").alias("longest_plateau"),
        F.try_divide(F.count_if("is_new_minimum").cast("double"), F.col("total_iterations")).alias("improvement_ratio"),
    ]
    out = with_ends(features).groupBy("run_id", *groups).agg(*aggregates, *head_tail_columns(head, tail))
    return out.withColumn("time_per_iteration", F.try_divide(F.col("vqe_time"), F.col("total_iterations"))) if "vqe_time" in groups else out


def longest_zero_run(df: DataFrame, flag: Column, name: str = "longest_plateau") -> DataFrame:
    """Longest stretch of consecutive steps without ``flag`` per run; 0 if there is none."""
    marked = df.select("run_id", "step", flag.cast("int").alias("f")).withColumn("g", F.sum("f").over(running()))
    runs = marked.groupBy("run_id", "g").agg(F.count_if(F.col("f") == 0).alias("n"))
    return runs.groupBy("run_id").agg(F.max("n").alias(name))


def tolerant_improvement(df: DataFrame, tolerance: float = TOLERANCE, seeded: bool = True) -> DataFrame:
    """(run_id, step, energy, steps_since): steps since the energy last fell by more than ``tolerance``.

    The state depends on the path, so a run is scanned in order, once, in Arrow batches of whole runs;
    ``seeded`` starts from the first energy (which then doesn't improve on itself), else the first step improves.
    """
    rows = df.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("step", "energy"))).alias("xs"))

    @F.pandas_udf("array<bigint>")
    def scan(energies: pd.Series) -> pd.Series:
        out = []
        for xs in energies:
            least, since, row = xs[0] if seeded and len(xs) and xs[0] is not None else np.inf, 0, []
            for x in xs:
                if x is not None and x < least - tolerance:
                    least, since = x, 0
                else:
                    since += 1
                row.append(since)
            out.append(row)
        return pd.Series(out)

    zipped = rows.select("run_id", F.arrays_zip(F.col("xs.step").alias("step"), F.col("xs.energy").alias("energy"), scan(F.col("xs.energy")).alias("since")).alias("z"))
    return zipped.select("run_id", F.explode("z").alias("r")).select("run_id", "r.step", "r.energy", F.col("r.since").alias("steps_since"))


def horizon_features(df: DataFrame, k: int) -> DataFrame:
    """One row per run from its first ``k`` steps only.  Needs energy, energy_delta, cumulative_min_energy, is_new_minimum, parameter_delta_norm."""
    if k < 1:
        raise ValueError("the horizon must be at least 1")
    early, step = df.where(F.col("step") <= k), F.col("step")
    plateau = longest_zero_run(early, F.col("is_new_minimum"), f"longest_plateau_k{k}")
    half = k // 2
    n = F.count(F.lit(1))
    columns = [
        n.alias("n_steps"),
        F.coalesce(F.regr_slope("energy", step.cast("double")), F.lit(0.0)).alias(f"energy_slope_k{k}"),
        *[F.max(F.when(step == i, F.col("energy_delta"))).alias(f"energy_delta_k{i}") for i in range(1, min(k, 5) + 1)],
        F.avg(F.when(step > k - 5, F.col("energy"))).alias(f"energy_mean_last5_k{k}"),
        F.coalesce(F.stddev_pop(F.when(step > k - 5, F.col("energy"))), F.lit(0.0)).alias(f"energy_std_last5_k{k}"),
        F.max_by("cumulative_min_energy", "step").alias(f"cumulative_min_energy_at_k{k}"),
        F.count_if("is_new_minimum").alias(f"num_new_minima_k{k}"),
        F.avg("parameter_delta_norm").alias(f"param_delta_norm_mean_k{k}"),
        F.coalesce(F.stddev_pop("parameter_delta_norm"), F.lit(0.0)).alias(f"param_delta_norm_std_k{k}"),
    ]
    if k >= 20:
        a = F.coalesce(F.sum(F.when(step <= half, F.col("energy_delta"))), F.lit(0.0))
        b = F.coalesce(F.sum(F.when(step > half, F.col("energy_delta"))), F.lit(0.0))
        columns.append((a / (a + b + 1e-12)).alias(f"improvement_ratio_k{k}"))
    return early.groupBy("run_id").agg(*columns).join(plateau, "run_id")


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise where any of ``columns`` is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def known_values(column: str, allowed: list[str]) -> Column:
    """The column; a value that isn't ``allowed`` is an error when it is read.  Null stays null."""
    c = F.col(column)
    return F.when(c.isNull() | c.isin(*allowed), c).otherwise(F.raise_error(F.concat(F.lit(f"unsupported {column}: "), c.cast("string"))).cast("string"))


#: Static columns of a run that features carry along where the table has them.
RUN_COLUMNS = ["molecule_name", "num_qubits", "optimizer", "basis_set", "init_strategy"]


def horizon_model_features(df: DataFrame, k: int, run: str = "run_id", step: str = "step") -> DataFrame:
    """One row per run: everything the convergence models read, from the first ``k`` steps only.

    Columns that the table lacks give their neutral values (no deltas, plateau ``k``, no movement, ratio 0.5).  Nulls
    don't count in means.  Signals at step ``k`` fall back on the last five steps, and on ``k``, where a run is shorter.
    """
    require_columns(df, [run, step, "energy"])
    if k < 1:
        raise ValueError("the horizon must be at least 1")
    have = set(df.columns)
    early = with_ends(df.withColumnsRenamed({run: "run_id", step: "step"}).where(F.col("step") <= k))
    s, delta, norm = F.col("step"), F.col("energy_delta") if "energy_delta" in have else F.lit(None).cast("double"), F.col("parameter_delta_norm") if "parameter_delta_norm" in have else F.lit(0.0)
    at_k = lambda c: F.max(F.when(s == k, F.col(c))) if c in have else F.lit(None).cast("double")
    recent = F.coalesce(F.stddev_pop(F.when(F.col("rn_desc") <= 5, F.col("energy"))), F.lit(0.0))
    half = lambda c: F.coalesce(F.sum(F.when(c, delta)), F.lit(0.0))
    columns = [
        *[F.max(F.when(s == i, delta)).alias(f"energy_delta_k{i}") for i in range(1, min(5, k) + 1)],
        F.coalesce(F.regr_slope("energy", F.col("rn_asc").cast("double")), F.lit(0.0)).alias(f"energy_slope_first{k}"),
        F.when(F.max(s == k) & F.lit("energy_moving_std_5" in have), at_k("energy_moving_std_5")).otherwise(recent).alias("energy_moving_std_5_at_k"),
        F.coalesce(at_k("steps_since_improvement").cast("double"), F.lit(float(k))).alias(f"steps_since_improvement_at_k{k}"),
        F.coalesce(F.avg(norm), F.lit(0.0)).alias(f"param_delta_norm_mean_k{k}"), F.coalesce(F.stddev_pop(norm), F.lit(0.0)).alias(f"param_delta_norm_std_k{k}"),
        *[F.min_by(c, "step").alias(c) for c in (*RUN_COLUMNS, "converged") if c in have],
    ]
    if k >= 20:
        a, b = half(s <= k // 2), half(s > k // 2)
        columns.append((a / (a + b + 1e-12) if "energy_delta" in have else F.lit(0.5)).alias(f"improvement_ratio_k{k}"))
    out = early.groupBy("run_id").agg(*columns)
    if "is_new_minimum" in have:
        out = out.join(longest_zero_run(early, F.col("is_new_minimum"), f"longest_plateau_first{k}"), "run_id")
    else:
        out = out.withColumn(f"longest_plateau_first{k}", F.lit(k))
    random = (F.lower(F.coalesce(F.col("init_strategy"), F.lit("random"))) == "random").cast("double") if "init_strategy" in have else F.lit(1.0)
    qubits = F.coalesce(F.col("num_qubits"), F.lit(0)).cast("double") if "num_qubits" in have else F.lit(0.0)
    return out.withColumns({"mean_param_delta_norm": F.col(f"param_delta_norm_mean_k{k}"), "init_strategy_random": random, "qubit_x_random": qubits * random}).withColumnRenamed("run_id", run)


def horizon_feature_names(k: int, columns: list[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) features of a horizon, those of ``columns`` only."""
    numeric = ["num_qubits", "mean_param_delta_norm", "init_strategy_random", "qubit_x_random", *[f"energy_delta_k{i}" for i in range(1, min(5, k) + 1)], f"energy_slope_first{k}", "energy_moving_std_5_at_k",
               f"steps_since_improvement_at_k{k}", f"longest_plateau_first{k}", f"param_delta_norm_mean_k{k}", f"param_delta_norm_std_k{k}", *([f"improvement_ratio_k{k}"] if k >= 20 else [])]
    return [c for c in numeric if c in columns], [c for c in ("optimizer", "basis_set") if c in columns]


#: Numeric and categorical features of ``prefix_model_features``.
PREFIX_NUMERIC = "cumulative_min_energy current_energy energy_slope energy_improvement_rate energy_delta_mean energy_delta_std energy_moving_std steps_since_improvement num_steps_observed num_qubits ansatz_reps trajectory_fraction".split()
PREFIX_CATEGORICAL = ["optimizer", "basis_set"]


def prefix_model_features(df: DataFrame, fraction: float, tolerance: float = TOLERANCE, run: str = "run_id", step: str = "step") -> DataFrame:
    """One row per run: everything the energy models read, from the first ``fraction`` of its steps, and final_energy where it is known."""
    require_columns(df, [run, step, "energy"])
    have = set(df.columns)
    rows = prefix_rows(df.withColumnsRenamed({run: "run_id", step: "step"}), fraction)
    rn, last5 = F.col("rn"), F.col("rn") > F.col("n_prefix") - 5
    delta = F.col("energy_delta") if "energy_delta" in have else F.abs(F.col("energy") - F.lag("energy").over(ordered()))
    rows = rows.withColumn("__d", delta)
    static = {"num_qubits": F.lit(0), "ansatz_reps": F.lit(1), "optimizer": F.lit("UNKNOWN"), "basis_set": F.lit("sto-3g"), "molecule_name": F.lit("UNKNOWN")}
    least = F.max_by("cumulative_min_energy", "rn") if "cumulative_min_energy" in have else F.min("energy")
    final = F.min_by("final_energy", "rn") if "final_energy" in have else F.max_by("minimum_energy", "rn") if "minimum_energy" in have else F.lit(None).cast("double")
    out = rows.groupBy("run_id").agg(
        least.alias("cumulative_min_energy"), F.max_by("energy", "rn").alias("current_energy"), F.coalesce(F.regr_slope("energy", rn.cast("double")), F.lit(0.0)).alias("energy_slope"), F.min_by("energy", "rn").alias("__e0"),
        F.coalesce(F.avg("__d"), F.lit(0.0)).alias("energy_delta_mean"), F.coalesce(F.stddev_pop("__d"), F.lit(0.0)).alias("energy_delta_std"), F.coalesce(F.stddev_pop(F.when(last5, F.col("energy"))), F.lit(0.0)).alias("energy_moving_std"),
        F.count(F.lit(1)).cast("double").alias("num_steps_observed"), F.array_sort(F.collect_list(F.struct("rn", "energy"))).alias("__xs"), final.alias("final_energy"),
        *[(F.coalesce(F.min_by(c, "rn"), d) if c in have else d).alias(c) for c, d in static.items()],
    )
    start = F.struct(F.col("__e0").alias("m"), F.lit(0.0).alias("n"))

    def advance(acc: Column, x: Column) -> Column:
        better = x["energy"] < acc["m"] - tolerance
        return F.struct(F.when(better, x["energy"]).otherwise(acc["m"]).alias("m"), F.when(better, F.lit(0.0)).otherwise(acc["n"] + 1.0).alias("n"))

    return out.select(
        "run_id", "molecule_name", "cumulative_min_energy", "current_energy", "energy_slope", ((F.col("__e0") - F.col("cumulative_min_energy")) / F.col("num_steps_observed")).alias("energy_improvement_rate"),
        "energy_delta_mean", "energy_delta_std", "energy_moving_std", F.aggregate("__xs", start, advance)["n"].alias("steps_since_improvement"), "num_steps_observed",
        F.col("num_qubits").cast("double").alias("num_qubits"), F.col("ansatz_reps").cast("double").alias("ansatz_reps"), F.lit(float(fraction)).alias("trajectory_fraction"), "optimizer", "basis_set", "final_energy",
    ).withColumnRenamed("run_id", run)


def prefix_rows(df: DataFrame, fraction: float) -> DataFrame:
    """The first max(1, ceil(n * fraction)) steps of each run, with rn (1-based) and n_prefix."""
    if not 0 < fraction <= 1:
        raise ValueError("the fraction must be in (0, 1]")
    n = F.count(F.lit(1)).over(Window.partitionBy("run_id"))
    keep = F.greatest(F.lit(1), F.ceil(n * F.lit(fraction)))
    return df.withColumns({"rn": F.row_number().over(ordered()), "n_prefix": keep}).where(F.col("rn") <= F.col("n_prefix"))


def fraction_features(df: DataFrame, fraction: float) -> DataFrame:
    """One row per run from a prefix of its steps; no look-ahead."""
    rows, index = prefix_rows(df, fraction), (F.col("rn") - 1).cast("double")
    last5 = F.col("rn") > F.col("n_prefix") - 5
    out = rows.groupBy("run_id").agg(
        F.max("n_prefix").cast("bigint").alias("steps_seen"), F.max_by("energy", "rn").alias("current_energy"), F.min("energy").alias("best_energy"),
        F.coalesce(F.regr_slope("energy", index), F.lit(0.0)).alias("energy_slope"),
        F.avg(F.when(last5, F.col("energy"))).alias("moving_avg_5"), F.coalesce(F.stddev_pop(F.when(last5, F.col("energy"))), F.lit(0.0)).alias("moving_std_5"),
        F.avg("energy_delta").alias("mean_energy_delta"), F.avg("parameter_delta_norm").alias("mean_param_delta_norm"),
        F.min_by("energy", "rn").alias("first_energy"),
    )
    return out.withColumn("improvement_rate", F.try_divide(F.col("first_energy") - F.col("best_energy"), F.col("steps_seen"))).drop("first_energy")


def best_step(df: DataFrame, *carry: str) -> DataFrame:
    """(run_id, best_energy, best_step, carried columns): the step of least energy, the earliest of equals."""
    row = F.min_by(F.struct("energy", "step", *carry), F.struct("energy", "step"))
    return df.where(F.col("energy").isNotNull()).groupBy("run_id").agg(row.alias("b")).select("run_id", F.col("b.energy").alias("best_energy"), F.col("b.step").alias("best_step"), *[F.col(f"b.{c}").alias(c) for c in carry])


def downsample(df: DataFrame, most: int) -> DataFrame:
    """Every stride-th step (stride n div most, at least 1) and the last one of each run."""
    n = F.count(F.lit(1)).over(Window.partitionBy("run_id"))
    rows = df.withColumns({"__n": n, "__r": F.row_number().over(ordered())})
    stride = F.greatest(F.lit(1), F.floor(F.col("__n") / F.lit(most)))
    return rows.where(((F.col("__r") - 1) % stride == 0) | (F.col("__r") == F.col("__n"))).drop("__n", "__r")


def evenly_spaced(df: DataFrame, points: int) -> DataFrame:
    """``points`` steps of each run at floor(i (n-1) / (points-1)); a run of fewer steps keeps all."""
    n = F.count(F.lit(1)).over(Window.partitionBy("run_id"))
    rows = df.withColumns({"__n": n, "__r": F.row_number().over(ordered()) - 1})
    wanted = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.floor(i * (F.col("__n") - 1) / F.lit(max(1, points - 1))))
    return rows.where((F.col("__n") <= points) | F.array_contains(wanted, F.col("__r").cast("bigint"))).drop("__n", "__r")


def null_key_gate(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key columns are all there, the others for quarantine)."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.where(~missing), df.where(missing)
