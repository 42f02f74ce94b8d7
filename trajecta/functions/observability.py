"""Derived metrics, exposition text, counter rates, alerts and batch status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import FileSystem


def accuracy(energy: Column, reference: Column) -> dict[str, Column]:
    """Error in hartree and millihartree, relative error in percent, and a logarithmic score from 0 to 100; all null without reference."""
    error = energy - reference
    size = F.abs(error)
    score = F.when(size < 1e-10, 100.0).otherwise(F.greatest(F.lit(0.0), 100.0 * (1 - F.log10(size * 1000.0 + 1) / 5)))
    return {
        "energy_error_hartree": error, "energy_error_millihartree": error * 1000.0,
        "relative_error_percent": F.try_divide(size, F.abs(reference)) * 100.0, "accuracy_score": F.when(error.isNotNull(), score),
    }


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def efficiency(iterations: Column, total: Column, vqe: Column, hamiltonian: Column, mapping: Column) -> dict[str, Column]:
    """Rates and ratios; each only where its operands are there and not zero."""
    setup = hamiltonian + mapping
    both = _truthy(iterations) & _truthy(vqe)
    return {
        "iterations_per_second": F.when(both, iterations / vqe), "time_per_iteration": F.when(both, vqe / iterations),
        "overhead_ratio": F.when(_truthy(total) & _truthy(vqe) & (vqe > 0), (total - vqe) / vqe), "efficiency_ratio": F.when(_truthy(total) & _truthy(vqe), vqe / total),
        "setup_ratio": F.when(_truthy(vqe) & _truthy(hamiltonian) & _truthy(mapping), F.coalesce(F.try_divide(setup, total), F.lit(0.0))),
    }


def label(value: Column) -> Column:
    """A label value with quotation marks escaped; null is empty."""
    return F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit('"'), F.lit('\\"'))


def exposition(name: str, labels: dict[str, Column], value: Column) -> Column:
    """One line of text exposition: name{label="value",...} number."""
    inner = F.concat_ws(",", *[F.concat(F.lit(f'{k}="'), label(v), F.lit('"')) for k, v in labels.items()])
    return F.concat(F.lit(f"{name}{{"), inner, F.lit("} "), value.cast("string"))


def numeric_lines(prefix: str, labels: dict[str, Column], values: dict[str, Column]) -> Column:
    """Array of exposition lines, one for each value that is a number: text counts if it reads as one, null and NaN don't."""
    number = lambda v: v.try_cast("double")
    lines = [F.when(number(v).isNotNull() & ~F.isnan(number(v)), exposition(prefix + name, labels, v)) for name, v in values.items()]
    return F.array_compact(F.array(*lines))


def run_lines(df: DataFrame, labels: list[str], values: list[str]) -> DataFrame:
    """(line): the exposition lines of runs: times, results, accuracy and the derived efficiency metrics.

    A missing label is ``unknown``.
    """
    named = {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in labels}
    derived = efficiency(*[F.col(c) for c in ("iterations_count", "total_time", "vqe_time", "hamiltonian_time", "mapping_time")])
    derived = {"vqe_efficiency" if k == "efficiency_ratio" else k: v for k, v in derived.items()}
    return df.select(F.explode(numeric_lines("qp_vqe_", named, {**{c: F.col(c) for c in values}, **derived})).alias("line"))


def system_lines(df: DataFrame, container: str, values: dict[str, str], prefix: str = "qp_sys_") -> DataFrame:
    """(line): exposition lines of system snapshots; ``values`` maps metric names to columns."""
    return df.select(F.explode(numeric_lines(prefix, {"container_type": F.col(container)}, {name: F.col(c) for name, c in values.items()})).alias("line"))


def context_lines(df: DataFrame, container: str, context: str, labels: list[str], prefix: str = "quantum_experiment_") -> DataFrame:
    """(line): one line for each entry of the map ``context`` that is a number; ``labels`` are its keys that become labels."""
    named = {"container_type": F.col(container), **{k: F.coalesce(F.try_element_at(F.col(context), F.lit(k)), F.lit("unknown")) for k in labels}}
    rows = df.select(*[c.alias(f"__l_{k}") for k, c in named.items()], F.explode(context).alias("k", "v")).where(F.col("v").try_cast("double").isNotNull())
    inner = F.concat_ws(",", *[F.concat(F.lit(f'{k}="'), label(F.col(f"__l_{k}")), F.lit('"')) for k in named])
    return rows.select(F.concat(F.lit(prefix), "k", F.lit("{"), inner, F.lit("} "), "v").alias("line"))


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics as JSON lines, appended."""
    df.write.mode("append").json(path)


def threshold_alerts(df: DataFrame, key: str, rules: dict[str, tuple[str, str, float]]) -> DataFrame:
    """(alert, key, value): rows that break a rule; ``rules`` maps names to (column, ``<``, ``>`` or ``=``, limit).  Nulls break none."""
    test = {"<": lambda c, x: c < x, ">": lambda c, x: c > x, "=": lambda c, x: c == x}
    found = [F.when(test[op](F.col(c).cast("double"), F.lit(float(limit))), F.struct(F.lit(name).alias("alert"), F.col(c).cast("double").alias("value"))) for name, (c, op, limit) in rules.items()]
    return df.select(key, F.explode(F.array_compact(F.array(*found))).alias("a")).select("a.alert", key, "a.value")


def idle_with_pending(samples: DataFrame, labels: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """(labels, pending): label sets whose ``in_progress`` is 0 while ``pending`` is above 0; a label set needs both samples."""
    sides = samples.where(F.col(name).isin("in_progress", "pending")).groupBy(*labels).agg(
        F.max(F.when(F.col(name) == "in_progress", F.col(value))).alias("busy"), F.max(F.when(F.col(name) == "pending", F.col(value))).alias("pending")
    )
    return sides.where("busy = 0 and pending > 0").select(*labels, "pending")


def label_sum(samples: DataFrame, label_column: str, pattern: str, by: list[str], value: str = "value") -> DataFrame:
    """(by, total): sum over the samples whose label matches ``pattern`` as a whole."""
    return samples.where(F.col(label_column).rlike(f"^(?:{pattern})$")).groupBy(*by).agg(F.sum(value).alias("total"))


def counter_increase(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Add ``increase``: growth since the previous sample of the key; after a reset the whole value, 0 for the first."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(ts))
    return df.withColumn("increase", F.when(before.isNull(), F.lit(0)).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before))


def windowed_rate(df: DataFrame, key: str, ts: str, window: str, slide: str | None = None) -> DataFrame:
    """(key, window_start, increase, rate per second) over tumbling or sliding windows of ``increase``."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    out = df.groupBy(key, w.alias("w")).agg(F.sum("increase").alias("increase"))
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return out.select(key, F.col("w.start").alias("window_start"), "increase", (F.col("increase") / seconds).alias("rate"))


def staleness(df: DataFrame, key: str, ts: str, now: Column, limit_s: int = 3600) -> DataFrame:
    """(key, last_seen, age_seconds, stale)."""
    age = F.unix_timestamp(now) - F.unix_timestamp("last_seen")
    return df.groupBy(key).agg(F.max(ts).alias("last_seen")).withColumn("age_seconds", age).withColumn("stale", F.col("age_seconds") > limit_s)


def ratio_alert(df: DataFrame, key: str, bad: Column, limit: float = 0.1) -> DataFrame:
    """(key, ratio, firing): share of rows that are bad."""
    return df.groupBy(key).agg(F.try_divide(F.count_if(bad).cast("double"), F.count(F.lit(1))).alias("ratio")).withColumn("firing", F.col("ratio") > limit)


def held_alerts(df: DataFrame, key: str, ts: str, condition: Column, hold_s: int) -> DataFrame:
    """(key, since, until, n): stretches of consecutive samples that meet the condition for at least ``hold_s`` seconds."""
    w = Window.partitionBy(key).orderBy(ts)
    marked = df.select(key, ts, F.coalesce(condition, F.lit(False)).alias("c"))
    grouped = marked.withColumn("g", F.row_number().over(w) - F.sum(F.col("c").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = grouped.where("c").groupBy(key, "g").agg(F.min(ts).alias("since"), F.max(ts).alias("until"), F.count(F.lit(1)).alias("n"))
    return runs.where(F.unix_timestamp("until") - F.unix_timestamp("since") >= hold_s).drop("g")


STATES = ("done", "failed", "in_progress", "timed_out")


def batch_status(runs: DataFrame, state: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Counts by state of the runs of a plan; a run without state is pending."""
    joined = runs.join(state.select(key, "state", "completed_at"), key, "left")
    counts = [F.count_if(F.col("state") == s).alias(s) for s in STATES]
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *counts, F.max(F.when(F.col("state") == "done", F.col("completed_at"))).alias("last_done")).withColumn(
        "pending", F.col("total") - F.col("done") - F.col("failed") - F.col("in_progress") - F.col("timed_out")
    )


def batch_progress(status: DataFrame) -> DataFrame:
    """(total, done, failed, in_progress, pending, done_percent): the whole batch, from ``batch_status`` by lane; whole percents."""
    sums = status.agg(*[F.sum(c).alias(c) for c in ("total", "done", "failed", "in_progress", "pending")])
    return sums.withColumn("done_percent", F.coalesce(F.floor(F.try_divide(F.col("done") * 100, F.col("total"))), F.lit(0)).cast("bigint"))


def batch_eta(state: DataFrame, pending: int | DataFrame, lanes: int = 3, last: int = 20) -> DataFrame:
    """(mean_seconds, eta_seconds) from the last completed runs; ``pending`` is a number or the one row of ``batch_progress``."""
    recent = state.where("state = 'done' and completed_at is not null and started_at is not null").orderBy(F.desc("completed_at"), "run_key").limit(last)
    mean = recent.agg(F.avg(F.unix_timestamp("completed_at") - F.unix_timestamp("started_at")).alias("mean_seconds"))
    if isinstance(pending, DataFrame):
        mean = mean.crossJoin(F.broadcast(pending.select(F.col("pending").alias("__p"))))  # one row each
        return mean.select("mean_seconds", (F.col("mean_seconds") * F.col("__p") / lanes).alias("eta_seconds"))
    return mean.withColumn("eta_seconds", F.col("mean_seconds") * pending / lanes)


STATE = "run_key string, state string, started_at timestamp, completed_at timestamp"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """(run_key, state, started_at, completed_at) of a batch-state file: one JSON object of objects by run key; none without a file."""
    if not FileSystem(spark, path).exists(path):
        return spark.createDataFrame([], STATE)
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", "map<string, struct<state: string, started_at: timestamp, completed_at: timestamp>>")).alias("run_key", "s"))
    return entries.select("run_key", F.coalesce("s.state", F.lit("pending")).alias("state"), "s.started_at", "s.completed_at")


def upsert_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """The state with each key's updates laid over it: a null in an update keeps what was there; new keys are added.

    ``updates`` has one row per key.
    """
    news = updates.select("run_key", *[F.col(c).alias(f"__{c}") for c in ("state", "started_at", "completed_at")])
    return state.join(news, "run_key", "full").select("run_key", *[F.coalesce(f"__{c}", c).alias(c) for c in ("state", "started_at", "completed_at")])


def save_state(state: DataFrame, path: str) -> None:
    """The state (the plan of a batch, not data) as one JSON object, replaced by one rename."""
    entry = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("run_key", F.struct("state", "started_at", "completed_at"))))))
    text = state.agg(entry.alias("j")).first()["j"]
    FileSystem(state.sparkSession, path).replace_text(path, text)


def run_key(*parts: Column, seed: Column) -> Column:
    return F.concat_ws("__", *parts, F.concat(F.lit("seed"), seed.cast("string")))


def run_matrix(lanes: DataFrame, *axes: DataFrame) -> DataFrame:
    """All combinations of a few small axes (the plan of a batch, not data)."""
    out = lanes
    for axis in axes:
        out = out.crossJoin(axis)
    return out


def phase_rank(column: str, order: list[str]) -> Column:
    """Place in a fixed order; values that aren't in it come last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column))
    return F.when(place == 0, len(order) + 1).otherwise(place)
