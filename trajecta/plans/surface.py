"""Queries over model features, sources, sinks, exposition, alerts, circuits and tracked runs, each with its DuckDB SQL where it has any."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics, observability
from ..operators import ingest, models, tracking, trajectory
from ..runtime import read_table, scratch_path
from ..settings import SENSITIVE
from ..sources import avro, readers
from ..sources import tables as table_store
from ..sources.tables import VersionedTable
from ..streaming import ingest as streams
from .reference import STEPS, runs
from .reference import features as event_features

NOW = datetime(2026, 1, 1)
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


# --- model features ---------------------------------------------------------------------------------------------

_DIMS = "SELECT c_custkey AS run_id, c_nationkey AS num_qubits, c_mktsegment AS optimizer, n_name AS basis_set, CASE WHEN c_custkey % 2 = 0 THEN 'Random' ELSE 'hf' END AS init_strategy, c_custkey % 3 AS converged, c_nationkey % 4 AS ansatz_reps FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"


def model_rows(spark: SparkSession, base: str) -> DataFrame:
    """Iteration features of event runs with the static columns of their customers."""
    nation = read_table(spark, base, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("basis_set"))
    dims = read_table(spark, base, "customer").join(nation, "c_nationkey", "left").select(
        F.col("c_custkey").alias("run_id"), F.col("c_nationkey").alias("num_qubits"), F.col("c_mktsegment").alias("optimizer"), "basis_set",
        F.when(F.col("c_custkey") % 2 == 0, "Random").otherwise("hf").alias("init_strategy"), (F.col("c_custkey") % 3).alias("converged"), (F.col("c_nationkey") % 4).alias("ansatz_reps"),
    )
    return event_features(spark, base).join(dims, "run_id")


def _horizon_sql(k: int) -> str:
    first, second = (f"coalesce(sum(energy_delta) FILTER (step {c} {k // 2}), 0)" for c in ("<=", ">"))
    deltas = ", ".join(f"max(energy_delta) FILTER (step = {i}) AS energy_delta_k{i}" for i in range(1, 6))
    ratio = f", round({first} / ({first} + {second} + 1e-12), 9) AS improvement_ratio_k{k}" if k >= 20 else ""
    return STEPS.rstrip() + f""", e AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS back FROM f WHERE step <= {k}),
  a AS (SELECT run_id, {deltas}, round(CASE WHEN count(*) > 1 THEN regr_slope(energy, step) ELSE 0 END, 9) AS energy_slope_first{k},
    round(CASE WHEN max(step) = {k} THEN max(energy_moving_std_5) FILTER (step = {k}) ELSE coalesce(stddev_pop(energy) FILTER (back <= 5), 0) END, 9) AS energy_moving_std_5_at_k,
    CAST(coalesce(max(steps_since_improvement) FILTER (step = {k}), {k}) AS DOUBLE) AS steps_since_improvement_at_k{k},
    round(coalesce(avg(parameter_delta_norm), 0), 9) AS param_delta_norm_mean_k{k}, round(coalesce(stddev_pop(parameter_delta_norm), 0), 9) AS param_delta_norm_std_k{k}{ratio} FROM e GROUP BY run_id),
  g AS (SELECT run_id, sum(CASE WHEN is_new_minimum THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY step) AS g, is_new_minimum FROM e),
  p AS (SELECT run_id, max(n) AS longest_plateau_first{k} FROM (SELECT run_id, count(*) FILTER (NOT is_new_minimum) AS n FROM g GROUP BY run_id, g) GROUP BY run_id), d AS ({_DIMS})
SELECT a.*, longest_plateau_first{k}, num_qubits, optimizer, basis_set, init_strategy, converged, param_delta_norm_mean_k{k} AS mean_param_delta_norm,
  CASE WHEN init_strategy = 'Random' THEN 1.0 ELSE 0.0 END AS init_strategy_random, CASE WHEN init_strategy = 'Random' THEN CAST(num_qubits AS DOUBLE) ELSE 0.0 END AS qubit_x_random
FROM a JOIN p USING (run_id) JOIN d USING (run_id)"""


def _horizon(k: int):
    def run(spark, base):
        out = trajectory.horizon_model_features(model_rows(spark, base), k)
        rounded = [f"energy_slope_first{k}", "energy_moving_std_5_at_k", f"param_delta_norm_mean_k{k}", f"param_delta_norm_std_k{k}", "mean_param_delta_norm", *([f"improvement_ratio_k{k}"] if k >= 20 else [])]
        return out.withColumns({c: F.round(c, 9) for c in rounded})

    return run


for _k in (10, 20, 50):
    query(f"model_horizon_k{_k}", _horizon_sql(_k))(_horizon(_k))


def _prefix_sql(fraction: float) -> str:
    return "WITH RECURSIVE " + STEPS.removeprefix("WITH ").rstrip() + f""", u AS (SELECT *, count(*) OVER (PARTITION BY run_id) AS total FROM f), e AS (SELECT * FROM u WHERE step <= greatest(1, ceil(total * {fraction}))),
  t AS (SELECT run_id, step, energy AS m, CAST(1 AS BIGINT) AS n FROM e WHERE step = 1
    UNION ALL SELECT e.run_id, e.step, CASE WHEN e.energy < t.m - 1e-8 THEN e.energy ELSE t.m END, CASE WHEN e.energy < t.m - 1e-8 THEN 0 ELSE t.n + 1 END FROM t JOIN e ON e.run_id = t.run_id AND e.step = t.step + 1),
  a AS (SELECT run_id, arg_max(cumulative_min_energy, step) AS cumulative_min_energy, arg_max(energy, step) AS current_energy, round(CASE WHEN count(*) > 1 THEN regr_slope(energy, step) ELSE 0 END, 9) AS energy_slope,
    round((arg_min(energy, step) - arg_max(cumulative_min_energy, step)) / count(*), 9) AS energy_improvement_rate, round(coalesce(avg(energy_delta), 0), 9) AS energy_delta_mean, round(coalesce(stddev_pop(energy_delta), 0), 9) AS energy_delta_std,
    round(coalesce(stddev_pop(energy) FILTER (step > greatest(1, ceil(total * {fraction})) - 5), 0), 9) AS energy_moving_std, CAST(count(*) AS DOUBLE) AS num_steps_observed FROM e GROUP BY run_id),
  l AS (SELECT run_id, CAST(arg_max(n, step) AS DOUBLE) AS steps_since_improvement FROM t GROUP BY run_id), d AS ({_DIMS})
SELECT run_id, 'UNKNOWN' AS molecule_name, cumulative_min_energy, current_energy, energy_slope, energy_improvement_rate, energy_delta_mean, energy_delta_std, energy_moving_std, steps_since_improvement, num_steps_observed,
  CAST(num_qubits AS DOUBLE) AS num_qubits, CAST(ansatz_reps AS DOUBLE) AS ansatz_reps, CAST({fraction} AS DOUBLE) AS trajectory_fraction, optimizer, basis_set FROM a JOIN l USING (run_id) JOIN d USING (run_id)"""


def _prefix(fraction: float):
    def run(spark, base):
        out = trajectory.prefix_model_features(model_rows(spark, base), fraction).drop("final_energy")
        return out.withColumns({c: F.round(c, 9) for c in ("energy_slope", "energy_improvement_rate", "energy_delta_mean", "energy_delta_std", "energy_moving_std")})

    return run


for _f in (0.25, 0.5, 0.75):
    query(f"model_prefix_{int(_f * 100)}", _prefix_sql(_f))(_prefix(_f))


_RIDGE = STEPS.rstrip() + """, x AS (SELECT run_id, CASE WHEN count(*) > 1 THEN regr_slope(energy, step) ELSE 0 END AS x FROM s WHERE step <= 10 GROUP BY run_id), y AS (SELECT run_id, min(energy) AS y FROM s GROUP BY run_id),
  r AS (SELECT run_id, x, y, c_mktsegment AS g FROM x JOIN y USING (run_id) JOIN customer ON run_id = c_custkey),
  t AS (SELECT h.g, avg(r.x) AS mx, stddev_pop(r.x) AS sx, avg(r.y) AS my, count(*) AS n, covar_pop(r.x, r.y) AS c FROM (SELECT DISTINCT g FROM r) h JOIN r ON r.g <> h.g GROUP BY h.g)
SELECT 'ridge' AS model, r.g AS held_out, run_id, y AS label, round(my + n * c / sx / (n + 1) * (x - mx) / sx, 5) AS score FROM r JOIN t USING (g)"""


@query("ridge_fold_predictions", _RIDGE)
def ridge_fold_predictions(spark, base):
    """Ridge on one feature, a segment left out at a time: what each fold says of the rows it hasn't seen."""
    rows = event_features(spark, base)
    x = rows.where("step <= 10").groupBy("run_id").agg(F.coalesce(F.regr_slope("energy", F.col("step").cast("double")), F.lit(0.0)).alias("x"))
    y = rows.groupBy("run_id").agg(F.min("energy").alias("y"))
    segment = read_table(spark, base, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("segment"))
    frame = x.join(y, "run_id").join(segment, "run_id")
    fitted = models.fit_regressors(frame, ["x"], [], "segment", "y", {"ridge": lambda n, std: models.ridge(n, std, label="y")}, key="run_id")
    return fitted.predictions().withColumn("score", F.round("score", 5))


@query("best_by_lowest", "SELECT c_acctbal, c_custkey, c_mktsegment FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_acctbal, c_custkey LIMIT 1")
def best_by_lowest(spark, base):
    return metrics.best_by(read_table(spark, base, "customer"), "c_acctbal", ["c_custkey", "c_mktsegment"], higher=False)


@query("exact_median_by_counting", "SELECT median(l_extendedprice) AS price, median(l_quantity) AS quantity FROM lineitem")
def exact_median_by_counting(spark, base):
    """The way for tables of any size, whatever the size of this one."""
    found = metrics.exact_medians(read_table(spark, base, "lineitem"), ["l_extendedprice", "l_quantity"], one_task=0)
    return spark.createDataFrame([tuple(found.values())], "price double, quantity double")


# --- sources -----------------------------------------------------------------------------------------------------

_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


def _orders(spark, base) -> DataFrame:
    return read_table(spark, base, "orders")


@query("topic_by_hour", "SELECT o_orderkey, o_totalprice, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders WHERE year(o_orderdate) = 1995")
def topic_by_hour(spark, base):
    """Records laid out by year, month, day and hour; the filter on the folders' columns reads one year's folders."""
    bucket = scratch_path(spark, "bucket")
    parts = {n: F.date_format("o_orderdate", p) for n, p in (("year", "yyyy"), ("month", "MM"))} | {"day": F.lit("01"), "hour": F.lit("00")}
    _orders(spark, base).withColumns(parts).drop("o_orderdate", "o_orderpriority").write.partitionBy("year", "month", "day", "hour").json(f"{bucket}/orders")
    return readers.read_topic(spark, bucket, "orders", spark.createDataFrame([], _ORDERS).schema, readers.BY_HOUR).where("year = 1995").select("o_orderkey", "o_totalprice", "year", "month")


@query("topic_by_partition", "SELECT o_orderkey, o_totalprice, CAST(o_orderkey % 4 AS INTEGER) AS partition FROM orders WHERE o_orderkey % 4 > 1")
def topic_by_partition(spark, base):
    """The older layout, Avro and JSON side by side: partition=<n> folders."""
    bucket, rows = scratch_path(spark, "bucket"), _orders(spark, base).withColumn("partition", F.col("o_orderkey") % 4).drop("o_orderdate", "o_orderpriority")
    rows.write.partitionBy("partition").parquet(f"{bucket}/orders")
    kind = spark.createDataFrame([], _ORDERS).schema
    return readers.read_topic(spark, bucket, "orders", kind, readers.BY_PARTITION, num_partitions=4).where("partition > 1").select("o_orderkey", "o_totalprice", "partition")


@query("spool_replay", "SELECT c_custkey AS molecule_id, c_name, c_acctbal FROM customer")
def spool_replay(spark, base):
    """Every delivery fails: all records come back from the spool."""
    spool = scratch_path(spark, "spool")
    rows = read_table(spark, base, "customer").select((F.col("c_custkey") % 5).alias("lane"), F.col("c_custkey").alias("molecule_id"), "c_name", "c_acctbal")

    def refuse(batch: DataFrame) -> None:
        raise OSError("the broker is away")

    if streams.deliver(rows, refuse, spool, "lane", attempts=2, pause=0.0):
        raise RuntimeError("delivered to nobody")
    return readers.replay_spool(spark, spool, rows.drop("lane").schema)


@query("schema_store_decode", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice FROM orders")
def schema_store_decode(spark, base):
    """Two versions of a subject in the store; each message is decoded by the version it was written with."""
    store = avro.SchemaStore(scratch_path(spark, "schemas"), spark)
    rows = _orders(spark, base).select("o_orderkey", "o_orderstatus", "o_totalprice")
    old, new = rows.where("o_orderkey % 2 = 1").drop("o_totalprice"), rows.where("o_orderkey % 2 = 0")
    ids = [store.register("orders", avro.avro_schema(df.schema)) for df in (old, new)]
    frames = avro.encode_frames(old, ids[0]).unionByName(avro.encode_frames(new, ids[1]))
    return avro.decode_frames(frames, store.by_id(), rows.schema).drop("decode_error")


@query("avro_logical_types", "SELECT o_orderkey, o_orderdate, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price FROM orders")
def avro_logical_types(spark, base):
    """Timestamps, dates and decimals through the codec."""
    rows = _orders(spark, base).select("o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    frames = avro.encode_frames(rows, 1)
    return avro.decode_frames(frames, {1: avro.avro_schema(rows.schema)}, rows.schema).drop("decode_error").withColumns({"price": F.col("price").cast("double"), "day": F.col("day").cast("string")})


@query("synthetic_runs", "SELECT 300 AS n_runs, 0 AS n_bad")
def synthetic_runs(spark, base):
    """The classifier's generator: 300 runs of 55 to 100 steps from 1, with a running minimum."""
    per = readers.synthetic_trajectories(spark).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.min("step").alias("lo"), F.max("step").alias("hi"), F.min("energy").alias("e"), F.min("cumulative_min_energy").alias("m"))
    return per.agg(F.count(F.lit(1)).cast("int").alias("n_runs"), F.count_if(~F.col("n").between(55, 100) | (F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("e") != F.col("m"))).cast("int").alias("n_bad"))


@query("synthetic_regressor_runs", "SELECT 300 AS n_runs, 0 AS n_bad, 6 AS n_molecules")
def synthetic_regressor_runs(spark, base):
    """The regressor's generator: 300 runs, steps from 0, the final energy is the least one."""
    per = readers.synthetic_regressor_trajectories(spark).groupBy("experiment_id", "molecule_name").agg(F.count(F.lit(1)).alias("n"), F.min("iteration_step").alias("lo"), F.max("iteration_step").alias("hi"), F.min("energy").alias("e"), F.max("final_energy").alias("f"))
    bad = (F.col("n") > 150) | (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("e") != F.col("f"))
    return per.agg(F.count(F.lit(1)).cast("int").alias("n_runs"), F.count_if(bad).cast("int").alias("n_bad"), F.count_distinct("molecule_name").cast("int").alias("n_molecules"))


@query("container_stats", "SELECT 'c' || event_id AS name, CAST(user_id AS DOUBLE) AS cpu_percent, '1MiB' AS memory_used, '2GiB' AS memory_limit, CASE WHEN event_type <> 'error' THEN CAST(user_id % 7 AS DOUBLE) END AS memory_percent, '1kB / 2kB' AS net_io, event_type AS block_io FROM events")
def container_stats(spark, base):
    """Tab-separated statistics, one line per event; what isn't a number is null."""
    percent = F.when(F.col("event_type") == "error", F.lit("--")).otherwise(F.concat((F.col("user_id") % 7).cast("string"), F.lit("%")))
    lines = read_table(spark, base, "events").select(F.concat_ws("\t", F.concat(F.lit("c"), "event_id"), F.concat(F.col("user_id").cast("string"), F.lit("%")), F.lit("1MiB / 2GiB"), percent, F.lit("1kB / 2kB"), "event_type").alias("line"))
    head = spark.createDataFrame([("NAME\tCPU %\tMEM",), ("",)], "line string")
    return readers.container_stats(lines.unionByName(head))


# --- tables and sinks --------------------------------------------------------------------------------------------


@query("catalog_audit", "SELECT table_name, n FROM (SELECT unnest(['orders', 'customer']) AS table_name, unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM customer)]) AS n)")
def catalog_audit(spark, base):
    """The audit table in the session's catalog: created if missing, written, read by name."""
    name = "audit_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    for _ in range(2):
        table_store.create_audit_table(spark, name, scratch_path(spark, "audit"))
    counts = {t: (None, read_table(spark, base, t).count()) for t in ("orders", "customer")}
    table_store.audit_row(spark, "b", "base_processing", NOW, counts, "").write.insertInto(name)
    found = table_store.catalog_tables(spark, [name, "no_such_table"])
    return found[name].select(F.explode(F.arrays_zip("table_names", "record_counts")).alias("z")).select(F.col("z.table_names").alias("table_name"), F.col("z.record_counts").alias("n"))


@query("export_mirror", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def export_mirror(spark, base):
    target = scratch_path(spark, "mirror")
    table_store.export(_orders(spark, base).select("o_orderkey", "o_orderstatus", "o_totalprice"), target, ["o_orderstatus"])
    return spark.read.parquet(target).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("object_sink_hourly", "SELECT event_id, user_id, hour(ts) AS hour FROM events WHERE hour(ts) < 6")
def object_sink_hourly(spark, base):
    """Events streamed to folders by hour; the read prunes to six hours of each day."""
    events = read_table(spark, base, "events").select("event_id", "user_id", "ts")
    folder, out = scratch_path(spark, "events"), scratch_path(spark, "sink")
    events.write.parquet(folder)
    streams.object_sink(streams.file_stream(spark, folder, events.schema, "parquet"), f"{out}/events", scratch_path(spark, "offsets"), "ts")
    kind = spark.createDataFrame([], "event_id bigint, user_id bigint").schema
    return readers.read_topic(spark, out, "events", kind, readers.BY_HOUR).where("hour < 6").select("event_id", "user_id", "hour")


@query("quarantine_stream", "SELECT 'good' AS side, count(*) AS n FROM orders UNION ALL SELECT 'bad', count(*) FROM orders WHERE o_orderkey % 10 = 0")
def quarantine_stream(spark, base):
    """Framed messages from a stream, some spoilt: bad ones are kept apart and stop nothing."""
    rows, folder = _orders(spark, base).select("o_orderkey", "o_totalprice"), scratch_path(spark, "frames")
    frames = avro.encode_frames(rows, 5)
    frames.unionByName(rows.where("o_orderkey % 10 = 0").select(F.concat(F.lit(b"\x07"), F.col("o_orderkey").cast("string").cast("binary")).alias("message"))).write.parquet(folder)
    stream = streams.decoded(streams.file_stream(spark, folder, frames.schema, "parquet"), {5: avro.avro_schema(rows.schema)}, rows.schema)
    good, bad = (VersionedTable(spark, scratch_path(spark, n)) for n in ("good", "bad"))
    streams.quarantine_sink(stream, "decode_error", good, bad, scratch_path(spark, "offsets"))
    counts = [t.read().select(F.lit(n).alias("side")) for n, t in (("good", good), ("bad", bad))]
    return counts[0].unionByName(counts[1]).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def _event_stream(spark, base, *more: DataFrame) -> DataFrame:
    events = read_table(spark, base, "events").select("event_id", "user_id", "ts")
    folder = scratch_path(spark, "events")
    for df in (events, *more):
        df.write.mode("append").parquet(folder)
    return streams.file_stream(spark, folder, events.schema, "parquet")


@query("stream_unique", "SELECT event_id, user_id FROM events")
def stream_unique(spark, base):
    """Every event delivered twice; one copy comes through."""
    again, out = read_table(spark, base, "events").select("event_id", "user_id", "ts"), scratch_path(spark, "unique")
    streams.object_sink(streams.unique_messages(_event_stream(spark, base, again), "event_id", "ts", "3650 days"), out, scratch_path(spark, "offsets"), file_format="parquet")
    return spark.read.parquet(out).select("event_id", "user_id")


_MARK = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query("stream_windows", f"SELECT user_id, CAST(epoch(w) AS BIGINT) AS window_start, n FROM (SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS w, count(*) AS n FROM events GROUP BY 1, 2) WHERE w + INTERVAL 1 HOUR <= {_MARK}")
def stream_windows(spark, base):
    """Counts of the windows that the watermark has passed."""
    out = scratch_path(spark, "windows")
    streams.object_sink(streams.windowed_counts(_event_stream(spark, base), "user_id", "ts", "1 hour"), out, scratch_path(spark, "offsets"), file_format="parquet")
    return spark.read.schema("user_id bigint, window_start timestamp, n bigint").parquet(out).withColumn("window_start", F.unix_timestamp("window_start"))


@query("tracked_runs", "SELECT 'ridge' AS name, 'finished' AS status, 2 AS n_params, 3 AS n_metrics, CAST((SELECT count(*) FROM orders) AS DOUBLE) AS n_rows UNION ALL SELECT 'boosted', 'failed', 0, 0, NULL")
def tracked_runs(spark, base):
    t = tracking.Tracker(spark, scratch_path(spark, "tracked"))
    t.log("ridge", NOW, {"alpha": 1.0, "fraction": 0.5}, {"n_rows": _orders(spark, base).count(), "nan": float("nan"), "text": "x"}, [("loss", 1, 0.5), ("loss", 2, 0.25)])
    t.log("boosted", NOW, status="failed")
    params, values = (t.read(n).groupBy("tracked_run").agg(F.count(F.lit(1)).cast("int").alias(c), *x) for n, c, x in (("params", "n_params", []), ("metrics", "n_metrics", [F.max(F.when(F.col("key") == "n_rows", F.col("value"))).alias("n_rows")])))
    rows = t.read("runs").join(params, "tracked_run", "left").join(values, "tracked_run", "left")
    return rows.select("name", "status", F.coalesce("n_params", F.lit(0)).alias("n_params"), F.coalesce("n_metrics", F.lit(0)).alias("n_metrics"), "n_rows")


@query("volume_check", """WITH r AS (SELECT * FROM vqe_runs WHERE experiment_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY experiment_id ORDER BY record_id) = 1),
  i AS (SELECT sum(len([x for x in vqe_result.iteration_list if x IS NOT NULL])) AS n, count(*) AS m FROM r)
  SELECT 2 AS tables, CAST((n > 0) AS INTEGER) + CAST((m > 0) AS INTEGER) AS tables_with_new, 'vqe_results=' || m || ', vqe_iterations=' || CAST(n AS BIGINT) AS summary, n < m AS short FROM i""")
def volume_check(spark, base):
    tables = ingest.normal_tables(runs(spark, base))
    report = ingest.volume_report({n: tables[n].count() for n in ("vqe_results", "vqe_iterations")})
    return spark.createDataFrame([(report["tables"], report["tables_with_new"], report["summary"], report["warning"] is not None)], "tables int, tables_with_new int, summary string, short boolean")


# --- exposition, metric files, alerts ----------------------------------------------------------------------------

_LABELS = "molecule_id=\"' || coalesce(CAST(molecule_id AS VARCHAR), 'unknown') || '\",basis_set=\"' || coalesce(replace(basis_set, '\"', '\\\"'), 'unknown') || '\"} '"


@query("run_exposition", "SELECT 'qp_vqe_' || m || '{" + _LABELS + """ || v AS line FROM (
  SELECT molecule_id, basis_set, unnest(['total_time', 'iterations_count', 'iterations_per_second', 'time_per_iteration', 'overhead_ratio', 'vqe_efficiency', 'setup_ratio']) AS m, unnest([t, n, CASE WHEN n <> 0 AND v <> 0 THEN n // v END, CASE WHEN n <> 0 AND v <> 0 THEN v // n END, CASE WHEN t <> 0 AND v > 0 THEN (t - v) // v END, CASE WHEN t <> 0 AND v <> 0 THEN v // t END, CASE WHEN v <> 0 AND h <> 0 AND p <> 0 THEN coalesce((h + p) // nullif(t, 0), 0) END]) AS v
  FROM (SELECT molecule_id, basis_set, CAST(len(vqe_result.iteration_list) AS BIGINT) AS n, CAST(floor(total_time) AS BIGINT) AS t, CAST(floor(vqe_time) AS BIGINT) AS v, CAST(floor(hamiltonian_time) AS BIGINT) AS h, CAST(floor(mapping_time) AS BIGINT) AS p FROM vqe_runs)) WHERE v IS NOT NULL""")
def run_exposition(spark, base):
    """Lines of every run, numbers cut to whole ones so that their text is the same anywhere."""
    whole = {c: F.floor(c).cast("bigint") for c in ("total_time", "vqe_time", "hamiltonian_time", "mapping_time")}
    rows = read_table(spark, base, "vqe_runs").withColumn("iterations_count", F.when(F.col("vqe_result.iteration_list").isNotNull(), F.size("vqe_result.iteration_list")).cast("bigint")).withColumns(whole)
    lines = observability.run_lines(rows, ["molecule_id", "basis_set"], ["total_time", "iterations_count"])
    number = F.regexp_extract("line", r"\} (\S+)$", 1)
    cut = F.floor(number.cast("double") + F.lit(1e-12)).cast("string")
    return lines.select(F.concat(F.regexp_extract("line", r"^(.*\} )", 1), cut).alias("line"))


@query("system_exposition", """SELECT 'qp_sys_' || m || '{container_type="' || event_type || '"} ' || v AS line FROM (SELECT event_type, unnest(['cpu_percent', 'memory_used_bytes']) AS m, unnest([user_id, CASE WHEN event_id % 3 > 0 THEN event_id END]) AS v FROM events) WHERE v IS NOT NULL""")
def system_exposition(spark, base):
    rows = read_table(spark, base, "events").withColumn("used", F.when(F.col("event_id") % 3 > 0, F.col("event_id")))
    return observability.system_lines(rows, "event_type", {"cpu_percent": "user_id", "memory_used_bytes": "used"})


@query("context_exposition", """SELECT 'quantum_experiment_' || k || '{container_type="cpu",basis_set="' || event_type || '",backend_type="unknown"} ' || v AS line FROM (SELECT event_type, unnest(['user', 'event']) AS k, unnest([user_id, event_id]) AS v FROM events)""")
def context_exposition(spark, base):
    """Only entries that are numbers become lines; the others may be labels."""
    context = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("event"), F.col("event_id").cast("string"), F.lit("basis_set"), "event_type", F.lit("note"), F.lit("n/a"))
    rows = read_table(spark, base, "events").select(F.lit("cpu").alias("container"), context.alias("context"))
    return observability.context_lines(rows, "container", "context", ["basis_set", "backend_type"])


@query("metrics_file", "SELECT user_id, n, total FROM (SELECT user_id, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY user_id) UNION ALL SELECT -1, (SELECT count(*) FROM events), 0.0")
def metrics_file(spark, base):
    """Metrics appended to a JSON file in two goes and read back."""
    path, events = scratch_path(spark, "metrics"), read_table(spark, base, "events")
    observability.write_metrics(events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")), path)
    observability.write_metrics(events.agg(F.count(F.lit(1)).alias("n")).select(F.lit(-1).alias("user_id"), "n", F.lit(0.0).alias("total")), path)
    return spark.read.schema("user_id bigint, n bigint, total double").json(path)


@query("threshold_alerts", "SELECT 'low' AS alert, event_id, value FROM events WHERE value < 2 UNION ALL SELECT 'high', event_id, value FROM events WHERE value > 95 UNION ALL SELECT 'down', event_id, CAST(user_id AS DOUBLE) FROM events WHERE user_id = 0")
def threshold_alerts(spark, base):
    return observability.threshold_alerts(read_table(spark, base, "events"), "event_id", {"low": ("value", "<", 2), "high": ("value", ">", 95), "down": ("user_id", "=", 0)})


_SAMPLES = "SELECT n_name AS lane, unnest(['in_progress', 'pending']) AS metric, unnest([n_regionkey % 3, n_nationkey % 4]) AS value FROM nation"


def _samples(spark, base) -> DataFrame:
    rows = read_table(spark, base, "nation").select(F.col("n_name").alias("lane"), F.explode(F.map_from_arrays(F.array(F.lit("in_progress"), F.lit("pending")), F.array(F.col("n_regionkey") % 3, F.col("n_nationkey") % 4))).alias("metric", "value"))
    return rows


@query("idle_with_pending", f"SELECT p.lane, p.value AS pending FROM ({_SAMPLES}) b JOIN ({_SAMPLES}) p USING (lane) WHERE b.metric = 'in_progress' AND p.metric = 'pending' AND b.value = 0 AND p.value > 0")
def idle_with_pending(spark, base):
    return observability.idle_with_pending(_samples(spark, base), ["lane"])


@query("label_sums", f"SELECT metric, CAST(sum(value) AS BIGINT) AS total FROM ({_SAMPLES}) WHERE regexp_full_match(lane, '.*1|.*7') GROUP BY metric")
def label_sums(spark, base):
    return observability.label_sum(_samples(spark, base), "lane", ".*1|.*7", ["metric"])


# --- circuits, geometry, complex numbers, names --------------------------------------------------------------------


@query("circuit_features", "SELECT s_suppkey, 3 AS qubits, 2 AS clbits, CAST(s_nationkey % 6 + 3 AS INTEGER) AS depth, CAST(s_nationkey % 6 + 3 AS INTEGER) AS n_gates FROM supplier")
def circuit_features(spark, base):
    """A chain of gates on one bit, a two-bit gate and a measurement: each adds one to the depth."""
    chain = F.expr("repeat('rx(0.1) q[0]; ', cast(s_nationkey % 6 as int))")
    text = F.concat(F.lit("OPENQASM 3.0; include \"stdgates.inc\"; qubit[3] q; bit[2] c; "), chain, F.lit("cx q[0], q[1]; barrier q; cx q[1], q[2]; c[0] = measure q[2];"))
    return metrics.circuit_features(read_table(spark, base, "supplier").select("s_suppkey", text.alias("qasm")), "s_suppkey", "qasm")


@query("coordinate_bounds", """WITH p AS (SELECT molecule_id, unnest(coords) AS c FROM molecule_catalog), x AS (SELECT molecule_id, unnest([0, 1, 2]) AS axis, unnest(c) AS x FROM p),
  a AS (SELECT molecule_id, axis, min(x) AS min_coord, max(x) AS max_coord, avg(x) AS mean_coord FROM x GROUP BY 1, 2), h AS (SELECT *, max(max_coord - min_coord) OVER (PARTITION BY molecule_id) / 2 * 1.3 AS h FROM a)
  SELECT molecule_id, axis, min_coord, max_coord, round(mean_coord, 6) AS mean_coord, round(mean_coord - h, 6) AS low, round(mean_coord + h, 6) AS high FROM h""")
def coordinate_bounds(spark, base):
    out = metrics.coordinate_bounds(read_table(spark, base, "molecule_catalog"), "molecule_id", "coords")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_coord", "low", "high")})


@query("atom_sizes", "SELECT molecule_id, place, round(500 * (1 + ln(m / least)), 6) AS size FROM (SELECT molecule_id, list_min(masses) AS least, unnest(masses) AS m, unnest(range(len(masses))) AS place FROM molecule_catalog) WHERE m IS NOT NULL")
def atom_sizes(spark, base):
    rows = read_table(spark, base, "molecule_catalog").select("molecule_id", F.posexplode(metrics.atom_sizes(F.col("masses"))).alias("place", "size"))
    return rows.where("size is not null").select("molecule_id", F.col("place").cast("bigint").alias("place"), F.round("size", 6).alias("size"))


@query("graph_names", "SELECT molecule_id, 'energy_' || array_to_string(symbols, '_') AS graph_name FROM molecule_catalog")
def graph_names(spark, base):
    return read_table(spark, base, "molecule_catalog").select("molecule_id", F.concat_ws("_", F.lit("energy"), F.array_join("symbols", "_")).alias("graph_name"))


@query("redacted_settings", "SELECT c_custkey, CASE WHEN k IN ('API_Token', 'db_password') THEN '***' ELSE v END AS v, k FROM (SELECT c_custkey, unnest(['API_Token', 'db_password', 'segment']) AS k, unnest([c_name, c_name, c_mktsegment]) AS v FROM customer)")
def redacted_settings(spark, base):
    pattern = "|".join(SENSITIVE.split())
    settings = F.create_map(F.lit("API_Token"), "c_name", F.lit("db_password"), "c_name", F.lit("segment"), "c_mktsegment")
    shown = F.transform_values(settings, lambda k, v: F.when(F.lower(k).rlike(pattern), "***").otherwise(v))
    return read_table(spark, base, "customer").select("c_custkey", F.explode(shown).alias("k", "v"))


@query("known_values", "SELECT o_orderkey, o_orderstatus FROM orders")
def known_values(spark, base):
    return _orders(spark, base).select("o_orderkey", trajectory.known_values("o_orderstatus", ["F", "O", "P"]).alias("o_orderstatus"))


@query("sorted_results", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2 ORDER BY 1, 2")
def sorted_results(spark, base):
    return read_table(spark, base, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n")).orderBy("c_mktsegment", "c_nationkey")


@query("total_energies", "SELECT round(avg(minimum + coalesce(nuclear_repulsion_energy, 0)), 6) AS mean_total FROM (SELECT vqe_result.minimum AS minimum, vqe_result.nuclear_repulsion_energy AS nuclear_repulsion_energy FROM vqe_runs)")
def total_energies(spark, base):
    """Total energies: the minimum and the nuclear repulsion, where it is known."""
    rows = read_table(spark, base, "vqe_runs").select(F.col("vqe_result.minimum").alias("minimum_energy"), F.col("vqe_result.nuclear_repulsion_energy").alias("nuclear_repulsion_energy"))
    return rows.agg(F.round(F.avg(ingest.total_energy()), 6).alias("mean_total"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

