"""Queries that run the codecs, the versioned tables, streaming, the pipelines and the models end to end."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import metrics
from ..operators import ingest, models, trajectory
from ..runtime import read_table, scratch_path
from ..sources import avro
from ..sources.tables import VersionedTable
from ..streaming import ingest as streams
from . import pipelines
from .reference import STEPS
from .surface import model_rows

#: Stands for the clock of a job, so that results can be repeated.
NOW = datetime(2026, 1, 1)
ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _orders(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders").select(*ORDERS)


def avro_round_trip(spark, base):
    orders = _orders(spark, base)
    frames = avro.encode_frames(orders, 7)
    return avro.decode_frames(frames, {7: avro.avro_schema(orders.schema)}, orders.schema).drop("decode_error")


def wire_frame_decode(spark, base):
    """Every tenth message is spoilt in its first byte and goes to quarantine."""
    orders = _orders(spark, base)
    frames = avro.encode_frames(orders, 7).withColumn("n", F.xxhash64("message"))
    schema = avro.avro_schema(orders.schema)
    spoilt = avro.encode_frames(orders.where("o_orderkey % 10 = 0"), None).select(F.concat(F.lit(b"\x01"), "message").alias("message"))
    rows = avro.decode_frames(frames.select("message").unionByName(spoilt), {7: schema}, orders.schema)
    return rows.groupBy(F.col("decode_error").isNotNull().alias("quarantined")).agg(F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("n_keys"))


def schema_evolution_defaults(spark, base):
    """Messages of an older writer, read with a newer schema: fields it lacks are null, fields it had more of go."""
    orders = _orders(spark, base)
    old = orders.select("o_orderkey", "o_orderstatus", F.lit(1).alias("gone"))
    target = orders.select("o_orderkey", "o_orderstatus", "o_totalprice").schema
    return avro.decode_frames(avro.encode_frames(old, 3), {3: avro.avro_schema(old.schema)}, target).drop("decode_error")


def _two_appends(spark, base) -> VersionedTable:
    orders = _orders(spark, base)
    table = VersionedTable(spark, scratch_path(spark, "orders"), ["o_orderkey"], ["o_orderstatus"])
    table.append(orders.where("o_orderkey % 3 < 2"), "first")
    table.append(orders.where("o_orderkey % 3 > 0"), "second")
    return table


def table_append_versions(spark, base):
    return _two_appends(spark, base).read().select(*ORDERS)


def time_travel(spark, base):
    return _two_appends(spark, base).read(tag="first").select(*ORDERS)


def compacted_table(spark, base):
    table = _two_appends(spark, base)
    table.compact(4 << 20)
    return table.read().select(*ORDERS)


def stream_ingest_dedup(spark, base):
    """Events written as two overlapping sets of files, streamed into a keyed table."""
    events = read_table(spark, base, "events").select("event_id", "user_id", "event_type", "value")
    folder = scratch_path(spark, "stream")
    events.where("event_id % 3 < 2").write.parquet(f"{folder}/a")
    events.where("event_id % 3 > 0").write.parquet(f"{folder}/b")
    table = VersionedTable(spark, scratch_path(spark, "streamed"), ["event_id"])
    streams.append_batches(streams.file_stream(spark, folder, events.schema, "parquet"), table, scratch_path(spark, "offsets"))
    return table.read()


def _warehouse(spark, base) -> str:
    warehouse = scratch_path(spark, "warehouse")
    raw = read_table(spark, base, "vqe_runs").drop("record_id", "experiment_id", "received_at")
    pipelines.ingest_records(spark, raw, warehouse, NOW)
    pipelines.build_features(spark, warehouse, NOW)
    return warehouse


def pipeline_run_summary(spark, base):
    """Archived runs through both pipelines: the summary table."""
    return VersionedTable(spark, f"{_warehouse(spark, base)}/ml_run_summary").read()


def pipeline_audit(spark, base):
    """Ingesting the same records twice: the second audit row says that nothing changed."""
    warehouse = scratch_path(spark, "warehouse")
    raw = read_table(spark, base, "vqe_runs").drop("experiment_id", "received_at")
    for _ in range(2):
        pipelines.ingest_records(spark, raw, warehouse, NOW, order="record_id")
    rows = VersionedTable(spark, f"{warehouse}/processing_metadata").read()
    return rows.select(F.explode(F.arrays_zip("table_names", "record_counts")).alias("z")).groupBy("z.table_names").agg(F.sum("z.record_counts").alias("n"), F.count_if(F.col("z.record_counts") == 0).alias("n_unchanged"))


NUMERIC = ["energy_slope_first10", "energy_delta_k1", "energy_delta_k2", "param_delta_norm_mean_k10", "longest_plateau_first10"]


HORIZONS, FRACTIONS = (10, 20, 50), (0.25, 0.5, 0.75)
#: Boosted fits take minutes each (README), so one horizon and one share are registered; the others differ in the number only.
BOOSTED_HORIZONS, BOOSTED_FRACTIONS = (20,), (0.5,)


def _labelled(spark, base, k: int = 10) -> DataFrame:
    """The convergence models' features of event runs up to step ``k``; the label says whether the run's minimum is below the median of minima."""
    features = model_rows(spark, base)
    rows = trajectory.horizon_model_features(features, k)
    best = features.groupBy("run_id").agg(F.min("energy").alias("best_energy"))
    middle = metrics.exact_medians(best, ["best_energy"])["best_energy"]
    return rows.join(best, "run_id").withColumns({"label": (F.col("best_energy") < F.lit(middle)).cast("int"), "segment": F.col("optimizer")})


def _classifier(name, model, horizons=HORIZONS):
    def run(spark, base):
        folds = []
        for k in horizons:
            df = _labelled(spark, base, k)
            numeric, categorical = trajectory.horizon_feature_names(k, df.columns)
            folds += models.fit_classifiers(df, numeric, categorical, "segment", "run_id", estimators={name: model}, suffix=f"_k{k}", interact=[f"energy_slope_first{k}", *models.INTERACT], refit=False).folds
        return models.Fitted(folds).summary(spark, ["model", "held_out"]).select("model", "held_out", "n_rows", "roc_auc", "brier", "mcc")

    return run


def _regressor(name, model, fractions=FRACTIONS):
    """Energy models on each share of the steps seen: the run's least energy from its first steps."""

    def run(spark, base):
        folds = []
        rows = model_rows(spark, base).withColumn("final_energy", F.min("energy").over(Window.partitionBy("run_id")))
        for fraction in fractions:
            df = trajectory.prefix_model_features(rows, fraction).withColumn("segment", F.col("optimizer"))
            folds += models.fit_regressors(df, trajectory.PREFIX_NUMERIC, trajectory.PREFIX_CATEGORICAL, "segment", "final_energy", {name: model}, suffix=f"_{int(fraction * 100)}", refit=False).folds
        return models.Fitted(folds).summary(spark, ["held_out", "model"]).select("model", "held_out", "n_rows", "mae", "rmse")

    return run


def imputed_features(spark, base):
    return metrics.median_impute(_labelled(spark, base), NUMERIC).select("run_id", *[F.round(c, 6).alias(c) if c in ("energy_slope_first10", "param_delta_norm_mean_k10") else c for c in NUMERIC], "label")


def fan_out_guard(spark, base):
    """Left join of orders to customers behind the uniqueness check."""
    customer = read_table(spark, base, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return ingest.guarded_left_join(_orders(spark, base), customer, "o_custkey")


def queries() -> dict:
    return {
        "avro_round_trip": avro_round_trip,
        "wire_frame_decode": wire_frame_decode,
        "schema_evolution_defaults": schema_evolution_defaults,
        "table_append_versions": table_append_versions,
        "time_travel": time_travel,
        "compacted_table": compacted_table,
        "stream_ingest_dedup": stream_ingest_dedup,
        "pipeline_run_summary": pipeline_run_summary,
        "pipeline_audit": pipeline_audit,
        "fan_out_guard": fan_out_guard,
        "imputed_features": imputed_features,
        "logistic_fit": _classifier("logistic", lambda n, _: models.logistic(n)),
        "forest_fit": _classifier("forest", lambda *_: models.forest()),
        **{f"gbt_fit_k{k}": _classifier("boosted", lambda *_: models.boosted(), (k,)) for k in BOOSTED_HORIZONS},
        "ridge_fit": _regressor("ridge", lambda n, std: models.ridge(n, std, label="final_energy")),
        **{f"gbt_regressor_fit_{int(f * 100)}": _regressor("boosted", lambda *_: models.boosted_regressor("final_energy"), (f,)) for f in BOOSTED_FRACTIONS},
    }


_COLUMNS = ", ".join(ORDERS)


def oracle_sql() -> dict[str, str]:
    whole = f"SELECT {_COLUMNS} FROM orders"
    last = "coalesce({0}, (SELECT median({0}) FROM v), 0.0)"
    imputed = STEPS.rstrip() + f""", e AS (SELECT * FROM f WHERE step <= 10), g AS (SELECT run_id, sum(CASE WHEN is_new_minimum THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY step) AS g, is_new_minimum FROM e),
      p AS (SELECT run_id, CAST(max(n) AS DOUBLE) AS longest_plateau_first10 FROM (SELECT run_id, count(*) FILTER (NOT is_new_minimum) AS n FROM g GROUP BY run_id, g) GROUP BY run_id), b AS (SELECT run_id, min(energy) AS best FROM s GROUP BY run_id),
      v AS (SELECT run_id, CASE WHEN count(*) > 1 THEN regr_slope(energy, step) ELSE 0 END AS energy_slope_first10, max(energy_delta) FILTER (step = 1) AS energy_delta_k1, max(energy_delta) FILTER (step = 2) AS energy_delta_k2, coalesce(avg(parameter_delta_norm), 0) AS param_delta_norm_mean_k10 FROM e GROUP BY run_id)
      SELECT run_id, round({last.format("energy_slope_first10")}, 6) AS energy_slope_first10, {last.format("energy_delta_k1")} AS energy_delta_k1, {last.format("energy_delta_k2")} AS energy_delta_k2,
        round({last.format("param_delta_norm_mean_k10")}, 6) AS param_delta_norm_mean_k10, longest_plateau_first10, CAST(best < (SELECT median(best) FROM b) AS INTEGER) AS label
      FROM v JOIN p USING (run_id) JOIN b USING (run_id) WHERE run_id IN (SELECT c_custkey FROM customer)"""
    its = "[x for x in vqe_result.iteration_list if x IS NOT NULL]"
    counts = {
        "molecules": "count(molecule_id)", "ansatz_info": "count(molecule_id)", "performance_metrics": "count(*) FILTER (molecule_id IS NOT NULL AND basis_set IS NOT NULL)", "vqe_results": "count(*) FILTER (molecule_id IS NOT NULL AND basis_set IS NOT NULL)",
        "initial_parameters": "sum(len(vqe_result.initial_data.initial_parameters))", "optimal_parameters": "sum(len(vqe_result.optimal_parameters))", "vqe_iterations": f"sum(len({its}))",
        "iteration_parameters": f"sum(list_sum([len(x.parameters) for x in {its}]))", "hamiltonian_terms": "sum(len(vqe_result.initial_data.hamiltonian))",
    }
    audit = "WITH r AS (SELECT * FROM vqe_runs QUALIFY row_number() OVER (PARTITION BY molecule.molecule_data, basis_set, vqe_result.initial_data ORDER BY record_id) = 1) " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_names, CAST(coalesce({c}, 0) AS BIGINT) AS n, CASE WHEN coalesce({c}, 0) > 0 THEN 1 ELSE 2 END AS n_unchanged FROM r" for t, c in counts.items()
    )
    return {
        "pipeline_audit": audit,
        "imputed_features": imputed,
        "avro_round_trip": whole,
        "wire_frame_decode": "SELECT false AS quarantined, count(*) AS n, count(*) AS n_keys FROM orders UNION ALL SELECT true, count(*), 0 FROM orders WHERE o_orderkey % 10 = 0",
        "schema_evolution_defaults": "SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders",
        "table_append_versions": whole,
        "time_travel": whole + " WHERE o_orderkey % 3 < 2",
        "compacted_table": whole,
        "stream_ingest_dedup": "SELECT event_id, user_id, event_type, value FROM events",
        "fan_out_guard": f"SELECT {_COLUMNS}, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    }
