"""Entry functions: ingest records into the nine tables, derive the feature tables, run queries over them."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest, trajectory
from ..runtime import cut
from ..sources.readers import read_topic, topics
from ..sources.tables import AUDIT, VersionedTable, audit_row


def ingest_records(spark: SparkSession, raw: DataFrame, warehouse: str, now: datetime, name: str = "base_processing", info: str = "", order: str | None = None) -> dict[str, tuple[str | None, int]]:
    """Append what is new of raw records to the nine tables and log it: table -> (tag or None, rows).

    One record per run identity is kept: that of least ``order`` (a column, e.g. the time of arrival), else that of
    least hash of the whole record, so the same records give the same result.  Running it again on the same
    records adds nothing but an audit row.  A warning about volumes goes into the audit row's text.
    """
    batch = str(uuid.uuid4())
    keyed = ingest.with_identity(raw)
    # the survivor is chosen on slim rows: the records themselves move at most once, for the semi join
    sequence = F.struct(F.col(order), F.xxhash64(*raw.columns)) if order else F.struct(F.xxhash64(*raw.columns))
    placed = keyed.withColumn("__order", sequence)
    unique = ingest.one_per_run(placed, "__order").dropDuplicates(["experiment_id"])
    runs = unique.drop("__order", *([order] if order and order not in ingest.RAW_NAMES else [])).persist()
    try:
        results = {}
        for table, rows in ingest.normal_tables(runs).items():
            keys, partitions = ingest.TABLES[table]
            results[table] = VersionedTable(spark, f"{warehouse}/{table}", keys, partitions).append(ingest.with_batch(rows, name, now, batch))
    finally:
        runs.unpersist()
    warning = ingest.volume_report({t: n for t, (_, n) in results.items()})["warning"]
    VersionedTable(spark, f"{warehouse}/processing_metadata").append(audit_row(spark, batch, name, now, results, f"{info}; {warning}" if warning else info))
    return results


def ingest_topics(spark: SparkSession, bucket: str, warehouse: str, now: datetime) -> dict[str, dict]:
    """Every topic of a bucket; an empty one is passed over, not an end."""
    out = {}
    for topic in topics(spark, bucket):
        raw = read_topic(spark, bucket, topic)
        if not raw.isEmpty():
            out[topic] = ingest_records(spark, raw, warehouse, now, info=topic)
    return out


RUN_GROUPS = ["molecule_name", "num_atoms", "num_qubits", "charge", "multiplicity", "basis_set", "optimizer", "ansatz_type", "ansatz_reps", "init_strategy", "seed", "default_shots", "total_iterations", "final_energy", "converged", "convergence_iteration", "vqe_time", "total_time"]


#: Columns of the two feature tables, in order.
ITERATION_COLUMNS = """experiment_id iteration_step molecule_name num_atoms num_qubits charge multiplicity basis_set optimizer ansatz_type ansatz_reps init_strategy seed default_shots
energy energy_std energy_delta parameter_delta_norm cumulative_min_energy relative_iteration energy_improvement_rate normalized_energy is_new_minimum steps_since_improvement
energy_moving_avg_5 energy_moving_std_5 mean_param_change total_iterations final_energy converged convergence_iteration vqe_time total_time processing_date""".split()
#: A row of the feature tables needs all of these.
KEY_COLUMNS = ["molecule_name", "optimizer", "basis_set", "num_qubits"]


def new_experiments(spark: SparkSession, warehouse: str, target: str = "ml_iteration_features") -> DataFrame:
    """(experiment_id) of the runs with iterations that neither the target table nor the quarantine has."""
    ids = VersionedTable(spark, f"{warehouse}/vqe_iterations").read().select("experiment_id").distinct()
    for table, key in ((target, "experiment_id"), ("quarantine", "run_id")):
        known = VersionedTable(spark, f"{warehouse}/{table}")
        if known.exists():
            ids = ids.join(known.read().select(F.col(key).alias("experiment_id")), "experiment_id", "left_anti")
    return ids


def feature_frame(spark: SparkSession, warehouse: str, ids: DataFrame | None = None) -> DataFrame:
    """Iteration features of the runs in ``ids`` (all without): steps with the four dimension tables, left joins on the unique run id.

    Every table is restricted to the ids before it is joined, so an incremental build reads features of new runs only.
    """

    def table(n: str) -> DataFrame:
        rows = VersionedTable(spark, f"{warehouse}/{n}").read()
        return rows if ids is None else ingest.restrict(rows, ids, "experiment_id")

    results = table("vqe_results").select("experiment_id", "num_qubits", "optimizer", "basis_set", "seed", "default_shots", "total_iterations", F.col("minimum_energy").alias("final_energy"), F.col("success").alias("converged"))
    ansatz = table("ansatz_info").select("experiment_id", F.col("ansatz_name").alias("ansatz_type"), "ansatz_reps", "init_strategy")
    molecules = table("molecules").select("experiment_id", "molecule_name", F.size("atom_symbols").alias("num_atoms"), "charge", "multiplicity")
    times = table("performance_metrics").select("experiment_id", "vqe_time", "total_time")
    steps = table("vqe_iterations").select("experiment_id", F.col("iteration_step").alias("step"), F.col("iteration_energy").alias("energy"), F.col("energy_std_dev").alias("energy_std"), "energy_delta", "parameter_delta_norm", "cumulative_min_energy")
    joined = trajectory.deduplicate_steps(steps, "experiment_id", "step")
    for dimension in (results, ansatz, molecules, times):
        joined = ingest.guarded_left_join(joined, dimension, "experiment_id")
    return trajectory.iteration_features(joined.withColumnRenamed("experiment_id", "run_id"))


def build_features(spark: SparkSession, warehouse: str, now: datetime) -> dict[str, tuple[str | None, int]]:
    """Append features and summaries of the runs that are new; rows without a key column go to quarantine.

    Runs whose features are there (or lie in quarantine) are read no more than their ids.
    """
    day = F.lit(now.date()).cast("date")
    ids = cut(new_experiments(spark, warehouse), "new-experiments")
    tables = {
        "ml_iteration_features": VersionedTable(spark, f"{warehouse}/ml_iteration_features", ["experiment_id", "iteration_step"], ["processing_date"]),
        "ml_run_summary": VersionedTable(spark, f"{warehouse}/ml_run_summary", ["experiment_id"], ["processing_date", "basis_set"]),
        "quarantine": VersionedTable(spark, f"{warehouse}/quarantine", ["run_id", "step"]),
    }
    if ids.isEmpty():
        return dict.fromkeys(tables, (None, 0))
    good, bad = trajectory.null_key_gate(feature_frame(spark, warehouse, ids), KEY_COLUMNS)
    good = good.persist()
    try:
        rows = good.withColumnRenamed("run_id", "experiment_id").withColumnRenamed("step", "iteration_step").withColumn("processing_date", day).select(*ITERATION_COLUMNS)
        summary = trajectory.run_summary(good, RUN_GROUPS).withColumnRenamed("run_id", "experiment_id").withColumn("processing_date", day)
        return {
            "ml_iteration_features": tables["ml_iteration_features"].append(rows),
            "ml_run_summary": tables["ml_run_summary"].append(summary),
            "quarantine": tables["quarantine"].append(bad.withColumn("processing_date", day)),
        }
    finally:
        good.unpersist()


__all__ = ["AUDIT", "build_features", "feature_frame", "ingest_records", "ingest_topics", "new_experiments"]
