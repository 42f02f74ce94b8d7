"""Queries p1 to p4: drifting schemas, small files, nested records, repeated delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compaction, drift, flatten, once
from ..runtime import cut, read_table


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    records = cut(drift.record_fields(read_table(spark, base, "run_messages"), read_table(spark, base, "run_files")), "drift-records")
    return drift.schema_changes(records).select("file_id", "field_path", "change_kind")


def p1_unified(spark: SparkSession, base: str) -> DataFrame:
    messages = read_table(spark, base, "run_messages")
    records = cut(drift.record_fields(messages, read_table(spark, base, "run_files")), "drift-records")
    schemas = cut(drift.file_schemas(records), "drift-schemas")
    evidence = drift.rename_evidence(records, schemas)
    names = drift.aliases(drift.schema_changes(records, schemas, evidence), records)
    overrides = cut(drift.lane_overrides(schemas, evidence, names), "drift-overrides")
    return drift.compiled_table(messages, drift.unified_columns(messages, names, overrides=overrides), overrides=overrides)


def _plan(spark: SparkSession, base: str) -> DataFrame:
    return compaction.consolidation_plan(read_table(spark, base, "run_messages"), read_table(spark, base, "processing_metadata"), read_table(spark, base, "run_files"))


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return compaction.small_files(_plan(spark, base))


def p2_consolidated(spark: SparkSession, base: str) -> DataFrame:
    return compaction.consolidate_runs(read_table(spark, base, "run_messages"), _plan(spark, base))


def p2_unread(spark: SparkSession, base: str) -> DataFrame:
    return compaction.unread_reports(read_table(spark, base, "processing_metadata"))


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return flatten.child_index(read_table(spark, base, "vqe_runs"), "record_id")


def _p3_table(path: str):
    def query(spark: SparkSession, base: str) -> DataFrame:
        runs = read_table(spark, base, "vqe_runs").select("record_id", "molecule", "vqe_result")
        table = next(t for t in flatten.node_tables(runs.schema, "record_id") if t.path == path)
        rows = flatten.node_table(runs, "record_id", table)
        return rows.withColumn("dewey", F.array_join(F.transform("dewey", lambda x: x.cast("string")), ".")).withColumn(
            "parent", F.array_join(F.transform("parent", lambda x: x.cast("string")), ".")
        )

    return query


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    """Both tables are one stream of arrivals; the table's name is part of the identifier."""
    runs = once.message_identifiers(read_table(spark, base, "run_messages"))
    steps = once.step_identifiers(read_table(spark, base, "ml_iteration_features"))
    return (
        once.surplus(runs, "identifier", "row_id").withColumn("table_name", F.lit("run_messages"))
        .unionByName(once.surplus(steps, "identifier", "row_id").withColumn("table_name", F.lit("ml_iteration_features")))
        .select("table_name", "row_id")
    )


def p4_kept_steps(spark: SparkSession, base: str) -> DataFrame:
    features = read_table(spark, base, "ml_iteration_features")
    state = once.scratch_state(spark)
    kept = once.keep_once(state, once.step_identifiers(features), "identifier", "row_id")
    return features.join(kept.select(F.col("row_id").alias("load_id")), "load_id", "left_semi").select("load_id", "experiment_id", "iteration_step", "energy")


def p4_kept_runs(spark: SparkSession, base: str) -> DataFrame:
    messages = read_table(spark, base, "run_messages")
    state = once.scratch_state(spark)
    kept = once.keep_once(state, once.message_identifiers(messages), "identifier", "row_id")
    return messages.join(kept.select(F.col("row_id").alias("record_id")), "record_id", "left_semi").select("record_id", "file_id", "line_no", "payload")


def p4_unidentified(spark: SparkSession, base: str) -> DataFrame:
    """Rows without identifier, copies of nothing: with the kept and the surplus rows they are the whole table."""
    runs = once.message_identifiers(read_table(spark, base, "run_messages")).withColumn("table_name", F.lit("run_messages"))
    steps = once.step_identifiers(read_table(spark, base, "ml_iteration_features")).withColumn("table_name", F.lit("ml_iteration_features"))
    return runs.unionByName(steps).where("identifier is null").select("table_name", "row_id")


def queries() -> dict:
    return {
        "p1_found": p1_found,
        "p1_unified": p1_unified,
        "p2_found": p2_found,
        "p2_consolidated": p2_consolidated,
        "p2_unread": p2_unread,
        "p3_found": p3_found,
        "p3_atoms": _p3_table("molecule.molecule_data.symbols"),
        "p3_hamiltonian_terms": _p3_table("vqe_result.initial_data.hamiltonian"),
        "p3_initial_parameters": _p3_table("vqe_result.initial_data.initial_parameters"),
        "p3_iterations": _p3_table("vqe_result.iteration_list"),
        "p3_iteration_parameters": _p3_table("vqe_result.iteration_list.parameters"),
        "p4_found": p4_found,
        "p4_kept_steps": p4_kept_steps,
        "p4_kept_runs": p4_kept_runs,
        "p4_unidentified": p4_unidentified,
    }


def _unnest(table: str, element: str) -> str:
    """DuckDB: one row per element of a list column of vqe_runs with its 0-based place."""
    return f"SELECT record_id, unnest({element}) AS e, unnest(range(len({element}))) AS pos FROM {table}"


_SYMBOLS, _TERMS = "molecule.molecule_data.symbols", "vqe_result.initial_data.hamiltonian"
_X0, _ITER = "vqe_result.initial_data.initial_parameters", "vqe_result.iteration_list"
_ITERATIONS = f"SELECT * FROM ({_unnest('vqe_runs', _ITER)}) WHERE e IS NOT NULL"
_PARAMETERS = f"SELECT record_id, pos AS parent_pos, unnest(e.parameters) AS e, unnest(range(len(e.parameters))) AS pos FROM ({_ITERATIONS})"


def oracle_sql() -> dict[str, str]:
    kinds = {"atom": _SYMBOLS, "hamiltonian_term": _TERMS, "initial_parameter": _X0}
    found = [f"SELECT record_id, '{k}' AS child_kind, CAST(-1 AS INTEGER) AS parent_pos, CAST(pos AS INTEGER) AS pos FROM ({_unnest('vqe_runs', p)})" for k, p in kinds.items()]
    found += [
        f"SELECT record_id, 'iteration' AS child_kind, CAST(-1 AS INTEGER) AS parent_pos, CAST(pos AS INTEGER) AS pos FROM ({_ITERATIONS})",
        f"SELECT record_id, 'iteration_parameter' AS child_kind, CAST(parent_pos AS INTEGER) AS parent_pos, CAST(pos AS INTEGER) AS pos FROM ({_PARAMETERS})",
    ]
    flat = "CAST(pos AS VARCHAR) AS dewey, '' AS parent"
    step_key = r"regexp_replace(lower(experiment_id), '^\s+|\s+$', '', 'g')"
    start = "$.vqe_result.initial_data"
    run_key = (
        "(CAST(payload->'$.molecule_id' AS DOUBLE), regexp_replace(lower(payload->>'$.basis_set'), '[^a-z0-9]', '', 'g'), "
        f"payload->>'{start}.backend', CAST(payload->'{start}.num_qubits' AS DOUBLE), payload->>'{start}.optimizer', "
        f"CAST(payload->'{start}.ansatz_reps' AS DOUBLE), CAST(payload->'{start}.initial_parameters' AS DOUBLE[]))"
    )
    return {
        "p3_found": " UNION ALL ".join(found),
        "p3_atoms": f"SELECT record_id, {flat}, e AS value FROM ({_unnest('vqe_runs', _SYMBOLS)})",
        "p3_hamiltonian_terms": f"SELECT record_id, {flat}, e.label AS label, e.coefficients.real AS coefficients_real, e.coefficients.imaginary AS coefficients_imaginary FROM ({_unnest('vqe_runs', _TERMS)})",
        "p3_initial_parameters": f"SELECT record_id, {flat}, e AS value FROM ({_unnest('vqe_runs', _X0)})",
        "p3_iterations": f"SELECT record_id, {flat}, e.iteration AS iteration, e.result AS result, e.std AS std, e.energy_delta AS energy_delta, e.parameter_delta_norm AS parameter_delta_norm, e.cumulative_min_energy AS cumulative_min_energy FROM ({_ITERATIONS})",
        "p3_iteration_parameters": f"SELECT record_id, CAST(parent_pos AS VARCHAR) || '.' || CAST(pos AS VARCHAR) AS dewey, CAST(parent_pos AS VARCHAR) AS parent, e AS value FROM ({_PARAMETERS})",
        "p4_found": f"""
            SELECT 'ml_iteration_features' AS table_name, load_id AS row_id FROM (
              SELECT load_id, row_number() OVER (PARTITION BY {step_key}, iteration_step ORDER BY load_id) AS rn
              FROM ml_iteration_features WHERE experiment_id IS NOT NULL) WHERE rn > 1
            UNION ALL
            SELECT 'run_messages' AS table_name, record_id AS row_id FROM (
              SELECT record_id, row_number() OVER (PARTITION BY {run_key} ORDER BY record_id) AS rn
              FROM (SELECT record_id, CAST(payload AS JSON) AS payload FROM run_messages WHERE json_valid(payload))) WHERE rn > 1""",
        "p4_kept_steps": f"""
            SELECT load_id, experiment_id, iteration_step, energy FROM (
              SELECT *, row_number() OVER (PARTITION BY {step_key}, iteration_step ORDER BY load_id) AS rn
              FROM ml_iteration_features WHERE experiment_id IS NOT NULL) WHERE rn = 1""",
        "p4_kept_runs": f"""
            SELECT record_id, file_id, line_no, text AS payload FROM (
              SELECT *, row_number() OVER (PARTITION BY {run_key} ORDER BY record_id) AS rn
              FROM (SELECT record_id, file_id, line_no, payload AS text, CAST(payload AS JSON) AS payload FROM run_messages WHERE json_valid(payload))) WHERE rn = 1""",
        "p4_unidentified": """
            SELECT 'ml_iteration_features' AS table_name, load_id AS row_id FROM ml_iteration_features WHERE experiment_id IS NULL
            UNION ALL
            SELECT 'run_messages' AS table_name, record_id AS row_id FROM run_messages WHERE payload IS NULL OR NOT json_valid(payload)""",
    }
