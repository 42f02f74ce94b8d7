"""Queries over trajectories, keys, nested data, metrics and operations, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import metrics, observability
from ..operators import ingest, trajectory
from ..runtime import read_table, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def r9(c) -> F.Column:
    return F.round(c, 9)


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r9(F.col(n)) for n in names})


# --- trajectories: run = user of events, step = place in time, energy = value ---------------------------


def steps(spark: SparkSession, base: str) -> DataFrame:
    events = read_table(spark, base, "events").select(F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("energy"))
    rows = trajectory.with_deltas(trajectory.with_steps(events, "run_id", ["ts", "event_id"]))
    return rows.withColumn("parameter_delta_norm", F.abs("energy_delta")).withColumn("total_iterations", F.count(F.lit(1)).over(Window.partitionBy("run_id")))


def features(spark: SparkSession, base: str) -> DataFrame:
    return trajectory.iteration_features(steps(spark, base))


STEPS = """WITH s0 AS (SELECT user_id AS run_id, event_id, ts, value AS energy, row_number() OVER w AS step, value - lag(value) OVER w AS energy_delta,
  min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cumulative_min_energy, count(*) OVER (PARTITION BY user_id) AS total_iterations
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, abs(energy_delta) AS parameter_delta_norm FROM s0),
f0 AS (SELECT *, coalesce(cumulative_min_energy < lag(cumulative_min_energy) OVER (PARTITION BY run_id ORDER BY step), true) AS is_new_minimum FROM s),
f AS (SELECT *, step - max(CASE WHEN is_new_minimum THEN step END) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS steps_since_improvement,
  max(CASE WHEN is_new_minimum THEN step END) OVER (PARTITION BY run_id) AS convergence_iteration,
  step / total_iterations AS relative_iteration,
  round(avg(energy) OVER last5, 9) AS energy_moving_avg_5, round(stddev(energy) OVER last5, 9) AS energy_moving_std_5,
  round(sum(parameter_delta_norm) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) / step, 9) AS mean_param_change,
  (first_value(energy) OVER (PARTITION BY run_id ORDER BY step) - cumulative_min_energy) / step AS energy_improvement_rate,
  CASE WHEN cumulative_min_energy <> 0 THEN abs(energy - cumulative_min_energy) / abs(cumulative_min_energy) ELSE 0 END AS normalized_energy
  FROM f0 WINDOW last5 AS (PARTITION BY run_id ORDER BY step ROWS 4 PRECEDING))
"""
_MEAN = ("energy_moving_avg_5", "energy_moving_std_5", "mean_param_change")


@query("trajectory_base", STEPS + "SELECT run_id, step, energy, energy_delta, cumulative_min_energy FROM s")
def trajectory_base(spark, base):
    return steps(spark, base).select("run_id", "step", "energy", "energy_delta", "cumulative_min_energy")


_ITER = "run_id, step, energy, energy_delta, cumulative_min_energy, is_new_minimum, steps_since_improvement, convergence_iteration, relative_iteration, energy_moving_avg_5, energy_moving_std_5, mean_param_change, energy_improvement_rate, normalized_energy"


@query("iter_features", STEPS + f"SELECT {_ITER}, c_mktsegment AS optimizer, n_name AS basis_set FROM f LEFT JOIN customer ON run_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def iter_features(spark, base):
    """Flagship: steps with their features and the dimensions of their run, left joins on unique keys."""
    customer = read_table(spark, base, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("optimizer"), "c_nationkey")
    nation = read_table(spark, base, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("basis_set"))
    dims = customer.join(nation, "c_nationkey", "left")
    return _round(features(spark, base).join(dims, "run_id", "left").select(*[c.strip() for c in _ITER.split(",")], "optimizer", "basis_set"), *_MEAN)


def _feature_query(name: str, columns: str, rounded: tuple[str, ...] = ()):
    SQL[name] = STEPS + f"SELECT {columns} FROM f"
    QUERIES[name] = lambda spark, base: _round(features(spark, base).select(*[c.strip() for c in columns.split(",")]), *rounded)


_feature_query("new_minimum_flags", "run_id, step, is_new_minimum")
_feature_query("steps_since_improvement", "run_id, step, steps_since_improvement")
_feature_query("rolling_mean_std_5", "run_id, step, energy_moving_avg_5, energy_moving_std_5", _MEAN[:2])
_feature_query("cumulative_param_change", "run_id, step, mean_param_change", _MEAN[2:])


@query("convergence_step", STEPS + "SELECT DISTINCT run_id, convergence_iteration FROM f")
def convergence_step(spark, base):
    return features(spark, base).groupBy("run_id").agg(F.max("convergence_iteration").alias("convergence_iteration"))


@query("rolling_std_pop_5", STEPS + "SELECT run_id, step, round(stddev_pop(energy) OVER (PARTITION BY run_id ORDER BY step ROWS 4 PRECEDING), 9) AS std_pop_5 FROM s")
def rolling_std_pop_5(spark, base):
    return steps(spark, base).select("run_id", "step", r9(F.stddev_pop("energy").over(trajectory.ordered().rowsBetween(-4, 0))).alias("std_pop_5"))


@query("initial_value_and_relative_step", STEPS + "SELECT run_id, step, first_value(energy) OVER (PARTITION BY run_id ORDER BY step) AS initial_energy, step / total_iterations AS relative_iteration FROM s")
def initial_value(spark, base):
    return steps(spark, base).select("run_id", "step", F.first("energy").over(trajectory.ordered()).alias("initial_energy"), (F.col("step") / F.col("total_iterations")).alias("relative_iteration"))


_SUMMARY = """run_id, optimizer, total_iterations, round(avg(energy_delta), 9) AS mean_energy_delta, round(stddev(energy_delta), 9) AS std_energy_delta,
  min(energy) AS min_energy, max(energy) AS max_energy, max(energy) - min(energy) AS energy_range, round(avg(parameter_delta_norm), 9) AS mean_param_delta_norm,
  round(stddev(parameter_delta_norm), 9) AS std_param_delta_norm, round(sum(parameter_delta_norm), 9) AS total_param_distance,
  count(*) FILTER (is_new_minimum) AS num_new_minima, max(steps_since_improvement) AS longest_plateau,
  count(*) FILTER (is_new_minimum) / total_iterations AS improvement_ratio,
  round(avg(energy) FILTER (step <= 10), 9) AS first_10_mean_energy,
  CASE WHEN count(*) FILTER (step <= 10) > 1 THEN round(regr_slope(energy, step) FILTER (step <= 10), 9) END AS first_10_energy_slope,
  round(avg(energy) FILTER (step > total_iterations - 10), 9) AS last_10_mean_energy"""


@query("run_summary", STEPS + f"SELECT {_SUMMARY} FROM (SELECT f.*, c_mktsegment AS optimizer FROM f LEFT JOIN customer ON run_id = c_custkey) GROUP BY run_id, optimizer, total_iterations")
def run_summary(spark, base):
    customer = read_table(spark, base, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("optimizer"))
    out = trajectory.run_summary(features(spark, base).join(customer, "run_id", "left"), ["optimizer", "total_iterations"])
    return _round(out, "mean_energy_delta", "std_energy_delta", "mean_param_delta_norm", "std_param_delta_norm", "total_param_distance", "first_10_mean_energy", "first_10_energy_slope", "last_10_mean_energy")


@query("head_tail_energy", STEPS + "SELECT run_id, round(avg(energy) FILTER (step <= 10), 9) AS first_10_mean_energy, CASE WHEN count(*) FILTER (step <= 10) > 1 THEN round(regr_slope(energy, step) FILTER (step <= 10), 9) END AS first_10_energy_slope, round(avg(energy) FILTER (step > total_iterations - 10), 9) AS last_10_mean_energy FROM s GROUP BY run_id")
def head_tail(spark, base):
    out = trajectory.with_ends(steps(spark, base)).groupBy("run_id").agg(*trajectory.head_tail_columns())
    return _round(out, *out.columns[1:])


_ISLANDS = "SELECT run_id, sum(CASE WHEN is_new_minimum THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS g, is_new_minimum FROM f"


@query("longest_plateau", STEPS + f"SELECT run_id, max(n) AS longest_plateau FROM (SELECT run_id, g, count(*) FILTER (NOT is_new_minimum) AS n FROM ({_ISLANDS}) GROUP BY run_id, g) GROUP BY run_id")
def longest_plateau(spark, base):
    return trajectory.longest_zero_run(features(spark, base), F.col("is_new_minimum"))


@query(
    "tolerant_improvement",
    "WITH RECURSIVE "
    + STEPS.removeprefix("WITH ")
    + """, t AS (SELECT run_id, step, energy, energy AS m, CAST(1 AS BIGINT) AS n FROM s WHERE step = 1
      UNION ALL SELECT s.run_id, s.step, s.energy, CASE WHEN s.energy < t.m - 1e-8 THEN s.energy ELSE t.m END, CASE WHEN s.energy < t.m - 1e-8 THEN 0 ELSE t.n + 1 END
      FROM t JOIN s ON s.run_id = t.run_id AND s.step = t.step + 1) SELECT run_id, step, energy, n AS steps_since FROM t""",
)
def tolerant(spark, base):
    return trajectory.tolerant_improvement(steps(spark, base))


def _horizon_sql(k: int) -> str:
    first, second = (f"coalesce(sum(energy_delta) FILTER (step {c} {k // 2}), 0)" for c in ("<=", ">"))
    ratio = f", {first} / ({first} + {second} + 1e-12) AS improvement_ratio_k{k}" if k >= 20 else ""
    deltas = ", ".join(f"max(energy_delta) FILTER (step = {i}) AS energy_delta_k{i}" for i in range(1, 6))
    inner = f"""SELECT run_id, count(*) AS n_steps, round(CASE WHEN count(*) > 1 THEN regr_slope(energy, step) ELSE 0 END, 9) AS energy_slope_k{k}, {deltas},
      round(avg(energy) FILTER (step > {k - 5}), 9) AS energy_mean_last5_k{k}, round(coalesce(stddev_pop(energy) FILTER (step > {k - 5}), 0), 9) AS energy_std_last5_k{k},
      arg_max(cumulative_min_energy, step) AS cumulative_min_energy_at_k{k}, count(*) FILTER (is_new_minimum) AS num_new_minima_k{k},
      round(avg(parameter_delta_norm), 9) AS param_delta_norm_mean_k{k}, round(coalesce(stddev_pop(parameter_delta_norm), 0), 9) AS param_delta_norm_std_k{k}{ratio}
      FROM f WHERE step <= {k} GROUP BY run_id"""  # fmt: skip
    if k >= 20:
        inner = f"SELECT * REPLACE (round(improvement_ratio_k{k}, 9) AS improvement_ratio_k{k}) FROM ({inner})"
    plateau = f"SELECT run_id, max(n) AS longest_plateau_k{k} FROM (SELECT run_id, g, count(*) FILTER (NOT is_new_minimum) AS n FROM ({_ISLANDS} WHERE step <= {k}) GROUP BY run_id, g) GROUP BY run_id"
    return STEPS + f"SELECT * FROM ({inner}) JOIN ({plateau}) USING (run_id)"


def _horizon(k: int):
    def run(spark, base):
        out = trajectory.horizon_features(features(spark, base), k)
        names = [f"energy_slope_k{k}", f"energy_mean_last5_k{k}", f"energy_std_last5_k{k}", f"param_delta_norm_mean_k{k}", f"param_delta_norm_std_k{k}", f"improvement_ratio_k{k}"]
        return _round(out, *[n for n in names if n in out.columns])

    return run


for _k in (10, 20, 50):
    query(f"horizon_features_k{_k}", _horizon_sql(_k))(_horizon(_k))


def _fraction_sql(p: float) -> str:
    return STEPS + f""", q AS (SELECT *, greatest(1, CAST(ceil(total_iterations * CAST({p} AS DOUBLE)) AS BIGINT)) AS np FROM s),
    p AS (SELECT * FROM q WHERE step <= np)
    SELECT run_id, max(np) AS steps_seen, arg_max(energy, step) AS current_energy, min(energy) AS best_energy,
      round(CASE WHEN count(*) > 1 THEN regr_slope(energy, step - 1) ELSE 0 END, 9) AS energy_slope, round(avg(energy) FILTER (step > np - 5), 9) AS moving_avg_5,
      round(coalesce(stddev_pop(energy) FILTER (step > np - 5), 0), 9) AS moving_std_5, round(avg(energy_delta), 9) AS mean_energy_delta,
      round(avg(parameter_delta_norm), 9) AS mean_param_delta_norm, (arg_min(energy, step) - min(energy)) / max(np) AS improvement_rate FROM p GROUP BY run_id"""  # fmt: skip


def _fraction(p: float):
    return lambda spark, base: _round(trajectory.fraction_features(steps(spark, base), p), "energy_slope", "moving_avg_5", "moving_std_5", "mean_energy_delta", "mean_param_delta_norm")


for _p in (25, 50, 75):
    query(f"fraction_features_{_p}", _fraction_sql(_p / 100))(_fraction(_p / 100))


@query("best_step", STEPS + "SELECT run_id, energy AS best_energy, step AS best_step FROM s QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY energy, step) = 1")
def best_step(spark, base):
    return trajectory.best_step(steps(spark, base))


@query("downsample_stride", STEPS + "SELECT run_id, step, energy FROM s WHERE (step - 1) % greatest(1, total_iterations // 10) = 0 OR step = total_iterations")
def downsample_stride(spark, base):
    return trajectory.downsample(steps(spark, base), 10).select("run_id", "step", "energy")


@query("evenly_spaced", STEPS + "SELECT run_id, step, energy FROM s WHERE total_iterations <= 12 OR list_contains([CAST(floor(i * (total_iterations - 1) / 11.0) AS BIGINT) for i in range(12)], step - 1)")
def evenly_spaced(spark, base):
    return trajectory.evenly_spaced(steps(spark, base), 12).select("run_id", "step", "energy")


# --- keys, joins, sets ------------------------------------------------------------------------------------


def _tables(spark, base, *names):
    return [read_table(spark, base, n) for n in names]


@query("new_records_anti_join", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey = o_custkey) AND o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
def new_records_anti_join(spark, base):
    orders, lineitem = _tables(spark, base, "orders", "lineitem")
    existing = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"))
    return ingest.new_records(orders.select("o_orderkey", "o_custkey"), existing, ["o_orderkey", "o_custkey"])


@query("new_ids_left_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'P')")
def new_ids_left_anti(spark, base):
    customer, orders = _tables(spark, base, "customer", "orders")
    return ingest.new_records(customer.select("c_custkey"), orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("restrict_left_semi", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def restrict_left_semi(spark, base):
    orders, customer = _tables(spark, base, "orders", "customer")
    ids = customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return ingest.restrict(orders, ids, "o_custkey").select("o_orderkey", "o_totalprice")


@query("star_left_join", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_orderpriority, p_brand, s_name, n_name FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey")
def star_left_join(spark, base):
    lineitem, orders, part, supplier, nation = _tables(spark, base, "lineitem", "orders", "part", "supplier", "nation")
    places = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name")
    out = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    out = out.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey", "left")
    out = out.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey", "left").join(places, "l_suppkey", "left")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "o_orderpriority", "p_brand", "s_name", "n_name")


@query("fanout_check", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def fanout_check(spark, base):
    return ingest.fan_out(read_table(spark, base, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_key_gate", "SELECT load_id, experiment_id IS NULL OR molecule_name IS NULL OR iteration_step IS NULL AS quarantined FROM ml_iteration_features")
def null_key_gate(spark, base):
    rows = read_table(spark, base, "ml_iteration_features")
    good, bad = trajectory.null_key_gate(rows, ["experiment_id", "molecule_name", "iteration_step"])
    return good.select("load_id", F.lit(False).alias("quarantined")).unionByName(bad.select("load_id", F.lit(True).alias("quarantined")))


@query("dedup_steps", "SELECT experiment_id, iteration_step, arg_min(load_id, load_id) AS load_id, arg_min(energy, load_id) AS energy FROM (SELECT experiment_id, iteration_step, load_id, coalesce(energy, 'NaN'::DOUBLE) AS energy FROM ml_iteration_features) GROUP BY 1, 2")
def dedup_steps(spark, base):
    rows = read_table(spark, base, "ml_iteration_features").select("experiment_id", "iteration_step", "load_id", F.coalesce("energy", F.lit(float("nan"))).alias("energy"))
    return trajectory.deduplicate_steps(rows, "experiment_id", "iteration_step", ["load_id"])


@query("distinct_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_keys(spark, base):
    return read_table(spark, base, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("union_append", "SELECT c_custkey AS k, 'customer' AS origin FROM customer UNION ALL SELECT o_custkey, 'orders' FROM orders")
def union_append(spark, base):
    customer, orders = _tables(spark, base, "customer", "orders")
    return customer.select(F.col("c_custkey").alias("k"), F.lit("customer").alias("origin")).unionByName(orders.select(F.col("o_custkey").alias("k"), F.lit("orders").alias("origin")))


@query("except_ids", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def except_ids(spark, base):
    customer, orders = _tables(spark, base, "customer", "orders")
    return customer.select(F.col("c_custkey").alias("k")).subtract(orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k")))


@query("intersect_ids", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def intersect_ids(spark, base):
    customer, orders = _tables(spark, base, "customer", "orders")
    return customer.select(F.col("c_custkey").alias("k")).intersect(orders.select(F.col("o_custkey").alias("k")))


@query("required_columns", "SELECT r AS missing FROM (SELECT unnest(['load_id', 'energy', 'reference_energy']) AS r) WHERE r NOT IN (SELECT column_name FROM (DESCRIBE ml_iteration_features))")
def required_columns(spark, base):
    have = read_table(spark, base, "ml_iteration_features").columns
    return spark.range(1).select(F.explode(F.array_except(F.array(*[F.lit(c) for c in ("load_id", "energy", "reference_energy")]), F.array(*[F.lit(c) for c in have]))).alias("missing"))


# --- nested records: the nine tables of the archived runs ---------------------------------------------------


def runs(spark: SparkSession, base: str) -> DataFrame:
    return ingest.one_per_run(read_table(spark, base, "vqe_runs"), "record_id")


RUNS = "WITH r AS (SELECT * FROM vqe_runs WHERE experiment_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY experiment_id ORDER BY record_id) = 1)\n"
_I, _V = "vqe_result.initial_data", "vqe_result"
_ITS = f"SELECT experiment_id, molecule_id, basis_set, {_I}.backend AS backend, unnest({_V}.iteration_list) AS it, unnest(range(len({_V}.iteration_list))) AS pos FROM r"


def _vector_sql(source: str, value: str, kind: str) -> str:
    return RUNS + f"SELECT experiment_id, molecule_id, basis_set, backend, num_qubits, CAST(pos AS INTEGER) AS parameter_index, v AS {value}, experiment_id || '_{kind}_' || pos AS parameter_id FROM (SELECT experiment_id, molecule_id, basis_set, {_I}.backend AS backend, {_I}.num_qubits AS num_qubits, unnest({source}) AS v, unnest(range(len({source}))) AS pos FROM r)"


_NORMAL_SQL = {
    "molecules": RUNS + "SELECT experiment_id, molecule_id, array_to_string(molecule.molecule_data.symbols, '') AS molecule_name, molecule.molecule_data.multiplicity AS multiplicity, molecule.molecule_data.charge AS charge, molecule.molecule_data.units AS coordinate_units, array_to_string(molecule.molecule_data.symbols, '|') AS atom_symbols, round(list_sum(flatten(molecule.molecule_data.coords)), 6) AS coordinates, len(molecule.molecule_data.masses) || ':' || round(coalesce(list_sum(molecule.molecule_data.masses), 0), 6) AS atomic_masses FROM r",
    "ansatz_info": RUNS + f"SELECT experiment_id, molecule_id, basis_set, {_I}.ansatz AS ansatz, {_I}.ansatz_reps AS ansatz_reps, coalesce({_I}.ansatz_name, 'EfficientSU2') AS ansatz_name, coalesce({_I}.init_strategy, 'random') AS init_strategy FROM r",
    "performance_metrics": RUNS + f"SELECT experiment_id, molecule_id, basis_set, hamiltonian_time, mapping_time, vqe_time, total_time, {_V}.minimization_time AS minimization_time, hamiltonian_time + mapping_time + vqe_time AS computed_total_time FROM r",
    "vqe_results": RUNS + f"SELECT experiment_id, molecule_id, basis_set, {_I}.backend AS backend, {_I}.num_qubits AS num_qubits, {_I}.optimizer AS optimizer, {_I}.noise_backend AS noise_backend, {_I}.default_shots AS default_shots, {_I}.ansatz_reps AS ansatz_reps, coalesce({_I}.ansatz_name, 'EfficientSU2') AS ansatz_name, coalesce({_I}.init_strategy, 'random') AS init_strategy, {_I}.seed AS seed, {_V}.minimum AS minimum_energy, {_V}.maxcv AS maxcv, {_V}.nuclear_repulsion_energy AS nuclear_repulsion_energy, {_V}.success AS success, {_V}.nfev AS nfev, {_V}.nit AS nit, CAST(len({_V}.iteration_list) AS INTEGER) AS total_iterations FROM r",
    "initial_parameters": _vector_sql(f"{_I}.initial_parameters", "initial_parameter_value", "init"),
    "optimal_parameters": _vector_sql(f"{_V}.optimal_parameters", "optimal_parameter_value", "opt"),
    "vqe_iterations": RUNS + f"SELECT experiment_id, molecule_id, basis_set, backend, it.iteration AS iteration_step, it.result AS iteration_energy, it.std AS energy_std_dev, it.energy_delta AS energy_delta, it.parameter_delta_norm AS parameter_delta_norm, it.cumulative_min_energy AS cumulative_min_energy, experiment_id || '_iter_' || pos AS iteration_id FROM ({_ITS}) WHERE it IS NOT NULL",
    "iteration_parameters": RUNS + f"SELECT experiment_id, molecule_id, basis_set, iteration_step, iteration_id, CAST(q AS INTEGER) AS parameter_index, v AS parameter_value, iteration_id || '_param_' || q AS parameter_id FROM (SELECT experiment_id, molecule_id, basis_set, it.iteration AS iteration_step, experiment_id || '_iter_' || pos AS iteration_id, unnest(it.parameters) AS v, unnest(range(len(it.parameters))) AS q FROM ({_ITS}) WHERE it IS NOT NULL)",
    "hamiltonian_terms": RUNS + f"SELECT experiment_id, molecule_id, basis_set, backend, t.label AS term_label, t.coefficients.real AS coeff_real, t.coefficients.imaginary AS coeff_imag, CAST(pos AS INTEGER) AS term_index, experiment_id || '_term_' || pos AS term_id FROM (SELECT experiment_id, molecule_id, basis_set, {_I}.backend AS backend, unnest({_I}.hamiltonian) AS t, unnest(range(len({_I}.hamiltonian))) AS pos FROM r)",
}


def _normal(name: str):
    def run(spark, base):
        out = ingest.normal_tables(runs(spark, base))[name]
        if name == "molecules":  # arrays as text and sums, so that any engine compares them
            total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
            flat = F.flatten("coordinates")
            out = out.withColumns({
                "atom_symbols": F.array_join("atom_symbols", "|"), "coordinates": F.when(F.size(F.filter(flat, lambda x: x.isNotNull())) > 0, F.round(total(flat), 6)),
                "atomic_masses": F.concat_ws(":", F.when(F.col("atomic_masses").isNotNull(), F.size("atomic_masses")).cast("string"), F.round(total(F.col("atomic_masses")), 6).cast("string")),
            })
            out = out.withColumn("atomic_masses", F.when(F.col("atomic_masses") != "", F.col("atomic_masses")))
        return out

    return run


for _name, _sql in _NORMAL_SQL.items():
    query(f"normal_{_name}", _sql)(_normal(_name))


@query("content_ids")
def content_ids(spark, base):
    """Content hash of every archived run: JSON text, so no SQL elsewhere gives it."""
    return read_table(spark, base, "vqe_runs").select("record_id", ingest.content_id().alias("run_identity"))


@query("compat_child_ids")
def compat_child_ids(spark, base):
    return ingest.normal_tables(runs(spark, base), compat_ids=True)["hamiltonian_terms"].select("experiment_id", "term_index", "term_id")


@query("identity_sha256", "SELECT o_orderkey, sha256(o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority) AS id FROM orders")
def identity_sha256(spark, base):
    return read_table(spark, base, "orders").select("o_orderkey", F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"), 256).alias("id"))


@query("nested_flatten", "SELECT record_id, molecule.molecule_data.charge AS charge, vqe_result.initial_data.optimizer AS optimizer, vqe_result.minimum AS minimum, len(vqe_result.iteration_list) AS n_iterations FROM vqe_runs")
def nested_flatten(spark, base):
    return read_table(spark, base, "vqe_runs").select("record_id", F.col("molecule.molecule_data.charge").alias("charge"), F.col("vqe_result.initial_data.optimizer").alias("optimizer"), F.col("vqe_result.minimum").alias("minimum"), F.size("vqe_result.iteration_list").cast("bigint").alias("n_iterations"))


@query("explode_array", "SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings")
def explode_array(spark, base):
    return read_table(spark, base, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v")).withColumn("pos", F.col("pos").cast("bigint"))


_LINES = "SELECT l_orderkey, list(struct_pack(l_linenumber := l_linenumber, l_partkey := l_partkey, l_quantity := l_quantity) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS lines FROM lineitem GROUP BY l_orderkey"


@query("inline_structs", f"SELECT l_orderkey, unnest(range(len(lines))) AS pos, unnest(lines).l_linenumber AS l_linenumber, unnest(lines).l_partkey AS l_partkey, unnest(lines).l_quantity AS l_quantity FROM ({_LINES})")
def inline_structs(spark, base):
    rows = read_table(spark, base, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).alias("lines"))
    return rows.select("l_orderkey", F.posexplode("lines").alias("pos", "x")).select("l_orderkey", F.col("pos").cast("bigint").alias("pos"), "x.l_linenumber", "x.l_partkey", "x.l_quantity")


@query("default_coalesce", "SELECT load_id, coalesce(init_strategy, 'random') AS init_strategy, coalesce(ansatz_type, 'EfficientSU2') AS ansatz_type FROM ml_iteration_features")
def default_coalesce(spark, base):
    return read_table(spark, base, "ml_iteration_features").select("load_id", F.coalesce("init_strategy", F.lit("random")).alias("init_strategy"), F.coalesce("ansatz_type", F.lit("EfficientSU2")).alias("ansatz_type"))


@query("array_join_name", "SELECT molecule_id, coalesce(name, array_to_string(symbols, '')) AS display_name, array_to_string(symbols, '') AS joined, len(symbols) AS num_atoms FROM molecule_catalog")
def array_join_name(spark, base):
    return read_table(spark, base, "molecule_catalog").select("molecule_id", F.coalesce("name", F.array_join("symbols", "")).alias("display_name"), F.array_join("symbols", "").alias("joined"), F.size("symbols").cast("bigint").alias("num_atoms"))


@query("molecule_geometry", "SELECT molecule_id, min(x) AS min_coord, max(x) AS max_coord, round(avg(x), 9) AS mean_coord FROM (SELECT molecule_id, unnest(flatten(coords)) AS x FROM molecule_catalog) GROUP BY molecule_id")
def molecule_geometry(spark, base):
    x = read_table(spark, base, "molecule_catalog").select("molecule_id", F.explode(F.flatten("coords")).alias("x"))
    return x.groupBy("molecule_id").agg(F.min("x").alias("min_coord"), F.max("x").alias("max_coord"), r9(F.avg("x")).alias("mean_coord"))


@query(
    "vector_l2_delta",
    """SELECT record_id, CAST(pos AS INTEGER) AS step, round(CASE WHEN len(p) = len(q) AND len([x for x in p if x IS NULL]) + len([x for x in q if x IS NULL]) = 0
      THEN sqrt(coalesce(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p, q)]), 0)) END, 9) AS norm
    FROM (SELECT record_id, pos, it.parameters AS p, lag(it.parameters) OVER (PARTITION BY record_id ORDER BY pos) AS q
      FROM (SELECT record_id, unnest(vqe_result.iteration_list) AS it, unnest(range(len(vqe_result.iteration_list))) AS pos FROM vqe_runs) WHERE it IS NOT NULL)""",
)
def vector_l2_delta(spark, base):
    """Distance of each iteration's parameter vector from the one before, in order of place."""
    its = read_table(spark, base, "vqe_runs").select("record_id", F.posexplode("vqe_result.iteration_list").alias("step", "it")).where("it is not null")
    rows = trajectory.with_parameter_norms(its.select(F.col("record_id").alias("run_id"), "step", F.col("it.parameters").alias("parameters")))
    return rows.select(F.col("run_id").alias("record_id"), "step", r9(F.col("parameter_delta_norm")).alias("norm"))


@query("vector_norms", "SELECT vec_id, round(sqrt(list_sum([CAST(x AS DOUBLE) * CAST(x AS DOUBLE) for x in embedding])), 9) AS norm FROM embeddings")
def vector_norms(spark, base):
    return read_table(spark, base, "embeddings").select("vec_id", r9(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).alias("norm"))


@query(
    "complex_other_bucket",
    f"""SELECT record_id, CASE WHEN sqrt(re * re + im * im) > 0.05 THEN label ELSE 'Other' END AS term, round(sum(re), 9) AS real_sum, round(sum(im), 9) AS imaginary_sum, round(sum(sqrt(re * re + im * im)), 9) AS magnitude_sum, round(avg(atan2(im, re)), 6) AS mean_phase, count(*) AS n
    FROM (SELECT record_id, t.label AS label, t.coefficients.real AS re, t.coefficients.imaginary AS im FROM (SELECT record_id, unnest({_I}.hamiltonian) AS t FROM vqe_runs)) GROUP BY 1, 2""",
)
def complex_other_bucket(spark, base):
    terms = read_table(spark, base, "vqe_runs").select("record_id", F.explode("vqe_result.initial_data.hamiltonian").alias("t")).select("record_id", "t.label", F.col("t.coefficients.real").alias("re"), F.col("t.coefficients.imaginary").alias("im"))
    return _round(metrics.complex_buckets(terms, "record_id", "label", "re", "im", 0.05), "real_sum", "imaginary_sum", "magnitude_sum").withColumn("mean_phase", F.round("mean_phase", 6))


# --- derived metrics, observability, batches -----------------------------------------------------------------


@query(
    "accuracy_score",
    """SELECT load_id, round(energy - final_energy, 9) AS energy_error_hartree, round((energy - final_energy) * 1000.0, 9) AS energy_error_millihartree,
    CASE WHEN final_energy <> 0 THEN round(abs(energy - final_energy) / abs(final_energy) * 100.0, 9) END AS relative_error_percent,
    CASE WHEN energy - final_energy IS NULL THEN NULL WHEN abs(energy - final_energy) < 1e-10 THEN 100.0 ELSE round(greatest(0.0, 100.0 * (1 - log10(abs(energy - final_energy) * 1000.0 + 1) / 5)), 9) END AS accuracy_score
    FROM ml_iteration_features""",
)
def accuracy_score(spark, base):
    rows = read_table(spark, base, "ml_iteration_features")
    return rows.select("load_id", *[r9(c).alias(n) for n, c in observability.accuracy(F.col("energy"), F.col("final_energy")).items()])


@query(
    "efficiency_metrics",
    """SELECT record_id, CASE WHEN n <> 0 AND vqe_time <> 0 THEN n / vqe_time END AS iterations_per_second, CASE WHEN n <> 0 AND vqe_time <> 0 THEN vqe_time / n END AS time_per_iteration,
    CASE WHEN total_time <> 0 AND vqe_time > 0 THEN (total_time - vqe_time) / vqe_time END AS overhead_ratio, CASE WHEN total_time <> 0 AND vqe_time <> 0 THEN vqe_time / total_time END AS efficiency_ratio,
    CASE WHEN vqe_time <> 0 AND hamiltonian_time <> 0 AND mapping_time <> 0 THEN coalesce((hamiltonian_time + mapping_time) / nullif(total_time, 0), 0) END AS setup_ratio
    FROM (SELECT *, len(vqe_result.iteration_list) AS n FROM vqe_runs)""",
)
def efficiency_metrics(spark, base):
    rows = read_table(spark, base, "vqe_runs").withColumn("n", F.size("vqe_result.iteration_list"))
    columns = observability.efficiency(*[F.col(c) for c in ("n", "total_time", "vqe_time", "hamiltonian_time", "mapping_time")])
    return rows.select("record_id", *[c.alias(n) for n, c in columns.items()])


_PD = "CAST(json_extract({}, '$.system.{}') AS DOUBLE)"


@query(
    "perf_delta_json",
    f"""SELECT record_id, {_PD.format('e', 'cpu.percent')} - {_PD.format('s', 'cpu.percent')} AS cpu_percent_delta, {_PD.format('e', 'memory.percent')} - {_PD.format('s', 'memory.percent')} AS memory_percent_delta,
    ({_PD.format('e', 'memory.used')} - {_PD.format('s', 'memory.used')}) / 1073741824.0 AS memory_used_delta_gb, coalesce(e->>'$.container_type', s->>'$.container_type') AS container_type,
    least(json_array_length(e, '$.gpu'), json_array_length(s, '$.gpu')) AS n_gpus,
    CASE WHEN least(json_array_length(e, '$.gpu'), json_array_length(s, '$.gpu')) > 0 THEN round(CAST(json_extract(e, '$.gpu[0].utilization_gpu') AS DOUBLE) - CAST(json_extract(s, '$.gpu[0].utilization_gpu') AS DOUBLE), 9) END AS gpu0_utilization_delta
    FROM (SELECT record_id, CASE WHEN json_valid(performance_start) THEN CAST(performance_start AS JSON) END AS s, CASE WHEN json_valid(performance_end) THEN CAST(performance_end AS JSON) END AS e FROM vqe_runs)""",
)
def perf_delta_json(spark, base):
    rows = read_table(spark, base, "vqe_runs").select("record_id", ingest.perf_delta().alias("d"))
    first = F.get(F.col("d.gpu"), F.lit(0))
    return rows.select("record_id", "d.cpu_percent_delta", "d.memory_percent_delta", "d.memory_used_delta_gb", "d.container_type", F.size("d.gpu").alias("n_gpus"), r9(first["utilization_gpu_delta"]).alias("gpu0_utilization_delta"))


@query("exposition_lines", """SELECT event_id, 'event_user{type="' || event_type || '",source="' || replace(props, '"', '\\"') || '"} ' || user_id AS line FROM events""")
def exposition_lines(spark, base):
    line = observability.exposition("event_user", {"type": F.col("event_type"), "source": F.col("props")}, F.col("user_id"))
    return read_table(spark, base, "events").select("event_id", line.alias("line"))


_COUNTER = "WITH c AS (SELECT user_id, ts, event_id, CAST(floor(value) AS BIGINT) AS v FROM events), i AS (SELECT *, CASE WHEN lag(v) OVER w IS NULL THEN 0 WHEN v < lag(v) OVER w THEN v ELSE v - lag(v) OVER w END AS increase FROM c WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"


def _counter(spark, base):
    rows = read_table(spark, base, "events").select("user_id", "ts", "event_id", F.floor("value").alias("v"), F.struct("ts", "event_id").alias("at"))
    return observability.counter_increase(rows, "user_id", "at", "v")


@query("counter_increase", _COUNTER + " SELECT event_id, increase FROM i")
def counter_increase(spark, base):
    return _counter(spark, base).select("event_id", "increase")


@query("counter_rate", _COUNTER + " SELECT user_id, strftime(time_bucket(INTERVAL 1 hour, ts), '%Y-%m-%d %H:%M:%S') AS window_start, CAST(sum(increase) AS BIGINT) AS increase, sum(increase) / 3600.0 AS rate FROM i GROUP BY 1, 2")
def counter_rate(spark, base):
    out = observability.windowed_rate(_counter(spark, base), "user_id", "ts", "1 hour")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


_HOUR = "strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start"


@query("tumbling_1h", f"SELECT event_type, {_HOUR}, count(*) AS n, round(sum(value), 6) AS total FROM (SELECT *, time_bucket(INTERVAL 1 hour, ts) AS w FROM events) GROUP BY event_type, w")
def tumbling_1h(spark, base):
    rows = read_table(spark, base, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return rows.select("event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "total")


@query("sliding_10m", f"SELECT event_type, {_HOUR}, count(*) AS n FROM (SELECT event_type, time_bucket(INTERVAL 5 minute, ts) - i * INTERVAL 5 minute AS w FROM events, (SELECT unnest([0, 1]) AS i)) GROUP BY event_type, w")
def sliding_10m(spark, base):
    rows = read_table(spark, base, "events").groupBy("event_type", F.window("ts", "10 minutes", "5 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


@query(
    "session_30m",
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 minute THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    k AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM g)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM k GROUP BY user_id, s""",
)
def session_30m(spark, base):
    rows = read_table(spark, base, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


@query("staleness", "SELECT lane_id, date_diff('second', date_trunc('second', max(received_at)), TIMESTAMPTZ '2026-01-01 00:00:00+00') AS age_seconds, date_diff('second', date_trunc('second', max(received_at)), TIMESTAMPTZ '2026-01-01 00:00:00+00') > 3600 AS stale FROM run_messages GROUP BY lane_id")
def staleness(spark, base):
    return observability.staleness(read_table(spark, base, "run_messages"), "lane_id", "received_at", F.to_timestamp(F.lit("2026-01-01 00:00:00"))).select("lane_id", "age_seconds", "stale")


@query("ratio_alert", "SELECT lane_id, count(*) FILTER (record_count IS NULL) / count(*) AS ratio, count(*) FILTER (record_count IS NULL) / count(*) > 0.1 AS firing FROM run_files GROUP BY lane_id")
def ratio_alert(spark, base):
    return observability.ratio_alert(read_table(spark, base, "run_files"), "lane_id", F.col("record_count").isNull())


@query(
    "alert_hold",
    """WITH m AS (SELECT user_id, ts, event_id, value > 20 AS c FROM events), g AS (SELECT *, row_number() OVER w - sum(CAST(c AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, epoch(date_trunc('second', min(ts))) AS since, count(*) AS n FROM g WHERE c GROUP BY user_id, g.g HAVING epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) >= 3600""",
)
def alert_hold(spark, base):
    rows = read_table(spark, base, "events")
    return observability.held_alerts(rows, "user_id", "ts", F.col("value") > 20, 3600).select("user_id", F.unix_timestamp("since").cast("double").alias("since"), "n")


PHASES = ["5-LOW", "1-URGENT", "3-MEDIUM"]


@query("phase_order", "SELECT o_orderpriority, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS rank, count(*) AS n FROM orders GROUP BY 1")
def phase_order(spark, base):
    return read_table(spark, base, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).withColumn("rank", observability.phase_rank("o_orderpriority", PHASES).cast("int"))


_MATRIX = "SELECT r_name || '__' || n_name || '__' || mode || '__seed' || seed AS run_key, r_name AS lane FROM region, nation, (SELECT unnest(['hf', 'random']) AS mode), (SELECT unnest(range(3)) AS seed) WHERE r_regionkey = n_regionkey"


def _matrix(spark, base):
    region, nation = _tables(spark, base, "region", "nation")
    lanes = region.join(nation, F.col("r_regionkey") == F.col("n_regionkey"))
    plan = observability.run_matrix(lanes, spark.createDataFrame([("hf",), ("random",)], "mode string"), spark.range(3).select(F.col("id").alias("seed")))
    return plan.select(observability.run_key(F.col("r_name"), F.col("n_name"), F.col("mode"), seed=F.col("seed")).alias("run_key"), F.col("r_name").alias("lane"))


@query("batch_matrix", _MATRIX)
def batch_matrix(spark, base):
    return _matrix(spark, base)


_STATE = f"SELECT run_key, lane, CASE WHEN ascii(sha256(run_key)) % 4 = 0 THEN 'done' WHEN ascii(sha256(run_key)) % 4 = 1 THEN 'failed' WHEN ascii(sha256(run_key)) % 4 = 2 THEN 'in_progress' END AS state, ascii(sha256(run_key)) * 60 AS seconds FROM ({_MATRIX})"


def _state(spark, base):
    code = F.ascii(F.sha2("run_key", 256))
    rows = _matrix(spark, base).withColumn("state", F.when(code % 4 == 0, "done").when(code % 4 == 1, "failed").when(code % 4 == 2, "in_progress")).where("state is not null")
    start = F.to_timestamp(F.lit("2025-01-01 00:00:00"))
    return rows.withColumns({"started_at": start, "completed_at": F.when(F.col("state") == "done", F.timestamp_seconds(F.unix_timestamp(start) + code * 60))})


@query("batch_pending", f"SELECT run_key FROM ({_STATE}) WHERE state IS DISTINCT FROM 'done'")
def batch_pending(spark, base):
    return _matrix(spark, base).join(_state(spark, base).where("state = 'done'").select("run_key"), "run_key", "left_anti").select("run_key")


@query("batch_status", f"SELECT lane, count(*) AS total, count(*) FILTER (state = 'done') AS done, count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'in_progress') AS in_progress, count(*) FILTER (state IS NULL) AS pending FROM ({_STATE}) GROUP BY lane")
def batch_status(spark, base):
    return observability.batch_status(_matrix(spark, base), _state(spark, base), "run_key", ["lane"]).select("lane", "total", "done", "failed", "in_progress", "pending")


@query("batch_eta", f"SELECT avg(seconds) AS mean_seconds, avg(seconds) * (SELECT count(*) FROM ({_STATE}) WHERE state IS NULL) / 3 AS eta_seconds FROM (SELECT seconds FROM ({_STATE}) WHERE state = 'done' ORDER BY seconds DESC, run_key LIMIT 20)")
def batch_eta(spark, base):
    status = observability.batch_status(_matrix(spark, base), _state(spark, base), "run_key", ["lane"])
    return observability.batch_eta(_state(spark, base), observability.batch_progress(status))


@query("batch_progress", f"SELECT count(*) AS total, count(*) FILTER (state = 'done') AS done, count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'in_progress') AS in_progress, count(*) FILTER (state IS NULL) AS pending, count(*) FILTER (state = 'done') * 100 // count(*) AS done_percent FROM ({_STATE})")
def batch_progress(spark, base):
    return observability.batch_progress(observability.batch_status(_matrix(spark, base), _state(spark, base), "run_key", ["lane"]))


_UPDATED = f"SELECT run_key, CASE WHEN lane = 'ASIA' THEN 'done' ELSE state END AS state, seconds FROM ({_STATE}) WHERE state IS NOT NULL OR lane = 'ASIA'"


@query("state_file", f"SELECT state, count(*) AS n FROM ({_UPDATED}) GROUP BY state")
def state_file(spark, base):
    """The batch's state written as a file, read, updated for one lane (known and new keys), written and read again."""
    path = scratch_path(spark, "state") + ".json"
    observability.save_state(_state(spark, base), path)
    news = _matrix(spark, base).where("lane = 'ASIA'").select("run_key", F.lit("done").alias("state"), F.lit(None).cast("timestamp").alias("started_at"), F.lit(None).cast("timestamp").alias("completed_at"))
    observability.save_state(observability.upsert_state(observability.read_state(spark, path), news), path)
    return observability.read_state(spark, path).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


# --- model input and metrics -----------------------------------------------------------------------------------


@query("median_impute", "SELECT load_id, coalesce(energy_delta, (SELECT median(energy_delta) FROM ml_iteration_features), 0.0) AS energy_delta, coalesce(parameter_delta_norm, (SELECT median(parameter_delta_norm) FROM ml_iteration_features), 0.0) AS parameter_delta_norm FROM ml_iteration_features")
def median_impute(spark, base):
    rows = read_table(spark, base, "ml_iteration_features").select("load_id", "energy_delta", "parameter_delta_norm")
    return metrics.median_impute(rows, ["energy_delta", "parameter_delta_norm"])


@query("standardize_pop", "SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 9) AS c_acctbal FROM customer")
def standardize_pop(spark, base):
    return _round(metrics.standardize(read_table(spark, base, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"]), "c_acctbal")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


@query("one_hot", "SELECT c_custkey, " + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s.lower()}" for s in _SEGMENTS) + " FROM customer")
def one_hot(spark, base):
    return read_table(spark, base, "customer").select("c_custkey", *metrics.one_hot("c_mktsegment", _SEGMENTS))


@query("interactions", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * l_discount AS l_quantity_x_l_discount, l_quantity * l_tax AS l_quantity_x_l_tax, l_discount * l_tax AS l_discount_x_l_tax FROM lineitem")
def interactions(spark, base):
    return read_table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *metrics.interactions(["l_quantity", "l_discount", "l_tax"]))


_SCORED = "SELECT d.source AS source, l.y AS y, d.n_chars / (d.n_chars + 400.0) AS s FROM (SELECT doc_id, max(abusive) AS y FROM review_labels WHERE abusive IS NOT NULL GROUP BY doc_id) l JOIN documents d USING (doc_id)"
_CLASS = """WITH b AS ({src}), t AS (SELECT s, count(*) FILTER (y = 1) AS p, count(*) AS n FROM b GROUP BY s),
 r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(p) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp, sum(n) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn FROM t),
 m AS (SELECT sum(p) AS pos, sum(n) AS n, sum(p * (below + (n + 1) / 2)) AS ranks, sum(p * cp / cn) AS ap FROM r),
 h AS (SELECT avg((s - y) * (s - y)) AS brier, CAST(count(*) FILTER (s >= 0.5 AND y = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (s >= 0.5 AND y = 0) AS DOUBLE) AS fp, CAST(count(*) FILTER (s < 0.5 AND y = 1) AS DOUBLE) AS fn, CAST(count(*) FILTER (s < 0.5 AND y = 0) AS DOUBLE) AS tn FROM b)
 SELECT CAST(n AS BIGINT) AS n_rows, round((ranks - pos * (pos + 1) / 2) / (pos * (n - pos)), 9) AS roc_auc, round(ap / pos, 9) AS average_precision, round(brier, 9) AS brier, round(coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0), 9) AS mcc FROM m, h"""


def _scored(spark, base):
    labels = read_table(spark, base, "review_labels").where("abusive is not null").groupBy("doc_id").agg(F.max("abusive").alias("label"))
    return labels.join(read_table(spark, base, "documents").select("doc_id", "source", "n_chars"), "doc_id").withColumn("score", F.col("n_chars") / (F.col("n_chars") + 400.0))


@query("classification_metrics", _CLASS.format(src=_SCORED))
def classification_metrics(spark, base):
    out = metrics.classification_metrics(_scored(spark, base))
    return _round(out, "roc_auc", "average_precision", "brier", "mcc")


@query("regression_metrics", "SELECT count(*) AS n_rows, round(avg(abs(e)), 9) AS mae, round(sqrt(avg(e * e)), 9) AS rmse, round(1 - sum(e * e) / (var_pop(y) * count(*)), 9) AS r2 FROM (SELECT final_energy AS y, final_energy - energy AS e FROM ml_iteration_features WHERE final_energy IS NOT NULL AND energy IS NOT NULL)")
def regression_metrics(spark, base):
    return _round(metrics.regression_metrics(read_table(spark, base, "ml_iteration_features"), "final_energy", "energy"), "mae", "rmse", "r2")


@query("grouped_regression_metrics", "SELECT l_returnflag, count(*) AS n_rows, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2 FROM (SELECT l_returnflag, l_extendedprice / 1000 AS y, l_extendedprice / 1000 - l_quantity AS e FROM lineitem) GROUP BY l_returnflag")
def grouped_regression_metrics(spark, base):
    rows = read_table(spark, base, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / 1000).alias("y"), "l_quantity")
    out = metrics.regression_metrics(rows, "y", "l_quantity", ["l_returnflag"])
    return out.withColumns({c: F.round(c, 6) for c in ("mae", "rmse", "r2")})


@query("metric_summary", "SELECT optimizer, ansatz_reps, round(avg(energy_moving_std_5), 4) AS mean_std, count(energy_moving_std_5) AS n FROM ml_iteration_features WHERE isfinite(energy_moving_std_5) GROUP BY 1, 2")
def metric_summary(spark, base):
    rows = read_table(spark, base, "ml_iteration_features").where(F.col("energy_moving_std_5").isNotNull() & ~F.isnan("energy_moving_std_5") & (F.abs("energy_moving_std_5") < float("inf")))
    return rows.groupBy("optimizer", "ansatz_reps").agg(F.round(F.avg("energy_moving_std_5"), 4).alias("mean_std"), F.count("energy_moving_std_5").alias("n"))


@query("best_by_metric", "SELECT c_acctbal, c_custkey, c_mktsegment FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_acctbal DESC, c_custkey, c_mktsegment LIMIT 1")
def best_by_metric(spark, base):
    return metrics.best_by(read_table(spark, base, "customer"), "c_acctbal", ["c_custkey", "c_mktsegment"])


@query("class_balance", "SELECT molecule_name, count(*) FILTER (converged) AS n_pos, count(*) FILTER (NOT converged) AS n_neg, coalesce(count(*) FILTER (NOT converged) / nullif(count(*) FILTER (converged), 0), 1.0) AS pos_weight FROM ml_iteration_features GROUP BY molecule_name")
def class_balance(spark, base):
    rows = read_table(spark, base, "ml_iteration_features").withColumn("label", F.col("converged").cast("int"))
    return metrics.class_balance(rows, "label", ["molecule_name"])


@query("lomo_split_counts", "SELECT g.molecule_name AS held_out, count(*) FILTER (f.molecule_name <> g.molecule_name) AS n_train, count(*) FILTER (f.molecule_name = g.molecule_name) AS n_test FROM (SELECT DISTINCT molecule_name FROM ml_iteration_features WHERE molecule_name IS NOT NULL) g, ml_iteration_features f WHERE f.molecule_name IS NOT NULL GROUP BY 1")
def lomo_split_counts(spark, base):
    """Rows on either side of each leave-one-group-out fold, from one aggregate of groups."""
    sizes = read_table(spark, base, "ml_iteration_features").where("molecule_name is not null").groupBy("molecule_name").agg(F.count(F.lit(1)).alias("n_test"))
    total = sizes.agg(F.sum("n_test").alias("n"))  # one row
    return sizes.crossJoin(F.broadcast(total)).select(F.col("molecule_name").alias("held_out"), (F.col("n") - F.col("n_test")).alias("n_train"), "n_test")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
