"""Nested run records into nine flat tables with a content-derived run identity."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The raw run record; readers always use it, so field order and types never depend on a file.
RAW_DDL = """molecule_id int, basis_set string, hamiltonian_time double, mapping_time double, vqe_time double, total_time double,
performance_start string, performance_end string,
molecule struct<molecule_data: struct<symbols: array<string>, coords: array<array<double>>, multiplicity: int, charge: int, units: string, masses: array<double>>>,
vqe_result struct<
initial_data: struct<backend: string, num_qubits: int, hamiltonian: array<struct<label: string, coefficients: struct<real: double, imaginary: double>>>,
num_parameters: int, initial_parameters: array<double>, optimizer: string, ansatz: string, noise_backend: string, default_shots: int, ansatz_reps: int,
init_strategy: string, seed: int, ansatz_name: string, exact_estimator: boolean>,
iteration_list: array<struct<iteration: int, parameters: array<double>, result: double, std: double, energy_delta: double, parameter_delta_norm: double, cumulative_min_energy: double>>,
minimum: double, optimal_parameters: array<double>, maxcv: double, minimization_time: double, nuclear_repulsion_energy: double, success: boolean, nfev: int, nit: int>"""

#: Names of the raw record's columns.
RAW_NAMES = "molecule_id basis_set hamiltonian_time mapping_time vqe_time total_time performance_start performance_end molecule vqe_result".split()
_D, _R, _I = "molecule.molecule_data", "vqe_result", "vqe_result.initial_data"


def content_id() -> Column:
    """64 hex digits over molecule, basis and inputs; results don't count, and a null field is like a missing one."""
    return F.sha2(F.to_json(F.struct(F.col(_D).alias("molecule_data"), "basis_set", F.col(_I).alias("initial_data"))), 256)


def with_identity(raw: DataFrame) -> DataFrame:
    return raw.withColumn("experiment_id", content_id())


def one_per_run(df: DataFrame, order: str, key: str = "experiment_id") -> DataFrame:
    """The record of least ``order`` of each run; rows without key go.

    The kept ids come from a partial aggregate and restrict the rows by a semi join on ``order``, which is
    unique: a run delivered very often moves no more than once per task.
    """
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order)).select(order)
    return df.join(kept, order, "left_semi")


def _base(df: DataFrame) -> DataFrame:
    return df.where("experiment_id is not null")


def _child_id(kind: str, *parts: Column, compat: bool = False) -> Column:
    """Child key: the parent's and the place; with ``compat`` the place is a hash modulo a million, which may repeat or be negative."""
    last = (F.hash(*parts) % 1_000_000) if compat else F.concat_ws("_", *[p.cast("string") for p in parts])
    return F.concat_ws("_", "experiment_id", F.lit(kind), last.cast("string"))


def normal_tables(runs: DataFrame, compat_ids: bool = False) -> dict[str, DataFrame]:
    """The nine tables of runs that have an experiment_id (one record per run, see ``one_per_run``).

    Empty and null arrays have no child rows; a null iteration has none either.  Places count from 0.
    """
    b = _base(runs)
    iterations = b.select("experiment_id", "molecule_id", "basis_set", F.col(f"{_I}.backend").alias("backend"), F.posexplode(f"{_R}.iteration_list").alias("pos", "it")).where("it is not null")
    iteration_id = _child_id("iter", F.col("pos"), compat=compat_ids)
    common = ["experiment_id", "molecule_id", "basis_set"]

    def vector(source: str, value: str, kind: str) -> DataFrame:
        rows = b.select(*common, F.col(f"{_I}.backend").alias("backend"), F.col(f"{_I}.num_qubits").alias("num_qubits"), F.posexplode(source).alias("parameter_index", value))
        return rows.withColumn("parameter_id", _child_id(kind, F.col("parameter_index"), compat=compat_ids))

    i = F.col
    return {
        "molecules": b.select("experiment_id", "molecule_id", i(f"{_D}.symbols").alias("atom_symbols"), F.array_join(f"{_D}.symbols", "").alias("molecule_name"), i(f"{_D}.coords").alias("coordinates"), i(f"{_D}.multiplicity").alias("multiplicity"), i(f"{_D}.charge").alias("charge"), i(f"{_D}.units").alias("coordinate_units"), i(f"{_D}.masses").alias("atomic_masses")),
        "ansatz_info": b.select(*common, i(f"{_I}.ansatz").alias("ansatz"), i(f"{_I}.ansatz_reps").alias("ansatz_reps"), F.coalesce(i(f"{_I}.ansatz_name"), F.lit("EfficientSU2")).alias("ansatz_name"), F.coalesce(i(f"{_I}.init_strategy"), F.lit("random")).alias("init_strategy")),
        "performance_metrics": b.select(*common, "hamiltonian_time", "mapping_time", "vqe_time", "total_time", i(f"{_R}.minimization_time").alias("minimization_time"), (i("hamiltonian_time") + i("mapping_time") + i("vqe_time")).alias("computed_total_time")),
        "vqe_results": b.select(*common, *[i(f"{_I}.{c}").alias(c) for c in ("backend", "num_qubits", "optimizer", "noise_backend", "default_shots", "ansatz_reps")], F.coalesce(i(f"{_I}.ansatz_name"), F.lit("EfficientSU2")).alias("ansatz_name"), F.coalesce(i(f"{_I}.init_strategy"), F.lit("random")).alias("init_strategy"), i(f"{_I}.seed").alias("seed"), i(f"{_R}.minimum").alias("minimum_energy"), *[i(f"{_R}.{c}").alias(c) for c in ("maxcv", "nuclear_repulsion_energy", "success", "nfev", "nit")], F.size(f"{_R}.iteration_list").alias("total_iterations")),
        "initial_parameters": vector(f"{_I}.initial_parameters", "initial_parameter_value", "init"),
        "optimal_parameters": vector(f"{_R}.optimal_parameters", "optimal_parameter_value", "opt"),
        "vqe_iterations": iterations.select(*common, "backend", i("it.iteration").alias("iteration_step"), i("it.result").alias("iteration_energy"), i("it.std").alias("energy_std_dev"), i("it.energy_delta").alias("energy_delta"), i("it.parameter_delta_norm").alias("parameter_delta_norm"), i("it.cumulative_min_energy").alias("cumulative_min_energy"), iteration_id.alias("iteration_id")),
        "iteration_parameters": iterations.select(*common, i("it.iteration").alias("iteration_step"), "pos", iteration_id.alias("iteration_id"), F.posexplode("it.parameters").alias("parameter_index", "parameter_value")).withColumn("parameter_id", F.concat_ws("_", "iteration_id", F.lit("param"), F.col("parameter_index").cast("string"))).drop("pos"),
        "hamiltonian_terms": b.select(*common, i(f"{_I}.backend").alias("backend"), F.posexplode(f"{_I}.hamiltonian").alias("term_index", "t")).select(*common, "backend", i("t.label").alias("term_label"), i("t.coefficients.real").alias("coeff_real"), i("t.coefficients.imaginary").alias("coeff_imag"), "term_index", _child_id("term", F.col("term_index"), compat=compat_ids).alias("term_id")),
    }


#: Key and partition columns of each table.
TABLES: dict[str, tuple[list[str], list[str]]] = {
    "molecules": (["experiment_id", "molecule_id"], ["processing_date"]),
    "ansatz_info": (["experiment_id", "molecule_id"], ["processing_date", "basis_set"]),
    "performance_metrics": (["experiment_id", "molecule_id", "basis_set"], ["processing_date", "basis_set"]),
    "vqe_results": (["experiment_id", "molecule_id", "basis_set"], ["processing_date", "basis_set", "backend"]),
    "initial_parameters": (["parameter_id"], ["processing_date", "basis_set"]),
    "optimal_parameters": (["parameter_id"], ["processing_date", "basis_set"]),
    "vqe_iterations": (["iteration_id"], ["processing_date", "basis_set", "backend"]),
    "iteration_parameters": (["parameter_id"], ["processing_date", "basis_set"]),
    "hamiltonian_terms": (["term_id"], ["processing_date", "basis_set", "backend"]),
}


def with_batch(df: DataFrame, name: str, now: datetime, batch: str | None = None) -> DataFrame:
    """Add the four processing columns; the clock and the batch id come from the caller."""
    return df.withColumns({
        "processing_timestamp": F.lit(now).cast("timestamp"), "processing_date": F.lit(now.date()).cast("date"),
        "processing_batch_id": F.lit(batch or str(uuid.uuid4())), "processing_name": F.lit(name),
    })


def new_records(df: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in ``existing``; rows with a null key go, on creation as on append."""
    filled = df.na.drop(subset=keys)
    return filled if existing is None else filled.join(existing.select(*keys), keys, "left_anti")


def restrict(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def fan_out(dimension: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): keys that a join on them would multiply."""
    return dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def volume_report(counts: dict[str, int]) -> dict:
    """What a batch brought: tables with new records of all, a text of all counts, and a warning or None.

    Fewer iterations than results point to messages that were cut short.
    """
    iterations, results = counts.get("vqe_iterations"), counts.get("vqe_results")
    short = results and iterations is not None and iterations < results
    return {
        "tables": len(counts), "tables_with_new": sum(n > 0 for n in counts.values()), "summary": ", ".join(f"{t}={n}" for t, n in counts.items()),
        "warning": f"vqe_iterations ({iterations}) < vqe_results ({results})" if short else None,
    }


class FanOut(RuntimeError):
    """A join returned more rows than its source."""


def guarded_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that must be unique on the right; raises ``FanOut`` before any row is multiplied."""
    if not fan_out(right, [key]).isEmpty():
        raise FanOut(f"{key} isn't unique on the right side")
    return left.join(right, key, "left")


def perf_delta(start: str = "performance_start", end: str = "performance_end") -> Column:
    """Differences of two JSON snapshots: cpu and memory percent, memory in GB, gpu list by place; absent keys give null."""
    kind = "struct<system: struct<cpu: struct<percent: double>, memory: struct<used: double, percent: double>>, container_type: string, gpu: array<struct<utilization_gpu: double, utilization_memory: double, power_draw: double>>>"
    a, b = F.from_json(start, kind), F.from_json(end, kind)
    gpus = F.transform(
        F.sequence(F.lit(1), F.least(F.size(a["gpu"]), F.size(b["gpu"]))),
        lambda i: F.struct((i - 1).alias("index"), *[(F.element_at(b["gpu"], i)[c] - F.element_at(a["gpu"], i)[c]).alias(f"{c}_delta") for c in ("utilization_gpu", "utilization_memory", "power_draw")]),
    )
    return F.struct(
        (b["system"]["cpu"]["percent"] - a["system"]["cpu"]["percent"]).alias("cpu_percent_delta"),
        (b["system"]["memory"]["percent"] - a["system"]["memory"]["percent"]).alias("memory_percent_delta"),
        ((b["system"]["memory"]["used"] - a["system"]["memory"]["used"]) / F.lit(float(1 << 30))).alias("memory_used_delta_gb"),
        F.coalesce(b["container_type"], a["container_type"]).alias("container_type"),
        F.when(F.least(F.size(a["gpu"]), F.size(b["gpu"])) > 0, gpus).alias("gpu"),
    )


def total_energy(minimum: str = "minimum_energy", repulsion: str = "nuclear_repulsion_energy") -> Column:
    return F.col(minimum) + F.coalesce(F.col(repulsion), F.lit(0.0))
