"""Topic folders, JSON and mixed scans, molecule files, synthetic trajectories."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import trajectory
from ..operators.ingest import RAW_DDL
from ..runtime import FileSystem
from . import avro


def raw_schema(spark: SparkSession) -> T.StructType:
    return spark.createDataFrame([], RAW_DDL).schema


def topics(spark: SparkSession, bucket: str) -> list[str]:
    """Names of the topic folders; none if the bucket can't be listed."""
    try:
        return FileSystem(spark, bucket).subdirs(bucket)
    except Exception:  # noqa: BLE001
        return []


#: Partition columns of the two folder layouts.
BY_PARTITION, BY_HOUR = "partition int", "year int, month int, day int, hour int"


def read_topic(spark: SparkSession, bucket: str, topic: str, schema: T.StructType | None = None, layout: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """All records of a topic, JSON, Avro and Parquet files alike, whatever the folder layout below it.

    The explicit schema makes a record the same from any format; fields a file lacks are null.  With
    ``layout`` (columns of the ``name=value`` folders, as BY_PARTITION or BY_HOUR) these columns are added, and filters on
    them prune folders.  ``num_partitions`` spreads what was read round robin.  Files are listed by the engine.
    """
    path, kind = f"{bucket.rstrip('/')}/{topic}", schema or raw_schema(spark)
    if not FileSystem(spark, path).exists(path):
        return spark.createDataFrame([], kind)
    folders = spark.createDataFrame([], layout).schema if layout else T.StructType([])
    whole = T.StructType([*kind.fields, *folders.fields])

    def files(pattern: str):
        reader = spark.read.option("pathGlobFilter", pattern)
        return reader.option("basePath", path) if layout else reader.option("recursiveFileLookup", True)

    parts = [
        files("*.{json,json.gz,jsonl}").schema(whole).format("json").load(path),
        files("*.parquet").schema(whole).format("parquet").load(path),
        avro.read_avro(spark, path, kind, folders if layout else None),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.repartition(num_partitions) if num_partitions else out


def replay_spool(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """Records that could not be delivered, from the spool's ``molecule_<id>*.json`` files; none if there is no spool."""
    kind = schema or raw_schema(spark)
    if not FileSystem(spark, folder).exists(folder):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("pathGlobFilter", "molecule_*.json").option("recursiveFileLookup", True).json(folder)


def container_stats(lines: DataFrame, column: str = "line") -> DataFrame:
    """(name, cpu_percent, memory_used, memory_limit, memory_percent, net_io, block_io) of tab-separated container statistics.

    Heads and lines of fewer than two fields are left out; what isn't a number is null.
    """
    part = F.split(F.col(column), "\t")
    at = lambda i: F.trim(F.get(part, F.lit(i)))
    percent = lambda i: F.regexp_extract(at(i), r"^([0-9.]+)\s*%?$", 1)
    number = lambda c: F.when(c != "", c.cast("double"))
    rows = lines.where((F.size(part) >= 2) & ~F.upper(F.col(column)).startswith("NAME\t"))
    memory = F.split(at(2), r"\s*/\s*")
    return rows.select(
        at(0).alias("name"), number(percent(1)).alias("cpu_percent"), F.get(memory, F.lit(0)).alias("memory_used"), F.get(memory, F.lit(1)).alias("memory_limit"),
        number(percent(3)).alias("memory_percent"), at(4).alias("net_io"), at(5).alias("block_io"),
    )


def primitive(value):
    """numpy arrays and scalars, dates and containers as plain Python values, at any depth."""
    if isinstance(value, dict):
        return {str(k): primitive(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [primitive(v) for v in value]
    if isinstance(value, np.ndarray):
        return primitive(value.tolist())
    if isinstance(value, np.generic):
        return primitive(value.item())
    if isinstance(value, complex):
        return {"real": value.real, "imaginary": value.imag}
    return value


def with_defaults(raw: DataFrame) -> DataFrame:
    """Old records: init_strategy random, exact_estimator false, ansatz_name EfficientSU2."""
    start = F.col("vqe_result.initial_data")
    filled = start.withField("init_strategy", F.coalesce(start["init_strategy"], F.lit("random"))).withField("exact_estimator", F.coalesce(start["exact_estimator"], F.lit(False))).withField("ansatz_name", F.coalesce(start["ansatz_name"], F.lit("EfficientSU2")))
    return raw.withColumn("vqe_result", F.when(F.col("vqe_result").isNotNull(), F.col("vqe_result").withField("initial_data", filled)))


MOLECULE = "name string, symbols array<string>, coords array<array<double>>, multiplicity int, charge int, units string, masses array<double>, description string, expected_qubits int, complexity_level int"


def molecules(spark: SparkSession, path: str) -> DataFrame:
    """Molecule files with defaults; raises where symbols or coordinates are missing."""
    rows = spark.read.schema(MOLECULE).option("multiLine", True).json(path)
    missing = F.col("symbols").isNull() | F.col("coords").isNull()
    checked = rows.withColumn("symbols", F.when(missing, F.raise_error(F.lit("a molecule needs symbols and coords")).cast("array<string>")).otherwise(F.col("symbols")))
    return checked.withColumns({
        "multiplicity": F.coalesce("multiplicity", F.lit(1)), "charge": F.coalesce("charge", F.lit(0)), "units": F.coalesce("units", F.lit("angstrom")),
        "name": F.coalesce("name", F.array_join("symbols", "")),
    })


TRAJECTORY = (
    "run_id string, molecule_name string, num_qubits int, optimizer string, basis_set string, ansatz_reps int, init_strategy string, step bigint, energy double, energy_delta double, "
    "parameter_delta_norm double, cumulative_min_energy double, final_energy double, converged int"
)
SPECIES = [("H2", 4, -1.13), ("HeH+", 4, -2.86), ("LiH", 8, -7.88), ("BeH2", 10, -15.6), ("H2O", 12, -75.0), ("NH3", 14, -55.5)]


def synthetic_trajectories(spark: SparkSession, runs: int = 300, least: int = 55, most: int = 100, seed: int = 42, molecules: list[tuple] | None = None) -> DataFrame:
    """Decaying energies with noise, each run from its own generator seeded by (seed, run).

    ``molecules`` are (name, qubits, ground energy).  All per-step features of ``trajectory.iteration_features`` are there.
    """
    known = molecules or SPECIES

    def make(batches):
        for pdf in batches:
            frames = []
            for r in pdf["id"]:
                g = np.random.default_rng([seed, int(r)])
                name, qubits, ground = known[int(r) % len(known)]
                strategy = "hf" if g.random() < 0.5 else "random"
                n = int(g.integers(least, most + 1))
                final = ground + abs(g.normal(0, 0.02))
                size = (0.2 if strategy == "hf" else 1.0) * (0.5 + g.random())
                speed = -np.log(0.01) / (n * g.uniform(0.4, 1.1))
                energy = final + size * np.exp(-speed * np.arange(n)) + g.normal(0, 0.002, n)
                norms = np.abs(g.normal(0.3, 0.1, n)) * np.exp(-speed * np.arange(n))
                frames.append(pd.DataFrame({
                    "run_id": f"run-{r}", "molecule_name": name, "num_qubits": qubits, "optimizer": ["COBYLA", "L-BFGS-B", "SLSQP"][int(g.integers(3))], "basis_set": "sto3g", "ansatz_reps": int(g.integers(1, 4)),
                    "init_strategy": strategy, "step": np.arange(1, n + 1), "energy": energy, "energy_delta": np.concatenate([[np.nan], np.diff(energy)]), "parameter_delta_norm": np.concatenate([[np.nan], norms[1:]]),
                    "cumulative_min_energy": np.minimum.accumulate(energy), "final_energy": final, "converged": int(size * np.exp(-speed * n) < 0.01 * size + 0.002),
                }))
            if frames:
                out = pd.concat(frames, ignore_index=True)
                yield out.astype(object).where(out.notna(), None)

    rows = spark.range(0, runs, 1, max(1, min(64, runs // 50))).mapInPandas(make, TRAJECTORY)
    return trajectory.iteration_features(rows.withColumn("total_iterations", F.count(F.lit(1)).over(Window.partitionBy("run_id"))))


REGRESSOR_SPECIES = [("H2", 4, -1.137, 2), ("HeH+", 4, -2.863, 2), ("LiH", 8, -7.882, 3), ("BeH2", 10, -15.595, 3), ("H2O", 12, -75.012, 4), ("NH3", 14, -55.455, 4)]
REGRESSOR = (
    "experiment_id string, molecule_name string, num_qubits int, ansatz_reps int, optimizer string, basis_set string, iteration_step bigint, energy double, energy_delta double, "
    "cumulative_min_energy double, minimum_energy double, final_energy double"
)


def synthetic_regressor_trajectories(spark: SparkSession, runs: int = 300, most: int = 150, seed: int = 42, species: list[tuple] | None = None) -> DataFrame:
    """Trajectories for the energy regressor: steps from 0, each run settling in one of its molecule's local minima.

    ``species`` are (name, qubits, ground energy, number of local minima).  Each run has its own generator, seeded by (seed, run).
    """
    known = species or REGRESSOR_SPECIES

    def make(batches):
        for pdf in batches:
            for r in pdf["id"]:
                g = np.random.default_rng([seed, 1, int(r)])
                name, qubits, ground, minima = known[int(r) % len(known)]
                n = int(g.integers(max(2, most // 3), most + 1))
                level = ground + 0.04 * int(g.integers(minima)) + abs(g.normal(0, 0.003))
                energy = level + (0.3 + g.random()) * np.exp(-g.uniform(3, 7) * np.arange(n) / n) + g.normal(0, 0.002, n)
                least = np.minimum.accumulate(energy)
                delta = [None, *np.diff(energy).tolist()]
                yield pd.DataFrame({
                    "experiment_id": f"exp-{r}", "molecule_name": name, "num_qubits": qubits, "ansatz_reps": int(g.integers(1, 5)), "optimizer": ["COBYLA", "L-BFGS-B", "SLSQP"][int(g.integers(3))],
                    "basis_set": ["sto-3g", "6-31g"][int(g.integers(2))], "iteration_step": np.arange(n), "energy": energy, "energy_delta": pd.Series(delta, dtype=object), "cumulative_min_energy": least,
                    "minimum_energy": least, "final_energy": float(least[-1]),
                })

    return spark.range(0, runs, 1, max(1, min(64, runs // 50))).mapInPandas(make, REGRESSOR)
