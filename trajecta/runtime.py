"""Session, shared scratch folder and small Hadoop file-system helpers.

Everything that must outlive an executor goes to the folder the cluster names in
``spark.checkpoint.dir``.  Only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "trajecta", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench share."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(conf.pop("shuffle_partitions", 8)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="trajecta-")
        atexit.register(shutil.rmtree, own, True)
        named = "file://" + own
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, unique to this call."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there, and later
    stages survive the loss of any executor.  The folder goes when the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    FileSystem(spark, path).delete_on_exit(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a data folder; zone-less timestamps become UTC instants."""
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{base}/{name}.parquet")
    ntz = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for work that is heavy per row.

    Only an input of fewer splits than cores is shuffled; larger ones are left as they are read.  A plan
    with a shuffle of its own is left to adaptive execution: asking for its partitions would run it.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if any(node in plan for node in ("Join", "Aggregate", "Window", "Sort", "Repartition", "Deduplicate", "Distinct", "FlatMapGroups", "CoGroup")):
        return df
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class FileSystem:
    """The few Hadoop file-system calls the table layers need (any scheme Spark can write to)."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self._path(old), self._path(new))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def subdirs(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory())

    def sizes(self, path: str) -> list[tuple[str, int]]:
        """(path, bytes) of every data file under ``path``, without markers and hidden files."""
        found, it = [], self._fs.listFiles(self._path(path), True)
        while it.hasNext():
            s = it.next()
            name = s.getPath().getName()
            if not name.startswith(("_", ".")):
                found.append((s.getPath().toString(), s.getLen()))
        return found

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete_on_exit(self, path: str) -> None:
        self._fs.deleteOnExit(self._path(path))

    def create_text(self, path: str, text: str) -> bool:
        """Create a small file; False if it is there already.

        The store's own create-without-overwrite decides between several writers.  A reader may see the
        file before its text is complete.
        """
        try:
            out = self._fs.create(self._path(path), False)
        except Exception:  # noqa: BLE001  (each store has its own error for an existing file)
            if self.exists(path):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def replace_text(self, path: str, text: str) -> None:
        """Write a small file under a temporary name and rename it over ``path``."""
        temporary = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self._fs.create(self._path(temporary), True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.rename(temporary, path):
            self.delete(path)
            self.rename(temporary, path)


def conf_scope(spark: SparkSession, **settings: str):
    """Context manager: session settings that hold for the block and are put back after it."""
    from contextlib import contextmanager

    @contextmanager
    def scope():
        before = {k: spark.conf.get(k, None) for k in settings}
        try:
            for k, v in settings.items():
                spark.conf.set(k, v)
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return scope()


def own_cores() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
