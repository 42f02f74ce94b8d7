"""Versioned append-only tables on Parquet: snapshots, tags, time travel, audit, compaction.

Data of a snapshot lies in ``data/_commit=<token>``; the snapshot holds once ``log/N`` is written, which is created
without overwriting, so of two writers one wins.  A read is one scan of the folders of the snapshots wanted, whatever
their number, so time travel prunes files.  A folder without log entry is a failed write and is never read.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.compaction import pack_splits
from ..operators.ingest import new_records
from ..runtime import FileSystem


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, partitions: list[str] | None = None, comment: str = "") -> None:
        self.spark, self.path, self.keys, self.partitions, self.comment = spark, path.rstrip("/"), keys, partitions or [], comment
        self.fs = FileSystem(spark, self.path)

    def exists(self) -> bool:
        return bool(self.snapshots())

    def snapshots(self) -> list[dict]:
        """All snapshots, oldest first.  An entry that isn't complete yet doesn't count."""
        out = []
        for n in (n for n in self.fs.names(f"{self.path}/log") if n.isdigit()):
            try:
                out.append(json.loads(self.fs.read_text(f"{self.path}/log/{n}")))
            except ValueError:
                continue
        return out

    def latest(self) -> int | None:
        found = self.snapshots()
        return found[-1]["snapshot_id"] if found else None

    def tags(self) -> dict[str, int]:
        return {n: int(self.fs.read_text(f"{self.path}/tags/{n}")) for n in self.fs.names(f"{self.path}/tags") if not n.endswith(".tmp")}

    def tag(self, name: str, snapshot: int) -> None:
        self.fs.mkdirs(f"{self.path}/tags")
        if not self.fs.create_text(f"{self.path}/tags/{name}", str(snapshot)):
            raise ValueError(f"tag {name} exists")

    def read(self, tag: str | None = None, snapshot: int | None = None) -> DataFrame:
        """The table as of a tag or snapshot, else now."""
        found = self.snapshots()
        if not found:
            raise FileNotFoundError(self.path)
        upto = self.tags()[tag] if tag else snapshot if snapshot is not None else found[-1]["snapshot_id"]
        held = [s for s in found if s["snapshot_id"] <= upto]
        start = max((i for i, s in enumerate(held) if s["operation"] == "compact"), default=0)
        kind = StructType.fromJson(json.loads(held[-1]["schema"]))
        folders = [f"{self.path}/data/{s['folder']}" for s in held[start:]]
        return self.spark.read.schema(StructType([*kind.fields, StructField("_commit", StringType())])).option("basePath", f"{self.path}/data").parquet(*folders).drop("_commit")

    def _commit(self, folder: str, operation: str, rows: int, schema: str) -> int:
        number = max((int(n) for n in self.fs.names(f"{self.path}/log") if n.isdigit()), default=0) + 1
        self.fs.mkdirs(f"{self.path}/log")
        entry = {"snapshot_id": number, "committed_at": datetime.now(UTC).isoformat(), "operation": operation, "rows": rows, "folder": folder, "schema": schema, "comment": self.comment}
        if not self.fs.create_text(f"{self.path}/log/{number:010d}", json.dumps(entry)):
            raise RuntimeError("another writer committed first; append again")
        return number

    def append(self, df: DataFrame, tag: str | None = None) -> tuple[str | None, int]:
        """Append the rows whose key is new (all rows without keys): (tag, rows), or (None, 0) if there are none.

        Rows with a null key are left out; of equal keys within ``df`` one row is kept.
        """
        if self.keys:
            df = new_records(df.dropDuplicates(self.keys), self.read() if self.exists() else None, self.keys)
        folder, writer = f"_commit={uuid.uuid4().hex}", df.write.mode("errorifexists")
        (writer.partitionBy(*self.partitions) if self.partitions else writer).parquet(f"{self.path}/data/{folder}")
        # counted from the footers of what was written; an Observation would leave a manager in the session that
        # later MLlib tasks can't serialise
        held = sum(n for _, n in self.fs.sizes(f"{self.path}/data/{folder}"))
        rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{folder}").count() if held else 0
        if not rows:
            self.fs.delete(f"{self.path}/data/{folder}")
            return None, 0
        name = tag or f"v_{'incr_' if self.exists() else ''}{uuid.uuid4().hex}"
        ordered = df.select(*[c for c in df.columns if c not in self.partitions], *self.partitions)
        self.tag(name, self._commit(folder, "append", rows, ordered.schema.json()))
        return name, rows

    def compact(self, target_bytes: int = 128 << 20) -> dict:
        """Rewrite all rows as few files; older snapshots and tags stay readable."""
        folder, now = f"_commit={uuid.uuid4().hex}", self.read()
        found = self.snapshots()
        start = max((i for i, s in enumerate(found) if s["operation"] == "compact"), default=0)
        held = sum(n for s in found[start:] for _, n in self.fs.sizes(f"{self.path}/data/{s['folder']}"))  # what is read, not what older snapshots hold
        done = pack_splits(self.spark, self.read, f"{self.path}/data/{folder}", target_bytes, "parquet", held or 1, partition_by=self.partitions)
        self._commit(folder, "compact", done["rows"], now.schema.json())
        return done


def create_audit_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The audit table in the session's catalog, if it isn't there; ``location`` names its folder, else the catalog does."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({AUDIT}) USING parquet{where}")


def catalog_tables(spark: SparkSession, names: list[str]) -> dict[str, DataFrame]:
    """The named tables of the catalog that exist."""
    return {n: spark.table(n) for n in names if spark.catalog.tableExists(n)}


def export(df: DataFrame, target: str, partitions: list[str] | None = None) -> dict:
    """Mirror a finished table to another store as Parquet, staged, counted and renamed; fails where the store can't be written."""
    fs, staging = FileSystem(df.sparkSession, target), f"{target.rstrip('/')}.staging"
    fs.mkdirs(target.rsplit("/", 1)[0])
    fs.delete(staging)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(staging)
    rows, want = df.sparkSession.read.parquet(staging).count(), df.count()
    if rows != want:
        fs.delete(staging)
        raise RuntimeError(f"{rows} rows arrived of {want}")
    fs.delete(target)
    if not fs.rename(staging, target):
        raise RuntimeError(f"can't publish {target}")
    return {"path": target, "rows": rows, "bytes": sum(n for _, n in fs.sizes(target))}


AUDIT = "processing_batch_id string, processing_name string, processing_timestamp timestamp, processing_date date, table_names array<string>, table_versions array<string>, record_counts array<bigint>, source_data_info string"


def audit_row(spark: SparkSession, batch: str, name: str, now: datetime, results: dict[str, tuple[str | None, int]], info: str) -> DataFrame:
    """One audit row: tables, their tags (no_changes where nothing was new) and counts."""
    row = (batch, name, now, now.date(), list(results), [t or "no_changes" for t, _ in results.values()], [n for _, n in results.values()], info)
    return spark.createDataFrame([row], AUDIT)
