"""Many small files into few well-sized ones, nothing lost or doubled.

Method: the engine's own split packing.  ``spark.sql.files.maxPartitionBytes`` and the file-open
cost are set so that the scan packs small files into combined splits of the wanted size; the splits
are coalesced without a shuffle, written to a staging folder, read back, compared with the source
(rows and an order-free checksum), and only then renamed into place.

Which logical files are still valid comes from the reports of earlier consolidations, free text or
JSON in no fixed form; ``reports`` reads them into (batch, role, reference) rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import FileSystem, conf_scope, cut, scratch_path
from .bitmaps import bit_is_set, id_bitmaps
from .once import with_json
from .reports import parse_report

MIB = 1 << 20
#: Bitmaps of 32,768 file ids that are broadcast at most (4 KB each, 200 MB in all).
BROADCAST_BITMAPS = 50_000
#: Source bytes that one task of a consolidation writes.
TASK_BYTES = 128 * MIB


def _report_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(b, role, ref) for b, t in zip(pdf["processing_batch_id"], pdf["source_data_info"], strict=True) if b is not None for role, ref in parse_report(t)]
        yield pd.DataFrame(rows, columns=["batch", "role", "ref"])


def report_roles(metadata: DataFrame, name: str = "file_consolidation") -> DataFrame:
    """(batch, role, ref): what the reports of consolidations say, repeated reports once; written once.

    Only the log of batches is parsed in Python, one short text per batch, never data.
    """
    log = metadata.where(F.col("processing_name") == name).select("processing_batch_id", "source_data_info").distinct()
    return cut(log.mapInPandas(_report_rows, "batch string, role string, ref string").distinct(), "roles")


def unread_reports(metadata: DataFrame, name: str = "file_consolidation") -> DataFrame:
    """(batch, report): reports that no file or batch could be read from.  They leave every file as it is."""
    return report_roles(metadata, name).where("role = 'unread'").select("batch", F.col("ref").alias("report"))


def consolidation_roles(metadata: DataFrame, files: DataFrame, name: str = "file_consolidation") -> DataFrame:
    """(file_id): the files that no longer hold valid data: inputs of a successful batch and outputs of an unsuccessful one.

    A batch is successful if its report says so and no report rolls it back.  Only references to files of
    the listing count; spans of numbers are written out inside the listing's own range.  Unread reports and null
    texts change nothing.
    """
    roles = report_roles(metadata, name)  # read five times below
    undone = roles.where("role = 'rollback'").select(F.lower("ref").alias("key")).distinct()
    good = (
        roles.where("role = 'end'").groupBy("batch").agg(F.min(F.col("ref") == "good").alias("good"))
        .withColumn("key", F.lower("batch")).join(undone, "key", "left_anti").where("good").select("batch")
    )
    refs = roles.where("role in ('input', 'output')")
    inputs = refs.where("role = 'input'").join(good, "batch", "left_semi")
    outputs = refs.where("role = 'output'").join(good, "batch", "left_anti")
    dead = inputs.select("ref").unionByName(outputs.select("ref")).distinct()
    listing = files.select("file_id", "file_path").where("file_id is not null")
    ends = listing.agg(F.min("file_id").alias("__lo"), F.max("file_id").alias("__hi"))  # one row
    span = dead.where(r"ref rlike '^[0-9]+[.][.][0-9]+$'").crossJoin(F.broadcast(ends)).select(
        F.greatest(F.expr("try_cast(split_part(ref, '..', 1) as bigint)"), "__lo").alias("lo"), F.least(F.expr("try_cast(split_part(ref, '..', 2) as bigint)"), "__hi").alias("hi")
    ).where("lo <= hi")
    numbers = dead.select(F.expr("try_cast(ref as bigint)").alias("file_id")).where("file_id is not null").unionByName(span.select(F.explode(F.sequence("lo", "hi")).alias("file_id")))
    by_id = listing.select("file_id").join(numbers.distinct(), "file_id", "left_semi")
    by_path = listing.join(dead.withColumnRenamed("ref", "file_path"), "file_path", "left_semi").select("file_id")
    return by_id.unionByName(by_path).distinct()


def file_sizes(messages: DataFrame) -> DataFrame:
    """(file_id, bytes, n_records) as stored: the listing's own figures may be wrong.  A null payload has no bytes but is a row."""
    return messages.where("file_id is not null").groupBy("file_id").agg(
        F.sum(F.coalesce(F.octet_length("payload"), F.lit(0))).cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("n_records")
    )


def valid_files(messages: DataFrame, metadata: DataFrame, files: DataFrame) -> DataFrame:
    """(file_id, bytes, n_records) of files with records that no consolidation has replaced or spoilt."""
    return file_sizes(messages).join(consolidation_roles(metadata, files), "file_id", "left_anti")


def split_plan(valid: DataFrame, target_bytes: int = MIB, open_cost: int = 4096, under: int = 32_768, buckets: int = 256) -> DataFrame:
    """(file_id, bytes, n_records, small, split_no): the combined split each valid file is packed into.

    As the engine packs: files are laid end to end, each with the cost of opening it, and a split ends where
    the target is reached.  Positions are prefix sums over buckets of files, so no task sees all of them.
    ``small`` marks files of fewer than ``under`` bytes, those that a consolidation is for.
    """
    rows = valid.select("file_id", "bytes", "n_records").withColumn("b", F.pmod(F.xxhash64("file_id"), F.lit(buckets)).cast("int"))
    cost = F.col("bytes") + F.lit(open_cost)
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # over one row per bucket
    offsets = F.broadcast(rows.groupBy("b").agg(F.sum(cost).alias("w")).select("b", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("o")))
    inside = F.sum(cost).over(Window.partitionBy("b").orderBy("file_id").rowsBetween(Window.unboundedPreceding, 0)) - cost
    return rows.withColumn("w", inside).join(offsets, "b").select(
        "file_id", "bytes", "n_records", (F.col("bytes") < under).alias("small"), F.floor((F.col("o") + F.col("w")) / target_bytes).cast("bigint").alias("split_no")
    )


def consolidation_plan(messages: DataFrame, metadata: DataFrame, files: DataFrame, target_bytes: int = MIB, under: int = 32_768) -> DataFrame:
    """``split_plan`` of the files still valid, written once: what a consolidation takes in and how it is packed."""
    return cut(split_plan(valid_files(messages, metadata, files), target_bytes, open_cost=0, under=under), "consolidation-plan")


def small_files(plan: DataFrame) -> DataFrame:
    """(file_id) of the planned files that the consolidation is for."""
    return plan.where("small").select("file_id")


class LostRecords(RuntimeError):
    """The staged output doesn't hold exactly what the source holds."""


def _fingerprint(df: DataFrame, columns: list[str]) -> tuple[int, str]:
    row = df.select(F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)").alias("h")).agg(F.count(F.lit(1)), F.coalesce(F.sum("h"), F.lit(0)).cast("string")).first()
    return row[0], row[1]


def pack_splits(spark: SparkSession, read, out: str, target_bytes: int = MIB, write_format: str = "json", source_bytes: int | None = None, expansion: float = 1.0, open_cost: int = 4096, max_rows_per_file: int | None = None, tasks: int | None = None, partition_by: list[str] | None = None) -> dict:
    """Write what ``read()`` yields as few files of about ``target_bytes`` under ``out``; return what was done.

    ``read`` builds the DataFrame anew; it is called while ``maxPartitionBytes`` is
    ``target_bytes / expansion`` (bytes of the source for one output file) and the open cost is
    ``open_cost``, so its scan packs small files into combined splits.  ``expansion`` is output bytes
    per source byte.  The plan must not shuffle; splits are coalesced to ``tasks`` partitions (default:
    one for each output file), each rolled over to a new file after ``max_rows_per_file`` rows.
    ``out`` must not exist.  If the staged rows differ from the source the staging folder is removed and
    ``LostRecords`` raised.
    """
    fs, staging = FileSystem(spark, out), f"{out.rstrip('/')}.staging"
    if fs.exists(out):
        raise FileExistsError(out)
    fs.delete(staging)
    span = max(65_536, int(target_bytes / max(expansion, 1e-6)))
    with conf_scope(spark, **{"spark.sql.files.maxPartitionBytes": str(span), "spark.sql.files.openCostInBytes": str(open_cost), "spark.sql.files.minPartitionNum": "1"}):
        df = read()
        wanted = tasks or max(1, math.ceil((source_bytes or 0) * expansion / target_bytes)) if source_bytes else tasks
        packed = df.coalesce(wanted) if wanted else df
        writer = packed.write.mode("errorifexists")
        if max_rows_per_file:
            writer = writer.option("maxRecordsPerFile", max_rows_per_file)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.format(write_format).save(staging)
        # the staged side is read as written, the source once more; both give count and checksum
        columns = df.columns
        staged = spark.read.schema(df.schema).format(write_format).load(staging)
        want, got = _fingerprint(df, columns), _fingerprint(staged, columns)
    if want != got:
        fs.delete(staging)
        raise LostRecords(f"source has {want[0]} rows, staged output {got[0]}, checksums {'equal' if want[1] == got[1] else 'differ'}")
    if not fs.rename(staging, out):
        raise RuntimeError(f"can't publish {out}")
    sizes = [n for _, n in fs.sizes(out)]
    return {"path": out, "rows": got[0], "files": len(sizes), "bytes": sum(sizes), "largest": max(sizes, default=0)}


def compact_files(spark: SparkSession, paths: list[str], out: str, schema, read_format: str = "json", target_bytes: int = 128 * MIB, write_format: str = "parquet", expansion: float = 1.0) -> dict:
    """Compact real files under ``paths`` into files of about ``target_bytes`` at ``out``."""
    fs = FileSystem(spark, paths[0])
    total = sum(n for p in paths for _, n in fs.sizes(p))
    return pack_splits(spark, lambda: spark.read.schema(schema).format(read_format).option("recursiveFileLookup", True).load(paths), out, target_bytes, write_format, total or 1, expansion)


def consolidate_runs(messages: DataFrame, plan: DataFrame, out: str | None = None, target_bytes: int = MIB) -> DataFrame:
    """Write the vqe_result of every record in the files of the plan as few JSON-lines files of about ``target_bytes``.

    Returns (output_file, n_records, n_bytes, first_record_id, last_record_id), read back from the
    published files.  A payload that isn't valid JSON has no vqe_result; its text is kept in
    ``raw_payload``, so no record is lost.  Empty input gives no files and no rows.
    """
    spark = messages.sparkSession
    out = out or scratch_path(spark, "consolidated")
    total = plan.agg(F.coalesce(F.max("split_no"), F.lit(-1)) + 1, F.coalesce(F.sum("n_records"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if not total[1]:
        return spark.createDataFrame([], "output_file string, n_records bigint, n_bytes bigint, first_record_id bigint, last_record_id bigint")
    n_files = max(1, total[0])
    per_file = max(1, math.ceil(total[1] / n_files))

    wanted = cut(id_bitmaps(plan, "file_id"), "wanted-files")
    small = wanted.count() <= BROADCAST_BITMAPS

    def read() -> DataFrame:
        if small:  # the payloads are filtered by bitmaps where they are read
            marked = messages.withColumn("bucket", F.bitmap_bucket_number("file_id"))
            kept = marked.join(F.broadcast(wanted), "bucket").where(bit_is_set("bits", F.bitmap_bit_position("file_id")))
        else:
            kept = messages.join(plan.select("file_id"), "file_id", "left_semi")
        v = with_json(kept, "record_id", "file_id", "line_no", "payload")
        result = F.to_json(F.expr("try_variant_get(v, '$.vqe_result', 'variant')"))
        return v.select("record_id", "file_id", "line_no", result.alias("vqe_result"), F.when(F.col("v").isNull(), F.col("payload")).alias("raw_payload"))

    tasks = max(1, min(n_files // 4, max(spark.sparkContext.defaultParallelism * 4, math.ceil(total[2] / TASK_BYTES))))
    pack_splits(spark, read, out, target_bytes, "json", max_rows_per_file=per_file, tasks=tasks)
    published = spark.read.schema("record_id bigint, file_id bigint, line_no int, vqe_result string, raw_payload string").json(out)
    return published.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("output_file"), F.col("_metadata.file_size").alias("n_bytes")).agg(
        F.count(F.lit(1)).alias("n_records"), F.min("record_id").alias("first_record_id"), F.max("record_id").alias("last_record_id")
    ).select("output_file", "n_records", "n_bytes", "first_record_id", "last_record_id")
