"""Exactly one copy of each message that was delivered at least once.

Method: identifiers are encoded exactly by a dictionary (identifier -> code), sharded by hash;
the codes already kept are bits of sharded, compressed bitmaps; of the arrivals of a batch the
one of smallest row id is selected for each unseen bit; the new bits are united with the stored
ones and published by one atomic rename.

Scale: arrivals are reduced to one row per identifier by a partial aggregate before anything is
shuffled by identifier, so a single identifier that holds a third of all rows moves as one row per
task.  Surplus copies are found by an anti-join on the row id, which is unique and can't be skewed.
Everything runs in the JVM; nothing is collected.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import FileSystem, cut, scratch_path, spread
from .bitmaps import bit_is_set

#: Codes of a shard live in a range of their own, so shards grow without touching one another.
SHARD_SPAN_BITS = 40
#: Identifiers of a shard and of a slice of new identifiers, which one task puts in order, about.
SHARD_ROWS, SLICE_ROWS = 2_000_000, 250_000
DICTIONARY = "identifier string, code bigint, shard int"
BITMAPS = "bucket bigint, bits binary, shard int"


class SeenState:
    """Dictionary and bitmaps of what was kept so far, by shard and version, under ``path``.

    Version N writes ``dictionary/_v=<N>/shard=<S>`` (the entries it added) and ``bitmaps/_v=<N>/shard=<S>`` (the
    whole bitmap of each shard it touched, zstd-compressed Parquet: the runs of zero bytes all but vanish).  It holds
    once ``commits/<N>`` is there, which says where each shard's bitmap lies; that file is created without
    overwriting, so of two writers that try for the same number one fails and must start again.  Folders without
    commit are ignored.  A batch reads and writes the shards it touches only.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = FileSystem(spark, self.path)
        self.fs.mkdirs(f"{self.path}/commits")
        commits = self.commits()
        self.shards = commits[-1]["shards"] if commits else shards

    def commits(self) -> list[dict]:
        """What was published, oldest first; an entry that isn't complete yet doesn't count."""
        out = []
        for n in sorted(n for n in self.fs.names(f"{self.path}/commits") if n.isdigit()):
            try:
                out.append(json.loads(self.fs.read_text(f"{self.path}/commits/{n}")))
            except ValueError:
                continue
        return out

    def versions(self) -> list[int]:
        return [c["number"] for c in self.commits()]

    def next_number(self) -> int:
        return max((int(n) for n in self.fs.names(f"{self.path}/commits") if n.isdigit()), default=0) + 1

    def dictionary(self, shards: list[int] | None = None) -> DataFrame:
        """(identifier, shard, code); only of ``shards`` if given: others aren't opened."""
        paths = [f"{self.path}/dictionary/_v={c['folder']}" for c in self.commits()]
        if not paths:
            return self.spark.createDataFrame([], DICTIONARY)
        rows = self.spark.read.schema(f"{DICTIONARY}, _v string").option("basePath", f"{self.path}/dictionary").parquet(*paths).drop("_v")
        return rows if shards is None else rows.where(F.col("shard").isin(*shards))

    def bitmaps(self, shards: list[int] | None = None) -> DataFrame:
        """(shard, bucket, bits): the newest bitmap of every shard, or of ``shards``."""
        commits = self.commits()
        held = {} if not commits else {int(s): f for s, f in commits[-1]["bitmaps"].items() if shards is None or int(s) in set(shards)}
        paths = [f"{self.path}/bitmaps/_v={f}/shard={s}" for s, f in sorted(held.items())]
        if not paths:
            return self.spark.createDataFrame([], BITMAPS)
        return self.spark.read.schema(f"{BITMAPS}, _v string").option("basePath", f"{self.path}/bitmaps").parquet(*paths).drop("_v")


def first_arrivals(arrivals: DataFrame, identifier: str, row_id: str) -> DataFrame:
    """(identifier, row_id): the smallest row id of every identifier that isn't null."""
    return (
        arrivals.where(F.col(identifier).isNotNull() & F.col(row_id).isNotNull())
        .groupBy(F.col(identifier).cast("string").alias("identifier"))
        .agg(F.min(row_id).alias("row_id"))
    )


def keep_once(state: SeenState, arrivals: DataFrame, identifier: str, row_id: str) -> DataFrame:
    """Take in one batch; return (identifier, row_id) of the arrivals kept, one for each new identifier.

    Nulls: rows with a null identifier or row id are neither kept nor remembered.  Ties: the smallest
    row id of the batch wins; a batch taken in earlier wins over a later one.  An empty batch keeps
    nothing and publishes no version.  Other columns are ignored, whatever their names.
    """
    spark, number = state.spark, state.next_number()
    folder = f"{number:010d}-{uuid.uuid4().hex[:12]}"
    first, commits = first_arrivals(arrivals, identifier, row_id), state.commits()
    if state.shards is None:
        state.shards = shards_for(arrivals.count())  # at least as many as there are identifiers
    shard = F.pmod(F.xxhash64("identifier"), F.lit(state.shards)).cast("int")
    first = first.withColumn("shard", shard)
    if commits:
        first = cut(first, "first-arrivals")
        touched = [r["shard"] for r in first.select("shard").distinct().collect()]  # at most one row a shard
        known, old = state.dictionary(touched), state.bitmaps(touched)
        used = known.groupBy("shard").agg(F.max("code").alias("top"))
        first = first.join(known.select("identifier", "code"), "identifier", "left")
    else:
        old, used = state.bitmaps(), spark.createDataFrame([], "shard int, top bigint")
        first = first.withColumn("code", F.lit(None).cast("bigint"))
    # exact codes: new identifiers are numbered inside a slice of their shard, slices are laid end to end
    slices = max(1, SHARD_ROWS // SLICE_ROWS)
    new = first.where("code is null").withColumn("slice", F.pmod(F.shiftright(F.xxhash64("identifier"), 32), F.lit(slices)).cast("int"))
    sizes = new.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    begin = F.sum("n").over(Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    base = sizes.join(F.broadcast(used), "shard", "left").select(
        "shard", "slice", (F.coalesce(F.col("top"), F.shiftleft(F.col("shard").cast("bigint"), SHARD_SPAN_BITS) - 1) + F.coalesce(begin, F.lit(0))).alias("base")
    )  # at most shards x slices rows, shards is a parameter
    coded = new.withColumn("place", F.row_number().over(Window.partitionBy("shard", "slice").orderBy("identifier"))).join(F.broadcast(base), ["shard", "slice"])
    fresh = cut(coded.select("identifier", "shard", (F.col("base") + F.col("place")).alias("code"), "row_id"), "coded-arrivals")
    entries = f"{state.path}/dictionary/_v={folder}"
    fresh.select("identifier", "code", "shard").write.option("compression", "zstd").partitionBy("shard").parquet(entries)
    candidates = fresh.select("identifier", "shard", "code", "row_id")
    if commits:  # known identifiers whose bit was never set (a version lost between both writes) may still be kept
        candidates = candidates.unionByName(first.where("code is not null").select("identifier", "shard", "code", "row_id"))
    marked = candidates.withColumn("bucket", F.bitmap_bucket_number("code")).withColumn("bit", F.bitmap_bit_position("code"))
    seen = bit_is_set("bits", F.col("bit"))
    unseen = marked.join(old.select("bucket", "bits"), "bucket", "left").where(~seen).select("identifier", "row_id", "shard", "bucket", "bit") if commits else marked.select("identifier", "row_id", "shard", "bucket", "bit")
    kept = cut(unseen, "kept") if commits else unseen  # a first batch keeps all that was written above
    added = kept.groupBy("shard", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).select("bucket", "bits", "shard")
    both = old.unionByName(added).groupBy("shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")) if commits else added
    both.select("bucket", "bits", "shard").write.option("compression", "zstd").partitionBy("shard").parquet(f"{state.path}/bitmaps/_v={folder}")
    if not kept.isEmpty():
        written = {n.removeprefix("shard="): folder for n in state.fs.subdirs(f"{state.path}/bitmaps/_v={folder}") if n.startswith("shard=")}
        entry = {"number": number, "folder": folder, "shards": state.shards, "bitmaps": {**(commits[-1]["bitmaps"] if commits else {}), **written}}
        if not state.fs.create_text(f"{state.path}/commits/{number:010d}", json.dumps(entry)):
            raise RuntimeError("another writer published this version first; take the batch in again")
    return kept.select("identifier", "row_id")


def scratch_state(spark: SparkSession, shards: int | None = None) -> SeenState:
    """An empty state in the shared folder, deleted when the driver ends."""
    state = SeenState(spark, scratch_path(spark, "seen"), shards)
    state.fs.delete_on_exit(state.path)
    return state


def surplus(arrivals: DataFrame, identifier: str, row_id: str, shards: int | None = None, state: SeenState | None = None) -> DataFrame:
    """Row ids of every arrival that isn't the copy kept.  Rows without identifier aren't copies of anything.

    The whole table is one batch against ``state``, an empty one in the shared folder if none is given.
    """
    spark = arrivals.sparkSession
    state = state or scratch_state(spark, shards)
    kept = keep_once(state, arrivals, identifier, row_id)
    return arrivals.where(F.col(identifier).isNotNull() & F.col(row_id).isNotNull()).select(F.col(row_id).alias("row_id")).join(kept.select("row_id"), "row_id", "left_anti")


def with_json(df: DataFrame, *keep: str, payload: str = "payload") -> DataFrame:
    """``keep`` and ``v``: the payload as a variant if it is exactly one valid JSON value, else null.

    The text is parsed inside brackets, so whatever follows the value makes the parse fail.  Nothing is
    filtered: a predicate on ``v`` would be pushed below and the text parsed twice.
    """
    whole = df.select(*keep, F.expr(f"try_parse_json(concat('[', {payload}, ']'))").alias("__w"))
    one = "case when try_variant_get(__w, '$[1]', 'variant') is null then try_variant_get(__w, '$[0]', 'variant') end"
    return whole.select(*keep, F.expr(one).alias("v"))


def run_identifier():
    """Canonical text of what identifies a run in its payload, parsed as ``v``; null for text that isn't a JSON object.

    Numbers count by value (1, 1.0 and 1e0 are one; -0.0 is 0.0); the basis set without case and
    punctuation; missing and null parts are the same.
    """
    start = "$.vqe_result.initial_data"

    def number(path: str):
        return F.expr(f"try_variant_get(v, '{path}', 'double')")

    def text(path: str):
        return F.expr(f"try_variant_get(v, '{path}', 'string')")

    parts = F.struct(
        number("$.molecule_id").alias("m"),
        F.regexp_replace(F.lower(text("$.basis_set")), r"[^\p{L}\p{N}]", "").alias("b"),
        text(f"{start}.backend").alias("k"),
        number(f"{start}.num_qubits").alias("q"),
        text(f"{start}.optimizer").alias("o"),
        number(f"{start}.ansatz_reps").alias("r"),
        F.transform(F.expr(f"try_variant_get(v, '{start}.initial_parameters', 'array<double>')"), lambda x: F.when(x == 0, 0.0).otherwise(x)).alias("p"),
    )
    return F.when(F.expr("schema_of_variant(v) like 'OBJECT%'"), F.to_json(parts))


def message_identifiers(messages: DataFrame) -> DataFrame:
    """(row_id, identifier) of run messages, written once: the payloads are parsed a single time."""
    parsed = with_json(spread(messages.select(F.col("record_id").alias("row_id"), "payload")), "row_id")
    return cut(parsed.select("row_id", run_identifier().alias("identifier")), "run-ids")


def step_identifiers(features: DataFrame) -> DataFrame:
    """(row_id, identifier) of feature rows: id without case and outer blanks, and step.  Null ids don't count; a null step is one more step."""
    trimmed = F.lower(F.regexp_replace("experiment_id", r"^\s+|\s+$", ""))
    return features.select(
        F.col("load_id").alias("row_id"),
        F.when(F.col("experiment_id").isNotNull(), F.concat(trimmed, F.lit("\u0001"), F.coalesce(F.col("iteration_step").cast("string"), F.lit("-")))).alias("identifier"),
    )


def shards_for(rows: int, per_shard: int = SHARD_ROWS) -> int:
    """Shards so that one holds about ``per_shard`` identifiers."""
    return max(1, min(65_536, -(-rows // per_shard)))
