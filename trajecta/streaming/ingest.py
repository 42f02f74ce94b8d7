"""Structured Streaming: files to tables with exactly-once effect, windows, duplicates, alerts, dead letters."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..runtime import FileSystem
from ..sources import avro
from ..sources.tables import VersionedTable


def file_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "json", per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", True).load(path)


def kafka_options(servers: str, topic: str, group: str, security: str = "PLAINTEXT", **extra: str) -> dict[str, str]:
    """Options of Spark's Kafka source for PLAINTEXT, SSL, SASL_PLAINTEXT or SASL_SSL; only of use where its jar is present."""
    if security not in ("PLAINTEXT", "SSL", "SASL_PLAINTEXT", "SASL_SSL"):
        raise ValueError(f"unknown security protocol {security}")
    if security.startswith("SASL") and not {"sasl_mechanism", "sasl_jaas_config"} <= set(extra):
        raise ValueError("SASL needs sasl_mechanism and sasl_jaas_config")
    named = {"kafka.bootstrap.servers": servers, "subscribe": topic, "kafka.group.id": group, "startingOffsets": "earliest", "kafka.security.protocol": security}
    return named | {"kafka." + k.replace("_", "."): v for k, v in extra.items()}


def topic_stream(spark: SparkSession, options: dict[str, str], schemas: dict[int, object], target: T.StructType) -> DataFrame:
    """Messages of a topic, each decoded by its writer's schema; a bad one has nulls and its reason in ``decode_error``.  Needs Spark's Kafka jar."""
    return decoded(spark.readStream.format("kafka").options(**options).load().select(F.col("value").alias("message")), schemas, target)


def decoded(stream: DataFrame, schemas: dict[int, object], target: T.StructType, column: str = "message") -> DataFrame:
    """A stream of framed messages (from any source) as records and ``decode_error``."""
    return avro.decode_frames(stream, schemas, target, column)


def deliver(batch: DataFrame, send: Callable[[DataFrame], None], spool: str, key: str = "molecule_id", attempts: int = 3, pause: float = 1.0) -> bool:
    """Hand a batch to ``send`` with growing pauses between attempts; True if it went through.

    What can't be delivered is kept in ``spool`` as ``molecule_<key>-<token>.json`` files, which ``readers.replay_spool`` reads.
    """
    for n in range(attempts):
        try:
            send(batch)
            return True
        except Exception:  # noqa: BLE001  (whatever is wrong with the sink, the records are kept)
            if n + 1 < attempts:
                time.sleep(pause * 2**n)
    token = uuid.uuid4().hex
    staging, fs = f"{spool.rstrip('/')}/_staging-{token}", FileSystem(batch.sparkSession, spool)
    batch.withColumn("__k", F.coalesce(F.col(key).cast("string"), F.lit("none"))).write.partitionBy("__k").json(staging)
    for i, (path, _) in enumerate(fs.sizes(staging)):
        name = path.rsplit("/", 2)[-2].removeprefix("__k=")
        fs.rename(path, f"{spool.rstrip('/')}/molecule_{name}-{token}-{i}.json")
    fs.delete(staging)
    return False


def _run(writer, every: str | None):
    """Start a writer: to the end of what is there, or every so often (``10 seconds``) until it is stopped."""
    query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    if not every:
        query.awaitTermination()
    return query


def append_batches(stream: DataFrame, table: VersionedTable, checkpoint: str, dead_letters: str | None = None, attempts: int = 3, every: str | None = None):
    """Run the stream to its end (or every so often), appending each micro-batch to ``table`` by its keys.

    A batch that is run again adds nothing, as its keys are there.  A batch that fails ``attempts`` times
    is written to ``dead_letters`` as JSON and the query fails.
    """

    def write(batch: DataFrame, number: int) -> None:
        for left in range(attempts - 1, -1, -1):
            try:
                table.append(batch)
                return
            except Exception:
                if left:
                    continue
                if dead_letters:
                    batch.write.mode("append").json(f"{dead_letters}/batch={number}")
                raise

    return _run(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), every)


def object_sink(stream: DataFrame, path: str, checkpoint: str, ts: str | None = None, file_format: str = "json", every: str | None = None):
    """Stream to files, by hour of ``ts`` (year, month, day, hour) if it is named."""
    if ts:
        stream = stream.withColumns({n: F.date_format(ts, p) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))})
    writer = stream.writeStream.format(file_format).option("path", path).option("checkpointLocation", checkpoint)
    return _run(writer.partitionBy("year", "month", "day", "hour") if ts else writer, every)


def quarantine_sink(stream: DataFrame, error: str, good: VersionedTable, bad: VersionedTable, checkpoint: str, every: str | None = None):
    """Stream records to ``good`` and those with a reason in ``error`` to ``bad``; a bad record stops nothing."""

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            good.append(held.where(F.col(error).isNull()).drop(error))
            bad.append(held.where(F.col(error).isNotNull()))
        finally:
            held.unpersist()

    return _run(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), every)


def unique_messages(stream: DataFrame, key: str, ts: str, delay: str = "7 days") -> DataFrame:
    """Each key once within the watermark; the keyed append catches copies that come later."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, key: str, ts: str, window: str, slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return stream.withWatermark(ts, delay).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("window_start"), "n")


def session_counts(stream: DataFrame, key: str, ts: str, gap: str, delay: str = "10 minutes") -> DataFrame:
    """Sessions that the watermark has passed."""
    return stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("session_start"), "n")


def held_alerts(stream: DataFrame, key: str, ts: str, value: str, limit: float, hold_s: int, delay: str = "1 hour") -> DataFrame:
    """(key, since, until): a row when samples have stayed above ``limit`` for ``hold_s`` seconds; the state is one start time per key."""
    kind = stream.schema[key].dataType.simpleString()

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, fired = state.get if state.exists else (-1, 0)
        out = []
        rows = pd.concat(list(batches)).sort_values(ts)
        for t, v in zip(rows[ts], rows[value], strict=True):
            at = int(t.timestamp())
            if v is None or not v > limit:
                since, fired = -1, 0
            else:
                since = at if since < 0 else since
                if at - since >= hold_s and not fired:
                    fired = 1
                    out.append((k[0], since, at))
        state.update((since, fired))
        yield pd.DataFrame(out, columns=[key, "since", "until"])

    return stream.withWatermark(ts, delay).groupBy(key).applyInPandasWithState(step, f"{key} {kind}, since bigint, until bigint", "since bigint, fired int", "append", GroupStateTimeout.NoTimeout)
