"""Avro without a jar: schemas from Spark types, a binary codec, container files and registry-framed messages.

Spark's ``avro`` format reads containers where its jar is present; otherwise they are read through
``binaryFile`` (splitting by file) and decoded in Arrow batches.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import FileSystem, spread

MAGIC, FRAME = b"Obj\x01", b"\x00"
_SIMPLE = {"boolean": "boolean", "int": "int", "bigint": "long", "double": "double", "float": "float", "string": "string", "binary": "bytes"}


def avro_schema(kind: T.DataType, name: str = "record", nullable: bool = False):
    """Avro schema of a Spark type; every nullable field is a union with null, default null."""
    if isinstance(kind, T.StructType):
        out = {"type": "record", "name": name, "fields": [
            {"name": f.name, "type": avro_schema(f.dataType, f"{name}_{f.name}", f.nullable), **({"default": None} if f.nullable else {})} for f in kind.fields
        ]}
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": avro_schema(kind.elementType, f"{name}_item", kind.containsNull)}
    elif isinstance(kind, T.MapType):
        out = {"type": "map", "values": avro_schema(kind.valueType, f"{name}_value", kind.valueContainsNull)}
    elif isinstance(kind, T.DecimalType):
        out = {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    elif isinstance(kind, T.DateType):
        out = {"type": "int", "logicalType": "date"}
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = {"type": "long", "logicalType": "timestamp-micros" if isinstance(kind, T.TimestampType) else "local-timestamp-micros"}
    elif kind.simpleString() in ("smallint", "tinyint"):
        out = "int"
    else:
        out = _SIMPLE[kind.simpleString()]
    return ["null", out] if nullable else out


_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def _to_logical(schema: dict, value):
    """A date, timestamp or decimal (also as text) as the number or bytes that Avro stores."""
    kind = schema.get("logicalType")
    if kind == "decimal":
        n = int(Decimal(str(value)).scaleb(schema["scale"]).to_integral_value())
        return n.to_bytes(max(1, (n.bit_length() + 8) // 8), "big", signed=True)
    if kind == "date" and not isinstance(value, int):
        return (date.fromisoformat(str(value)) - _EPOCH.date()).days
    if kind in ("timestamp-micros", "timestamp-millis", "local-timestamp-micros") and not isinstance(value, int):
        at = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
        at = at if at.tzinfo else at.replace(tzinfo=UTC)
        return (at - _EPOCH) // timedelta(microseconds=1 if kind.endswith("micros") else 1000)
    return value


def _from_logical(schema: dict, value):
    kind = schema.get("logicalType")
    if kind == "decimal":
        return str(Decimal(int.from_bytes(value, "big", signed=True)).scaleb(-schema.get("scale", 0)))
    if kind == "date":
        return (_EPOCH.date() + timedelta(days=value)).isoformat()
    if kind in ("timestamp-micros", "timestamp-millis", "local-timestamp-micros"):
        at = _EPOCH + timedelta(microseconds=value * (1 if kind.endswith("micros") else 1000))
        return (at if not kind.startswith("local") else at.replace(tzinfo=None)).isoformat()
    return value


def write_long(n: int, out: bytearray) -> None:
    z = (n << 1) ^ (n >> 63)
    z &= (1 << 64) - 1
    while z > 0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    out.append(z)


def encode(schema, value, out: bytearray) -> None:
    """Append the binary form of ``value``."""
    if isinstance(schema, list):
        at = next(i for i, s in enumerate(schema) if (s == "null") == (value is None))
        write_long(at, out)
        encode(schema[at], value, out)
        return
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(schema, dict) and "logicalType" in schema:
        value = _to_logical(schema, value)
    if kind == "null":
        return
    if kind == "boolean":
        out.append(1 if value else 0)
    elif kind in ("int", "long"):
        write_long(int(value), out)
    elif kind == "double":
        out += struct.pack("<d", value)
    elif kind == "float":
        out += struct.pack("<f", value)
    elif kind in ("string", "bytes"):
        data = value.encode() if kind == "string" else bytes(value)
        write_long(len(data), out)
        out += data
    elif kind == "array":
        if len(value):
            write_long(len(value), out)
            for x in value:
                encode(schema["items"], x, out)
        write_long(0, out)
    elif kind == "map":
        if value:
            write_long(len(value), out)
            for k, v in value.items():
                encode("string", k, out)
                encode(schema["values"], v, out)
        write_long(0, out)
    elif kind == "enum":
        write_long(schema["symbols"].index(value), out)
    elif kind == "fixed":
        out += bytes(value)
    elif kind == "record":
        get = value.get if isinstance(value, dict) else lambda n, d=None: getattr(value, n, d)
        for f in schema["fields"]:
            encode(f["type"], get(f["name"], f.get("default")), out)
    else:
        raise ValueError(f"unknown Avro type {kind}")


class Reader:
    """Reads values from bytes by the writer's schema."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("the Avro data ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        shift = z = 0
        while True:
            b = self.take(1)[0]
            z |= (b & 0x7F) << shift
            if b < 0x80:
                return (z >> 1) ^ -(z & 1)
            shift += 7

    def value(self, schema):
        if isinstance(schema, dict) and "logicalType" in schema:
            return _from_logical(schema, self._value(schema))
        return self._value(schema)

    def _value(self, schema):
        if isinstance(schema, list):
            return self.value(schema[self.long()])
        kind = schema["type"] if isinstance(schema, dict) else schema
        if kind == "null":
            return None
        if kind == "boolean":
            return self.take(1) == b"\x01"
        if kind in ("int", "long"):
            return self.long()
        if kind == "double":
            return struct.unpack("<d", self.take(8))[0]
        if kind == "float":
            return struct.unpack("<f", self.take(4))[0]
        if kind == "bytes":
            return self.take(self.long())
        if kind == "string":
            return self.take(self.long()).decode()
        if kind == "array":
            out = []
            while n := self.long():
                if n < 0:
                    n = -n
                    self.long()
                out += [self.value(schema["items"]) for _ in range(n)]
            return out
        if kind == "map":
            out = {}
            while n := self.long():
                if n < 0:
                    n = -n
                    self.long()
                for _ in range(n):
                    key = self.value("string")
                    out[key] = self.value(schema["values"])
            return out
        if kind == "enum":
            return schema["symbols"][self.long()]
        if kind == "fixed":
            return self.take(schema["size"])
        if kind == "record":
            return {f["name"]: self.value(f["type"]) for f in schema["fields"]}
        raise ValueError(f"unknown Avro type {kind}")


def resolve(value, reader):
    """A value read by its writer's schema, seen through the reader's: missing fields get defaults, extra ones go."""
    if isinstance(reader, list):
        return None if value is None else resolve(value, next(s for s in reader if s != "null"))
    if not isinstance(reader, dict) or value is None:
        return value
    if reader["type"] == "array":
        return [resolve(x, reader["items"]) for x in value]
    if reader["type"] == "map":
        return {k: resolve(x, reader["values"]) for k, x in value.items()}
    if reader["type"] != "record":
        return value
    out = {}
    for f in reader["fields"]:
        if f["name"] in value:
            out[f["name"]] = resolve(value[f["name"]], f["type"])
        elif "default" in f or isinstance(f["type"], list) and "null" in f["type"]:
            out[f["name"]] = f.get("default")
        else:
            raise ValueError(f"field {f['name']} is missing and has no default")
    return out


def to_bytes(schema, value) -> bytes:
    out = bytearray()
    encode(schema, value, out)
    return bytes(out)


def frame(schema_id: int | None, body: bytes) -> bytes:
    """Registry framing: a zero byte and the id in four bytes; nothing for an unknown id."""
    return body if schema_id is None else FRAME + struct.pack(">I", schema_id) + body


def unframe(message: bytes) -> tuple[int, bytes]:
    if message[:1] != FRAME or len(message) < 5:
        raise ValueError("the message doesn't begin with the framing's zero byte")
    return struct.unpack(">I", message[1:5])[0], message[5:]


def write_container(schema, values, codec: str = "deflate", sync: bytes | None = None) -> bytes:
    """A container file with one block."""
    sync, body, out = sync or os.urandom(16), bytearray(), bytearray(MAGIC)
    n = 0
    for v in values:
        encode(schema, v, body)
        n += 1
    meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
    write_long(len(meta), out)
    for k, v in meta.items():
        for x in (k.encode(), v):
            write_long(len(x), out)
            out += x
    write_long(0, out)
    out += sync
    if n:
        if codec == "deflate":
            c = zlib.compressobj(wbits=-15)
            body = c.compress(bytes(body)) + c.flush()
        write_long(n, out)
        write_long(len(body), out)
        out += body
        out += sync
    return bytes(out)


def read_container(data: bytes) -> Iterator[dict]:
    """Records of a container file (codecs null and deflate)."""
    r = Reader(data)
    if r.take(4) != MAGIC:
        raise ValueError("not an Avro container file")
    meta = {}
    while n := r.long():
        if n < 0:
            n = -n
            r.long()
        for _ in range(n):
            key = r.take(r.long()).decode()
            meta[key] = r.take(r.long())
    sync, schema, codec = r.take(16), json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null")
    while r.at < len(data):
        n, size = r.long(), r.long()
        body = r.take(size)
        block = Reader(zlib.decompress(body, wbits=-15) if codec == b"deflate" else body)
        for _ in range(n):
            yield block.value(schema)
        if r.take(16) != sync:
            raise ValueError("a block's sync marker is wrong")


def has_avro_source(spark: SparkSession) -> bool:
    """Whether Spark's own Avro source is on the class path."""
    jvm = spark.sparkContext._jvm
    try:
        jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource("avro", spark._jsparkSession.sessionState().conf())
        return True
    except Exception:  # noqa: BLE001  (an analysis error names the missing source)
        return False


def read_avro(spark: SparkSession, path: str, schema: T.StructType, folders: T.StructType | None = None) -> DataFrame:
    """Container files under ``path`` (recursive, ``*.avro``) with the reader's schema, and the columns of ``folders`` if given.

    Spark's Avro source reads them in splits where its jar is present.  Otherwise a file is the unit of work:
    it is read in one task, block by block.
    """
    reader, names = avro_schema(schema), [f.name for f in folders.fields] if folders else []
    if has_avro_source(spark):
        source = spark.read.format("avro").option("pathGlobFilter", "*.avro").option("avroSchema", json.dumps(reader))
        return (source.option("basePath", path) if folders else source.option("recursiveFileLookup", True)).load(path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                some: list[str] = []
                for v in read_container(bytes(row.content)):
                    some.append(json.dumps(resolve(v, reader), default=str))
                    if len(some) == 5000:
                        yield pd.DataFrame({"j": some, **{n: getattr(row, n) for n in names}})
                        some = []
                yield pd.DataFrame({"j": pd.Series(some, dtype=object), **{n: getattr(row, n) for n in names}})

    source = spark.read.format("binaryFile").option("pathGlobFilter", "*.avro")
    if folders:
        files = source.option("basePath", path).load(path)
        files = files.select("content", *[(F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in folders.fields])
    else:
        files = source.option("recursiveFileLookup", True).load(path).select("content")
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in folders.fields) if folders else ""
    return files.mapInPandas(decode, "j string" + kinds).select(F.from_json("j", schema).alias("r"), *names).select("r.*", *names)


def encode_frames(df: DataFrame, schema_id: int | None, name: str = "record") -> DataFrame:
    """(message): every row as a framed Avro message."""
    schema, columns = avro_schema(df.schema, name), df.columns

    @F.pandas_udf("binary")
    def pack(rows: pd.Series) -> pd.Series:
        return rows.map(lambda j: frame(schema_id, to_bytes(schema, json.loads(j))))

    return spread(df).select(pack(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias("message"))


def decode_frames(df: DataFrame, schemas: dict[int, object], target: T.StructType, column: str = "message") -> DataFrame:
    """Framed messages decoded with their writer's schema; a bad message has nulls and its reason in ``decode_error``."""
    reader = avro_schema(target)

    @F.pandas_udf("struct<j: string, e: string>")
    def unpack(messages: pd.Series) -> pd.DataFrame:
        out = []
        for m in messages:
            try:
                known, body = unframe(bytes(m))
                if known not in schemas:
                    raise ValueError(f"schema {known} is unknown")
                out.append((json.dumps(resolve(Reader(body).value(schemas[known]), reader)), None))
            except Exception as e:  # noqa: BLE001  (whatever is wrong with a message goes to quarantine)
                out.append((None, str(e) or type(e).__name__))
        return pd.DataFrame(out, columns=["j", "e"])

    rows = spread(df).select(unpack(column).alias("u"))
    return rows.select(F.from_json("u.j", target).alias("r"), F.col("u.e").alias("decode_error")).select("r.*", "decode_error")


class SchemaStore:
    """Schemas by subject ``<name>-value``, cached; stands in for a registry service.

    An id is a file ``ids/<id>`` that is created without overwriting, so of two writers each gets an id of its
    own.  With a session the folder may be on any file system that the cluster shares; else it is a local one.
    """

    def __init__(self, folder: str, spark: SparkSession | None = None) -> None:
        self.folder, self.cache = folder.rstrip("/"), {}
        self.fs = FileSystem(spark, self.folder) if spark else _LocalFiles()
        self.fs.mkdirs(f"{self.folder}/ids")

    def _all(self) -> dict[int, dict]:
        return {int(n): json.loads(self.fs.read_text(f"{self.folder}/ids/{n}")) for n in self.fs.names(f"{self.folder}/ids") if n.isdigit()}

    def register(self, name: str, schema) -> int:
        """The id of the schema; an equal schema of the subject keeps its id."""
        if not isinstance(schema, (dict, list, str)) or isinstance(schema, dict) and "type" not in schema:
            raise ValueError("not an Avro schema")
        known = self._all()
        for number, entry in sorted(known.items()):
            if entry["subject"] == f"{name}-value" and entry["schema"] == schema:
                return number
        number = max(known, default=0) + 1
        while not self.fs.create_text(f"{self.folder}/ids/{number}", json.dumps({"subject": f"{name}-value", "schema": schema})):
            number += 1
        self.cache[name] = (number, schema)
        return number

    def latest(self, name: str) -> tuple[int, object]:
        if name not in self.cache:
            own = [(n, e["schema"]) for n, e in self._all().items() if e["subject"] == f"{name}-value"]
            if not own:
                raise KeyError(name)
            self.cache[name] = max(own, key=lambda x: x[0])
        return self.cache[name]

    def known(self, name: str) -> bool:
        return any(e["subject"] == f"{name}-value" for e in self._all().values())

    def by_id(self) -> dict[int, object]:
        return {n: e["schema"] for n, e in self._all().items()}


class _LocalFiles:
    """The same few calls on the local file system."""

    mkdirs = staticmethod(lambda path: os.makedirs(path, exist_ok=True))
    names = staticmethod(lambda path: sorted(os.listdir(path)))

    @staticmethod
    def read_text(path: str) -> str:
        with open(path) as f:
            return f.read()

    @staticmethod
    def create_text(path: str, text: str) -> bool:
        try:
            with open(path, "x") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True
