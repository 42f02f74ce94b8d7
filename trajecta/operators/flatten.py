"""Deeply nested records as flat, linked tables.

Method: Dewey labelling.  Every element of every array gets the label of its parent extended by
its own ordinal (from 0, null elements counted); a parent's label is the child's label without
its last ordinal; nodes are grouped into one table for each schema path.

Scale: a table is a projection of exactly the leaves it needs (nested column pruning reaches the
Parquet scan) and a chain of generators: no shuffle, no join, no Python.  A record's own arrays
bound what one row can yield.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL, PARENT = "dewey", "parent"
ELEMENT = "[]"


@dataclass(frozen=True)
class NodeTable:
    """One schema path with an array at its end: ``steps`` are the array hops from the record down."""

    path: str
    steps: tuple[tuple[str, ...], ...]
    element: T.DataType
    parent_path: str


def _arrays_in(kind: T.DataType, fields: tuple[str, ...]):
    """(field path, element type) of each array reachable through structs only."""
    if isinstance(kind, T.ArrayType):
        yield fields, kind.elementType
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _arrays_in(f.dataType, (*fields, f.name))


def node_tables(schema: T.StructType, key: str) -> list[NodeTable]:
    """All array paths of ``schema``, parents before children."""
    found: list[NodeTable] = []

    def walk(kind: T.DataType, steps: tuple, parent: str) -> None:
        for fields, element in _arrays_in(kind, ()):
            path = (parent + "." if parent else "") + ".".join(fields or (ELEMENT,))
            found.append(NodeTable(path, (*steps, fields), element, parent))
            walk(element, (*steps, fields), path)

    walk(T.StructType([f for f in schema.fields if f.name != key]), (), "")
    return found


def _leaves(kind: T.DataType, fields: tuple[str, ...] = ()):
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _leaves(f.dataType, (*fields, f.name))
    elif not isinstance(kind, T.ArrayType):
        yield fields


def _get(base: Column | None, fields: tuple[str, ...]) -> Column:
    for name in fields:
        base = F.col(f"`{name}`") if base is None else base.getField(name)
    return base


def _named(base: Column | None, kind: T.DataType, taken: set[str]) -> list[Column]:
    columns = []
    for fields in _leaves(kind):
        name = "_".join(fields) or "value"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        columns.append(_get(base, fields).alias(name))
    return columns


def node_table(df: DataFrame, key: str, table: NodeTable) -> DataFrame:
    """(key, dewey, parent, leaves of the element...), one row per element.

    Null structs and null arrays inside an array yield no row but keep their ordinal; null scalars
    yield a row with a null value.  Null or missing arrays, also inside null structs, and empty ones
    yield nothing.  Equal elements stay separate rows.  Leaves whose name is taken get ``_`` appended.
    The record's key may be null or repeated; it is carried along, never joined on.
    """
    if key in (LABEL, PARENT):
        raise ValueError(f"the key can't be called {key}")
    current, label = df.select(F.col(f"`{key}`").alias("__k"), _get(None, table.steps[0]).alias("__a")), None
    for depth, _ in enumerate(table.steps):
        current = current.select("__k", *(["__l"] if depth else []), F.posexplode("__a").alias("__p", "__e"))
        label = F.array("__p") if depth == 0 else F.array_append("__l", F.col("__p"))
        if depth + 1 < len(table.steps):
            fields = table.steps[depth + 1]
            current = current.select("__k", label.alias("__l"), (_get(F.col("__e"), fields) if fields else F.col("__e")).alias("__a"))
    if isinstance(table.element, (T.StructType, T.ArrayType)):
        current = current.where(F.col("__e").isNotNull())
    taken = {key.lower(), LABEL, PARENT}
    return current.select(F.col("__k").alias(key), label.alias(LABEL), F.col("__e")).select(
        key, LABEL, F.slice(LABEL, 1, F.size(LABEL) - 1).alias(PARENT), *_named(F.col("__e"), table.element, taken)
    )


def flatten(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """Flat tables of a nested DataFrame by schema path; ``""`` is the table of the records themselves.

    A child row's (key, parent) equals its parent row's (key, dewey); the records' label is empty.
    """
    rest = T.StructType([f for f in df.schema.fields if f.name != key])
    empty = F.array().cast("array<int>")
    root = df.select(F.col(f"`{key}`"), empty.alias(LABEL), empty.alias(PARENT), *_named(None, rest, {key.lower(), LABEL, PARENT}))
    return {"": root, **{t.path: node_table(df, key, t) for t in node_tables(df.schema, key)}}


#: The array paths of a run record and what their elements are called.
RUN_CHILDREN = {
    "molecule.molecule_data.symbols": "atom",
    "vqe_result.initial_data.hamiltonian": "hamiltonian_term",
    "vqe_result.initial_data.initial_parameters": "initial_parameter",
    "vqe_result.iteration_list": "iteration",
    "vqe_result.iteration_list.parameters": "iteration_parameter",
}


def child_index(df: DataFrame, key: str, kinds: dict[str, str] = RUN_CHILDREN) -> DataFrame:
    """(key, child_kind, parent_pos, pos) of every child, from the labels alone."""
    tables = {t.path: t for t in node_tables(df.schema, key)}
    rows = [
        node_table(df, key, tables[path]).select(
            key,
            F.lit(kind).alias("child_kind"),
            F.coalesce(F.try_element_at(PARENT, F.lit(-1)), F.lit(-1)).alias("parent_pos"),
            F.element_at(LABEL, -1).alias("pos"),
        )
        for path, kind in kinds.items()
        if path in tables
    ]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out
