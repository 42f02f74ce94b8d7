"""Schemas that drift between files: every change reported, one consistent table read.

Method: tree edit distance between consecutive nested schemas.  A file's schema is a tree (roots,
structs, fields, JSON types); the minimum-cost edit script between a lane's consecutive schemas is
made of add, delete, rename and move operations.  Fields that keep their path cost nothing; of the
rest, a constrained matching of vanished with appeared nodes is cheaper than deletion and insertion
where both carry the same quantity.  The scripts' renames are then compiled into one projection that
reads every file into the same columns.

What a rename costs is learned from the whole corpus, not from one file: two names that ever occur in
the same record aren't one quantity; otherwise the cost falls with the likeness of the names (camel
case and abbreviations understood) and of the values both carry.

Scale: one pass parses the payloads (variant, JVM) and keeps a slim row per record; schemas are one row
per file after a partial aggregate, so a hot file never gathers in one task.  Lanes grow in number, not
in length: a lane's fold sees one slim row per file.  Evidence about names is as large as the set of
field names, never as the data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, spread
from .once import with_json

ROOTS = ("vqe_result", "vqe_result.initial_data")
#: Costs of the edit operations; renaming ranges from 0 to 1 by evidence, a move adds to it.
DELETE = INSERT = 1.0
MOVE, RETYPE, FORBIDDEN = 0.4, 0.25, 9.0
#: Rename beats deletion and insertion only below this cost.
RENAME_LIMIT = 0.62
#: SQL pattern of a string leaf in JSON text.
STRING_LEAF = r"""r':"((?:[^"\\]|\\.)*)"'"""
#: Pairs of field names that drift at most, else an error: they are evidence about names, not data.
MAX_NAMES = 20_000
#: A pair whose vanishing and appearing fall together so often (share, files) is evidence where there is no text.
HISTORY_SHARE, HISTORY_FILES = 0.8, 5


def _json_type(kind: str) -> str:
    """SQL for the JSON type of a value whose ``schema_of_variant`` is ``kind``."""
    return (
        f"case when {kind} = 'VOID' then 'null' when {kind} = 'BOOLEAN' then 'boolean' when {kind} = 'STRING' then 'string' "
        f"when {kind} like 'OBJECT%' then 'object' when {kind} like 'ARRAY%' then 'array' else 'number' end"
    )


def record_fields(messages: DataFrame, files: DataFrame, roots: tuple[str, ...] = ROOTS) -> DataFrame:
    """(lane_id, file_seq, file_id, line_no, fields): the fields of each record of the files with a file_seq.

    ``fields`` is an array of (path, kind, text, number), sorted by path; ``text`` has the hashes of the string
    leaves of strings and objects, ``number`` the value of numbers and booleans (0 or 1).  Invalid JSON and records without any root have no fields; a root that isn't an
    object has none.
    """
    placed = files.where("file_seq is not null and lane_id is not null").select("file_id", "lane_id", "file_seq")
    rows = with_json(spread(messages.select("file_id", "line_no", "payload")), "file_id", "line_no")
    maps = rows.select("file_id", "line_no", *[F.expr(f"try_variant_get(v, '$.{r}', 'map<string,variant>')").alias(f"m{i}") for i, r in enumerate(roots)])
    entry = (
        "transform(transform(map_entries({m}), e -> named_struct('path', '{r}.' || e.key, 'value', e.value, 'kind', schema_of_variant(e.value))), "
        "e -> named_struct('path', e.path, 'kind', {kind}, 'text', "
        "transform(case when e.kind = 'STRING' then array(e.value::string) "
        "when e.kind like 'OBJECT%' then regexp_extract_all(to_json(e.value), {leaf}, 1) end, x -> xxhash64(x)), 'number', "
        "case when e.kind = 'BOOLEAN' then cast(try_variant_get(e.value, '$', 'boolean') as double) "
        "when e.kind != 'STRING' and e.kind not like 'OBJECT%' and e.kind not like 'ARRAY%' then try_variant_get(e.value, '$', 'double') end))"
    )
    parts = [f"coalesce({entry.format(m=f'm{i}', r=r, kind=_json_type('e.kind'), leaf=STRING_LEAF)}, array())" for i, r in enumerate(roots)]
    fields = maps.select("file_id", "line_no", F.expr(f"array_sort(concat({', '.join(parts)}))").alias("fields"))
    return fields.join(placed, "file_id").select("lane_id", "file_seq", "file_id", "line_no", "fields")


def file_schemas(records: DataFrame) -> DataFrame:
    """(lane_id, file_seq, file_id, paths, firsts, lasts): one row per file, arrays in order of path.

    A type is the first or last one of the file that isn't null, in order of line_no; null if there is none.
    """
    slim = records.select("lane_id", "file_seq", "file_id", "line_no", F.transform("fields", lambda f: F.struct(f["path"].alias("path"), f["kind"].alias("kind"))).alias("sig"))
    once = slim.groupBy("lane_id", "file_seq", "file_id", "sig").agg(F.min("line_no").alias("lo"), F.max("line_no").alias("hi"))
    nodes = once.select("lane_id", "file_seq", "file_id", "lo", "hi", F.explode("sig").alias("n"))
    typed = F.col("n.kind") != "null"
    per = nodes.groupBy("lane_id", "file_seq", "file_id", F.col("n.path").alias("path")).agg(
        F.min_by("n.kind", F.when(typed, F.col("lo"))).alias("first"), F.max_by("n.kind", F.when(typed, F.col("hi"))).alias("last")
    )
    row = F.array_sort(F.collect_list(F.struct("path", F.when(F.col("first") != "null", F.col("first")).alias("first"), F.when(F.col("last") != "null", F.col("last")).alias("last"))))
    return per.groupBy("lane_id", "file_seq", "file_id").agg(row.alias("s")).select(
        "lane_id", "file_seq", "file_id", F.col("s.path").alias("paths"), F.col("s.first").alias("firsts"), F.col("s.last").alias("lasts")
    )


def name_tokens(path: str) -> list[str]:
    """Lower-case words of the last part of a path; camel case and digits split."""
    return [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+", path.rsplit(".", 1)[-1])]


#: Words of a name that say little about its quantity.
GENERIC = frozenset("value name type data info is use the of id has".split())


def name_likeness(a: str, b: str) -> float:
    """Share of the shorter name's telling words that the other has, an abbreviation (a prefix) counting a little less; 0 to 1."""
    sides = [[w for w in t if w not in GENERIC] or t for t in (name_tokens(a), name_tokens(b))]
    short, left = sorted(sides, key=len)
    left, total = list(left), 0.0
    for w in short:
        same = [v for v in left if v.startswith(w) or w.startswith(v)]
        if same:
            best = max(same, key=lambda v: (v == w, v))
            total += 1.0 if best == w else 0.8
            left.remove(best)
    return total / len(short) if short else 0.0


def range_likeness(a: tuple[float, float] | None, b: tuple[float, float] | None) -> float | None:
    """Overlap of two ranges (mean and deviation), as the shorter one's share; None without numbers on both sides."""
    if a is None or b is None:
        return None
    (lo, hi), (lo2, hi2) = ((m - 2 * d - 1e-9 * abs(m) - 1e-12, m + 2 * d + 1e-9 * abs(m) + 1e-12) for m, d in (a, b))
    return max(0.0, min(hi, hi2) - max(lo, lo2)) / min(hi - lo, hi2 - lo2)


def chained(costs: dict[tuple[str, str], float], together: set[tuple[str, str]]) -> dict[tuple[str, str], float]:
    """Costs where a name may also be reached through a third: the dearer of both steps, if that is less.

    Pairs seen together in a record are FORBIDDEN, as steps as well.
    """
    near: dict[str, dict[str, float]] = {}
    apart = together | {(b, a) for a, b in together}
    for (a, b), c in costs.items():
        if (a, b) not in apart and c < RENAME_LIMIT:
            near.setdefault(a, {})[b] = min(c, near.get(a, {}).get(b, FORBIDDEN))
            near.setdefault(b, {})[a] = min(c, near.get(b, {}).get(a, FORBIDDEN))

    def reach(a: str, b: str) -> float:
        return min((max(c, near[m][b]) for m, c in near.get(a, {}).items() if b in near.get(m, {})), default=FORBIDDEN)

    return {(a, b): FORBIDDEN if (a, b) in apart else min(c, reach(a, b)) for (a, b), c in costs.items()}


@dataclass(frozen=True)
class RenameEvidence:
    """Rename costs of pairs of paths; ``cost`` is FORBIDDEN for pairs seen together in a record."""

    costs: dict[tuple[str, str], float]

    def cost(self, old: str, new: str) -> float:
        return self.costs.get((old, new), FORBIDDEN)


def rename_evidence(records: DataFrame, schemas: DataFrame) -> RenameEvidence:
    """Costs of all pairs (vanished, appeared) that meet at some file of the corpus."""
    from pyspark.sql import Window

    earlier = F.lag("paths").over(Window.partitionBy("lane_id").orderBy("file_seq", "file_id"))
    step = schemas.select("paths", earlier.alias("before")).where("before is not null and before != paths")
    sides = step.select(F.array_except("before", "paths").alias("gone"), F.array_except("paths", "before").alias("come")).where("size(gone) > 0 and size(come) > 0").distinct()
    pairs = cut(sides.select(F.explode("gone").alias("a"), "come").select("a", F.explode("come").alias("b")).distinct(), "drift-pairs")
    wanted = pairs.select(F.col("a").alias("path")).unionByName(pairs.select(F.col("b").alias("path"))).distinct()
    # pairs of names seen in one record, by equi-joins over the distinct path sets
    sets = records.select(F.array_distinct(F.col("fields.path")).alias("paths")).distinct().select(F.xxhash64(F.concat_ws("\u0001", "paths")).alias("sig"), "paths")
    inside = sets.select("sig", F.explode("paths").alias("path")).join(wanted, "path", "left_semi")
    met = pairs.join(inside.withColumnRenamed("path", "a"), "a").join(inside.withColumnRenamed("path", "b"), ["sig", "b"]).select("a", "b").distinct()
    rows = pairs.join(met.withColumn("met", F.lit(True)), ["a", "b"], "left").limit(MAX_NAMES + 1).collect()  # as many as pairs of names, not of data
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} pairs of field names drift; split the corpus by producer")
    together = {(r["a"], r["b"]) for r in rows if r["met"]}
    seen = records.select(F.explode("fields").alias("f")).select("f.path", "f.kind", "f.text", "f.number").join(F.broadcast(wanted) if len(rows) <= 2_000 else wanted, "path", "left_semi")
    # every value counts: profiles meet in equi-joins, and only one figure for each pair is collected
    values = cut(seen.select("path", F.explode("text").alias("value")).groupBy("path", "value").agg(F.count(F.lit(1)).alias("n")), "drift-values")
    weights = {r["path"]: r["n"] for r in values.groupBy("path").agg(F.sum("n").alias("n")).collect()}
    here, there = values.toDF("a", "value", "n"), values.toDF("b", "value", "n2")
    shared = {
        (r["a"], r["b"]): (r["n"], r["n2"])
        for r in pairs.join(here, "a").join(there, ["b", "value"]).groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("n2").alias("n2")).collect()
    }
    ranges = {
        (r["path"], r["boolean"]): (r["m"], r["d"] or 0.0)
        for r in seen.where("number is not null").groupBy("path", (F.col("kind") == "boolean").alias("boolean")).agg(F.avg("number").alias("m"), F.stddev_pop("number").alias("d")).collect()
    }
    # how often both changes fall together, of the files that show either
    gone = {r["a"]: r["n"] for r in _side_counts(step, "before", "paths", "a")}
    come = {r["b"]: r["n"] for r in _side_counts(step, "paths", "before", "b")}
    both = step.select(F.explode(F.array_except("before", "paths")).alias("a"), F.array_except("paths", "before").alias("come")).select("a", F.explode("come").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    history = {(r["a"], r["b"]): (r["n"], max(gone[r["a"]], come[r["b"]])) for r in both.collect()}

    def cost(a: str, b: str) -> float:
        likeness = None
        if a in weights and b in weights:
            n, n2 = shared.get((a, b), (0, 0))
            likeness = n / weights[a] if weights[a] <= weights[b] else n2 / weights[b]
        numbers = next((x for k in (False, True) if (x := range_likeness(ranges.get((a, k)), ranges.get((b, k)))) is not None), None)
        return rename_cost(a, b, likeness, numbers, history.get((a, b), (0, 1)))

    return RenameEvidence(chained({(r["a"], r["b"]): cost(r["a"], r["b"]) for r in rows}, together))


def _side_counts(step: DataFrame, more: str, less: str, name: str) -> list:
    """How many files lose (or gain) each path; as many rows as field names."""
    return step.select(F.explode(F.array_except(more, less)).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()


def rename_cost(a: str, b: str, values: float | None, numbers: float | None = None, history: tuple[int, int] = (0, 1)) -> float:
    """0 (surely one quantity) to 1, and MOVE more where the parent differs.

    ``values`` is the likeness of the texts both carry, ``numbers`` that of their ranges, ``history`` how many
    files change both names, of those that change either.  Without texts, names that don't resemble each other may
    still be one quantity where their ranges agree and one keeps appearing just where the other vanishes.
    """
    names = name_likeness(a, b)
    base = 1.0 - names if values is None else 1.0 - max(0.75 * names + 0.25 * values, 0.9 * values if values > 0.5 else 0.0)
    if values is None and numbers is not None and numbers > 0.5 and history[0] >= HISTORY_FILES and history[0] >= HISTORY_SHARE * history[1]:
        base = min(base, 1.0 - 0.6 * history[0] / history[1])
    return base + (MOVE if a.rsplit(".", 1)[0] != b.rsplit(".", 1)[0] else 0.0)


def assign(costs: list[list[float]]) -> list[int]:
    """Minimum-cost assignment of rows to columns (rows <= columns): column of each row."""
    n, m = len(costs), len(costs[0]) if costs else 0
    u, v, match = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while True:
            used[j0], i0, delta, j1 = True, match[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    c = costs[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = [-1] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def edit_script(before: dict[str, str | None], after: dict[str, str | None], evidence: RenameEvidence) -> list[tuple[str, str | None, str | None]]:
    """Minimum-cost script (operation, old path, new path) between two schemas given as path -> type.

    Equal paths are matched at no cost.  Every vanished node is matched with an appeared one or with
    its own deletion; what no vanished node takes is inserted.  A match across parents is a move.
    """
    gone, come = sorted(set(before) - set(after)), sorted(set(after) - set(before))
    if not gone or not come:
        return [*(("delete", p, None) for p in gone), *(("insert", None, p) for p in come)]
    costs = []
    for i, a in enumerate(gone):
        row = []
        for b in come:
            c = evidence.cost(a, b) + (RETYPE if before[a] and after[b] and before[a] != after[b] else 0.0)
            row.append(c - INSERT if c < RENAME_LIMIT else FORBIDDEN)  # a match saves the insertion
        costs.append(row + [DELETE if i == j else FORBIDDEN * 2 for j in range(len(gone))])
    script, taken = [], set()
    for i, j in enumerate(assign(costs)):
        if j < len(come):
            taken.add(j)
            moved = gone[i].rsplit(".", 1)[0] != come[j].rsplit(".", 1)[0]
            script.append(("move" if moved else "rename", gone[i], come[j]))
        else:
            script.append(("delete", gone[i], None))
    return [*script, *(("insert", None, b) for j, b in enumerate(come) if j not in taken)]


KINDS = {"delete": "removed", "insert": "added", "rename": "renamed", "move": "renamed"}


def fold_lane(files: pd.DataFrame, evidence: RenameEvidence) -> list[tuple]:
    """(lane_id, file_id, file_seq, field_path, change_kind, old_path) of one lane, files in order of file_seq and file_id.

    The last type seen belongs to the quantity: a rename hands it on to the new path, and a field that
    comes back is held against the type it had.
    """
    changes: list[tuple] = []
    before: dict[str, str | None] | None = None
    last: dict[str, str] = {}
    for f in files.sort_values(["file_seq", "file_id"]).itertuples():
        first, final = dict(zip(f.paths, f.firsts, strict=True)), dict(zip(f.paths, f.lasts, strict=True))
        if before is not None:
            known = {p: last.get(p) for p in before}
            for op, old, new in edit_script(known, first, evidence):
                changes.append((f.lane_id, f.file_id, f.file_seq, new or old, KINDS[op], old if new else None))
                if old and new:
                    last.pop(new, None)
                    if old in last:
                        last[new] = last[old]
            for p in f.paths:
                if p in last and ((first[p] or last[p]) != last[p] or (final[p] or last[p]) != last[p]):
                    changes.append((f.lane_id, f.file_id, f.file_seq, p, "retyped", None))
        last.update({p: k for p, k in final.items() if k})
        before = first
    return changes


def schema_changes(records: DataFrame, schemas: DataFrame | None = None, evidence: RenameEvidence | None = None) -> DataFrame:
    """(lane_id, file_id, file_seq, field_path, change_kind, old_path): one row per change of a lane.

    Files without a valid record report nothing and are passed over; a lane's first file reports
    nothing; files of equal file_seq are taken in order of file_id.  Empty input gives no rows.
    """
    schemas = cut(file_schemas(records), "drift-schemas") if schemas is None else schemas
    known = evidence or rename_evidence(records, schemas)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(fold_lane(pdf, known), columns=["lane_id", "file_id", "file_seq", "field_path", "change_kind", "old_path"])

    lane = schemas.schema["lane_id"].dataType.simpleString()
    return schemas.groupBy("lane_id").applyInPandas(fold, f"lane_id {lane}, file_id bigint, file_seq int, field_path string, change_kind string, old_path string")


def names_that_meet(records: DataFrame, names: list[str]) -> set[tuple[str, str]]:
    """Pairs (a < b) of ``names`` that some record has both of.  As many rows as pairs of names, at most MAX_NAMES."""
    own = F.filter(F.array_sort(F.array_distinct("fields.path")), lambda p: p.isin(*names))
    sets = records.select(own.alias("paths")).where("size(paths) > 1").distinct()
    rows = sets.select("paths", F.explode("paths").alias("a")).select("a", F.explode("paths").alias("b")).where("a < b").distinct().limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} pairs of renamed fields; split the corpus by producer")
    return {(r["a"], r["b"]) for r in rows}


def aliases(changes: DataFrame, records: DataFrame | None = None) -> dict[str, list[str]]:
    """Canonical path -> all paths of the quantity, from the renames of the whole corpus (as many as field names).

    The canonical name is the one most often renamed away from; ties by name.  The commonest renames are
    taken first; with ``records`` a rename that would unite names which meet in a record is left to
    ``lane_overrides``: there a name stands for different quantities in different lanes.
    """
    links = changes.where("old_path is not null").groupBy("old_path", "field_path").agg(F.count(F.lit(1)).alias("n")).collect()
    met = names_that_meet(records, sorted({p for r in links for p in (r["old_path"], r["field_path"])})) if records is not None and links else set()
    group: dict[str, set[str]] = {}
    left: dict[str, int] = {}
    for r in sorted(links, key=lambda r: (-r["n"], r["old_path"], r["field_path"])):
        a, b = (group.setdefault(p, {p}) for p in (r["old_path"], r["field_path"]))
        left[r["old_path"]] = left.get(r["old_path"], 0) + r["n"]
        if a is not b and not any((min(x, y), max(x, y)) in met for x in a for y in b):
            a |= b
            for p in b:
                group[p] = a
    groups = {id(g): sorted(g) for g in group.values() if len(g) > 1}
    return {max(g, key=lambda p: left.get(p, 0)): g for g in groups.values()}


def lane_overrides(schemas: DataFrame, evidence: RenameEvidence, names: dict[str, list[str]]) -> DataFrame:
    """(file_id, renames): path -> canonical path in files whose lane reached the name otherwise than the corpus did.

    A lane's scripts are followed from its first file on, so each schema version has a projection of its own.
    """
    canon = {p: c for c, g in names.items() for p in g}

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        out, first, before = [], {}, None  # first: the name under which the lane's quantity was first seen
        for f in pdf.sort_values(["file_seq", "file_id"]).itertuples():
            now = dict(zip(f.paths, f.firsts, strict=True))
            if before is not None:
                for _, old, new in edit_script(before, now, evidence):
                    if new:
                        first[new] = first.get(old, old) if old else new
            before = now
            renamed = {p: canon.get(first.get(p, p), first.get(p, p)) for p in f.paths}
            renamed = {p: c for p, c in renamed.items() if c != canon.get(p, p)}
            if renamed:
                out.append((f.file_id, list(renamed), list(renamed.values())))
        return pd.DataFrame(out, columns=["file_id", "a", "b"])

    return schemas.groupBy("lane_id").applyInPandas(follow, "file_id bigint, a array<string>, b array<string>").select("file_id", F.map_from_arrays("a", "b").alias("renames"))


#: Keys under which an object keeps the value that other records write plainly, if the values don't tell.
MAIN_KEYS = ("value", "name")
#: Longest array that may stand for a plain value, by places; longer ones come out as JSON text.
MAX_PLACES = 16


@dataclass(frozen=True)
class Source:
    """One column of the unified table: ``paths`` of the quantity, its SQL type, and the parts it is read from.

    ``key`` (of objects) and ``place`` (of arrays) name the part; ``plain`` says that other values count
    as well.  ``whole`` values are read as they are, whatever they are.
    """

    paths: tuple[str, ...]
    kind: str
    whole: bool = True
    plain: bool = True
    key: str | None = None
    place: int | None = None


def scalar_type(n: dict[str, int]) -> str:
    """The narrowest SQL type that every counted value has; JSON text beyond plain values."""
    if n["nested"]:
        return "string"
    if n["booleans"]:
        return "boolean" if n["bits"] == n["numbers"] and n["boolean_texts"] == n["texts"] else "string"
    if not n["numbers"] or n["double_texts"] < n["texts"]:
        return "string"
    return "bigint" if n["integers"] == n["numbers"] and n["integer_texts"] == n["texts"] else "double"


def nested_type(schema: str) -> str:
    """SQL type of a ``schema_of_variant_agg``; what has no common type is JSON text."""
    schema = re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", schema))
    return re.sub(r"\b(?:VARIANT|VOID)\b(?!`?:)|STRUCT<>", "STRING", schema)


def _counts(kind: F.Column, value: str = "value") -> list[F.Column]:
    """Counts that ``scalar_type`` needs, of a variant column and the JSON type in ``kind``."""
    text = f"try_variant_get({value}, '$', 'string')"
    of = lambda k, test="true": F.count_if(F.expr(f"{kind} = '{k}' and {test}"))
    return [
        of("boolean").alias("booleans"), of("number").alias("numbers"), of("string").alias("texts"), F.count_if(F.expr(f"{kind} in ('object', 'array')")).alias("nested"),
        of("number", f"try_variant_get({value}, '$', 'double') in (0, 1)").alias("bits"), of("number", f"schema_of_variant({value}) = 'BIGINT'").alias("integers"),
        of("string", f"try_cast({text} as boolean) is not null").alias("boolean_texts"), of("string", f"try_cast({text} as bigint) is not null and {text} not like '%.%'").alias("integer_texts"),
        of("string", f"try_cast({text} as double) is not null").alias("double_texts"),
    ]


COUNTS = ("booleans", "numbers", "texts", "nested", "bits", "integers", "boolean_texts", "integer_texts", "double_texts")


#: Files with renames of their own that are broadcast at most.
BROADCAST_OVERRIDES = 100_000


def _entries(messages: DataFrame, roots: tuple[str, ...], overrides: DataFrame | None) -> DataFrame:
    """(record_id, file_id, entries): path and value of every field of every record, names as in ``overrides``."""
    rows = with_json(spread(messages.select("record_id", "file_id", "payload")), "record_id", "file_id")
    maps = rows.select("record_id", "file_id", *[F.expr(f"try_variant_get(v, '$.{r}', 'map<string,variant>')").alias(f"m{i}") for i, r in enumerate(roots)])
    entries = F.concat(*[F.expr(f"coalesce(transform(map_entries(m{i}), e -> struct('{r}.' || e.key as path, e.value as value)), array())") for i, r in enumerate(roots)])
    out = maps.select("record_id", "file_id", entries.alias("entries"))
    if overrides is None:
        return out
    held = cut(overrides, "drift-overrides")
    n = held.count()
    if not n:
        return out
    joined = out.join(F.broadcast(held) if n <= BROADCAST_OVERRIDES else held, "file_id", "left")
    named = F.expr("transform(entries, e -> struct(coalesce(try_element_at(renames, e.path), e.path) as path, e.value as value))")
    return joined.withColumn("entries", F.when(F.col("renames").isNull(), F.col("entries")).otherwise(named)).withColumn(  # two names of one quantity: the first holds
        "entries", F.expr("case when renames is null then entries else filter(entries, (e, i) -> array_position(entries.path, e.path) = i + 1) end")
    ).select("record_id", "file_id", "entries")


def _quantities(messages: DataFrame, names: dict[str, list[str]], roots: tuple[str, ...], overrides: DataFrame | None = None) -> DataFrame:
    """(quantity, kind, value): every field of every record that isn't null, whatever its file."""
    known = {p: c for c, g in names.items() for p in g}
    quantity = F.col("e.path")
    if known:
        quantity = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), F.col("e.path")), quantity)
    rows = _entries(messages, roots, overrides).select(F.explode("entries").alias("e")).where(~F.col("e.path").isin(*roots)).select(quantity.alias("quantity"), F.col("e.value").alias("value"))
    return rows.withColumn("kind", F.expr(_json_type("schema_of_variant(value)"))).where("kind != 'null'")


def _add(*counts: dict[str, int]) -> dict[str, int]:
    return {k: sum(c[k] for c in counts) for k in COUNTS}


def unified_columns(messages: DataFrame, names: dict[str, list[str]], roots: tuple[str, ...] = ROOTS, overrides: DataFrame | None = None) -> dict[str, Source]:
    """Column name -> source: every quantity of the corpus with the most general type it has.

    A quantity that is always an object or always an array keeps that form.  Where it is plain in some
    records and an object or array in others, the part that holds the plain values (by the share of
    its values that occur plainly, else by MAIN_KEYS) is read into the column and every other part into
    a column of its own, so nothing is dropped.  Collected: one row per field name and part.
    """
    fields = _quantities(messages, names, roots, overrides)
    whole = fields.groupBy("quantity").agg(
        *_counts("kind"), F.count_if(F.col("kind") == "object").alias("objects"), F.count_if(F.col("kind") == "array").alias("arrays"),
        F.max(F.expr("case when kind = 'array' then size(try_variant_get(value, '$', 'array<variant>')) end")).alias("longest"), F.expr("schema_of_variant_agg(value)").alias("schema"),
    ).limit(MAX_NAMES + 1).collect()
    if len(whole) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} field names; split the corpus by producer")
    mixed = [r["quantity"] for r in whole if r["nested"] and r["booleans"] + r["numbers"] + r["texts"] and (r["longest"] or 0) <= MAX_PLACES]
    parts, likeness = _parts(fields.where(F.col("quantity").isin(*mixed))) if mixed else ({}, {})
    out: dict[str, Source] = {}
    taken = {"record_id", "file_id"}

    def add(quantity: str, suffix: str, source: Source) -> None:
        parent, last = quantity.rsplit(".", 1)
        for name in (last + suffix, f"{parent.rsplit('.', 1)[-1]}_{last}{suffix}", quantity + suffix):
            if name.lower() not in taken:
                break
        else:
            name = next(f"{quantity}{suffix}_{i}" for i in range(2, 9999) if f"{quantity}{suffix}_{i}".lower() not in taken)
        taken.add(name.lower())
        out[name] = source

    for r in sorted(whole, key=lambda r: r["quantity"]):
        q, own = r["quantity"], parts.get(r["quantity"], {})
        paths = (q, *[p for p in names.get(q, []) if p != q])
        if not r["nested"]:
            add(q, "", Source(paths, scalar_type(r.asDict())))
            continue
        main = {form: _main(form, own, likeness.get(q, {})) for form in ("key", "place")}
        if (r["objects"] and main["key"] is None) or (r["arrays"] and main["place"] is None):  # nothing says which part is meant
            pure = max(r["objects"], r["arrays"]) == sum(r[k] for k in ("booleans", "numbers", "texts", "nested"))
            add(q, "", Source(paths, nested_type(r["schema"]) if pure else "string"))
            continue
        used = [own[("plain", "")], *[own[(f, m)] for f, m in main.items() if m is not None]]
        add(q, "", Source(paths, scalar_type(_add(*used)), False, True, main["key"], None if main["place"] is None else int(main["place"])))
        places = {p for f, p in own if f == "place" and p != main["place"]}
        for key in sorted(k for f, k in own if f == "key" and k != main["key"]):
            same = max(((likeness.get(q, {}).get((("place", p), ("key", key)), 0.0), p) for p in places), default=(0.0, ""))
            place = same[1] if same[0] > 0.5 else None
            places.discard(place)
            used = [own[("key", key)], *([own[("place", place)]] if place else [])]
            add(q, f"_{key}", Source(paths, scalar_type(_add(*used)), False, False, key, int(place) if place else None))
        for p in sorted(places, key=int):
            add(q, f"_{p}", Source(paths, scalar_type(own[("place", p)]), False, False, None, int(p)))
    return out


def _main(form: str, own: dict[tuple[str, str], dict[str, int]], likeness: dict) -> str | None:
    """The part of objects (``key``) or arrays (``place``) that holds what is written plainly elsewhere; None if unknown."""
    found = []
    for f, part in own:
        share = likeness.get(((f, part), ("plain", "")), 0.0)
        if f == form and not own[(f, part)]["nested"] and (share > 0.5 or part in MAIN_KEYS):
            found.append((share > 0.5, part in MAIN_KEYS, share, part))
    return max(found)[-1] if found else None


def _parts(fields: DataFrame) -> tuple[dict, dict]:
    """Counts of each (form, part) by quantity, and the share of a part's values that another one has."""
    forms = F.expr("""case kind
        when 'object' then transform(map_entries(try_variant_get(value, '$', 'map<string,variant>')), e -> struct('key' as form, e.key as part, e.value as value))
        when 'array' then transform(try_variant_get(value, '$', 'array<variant>'), (x, i) -> struct('place' as form, cast(i as string) as part, x as value))
        else array(struct('plain' as form, '' as part, value as value)) end""")
    leaves = fields.select("quantity", F.explode(forms).alias("p")).select("quantity", "p.form", "p.part", "p.value").withColumn("kind", F.expr(_json_type("schema_of_variant(value)")))
    text = "try_variant_get(value, '$', 'string')"
    rows = cut(leaves.groupBy("quantity", "form", "part", F.expr(f"coalesce(cast(try_cast({text} as double) as string), {text})").alias("text")).agg(F.count_if(F.col("kind") != "null").alias("n"), *_counts("kind")), "drift-parts")
    counts: dict = {}
    for r in rows.groupBy("quantity", "form", "part").agg(*[F.sum(c).alias(c) for c in COUNTS]).collect():
        counts.setdefault(r["quantity"], {})[(r["form"], r["part"])] = {c: r[c] for c in COUNTS}
    here, there = rows.where("n > 0").alias("a"), rows.where("n > 0").alias("b")
    total = rows.groupBy("quantity", "form", "part").agg(F.sum("n").alias("total"))
    met = here.join(there, F.expr("a.quantity = b.quantity and a.text = b.text and a.form != b.form")).groupBy("a.quantity", "a.form", "a.part", F.col("b.form").alias("form2"), F.col("b.part").alias("part2")).agg(F.sum("a.n").alias("n"))
    likeness: dict = {}
    for r in met.join(total, ["quantity", "form", "part"]).collect():
        likeness.setdefault(r["quantity"], {})[((r["form"], r["part"]), (r["form2"], r["part2"]))] = r["n"] / r["total"]
    return counts, likeness


def compiled_table(messages: DataFrame, columns: dict[str, Source], roots: tuple[str, ...] = ROOTS, overrides: DataFrame | None = None) -> DataFrame:
    """(record_id, file_id, one column for each source) of every record, all null for invalid JSON.

    Names of a quantity never meet in a record, so the first one that is there is its value.
    """
    maps = _entries(messages, roots, overrides).select("record_id", "file_id", F.map_from_entries("entries").alias("m"))

    def get(value: F.Column, kind: str) -> F.Column:
        return F.try_variant_get(value, "$", kind)

    def read(path: str, s: Source) -> F.Column:
        value = F.try_element_at(F.col("m"), F.lit(path))
        if s.whole:
            return get(value, s.kind)
        form = F.schema_of_variant(value)
        part = F.when(form.like("OBJECT%"), get(F.try_element_at(get(value, "map<string,variant>"), F.lit(s.key)), s.kind) if s.key is not None else F.lit(None))
        part = part.when(form.like("ARRAY%"), get(F.get(get(value, "array<variant>"), F.lit(s.place)), s.kind) if s.place is not None else F.lit(None))
        return part.otherwise(get(value, s.kind)) if s.plain else part

    return maps.select("record_id", "file_id", *[F.coalesce(*[read(p, s) for p in s.paths]).alias(name) for name, s in columns.items()])
