"""Items of varying length into containers of fixed capacity, with as little unused space as possible.

Method: non-negative least squares on the length histogram.  Shallow combinations of lengths that fill
the window (the capacity) exactly are enumerated: up to three items, or copies of up to two lengths;
non-negative repeat counts that explain the histogram are solved for; they are rounded down to whole
containers; what is left is packed greedily, best fit in decreasing length, again on counts.

Scale: the plan depends on the histogram alone, at most one count for each length up to the capacity,
so the driver holds a few thousand numbers however large the corpus.  Items get exact places inside
their length by bucketed ordinals (one length may have a third of all rows), and a place is turned into a
container by a search in the plan, as large as the plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinals import with_ordinals

#: Combinations that the least squares see at most (parameter of ``plan_packing``).  Where there are more triples
#: they are thinned evenly for each longest length; lengths are never left out.
MAX_COMBINATIONS = 400_000
#: Least squares end when a round changes the counts by less than this share, at the latest after NNLS_ROUNDS.
NNLS_CHANGE, NNLS_ROUNDS = 1e-3, 2000


def combinations(lengths: np.ndarray, capacity: int, limit: int = MAX_COMBINATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, copies), both n x 3: combinations of present lengths that fill the capacity exactly.

    k copies of one length, copies of two lengths, and triples.  Triples beyond ``limit`` are thinned: each
    longest length keeps an equal number, evenly spaced over the second one.
    """
    present = np.zeros(capacity + 1, dtype=bool)
    present[lengths] = True
    rows_s, rows_k, total = [], [], 0
    desc = np.sort(lengths)[::-1]

    def add(s: np.ndarray, k: np.ndarray) -> None:
        nonlocal total
        rows_s.append(s)
        rows_k.append(k)
        total += len(s)

    for a in desc:  # i copies of a, the rest filled by j copies of one other length
        for i in range(1, capacity // int(a) + 1):
            rest = capacity - i * int(a)
            if rest == 0:
                add(np.array([[a, 0, 0]]), np.array([[i, 0, 0]]))
            elif i <= 3:
                j = np.arange(1, min(12, rest) + 1)
                b = rest // j
                ok = (rest % j == 0) & (b < a)
                ok[ok] = present[b[ok]]
                if ok.any():
                    n = int(ok.sum())
                    add(np.column_stack([np.full(n, a), b[ok], np.zeros(n, int)]), np.column_stack([np.full(n, i), j[ok], np.zeros(n, int)]))
    found = []
    for a in desc:  # triples a >= b >= c, each once
        b = desc[(desc <= a) & (2 * desc >= capacity - a) & (desc < capacity - a)]
        ok = present[capacity - a - b]
        if ok.any():
            found.append((a, b[ok]))
    room, left = max(0, limit - total), len(found)
    for a, b in sorted(found, key=lambda x: len(x[1])):  # what short lists leave over goes to longer ones
        share = max(1, room // left)
        b = b if len(b) <= share else b[np.linspace(0, len(b) - 1, share).astype(int)]
        room, left = room - len(b), left - 1
        add(np.column_stack([np.full(len(b), a), b, capacity - a - b]), np.ones((len(b), 3), int))
    if not rows_s:
        return np.empty((0, 3), int), np.empty((0, 3), int)
    return np.concatenate(rows_s), np.concatenate(rows_k)


def nnls(sizes: np.ndarray, copies: np.ndarray, target: np.ndarray, rounds: int = NNLS_ROUNDS, change: float = NNLS_CHANGE) -> np.ndarray:
    """x >= 0 that minimises |W(Ax - target)|, by accelerated projected gradient; A is given sparsely.

    Column j of A has ``copies[j]`` at ``sizes[j]``; W weighs a length by the square root of its share of
    the capacity, as space left by long items is dearer.
    """
    w = np.sqrt(np.arange(len(target)) / (len(target) - 1) + 1e-3)
    flat = sizes.ravel()
    weight = (copies * w[sizes] * (copies > 0)).astype(float)

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, (weight * x[:, None]).ravel(), minlength=len(target))

    def back(r: np.ndarray) -> np.ndarray:
        return (weight * r[sizes]).sum(1)

    scale = np.ones(len(sizes))
    for _ in range(20):  # largest eigenvalue of A'A
        scale = back(forward(scale))
        top = float(np.linalg.norm(scale)) or 1.0
        scale /= top
    goal, x, y, t = w * target, np.zeros(len(sizes)), np.zeros(len(sizes)), 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - back(forward(y) - goal) / (1.02 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if float(((y - new) * (new - x)).sum()) > 0:  # restart where momentum overshoots
            t_new, y = 1.0, new
        else:
            y = new + (t - 1) / t_new * (new - x)
        moved, x, t = np.abs(new - x).sum(), new, t_new
        if moved <= change * max(1.0, x.sum()):
            break
    return x


def greedy(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in decreasing length on counts: [(lengths of a container, containers like it)].

    Containers in the same state are handled as one group, so the work follows the number of different
    lengths, not of items.
    """
    open_by_space: dict[int, list[list]] = {}
    spaces: list[int] = []
    import bisect

    def put(space: int, pattern: tuple[int, ...], n: int) -> None:
        if space not in open_by_space:
            bisect.insort(spaces, space)
            open_by_space[space] = []
        open_by_space[space].append([pattern, n])

    for size in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(spaces, size)
            if at == len(spaces):
                per = capacity // size
                full, part = divmod(left, per)
                if full:
                    put(capacity - per * size, (size,) * per, full)
                if part:
                    put(capacity - part * size, (size,) * part, 1)
                left = 0
                continue
            space = spaces[at]
            group = open_by_space[space]
            pattern, n = group.pop()
            if not group:
                del open_by_space[space]
                spaces.pop(at)
            per = min(space // size, left)
            whole = min(n, left // per)
            put(space - per * size, pattern + (size,) * per, whole)
            if n > whole:
                put(space, pattern, n - whole)
            left -= whole * per
    return [(tuple(p), n) for groups in open_by_space.values() for p, n in groups]


@dataclass(frozen=True)
class PackingPlan:
    """Which places of a length go to which containers.

    Sorted by (size, start): the items of ``size`` at places start, start+1, ... go to containers
    first, first, ... (``copies`` in each), first+1 and so on.
    """

    capacity: int
    size: np.ndarray
    start: np.ndarray
    copies: np.ndarray
    first: np.ndarray
    containers: int
    solved_share: float

    @cached_property
    def _key(self) -> np.ndarray:
        return (self.size.astype(np.int64) << 44) | self.start

    def container(self, size: np.ndarray, place: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self._key, (size.astype(np.int64) << 44) | place, side="right") - 1
        return self.first[at] + (place - self.start[at]) // self.copies[at]


def plan_packing(histogram: dict[int, int], capacity: int, limit: int = MAX_COMBINATIONS, rounds: int = NNLS_ROUNDS) -> PackingPlan:
    """Plan for all items of the histogram {length: count}, lengths from 1 to the capacity."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in histogram.items():
        left[s] = n
    groups: list[tuple[tuple[int, ...], int]] = []
    total = int((left * np.arange(capacity + 1)).sum())
    lengths = np.flatnonzero(left)
    sizes, copies = combinations(lengths, capacity, limit) if len(lengths) else (np.empty((0, 3), int), None)
    if len(sizes):
        x = nnls(sizes, copies, left.astype(float), rounds)
        for j in np.argsort(-x, kind="stable"):
            n = int(x[j] + 0.5)  # round, but never beyond what is there
            used = copies[j] > 0
            n = min(n, *(int(left[s]) // int(k) for s, k in zip(sizes[j][used], copies[j][used], strict=True)))
            if n > 0:
                pattern = tuple(int(s) for s, k in zip(sizes[j], copies[j], strict=True) for _ in range(int(k)))
                groups.append((pattern, n))
                for s, k in zip(sizes[j][used], copies[j][used], strict=True):
                    left[s] -= n * int(k)
            elif x[j] < 0.5:
                break
    solved = sum(n for _, n in groups) * capacity / total if total else 1.0
    groups += greedy({int(s): int(left[s]) for s in np.flatnonzero(left)}, capacity)
    place, rows, first = {}, [], 0
    for pattern, n in groups:
        for s in sorted(set(pattern)):
            k = pattern.count(s)
            rows.append((s, place.get(s, 0), k, first))
            place[s] = place.get(s, 0) + k * n
        first += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return PackingPlan(capacity, *(table[:, i] for i in range(4)), containers=first, solved_share=solved)


def pieces(sizes: DataFrame, capacity: int, key: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """(doc_id, piece, piece_start, size): items; only a text beyond the capacity is cut, into full pieces and a rest."""
    n = F.coalesce(F.col(tokens), F.lit(0))
    last = F.when(n <= capacity, F.lit(0)).otherwise(F.floor((n - 1) / capacity)).cast("int")
    return sizes.select(F.col(key).alias("doc_id"), n.cast("int").alias("__n"), F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("piece_start"), F.least(F.lit(capacity), F.col("__n") - F.col("piece") * capacity).alias("size")
    )


def pack(sizes: DataFrame, capacity: int, key: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """(doc_id, piece, piece_start, size, container_id): every text, whole, in a container.

    Items of equal length are alike; which of them goes where follows the hash of (doc_id, piece).
    Empty texts have size 0, take no space and are spread over the containers (container 0 if there
    are no others).  Null sizes count as 0.  Rows that repeat a key are separate items.  An empty table
    gives no rows.  ``sizes`` is read twice; pass a written table if counting is dear.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    items = pieces(sizes, capacity, key, tokens)
    rows = items.where("size > 0").groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row per length
    plan = plan_packing({r["size"]: r["n"] for r in rows}, capacity)
    last = max(1, plan.containers)
    held = sizes.sparkSession.sparkContext.broadcast(plan)  # at most some rows for each length and pattern, see plan_packing

    @F.pandas_udf("bigint")
    def container(size: pd.Series, place: pd.Series) -> pd.Series:
        out, s, p = np.empty(len(size), dtype=np.int64), size.to_numpy(), place.to_numpy()
        out[s == 0] = p[s == 0] % last
        out[s > 0] = held.value.container(s[s > 0], p[s > 0])
        return pd.Series(out)

    placed = with_ordinals(items, ["size"], ["doc_id", "piece"], "place")
    return placed.select("doc_id", "piece", "piece_start", "size", container("size", "place").alias("container_id"))


def containers(packed: DataFrame, capacity: int) -> DataFrame:
    """(container_id, n_items, used_tokens, unused_tokens)."""
    return packed.groupBy("container_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("size").cast("bigint").alias("used_tokens"), (F.lit(capacity) - F.sum("size")).cast("bigint").alias("unused_tokens")
    )
