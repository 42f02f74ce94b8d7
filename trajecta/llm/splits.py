"""Train, validation and test splits that keep related records together.

Records of one entity (a molecule, however written) and of one experiment belong together; an
experiment that names two entities ties them.  Method: components of the graph of entities and
experiments are bundled by identical size and label profile; split quotas are solved as a min-cost flow
with deviation costs; flows are rounded to whole components; members are assigned by hash.

Scale: rows are first reduced to (experiment, name) pairs by a partial aggregate.  The graph is
contracted to its entities (only experiments with several entities give edges) and solved in one task up to a
counted size, else by alternating large and small stars, cut by written tables, with hubs salted; components are never collected.  Bundles
are: N rows can make at most about sqrt(2 N) distinct sizes, times the profile's classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinals import with_ordinals
from ..runtime import cut
from .molecules import MoleculeNames, tidy

SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
#: Classes a component's share of labelled rows falls into.
PROFILE_CLASSES = 5
#: Pair rows that are broadcast at most; beyond it the join shuffles and AQE splits hot keys.
BROADCAST_PAIRS = 200_000
#: Copies of a node's minimum that its edges are spread over.
SALTS = 16
#: Edges between entities that one task joins by union-find (about 20 MB); more are contracted by stars.
ONE_TASK_EDGES = 100_000
#: Bundles solved on the driver at most, else an error; 2e10 rows make no more than 1,000,000.
MAX_BUNDLES = 1_000_000
#: Bundle rows that are broadcast at most.
BROADCAST_BUNDLES = 200_000


def catalogue_names(catalogue: DataFrame) -> MoleculeNames:
    """The fixed-size catalogue, collected."""
    rows = catalogue.select("molecule_id", "name", "symbols", "charge", "description").collect()
    return MoleculeNames([tuple(r) for r in rows])


def entity_links(features: DataFrame, names: MoleculeNames, label: str = "converged") -> DataFrame:
    """(experiment, molecule_name, entity, molecule_id, alias, n, positives): one row per distinct pair.

    ``experiment`` is the id in lower case without outer blanks; ``entity`` is ``m:<id>`` of the catalogue
    molecule the name means, or ``n:<tidied name>`` where it means none; ``alias`` says that the name isn't
    the catalogue's, character for character.  Null and blank names have no entity, null ids no experiment.
    """
    experiment = F.lower(F.regexp_replace("experiment_id", r"^\s+|\s+$", ""))
    pairs = features.select(experiment.alias("experiment"), "molecule_name", F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("p")).groupBy("experiment", "molecule_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p").alias("positives")
    )

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = [names.resolve(x) for x in pdf["molecule_name"]]
            entity = [f"m:{i}" if i is not None else f"n:{(tidy(x) or x).casefold()}" if x is not None and x.strip(" ") else None for i, x in zip(ids, pdf["molecule_name"], strict=True)]
            alias = [i is not None and names.exact.get(x) != i for i, x in zip(ids, pdf["molecule_name"], strict=True)]
            yield pdf.assign(entity=entity, molecule_id=pd.array(ids, dtype="Int32"), alias=alias)[["experiment", "molecule_name", "entity", "molecule_id", "alias", "n", "positives"]]

    return pairs.mapInPandas(resolve, "experiment string, molecule_name string, entity string, molecule_id int, alias boolean, n bigint, positives bigint")


def alias_experiments(links: DataFrame) -> DataFrame:
    """(experiment_id, molecule_id): experiments and the catalogue molecules they name by another name than the catalogue's."""
    return links.where("alias and experiment is not null and molecule_id is not null").select(F.col("experiment").alias("experiment_id"), "molecule_id").distinct()


def connected(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, label) of every node of ``edges``; the label is the smallest node of its component.

    Up to ``one_task`` distinct edges are joined in one task by union-find.  More are contracted by alternating
    large and small stars: O(log^2) rounds, each written to the shared folder; each round reads a node's
    minimum from a table spread over salts, so a hub's edges are shared by many tasks.  Both give the same
    labels.  Nodes without edges aren't in the result.  Self-loops and repeats are harmless.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = cut(pairs, "star")
    if now.count() <= one_task:
        return now.coalesce(1).mapInPandas(_union_find, f"node {now.schema['u'].dataType.simpleString()}, label {now.schema['u'].dataType.simpleString()}")
    return _stars(now, most)


def _union_find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for pdf in batches:
        for u, v in zip(pdf["u"], pdf["v"], strict=True):
            u, v = root(u), root(v)
            parent[max(u, v)] = min(u, v)
    yield pd.DataFrame([(x, root(x)) for x in list(parent)], columns=["node", "label"])


def _stars(now: DataFrame, most: int) -> DataFrame:
    pairs, before = now, None
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int").alias("salt")

    def with_min(both: DataFrame) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        return both.select("u", "v", salt).join(least, ["u", "salt"])

    for _ in range(most):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v")
        large = cut(with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star")
        small_in = large.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = with_min(small_in)
        now = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "star")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components didn't settle in {most} rounds")
    labelled = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(labelled.select("node"), "node", "left_anti")
    return labelled.unionByName(roots.select("node", F.col("node").alias("label")))


def components(links: DataFrame) -> DataFrame:
    """(experiment, molecule_name, molecule_id, alias, component, n, positives): the component of every pair that has an id or a name.

    A pair's component is that of its entity, else that of its experiment's other rows, else the
    experiment alone.
    """
    edges = links.where("experiment is not null and entity is not null").groupBy("experiment", "entity").agg(F.count(F.lit(1)).alias("c"))
    ends = edges.groupBy("experiment").agg(F.min("entity").alias("lo"), F.max("entity").alias("hi"))
    ties = edges.join(ends.where("lo < hi"), "experiment").where("entity != lo").select("lo", F.col("entity").alias("hi")).distinct()
    label = connected(ties, "lo", "hi")
    known = (
        links.where("entity is not null").join(label.withColumnRenamed("node", "entity"), "entity", "left")
        .select("experiment", "molecule_name", "molecule_id", "alias", F.coalesce("label", "entity").alias("component"), "n", "positives")
    )
    home = ends.select("experiment", F.col("lo").alias("node")).join(label, "node", "left").select("experiment", F.coalesce("label", "node").alias("home"))
    unnamed = (
        links.where("entity is null and experiment is not null").join(home, "experiment", "left")
        .select("experiment", "molecule_name", "molecule_id", "alias", F.coalesce("home", F.concat(F.lit("e:"), "experiment")).alias("component"), "n", "positives")
    )
    return known.unionByName(unnamed)


def min_cost_flow(arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost) of a cheapest maximum flow: successive shortest paths."""
    n = 1 + max(max(a, b) for a, b, *_ in arcs)
    to, cap, cost, out = [], [], [], [[] for _ in range(n)]
    for a, b, c, w in arcs:
        out[a].append(len(to))
        to.append(b)
        cap.append(c)
        cost.append(w)
        out[b].append(len(to))
        to.append(a)
        cap.append(0)
        cost.append(-w)
    while True:
        dist, via = [math.inf] * n, [-1] * n
        dist[source], queue = 0, [source]
        while queue:
            u = queue.pop(0)
            for e in out[u]:
                if cap[e] and dist[u] + cost[e] < dist[to[e]]:
                    dist[to[e]], via[to[e]] = dist[u] + cost[e], e
                    if to[e] not in queue:
                        queue.append(to[e])
        if via[sink] < 0:
            return [arcs[i][2] - cap[2 * i] for i in range(len(arcs))]
        push, v = math.inf, sink
        while v != source:
            push, v = min(push, cap[via[v]]), to[via[v] ^ 1]
        v = sink
        while v != source:
            cap[via[v]] -= push
            cap[via[v] ^ 1] += push
            v = to[via[v] ^ 1]


def allocate(bundles: dict[tuple[int, int], int], splits=SPLITS) -> dict[tuple[int, int], list[int]]:
    """Components of each bundle (size, profile class) for each split.

    The flow runs from profile classes to splits in rows.  Within quota it is free; beyond a class's own
    share of a split it costs 1 a row, beyond the split's total 3.  Flows are rounded to whole
    components, large ones first, each left over to where most rows are missing.  Then, whatever the number of
    bundles, the component or the swap of two that comes nearest to what a split has too much of is moved to
    one that lacks rows, as long as that lowers the total deviation (``_repair``).
    """
    classes = sorted({c for _, c in bundles})
    rows = {c: sum(s * n for (s, k), n in bundles.items() if k == c) for c in classes}
    total, m = sum(rows.values()), len(splits)
    if not total:
        return {b: [n] + [0] * (m - 1) for b, n in bundles.items()}
    shares = [p / sum(q for _, q in splits) for _, p in splits]

    def quota(n: int) -> list[int]:
        q = [int(n * p) for p in shares]
        q[0] += n - sum(q)
        return q

    source, sink, arcs, flows = 0, 1 + len(classes) + m, [], []
    for i, c in enumerate(classes):
        arcs.append((source, 1 + i, rows[c], 0))
        for j, q in enumerate(quota(rows[c])):
            flows.append((c, j, len(arcs)))
            arcs.append((1 + i, 1 + len(classes) + j, q, 0))
            flows.append((c, j, len(arcs)))
            arcs.append((1 + i, 1 + len(classes) + j, rows[c], 1))
    for j, q in enumerate(quota(total)):
        arcs += [(1 + len(classes) + j, sink, q, 0), (1 + len(classes) + j, sink, total, 3)]
    flow = min_cost_flow(arcs, source, sink)
    want = {c: [0] * m for c in classes}
    for c, j, e in flows:
        want[c][j] += flow[e]
    goal, have = quota(total), [0] * m
    out: dict[tuple[int, int], list[int]] = {}
    for size, c in sorted(bundles, reverse=True):
        n, given = bundles[size, c], [0] * m
        if size:
            open_rows = sum(max(0, w) for w in want[c]) or 1
            for j in range(m):
                k = min(n - sum(given), int(n * max(0, want[c][j]) / open_rows), max(0, want[c][j]) // size)
                given[j] += k
                want[c][j] -= k * size
                have[j] += k * size
        for _ in range(n - sum(given) if size else 0):
            j = max(range(m), key=lambda j: (goal[j] - have[j], want[c][j]))
            given[j] += 1
            want[c][j] -= size
            have[j] += size
        if not size:
            given[0] = n
        out[size, c] = given
    return _repair(out, [h - g for h, g in zip(have, goal, strict=True)])


def _repair(out: dict[tuple[int, int], list[int]], over: list[int]) -> dict[tuple[int, int], list[int]]:
    """Moves and swaps single components between splits; ``over`` is what each split has too many rows of.

    Candidates are found by bisection in the sorted sizes, so a step costs B log B for B bundles.
    """
    keys = sorted(k for k in out if k[0])
    sizes, held = np.array([k[0] for k in keys], dtype=np.int64), np.array([out[k] for k in keys], dtype=np.int64).reshape(len(keys), len(over))
    over = np.array(over, dtype=np.int64)

    def nearest(have: np.ndarray, want: np.ndarray) -> np.ndarray:
        """For each of ``want`` the place in ``have`` (ascending) of the nearest value."""
        at = np.clip(np.searchsorted(have, want), 1, max(1, len(have) - 1))
        return np.where((len(have) == 1) | (np.abs(have[at - 1] - want) <= np.abs(have[np.minimum(at, len(have) - 1)] - want)), at - 1, at)

    while len(keys):
        best = (0, 0, 0, 0, -1)  # gain, from, to, bundle given, bundle taken
        for i in np.flatnonzero(over > 0):
            for j in np.flatnonzero(over < 0):
                here, there = np.flatnonzero(held[:, i]), np.flatnonzero(held[:, j])
                target = min(over[i], -over[j])
                before = abs(over[i]) + abs(over[j])
                options = []
                if len(here):
                    g = here[nearest(sizes[here], np.array([target]))[0]]
                    options.append((g, -1, sizes[g]))
                if len(here) and len(there):
                    t = there[nearest(sizes[there], sizes[here] - target)]
                    k = int(np.argmin(np.abs(sizes[here] - sizes[t] - target)))
                    options.append((here[k], t[k], sizes[here[k]] - sizes[t[k]]))
                for g, t, d in options:
                    gain = before - abs(over[i] - d) - abs(over[j] + d)
                    if gain > best[0]:
                        best = (gain, i, j, g, t)
        if not best[0]:
            break
        _, i, j, g, t = best
        d = sizes[g] - (sizes[t] if t >= 0 else 0)
        held[g, i] -= 1
        held[g, j] += 1
        if t >= 0:
            held[t, j] -= 1
            held[t, i] += 1
        over[i] -= d
        over[j] += d
    return {**out, **{k: [int(x) for x in row] for k, row in zip(keys, held, strict=True)}}


def _alone(label: str, row_id: str):
    """(condition of rows with neither id nor name, the component such a row is)."""
    return F.col("experiment_id").isNull() & (F.col("molecule_name").isNull() | (F.trim("molecule_name") == "")), F.concat(F.lit("r:"), F.col(row_id).cast("string"))


def split_links(features: DataFrame, catalogue: DataFrame, splits=SPLITS, row_id: str = "load_id", label: str = "converged") -> tuple[DataFrame, DataFrame]:
    """(links with their component and split, component -> split), both written once.

    Links are the distinct (experiment, name) pairs of ``entity_links``.
    """
    links = cut(entity_links(features, catalogue_names(catalogue), label), "links")
    placed = cut(components(links), "components")
    alone, own = _alone(label, row_id)
    singles = features.where(alone).select(own.alias("component"), F.lit(1).cast("bigint").alias("size"), F.coalesce(F.col(label).cast("bigint"), F.lit(0)).alias("positives"))
    comps = placed.groupBy("component").agg(F.sum("n").alias("size"), F.sum("positives").alias("positives")).unionByName(singles)
    comps = comps.withColumn("profile", F.round(F.col("positives") / F.col("size") * (PROFILE_CLASSES - 1)).cast("int"))
    rows = comps.groupBy("size", "profile").agg(F.count(F.lit(1)).alias("n")).limit(MAX_BUNDLES + 1).collect()  # counted: more is an error
    if len(rows) > MAX_BUNDLES:
        raise ValueError(f"more than {MAX_BUNDLES} bundles; use fewer PROFILE_CLASSES")
    shares = allocate({(r["size"], r["profile"]): r["n"] for r in rows}, splits)
    ends = [(s, c, [sum(g[: j + 1]) for j in range(len(g))]) for (s, c), g in shares.items()]
    bounds = features.sparkSession.createDataFrame(ends, "size bigint, profile int, ends array<bigint>")
    bounds = F.broadcast(bounds) if len(ends) <= BROADCAST_BUNDLES else bounds
    ranked = with_ordinals(comps, ["size", "profile"], ["component"], "place").join(bounds, ["size", "profile"])
    chosen = F.element_at(F.array(*[F.lit(n) for n, _ in splits]), (F.size(F.filter("ends", lambda e: e <= F.col("place"))) + 1).cast("int"))
    split_of = cut(ranked.select("component", chosen.alias("split")), "split-of")
    return cut(placed.join(split_of, "component"), "split-links"), split_of


def assign_splits(features: DataFrame, catalogue: DataFrame, splits=SPLITS, row_id: str = "load_id", label: str = "converged") -> DataFrame:
    """(load_id, component, split): the split of every row.

    Rows without id and name are components of their own.  Ties in a bundle are decided by the hash of
    the component.  An empty table gives no rows.
    """
    links, split_of = split_links(features, catalogue, splits, row_id, label)
    alone, own = _alone(label, row_id)
    by_pair = links.select(F.col("experiment").alias("__e"), F.col("molecule_name").alias("__m"), "component", "split")
    by_pair = F.broadcast(by_pair) if links.count() <= BROADCAST_PAIRS else by_pair
    keyed = features.select(row_id, F.lower(F.regexp_replace("experiment_id", r"^\s+|\s+$", "")).alias("__x"), F.col("molecule_name").alias("__y"), alone.alias("__alone"))
    named = keyed.where("not __alone").join(by_pair, F.col("__x").eqNullSafe(F.col("__e")) & F.col("__y").eqNullSafe(F.col("__m"))).select(row_id, "component", "split")
    lone = keyed.where("__alone").select(row_id, own.alias("component")).join(split_of, "component").select(row_id, "component", "split")
    return named.unionByName(lone)
