"""Drift, compaction, flattening and once-only delivery against brute force and on dirty input."""

import json
import random

import pytest

from pyspark.sql import functions as F

from trajecta.operators import compaction, drift, flatten, once
from trajecta.operators.ordinals import with_ordinals
from trajecta.runtime import cut

MSG = "record_id bigint, file_id bigint, line_no int, payload string, junk string"
FILES = "file_id bigint, lane_id int, file_seq int, file_path string, v string"


def payload(vr=None, initial=None, **top):
    return json.dumps({"molecule_id": 1, "basis_set": "sto-3g", "vqe_result": {"initial_data": initial or {}, **(vr or {})}, **top})


def lane(spark, files, lane_id=1):
    """Messages and files of one lane; ``files`` is a list of lists of payloads."""
    rows, listing, n = [], [], 0
    for seq, payloads in enumerate(files):
        listing.append((seq + 1, lane_id, seq, f"lane/{seq}.json", "x"))
        for line, p in enumerate(payloads):
            rows.append((n, seq + 1, line, p, None))
            n += 1
    return spark.createDataFrame(rows, MSG), spark.createDataFrame(listing, FILES)


def changes(messages, files):
    records = cut(drift.record_fields(messages, files))
    return {(r.file_id, r.field_path.removeprefix("vqe_result."), r.change_kind) for r in drift.schema_changes(records).collect()}


def test_drift_reports_each_change(spark):
    files = [
        [payload({"nuclear_repulsion_energy": 1.5}, {"ansatz_name": "A"})],
        [payload({"nuclear_repulsion_energy": None}, {"ansatz_name": "A"}), "{broken"],
        ["not json at all"],
        [payload({"nuclear_repulsion_energy": "1.5"}, {"ansatzName": "A"})],
        [payload({"e_nuc": "1.5", "dipole_moment": 0.1}, {"ansatzName": {"name": "A"}})],
        [payload({"dipole_moment": None}, {"ansatzName": {"name": "A"}, "seed": 1})],
    ]
    assert changes(*lane(spark, files)) == {
        (4, "nuclear_repulsion_energy", "retyped"),
        (4, "initial_data.ansatzName", "renamed"),
        (5, "e_nuc", "renamed"),
        (5, "dipole_moment", "added"),
        (5, "initial_data.ansatzName", "retyped"),
        (6, "e_nuc", "removed"),
        (6, "initial_data.seed", "added"),
    }


def test_drift_names_seen_together_are_no_rename(spark):
    together = [payload({"dipole_energy": 1.0, "nuclear_energy": 1.0})]
    messages, files = lane(spark, [together, [payload({"dipole_energy": 1.0})], [payload({"nuclear_energy": 2.0})]])
    assert changes(messages, files) == {(2, "nuclear_energy", "removed"), (3, "dipole_energy", "removed"), (3, "nuclear_energy", "added")}


def test_drift_empty_and_null_input(spark):
    none = spark.createDataFrame([], MSG)
    assert changes(none, spark.createDataFrame([], FILES)) == set()
    messages = spark.createDataFrame([(1, 1, 0, None, None), (2, None, 0, payload(), None), (3, 2, None, payload({"a": 1}), None)], MSG)
    files = spark.createDataFrame([(1, 1, 0, "a", None), (2, 1, None, "b", None), (None, None, None, None, None)], FILES)
    assert changes(messages, files) == set()


def test_edit_script_is_cheapest():
    evidence = drift.RenameEvidence({("r.a", "r.x"): 0.5, ("r.a", "r.y"): 0.1, ("r.b", "r.y"): 0.2, ("r.b", "r.x"): 0.9})
    script = set(drift.edit_script(dict.fromkeys(["r.a", "r.b"]), dict.fromkeys(["r.x", "r.y"]), evidence))
    assert script == {("rename", "r.a", "r.x"), ("rename", "r.b", "r.y")}


def test_assignment_matches_brute_force():
    from itertools import permutations

    rng = random.Random(3)
    for _ in range(40):
        n, m = rng.randint(1, 4), rng.randint(4, 6)
        costs = [[rng.random() for _ in range(m)] for _ in range(n)]
        best = min(sum(costs[i][p[i]] for i in range(n)) for p in permutations(range(m), n))
        assert sum(costs[i][j] for i, j in enumerate(drift.assign(costs))) == pytest.approx(best)


def test_unified_table_reads_every_name_and_form(spark):
    messages, files = lane(spark, [
        [payload({"nuclear_repulsion_energy": 1.5}, {"exact_estimator": True})],
        [payload({"e_nuc": {"value": 2.5, "unit": "ha"}}, {"use_exact": 0})],
        [payload({"e_nuc": "3.5"}, {"use_exact": "true"}), "{"],
    ])
    records = cut(drift.record_fields(messages, files))
    names = drift.aliases(drift.schema_changes(records))
    table = drift.compiled_table(messages, drift.unified_columns(messages, names)).orderBy("record_id")
    assert [(r.nuclear_repulsion_energy, r.exact_estimator) for r in table.collect()] == [(1.5, True), (2.5, False), (3.5, True), (None, None)]


def test_a_name_that_means_different_things_in_different_lanes(spark):
    """Lane 1 renames a to x, lane 2 b to x, and a and b meet in lane 3: each lane keeps its own projection."""
    one, f1 = lane(spark, [[payload({"a_energy": 1.0})], [payload({"x_energy": 2.0})], [payload({"x_energy": 2.5})]], 1)
    two, f2 = lane(spark, [[payload({"b_energy": 3.0})], [payload({"x_energy": 4.0})]], 2)
    three, f3 = lane(spark, [[payload({"a_energy": 5.0, "b_energy": 6.0})]], 3)
    shift = lambda df, k: df.withColumn("file_id", F.col("file_id") + 10 * k)
    messages = one.unionByName(shift(two, 1).withColumn("record_id", F.col("record_id") + 10)).unionByName(shift(three, 2).withColumn("record_id", F.col("record_id") + 20))
    files = f1.unionByName(shift(f2, 1)).unionByName(shift(f3, 2))
    records = cut(drift.record_fields(messages, files))
    schemas = cut(drift.file_schemas(records))
    evidence = drift.RenameEvidence({("vqe_result.a_energy", "vqe_result.x_energy"): 0.2, ("vqe_result.b_energy", "vqe_result.x_energy"): 0.2})
    names = drift.aliases(drift.schema_changes(records, schemas, evidence), records)
    assert names == {"vqe_result.a_energy": ["vqe_result.a_energy", "vqe_result.x_energy"]}
    overrides = drift.lane_overrides(schemas, evidence, names)
    assert [(r.file_id, r.renames) for r in overrides.collect()] == [(12, {"vqe_result.x_energy": "vqe_result.b_energy"})]
    table = drift.compiled_table(messages, drift.unified_columns(messages, names, overrides=overrides), overrides=overrides)
    assert sorted((r.record_id, r.a_energy, r.b_energy) for r in table.collect()) == [(0, 1.0, None), (1, 2.0, None), (2, 2.5, None), (10, None, 3.0), (11, None, 4.0), (20, 5.0, 6.0)]


def test_fields_without_texts_are_renamed_by_range_and_history(spark):
    """true/false fields whose names don't resemble each other, changed together in several lanes."""
    parts = [lane(spark, [[payload(None, {"exact_estimator": n % 2 == 0, "w": 1})], [payload(None, {"noiseless": n % 2 == 1, "w": 1})]], n) for n in range(8)]
    shift = lambda df, k: df.withColumn("file_id", F.col("file_id") + 10 * k)
    messages, files = (shift(parts[0][i], 0) for i in (0, 1))
    for k, (m, f) in enumerate(parts[1:], 1):
        messages, files = messages.unionByName(shift(m, k)), files.unionByName(shift(f, k))
    assert changes(messages, files) == {(10 * k + 2, "initial_data.noiseless", "renamed") for k in range(8)}
    lonely, listing = parts[0]  # in a single lane nothing says so
    assert changes(lonely, listing) == {(2, "initial_data.exact_estimator", "removed"), (2, "initial_data.noiseless", "added")}


def test_evidence_counts_every_value_whatever_its_length(spark):
    long = ["x" * 5000 + str(i) for i in range(200)]
    messages, files = lane(spark, [[payload({"alpha": v}) for v in long], [payload({"beta": v}) for v in long]])
    assert changes(messages, files) == {(2, "beta", "renamed")}


def test_unified_columns_cover_every_field_of_every_file(spark):
    messages, files = lane(spark, [
        [payload({"warnings": ["a"], "minimum": -1}, {"ansatz_name": "A", "seed": 7}), payload({"warnings": None, "minimum": -1.5}, {"ansatz_name": "B", "seed": "8"})],
        [payload({"late": True}, {"ansatzName": {"family": "A", "entanglement": "linear"}, "resilience": {"level": 1}, "code": "x"})],
        [payload({"late": False}, {"ansatzName": ["B", "linear"], "code": 5}), "{"],
    ])
    messages = messages.unionByName(spark.createDataFrame([(50, None, 0, payload({"unlisted": 2}), None)], MSG))
    names = {"vqe_result.initial_data.ansatz_name": ["vqe_result.initial_data.ansatzName", "vqe_result.initial_data.ansatz_name"]}
    table = drift.compiled_table(messages, drift.unified_columns(messages, names)).drop("file_id")
    assert dict(table.dtypes) == {
        "record_id": "bigint", "late": "boolean", "minimum": "double", "unlisted": "bigint", "warnings": "array<string>", "ansatz_name": "string",
        "ansatz_name_entanglement": "string", "code": "string", "resilience": "struct<level:bigint>", "seed": "bigint",
    }
    rows = {r.record_id: {k: v for k, v in r.asDict(True).items() if v is not None and k != "record_id"} for r in table.collect()}
    assert rows == {
        0: {"warnings": ["a"], "minimum": -1.0, "ansatz_name": "A", "seed": 7}, 1: {"minimum": -1.5, "ansatz_name": "B", "seed": 8},
        2: {"late": True, "ansatz_name": "A", "ansatz_name_entanglement": "linear", "resilience": {"level": 1}, "code": "x"},
        3: {"late": False, "ansatz_name": "B", "ansatz_name_entanglement": "linear", "code": "5"}, 4: {}, 50: {"unlisted": 2},
    }


@pytest.mark.parametrize(("text", "inputs", "output", "end"), [
    ("consolidated files 106-108, 110 into 205; aborted", "106 107 108 110", "205", "bad"),
    ("job=merge in=1-2|7 out=9 state=success", "1 2 7", "9", "good"),
    ("merge of 3 files [4 5 6] -> lane-1/merged/0001-ab12.json (committed)", "4 5 6", "lane-1/merged/0001-ab12.json", "good"),
    ('{"status": "DONE", "merge": {"from": ["l/1.json", "l/2.json"], "to": "l/m.json"}}', "l/1.json l/2.json", "l/m.json", "good"),
    ('{"op": "consolidate", "inputs": [1, 2], "output": 3, "status": "crashed"}', "1 2", "3", "bad"),
    ("merged files 4, 5 into 9 on 2025-12-31: success", "4 5", "9", "good"),
    ("merged files 4, 5 into 9 after 3 retries, at 10:42 on 31.12.2025: success", "4 5", "9", "good"),
    ("merged files 4 and 5 into 9 OK in 12 s, 30 records, 4 KB", "4 5", "9", "good"),
    ("combined ids 4; 5 into 9 on worker 7, no failures, committed", "4 5", "9", "good"),
    ("files 4, 5 into 9: not committed", "4 5", "9", "bad"),
    ("merging 4, 5 -> 9; exit code 1", "4 5", "9", "bad"),
    ('{"inputs": [4, 5], "output": 9, "status": "success", "errors": "no failed files"}', "4 5", "9", "good"),
    ('{"merged_from": [4, 5], "merged_to": 9, "state": "done", "took": 12, "attempt": 3}', "4 5", "9", "good"),
    ('{"input_count": 2, "inputs": ["4", "5"], "output": {"file_id": 9, "bytes": 100}, "success": true}', "4 5", "9", "good"),
    ('{"batch": {"sources": [{"id": 4, "rows": 8}, {"id": 5, "rows": 7}], "target": {"id": 9}}, "failed": false}', "4 5", "9", "good"),
])
def test_reports_in_no_fixed_form(text, inputs, output, end):
    rows = compaction.parse_report(text)
    found = [r for k, r in rows if k == "input"]
    assert [str(i) for r in found for i in (range(int(r.split("..")[0]), int(r.split("..")[1]) + 1) if ".." in r else [r])] == inputs.split()
    assert [r for k, r in rows if k == "output"] == [output] and ("end", end) in rows


def test_reports_without_files():
    assert compaction.parse_report(None) == [] == compaction.parse_report("") == compaction.parse_report("  ")
    for text in ("nothing to merge", "batch finished: 12 files, 30 records in 4 s", "took 5", '{"status": "done", "n": 4}', "[1, 2]"):
        assert compaction.parse_report(text) == [("unread", text)]
    assert compaction.parse_report("rollback of batch " + "a" * 32) == [("rollback", "a" * 32)]


META = "processing_batch_id string, processing_name string, source_data_info string"


def storage(spark):
    rows = [(i, f, 0, payload({"n": i}), None) for i, f in enumerate([1, 2, 3, 4, 5, 6, 6, 7])] + [(90, 8, 0, "x" * 40_000, None), (91, 9, 0, None, None), (92, None, 0, "y", None), (93, 5, 1, "{bad", None)]
    listing = [(i, 1, i, f"l/{i}.json", None) for i in range(1, 10)]
    good, undone = "b" * 32, "c" * 32
    log = [(good, "file_consolidation", "files 1-2 into 4; done")] * 2 + [("d" * 32, "file_consolidation", "files 5-6 into 7; failed"), (undone, "file_consolidation", "merge in=6 out=3 state=done")]
    log += [("e" * 32, "file_consolidation", f"rollback of batch {undone}"), ("f" * 32, "other", "files 8-9 into 5; done"), (None, "file_consolidation", None)]
    return spark.createDataFrame(rows, MSG), spark.createDataFrame(log, META), spark.createDataFrame(listing, FILES)


def test_small_valid_files(spark):
    assert {r.file_id for r in compaction.small_files(compaction.consolidation_plan(*storage(spark))).collect()} == {4, 5, 6, 9}
    messages, log, files = storage(spark)
    odd = log.limit(0).unionByName(spark.createDataFrame([("a" * 32, "file_consolidation", "files 0-99999999999 into 7; done"), ("b" * 32, "file_consolidation", "4 of 9 went well")], META))
    assert compaction.consolidation_plan(messages, odd, files).count() == 0  # a span ends with the listing
    assert [tuple(r) for r in compaction.unread_reports(odd).collect()] == [("b" * 32, "4 of 9 went well")]


def test_consolidation_keeps_every_record_once(spark):
    messages, log, files = storage(spark)
    plan = compaction.consolidation_plan(messages, log, files, target_bytes=20_000)
    manifest = compaction.consolidate_runs(messages, plan, target_bytes=20_000).collect()
    assert sum(r.n_records for r in manifest) == 1 + 2 + 2 + 1 + 1  # files 4, 5, 6, 8, 9
    none = spark.createDataFrame([], MSG)
    assert compaction.consolidate_runs(none, compaction.consolidation_plan(none, log, files)).collect() == []


@pytest.mark.parametrize("most", [0, 50_000])
def test_payloads_are_filtered_by_bitmaps_up_to_a_checked_size(spark, monkeypatch, most):
    """Above the limit the join shuffles; either way the same records come out."""
    monkeypatch.setattr(compaction, "BROADCAST_BITMAPS", most)
    ids = [0, 7, 8, 32_767, 32_768, 70_000, -5, None]
    messages = spark.createDataFrame([(i, f, 0, "{}", None) for i, f in enumerate([*ids, 9, 32_769, -6])], MSG)
    listing = spark.createDataFrame([(f, 1, 1, f"l/{f}.json", None) for f in (9, 32_769, -6)], FILES)
    log = spark.createDataFrame([("a" * 32, "file_consolidation", "files l/9.json, l/32769.json, l/-6.json into l/no.json; done")], META)
    manifest = compaction.consolidate_runs(messages, compaction.consolidation_plan(messages, log, listing)).collect()
    assert sum(r.n_records for r in manifest) == 7


def test_compact_many_small_files(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(2000).selectExpr("id", "repeat('x', 50) as t").repartition(200).write.json(src)
    done = compaction.compact_files(spark, [src], out, "id bigint, t string", target_bytes=64_000, write_format="json")
    assert done["rows"] == 2000 and done["files"] <= 4
    assert spark.read.schema("id bigint").json(out).distinct().count() == 2000
    with pytest.raises(FileExistsError):
        compaction.compact_files(spark, [src], out, "id bigint, t string")


def test_a_lossy_write_is_not_published(spark, tmp_path):
    chance = F.udf(lambda _: random.random(), "double").asNondeterministic()
    out = str(tmp_path / "out")
    with pytest.raises(compaction.LostRecords):
        compaction.pack_splits(spark, lambda: spark.range(10).withColumn("r", chance("id")), out, 1000)
    assert not (tmp_path / "out").exists()


NESTED = "k bigint, pos int, a array<struct<x: int, ys: array<double>, `dewey`: string>>, b struct<c: array<string>, d: struct<e: int>>, m array<array<int>>"


def test_flatten_links_children_to_parents(spark):
    rows = [
        (1, 9, [(1, [0.5, None], "q"), None, (2, [], None), (2, None, None)], (["u", None, "u"], (7,)), [[1, 2], None, [3]]),
        (2, None, None, None, []),
        (None, 0, [(5, [1.0], "z")], (None, None), None),
    ]
    tables = flatten.flatten(spark.createDataFrame(rows, NESTED), "k")
    assert set(tables) == {"", "a", "a.ys", "b.c", "m", "m.[]"}
    assert {(r.k, tuple(r.dewey), r.x) for r in tables["a"].collect()} == {(1, (0,), 1), (1, (2,), 2), (1, (3,), 2), (None, (0,), 5)}
    assert {(r.k, tuple(r.dewey), tuple(r.parent), r.value) for r in tables["a.ys"].collect()} == {(1, (0, 0), (0,), 0.5), (1, (0, 1), (0,), None), (None, (0, 0), (0,), 1.0)}
    assert [r.value for r in tables["b.c"].orderBy("dewey").collect()] == ["u", None, "u"]
    assert {(tuple(r.dewey), r.value) for r in tables["m.[]"].collect()} == {((0, 0), 1), ((0, 1), 2), ((2, 0), 3)}
    assert tables[""].count() == 3 and "dewey_" in tables["a"].columns
    orphans = tables["a.ys"].join(tables["a"].select("k", F.col("dewey").alias("parent")), ["k", "parent"], "left_anti").where("k is not null")
    assert orphans.count() == 0


def test_flatten_empty_table(spark):
    assert all(t.count() == 0 for t in flatten.flatten(spark.createDataFrame([], NESTED), "k").values())
    with pytest.raises(ValueError):
        flatten.node_table(spark.range(1).selectExpr("id as dewey", "array(1) as a"), "dewey", flatten.node_tables(spark.range(1).selectExpr("array(1) as a").schema, "dewey")[0])


def test_surplus_matches_brute_force_with_a_hot_identifier(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 300 + [f"k{j}" for j in range(500)] + [None])) for i in rng.sample(range(5000), 2000)]
    df = spark.createDataFrame(rows, "row_id bigint, identifier string").withColumn("shard", F.lit("x")).withColumn("code", F.lit(1))
    first = {}
    for i, k in sorted(rows):
        if k is not None:
            first.setdefault(k, i)
    want = sorted(i for i, k in rows if k is not None and first[k] != i)
    assert sorted(r.row_id for r in once.surplus(df, "identifier", "row_id", shards=8).collect()) == want


def test_batches_share_what_was_seen(spark):
    state = once.SeenState(spark, once.scratch_path(spark, "t"), shards=4)
    kept = [sorted((r.identifier, r.row_id) for r in once.keep_once(state, spark.createDataFrame(b, "identifier string, row_id bigint"), "identifier", "row_id").collect()) for b in (
        [("a", 5), ("a", 3), ("b", 9), (None, 1)], [("a", 1), ("c", 2)], [("b", 0)])]
    assert kept == [[("a", 3), ("b", 9)], [("c", 2)], []]
    assert state.versions() == [1, 2]
    codes = [r.code for r in state.dictionary().collect()]
    assert len(codes) == len(set(codes)) == 3
    empty = once.keep_once(state, spark.createDataFrame([], "identifier string, row_id bigint"), "identifier", "row_id")
    assert empty.count() == 0 and state.versions() == [1, 2]


def test_a_batch_reads_and_writes_only_its_shards(spark):
    state = once.SeenState(spark, once.scratch_path(spark, "t"), shards=16)
    batch = lambda *ids: spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "identifier string, row_id bigint")
    assert once.keep_once(state, batch(*map(str, range(200))), "identifier", "row_id").count() == 200
    assert [r.identifier for r in once.keep_once(state, batch("7", "new"), "identifier", "row_id").collect()] == ["new"]
    shards = {r.shard for r in batch("7", "new").select(F.pmod(F.xxhash64("identifier"), F.lit(16)).cast("int").alias("shard")).collect()}
    written = {int(n.removeprefix("shard=")) for n in state.fs.subdirs(f"{state.path}/bitmaps/_v={state.commits()[-1]['folder']}")}
    assert written <= shards and state.bitmaps(sorted(shards)).count() < state.bitmaps().count()
    plan = state.dictionary(sorted(shards))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan.replace("isnotnull(shard", "[shard") or "PartitionFilters: [" in plan and "shard" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert once.keep_once(state, batch(*map(str, range(200)), "new"), "identifier", "row_id").count() == 0
    assert once.shards_for(0) == 1 and once.shards_for(5_000_000) == 3 and once.SeenState(spark, state.path).shards == 16


def test_a_lost_version_is_invisible(spark):
    state = once.SeenState(spark, once.scratch_path(spark, "t"))
    spark.createDataFrame([("z", 1, 0)], once.DICTIONARY).drop("shard").write.parquet(f"{state.path}/dictionary/_v=0000000001-dead/shard=0")
    assert once.keep_once(state, spark.createDataFrame([("z", 7)], "identifier string, row_id bigint"), "identifier", "row_id").count() == 1


def test_run_identifier_counts_numbers_by_value(spark):
    start = {"backend": "b", "num_qubits": 4, "optimizer": "O", "ansatz_reps": 2}
    texts = [
        payload(initial={**start, "initial_parameters": [0.1, -0.0]}),
        payload(initial={**start, "initial_parameters": [0.1, 0]}, basis_set="STO3G"),
        payload(initial={**start, "initial_parameters": [0.1, 0], "seed": 3}).replace("0.1", "1e-1").replace('"num_qubits": 4', '"num_qubits": 4.0'),
        payload(initial={**start, "initial_parameters": [0.1, 0.2]}),
        "{cut", "", None, "[1]", payload(initial=start) + " trailing",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "record_id bigint, payload string")
    ids = [r.identifier for r in once.message_identifiers(df).orderBy("row_id").collect()]
    assert ids[0] == ids[1] == ids[2] != ids[3] and ids[4:] == [None] * 5


def test_step_identifiers(spark):
    rows = [(1, " Ab", 1), (2, "aB\t", 1), (3, "ab", None), (4, None, 1), (5, "ab", 2)]
    df = spark.createDataFrame(rows, "load_id bigint, experiment_id string, iteration_step int")
    assert [r.row_id for r in once.surplus(once.step_identifiers(df), "identifier", "row_id").collect()] == [2]


def test_kept_surplus_and_unidentified_rows_are_the_whole_table(spark):
    from trajecta.plans import corpus

    base = "/root/testdata/sf0.001"
    ids = lambda q, *c: [tuple(r) for r in corpus.queries()[q](spark, base).select(*c).collect()]
    rest = ids("p4_found", "table_name", "row_id") + ids("p4_unidentified", "table_name", "row_id")
    for table, key, kept in (("run_messages", "record_id", "p4_kept_runs"), ("ml_iteration_features", "load_id", "p4_kept_steps")):
        whole = [r[0] for r in spark.read.parquet(f"{base}/{table}.parquet").select(key).collect()]
        assert sorted([r[0] for r in ids(kept, key)] + [r for t, r in rest if t == table]) == sorted(whole)


def test_ordinals_are_exact_in_a_hot_group(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then id % 7 end as g")
    rows = with_ordinals(df, ["g"], ["id"], "n", buckets=16).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.g, []).append(r.n)
    assert all(sorted(v) == list(range(len(v))) for v in groups.values()) and len(rows) == 3000
    assert with_ordinals(df.limit(0), ["g"], ["id"]).count() == 0


