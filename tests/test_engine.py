"""Trajectories, ingest, tables, codecs, streaming, metrics and models on hand-made rows."""

import json
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trajecta.functions import metrics, observability
from trajecta.operators import ingest, models, trajectory
from trajecta.plans import engine, pipelines
from trajecta.sources import avro, readers
from trajecta.sources.tables import VersionedTable
from trajecta.streaming import ingest as streams

GOLDEN = [(-1.0, None, None), (-1.2, -0.2, 0.5), (-1.1, 0.1, 0.4), (-1.3, -0.2, 0.3), (-1.3, 0.0, 0.2), (-1.25, 0.05, 0.1)]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [("r", i + 1, e, d, p, min(x[0] for x in GOLDEN[: i + 1]), 6, 12.0) for i, (e, d, p) in enumerate(GOLDEN)]
    return spark.createDataFrame(rows, "run_id string, step bigint, energy double, energy_delta double, parameter_delta_norm double, cumulative_min_energy double, total_iterations bigint, vqe_time double")


def test_golden_iteration_features(golden):
    rows = trajectory.iteration_features(golden).orderBy("step").collect()
    rounded = lambda name: [None if r[name] is None else round(r[name], 6) for r in rows]
    assert [r.is_new_minimum for r in rows] == [True, True, False, True, False, False]
    assert rounded("steps_since_improvement") == [0, 0, 1, 0, 1, 2] and rows[0].convergence_iteration == 4
    assert rounded("energy_moving_avg_5") == [-1.0, -1.1, -1.1, -1.15, -1.18, -1.23]
    assert rounded("energy_moving_std_5") == [None, 0.141421, 0.1, 0.129099, 0.130384, 0.083666]
    assert rounded("normalized_energy") == [0, 0, 0.083333, 0, 0, 0.038462]
    assert rounded("energy_improvement_rate") == [0, 0.1, 0.066667, 0.075, 0.06, 0.05]
    assert rounded("mean_param_change") == [None, 0.25, 0.3, 0.3, 0.28, 0.25]


def test_golden_run_summary(golden):
    r = trajectory.run_summary(trajectory.iteration_features(golden), ["total_iterations", "vqe_time"]).first().asDict()
    want = {"mean_energy_delta": -0.05, "std_energy_delta": 0.141421, "min_energy": -1.3, "energy_range": 0.3, "mean_param_delta_norm": 0.3, "std_param_delta_norm": 0.158114, "total_param_distance": 1.5, "num_new_minima": 3, "longest_plateau": 2, "improvement_ratio": 0.5, "first_10_mean_energy": -1.191667, "first_10_energy_slope": -0.05, "time_per_iteration": 2.0}
    assert {k: round(r[k], 6) for k in want} == want


@pytest.mark.parametrize(("fraction", "seen", "slope", "rate"), [(0.25, 2, -0.2, 0.1), (0.5, 3, -0.05, 0.066667), (0.75, 5, -0.07, 0.06)])
def test_golden_fractions(golden, fraction, seen, slope, rate):
    r = trajectory.fraction_features(golden, fraction).first()
    assert (r.steps_seen, round(r.energy_slope, 6), round(r.improvement_rate, 6)) == (seen, slope, rate)


def test_prefixes_see_nothing_later(spark, golden):
    changed = golden.withColumn("energy", F.when(F.col("step") > 3, 99.0).otherwise(F.col("energy")))
    features = lambda df: trajectory.horizon_features(trajectory.with_improvement(df), 3).collect()
    assert features(golden) == features(changed)
    with pytest.raises(ValueError):
        trajectory.horizon_features(golden, 0)
    with pytest.raises(ValueError):
        trajectory.fraction_features(golden, 0)


def test_tolerant_scan(golden):
    assert [r.steps_since for r in trajectory.tolerant_improvement(golden).orderBy("step").collect()] == [1, 0, 1, 0, 1, 2]
    assert [r.steps_since for r in trajectory.tolerant_improvement(golden, seeded=False).orderBy("step").collect()] == [0, 0, 1, 0, 1, 2]


def test_trajectories_of_empty_and_dirty_tables(spark, golden):
    empty = golden.limit(0)
    assert trajectory.run_summary(trajectory.iteration_features(empty), ["total_iterations"]).count() == 0
    odd = spark.createDataFrame([(None, 0, None, None, None, None, None), (None, 0, None, None, None, None, None), ("a", 0, 1.0, None, None, 0.0, 0)], "run_id string, step bigint, energy double, energy_delta double, parameter_delta_norm double, cumulative_min_energy double, total_iterations bigint")
    rows = trajectory.iteration_features(odd).collect()
    assert len(rows) == 3 and all(r.mean_param_change is None and r.relative_iteration is None for r in rows)
    assert trajectory.best_step(odd).collect()[0].best_step == 0
    good, bad = trajectory.null_key_gate(odd, ["run_id", "energy"])
    assert (good.count(), bad.count()) == (1, 2)


@pytest.mark.parametrize(("n", "most", "least"), [(1000, 100, 100), (200, 50, 50), (10, 1, 1), (100, 10, 10)])
def test_downsampling_keeps_the_last_point(spark, n, most, least):
    rows = trajectory.downsample(spark.range(n).selectExpr("'r' as run_id", "id as step"), most).collect()
    assert least <= len(rows) <= 2 * most and max(r.step for r in rows) == n - 1
    assert trajectory.evenly_spaced(spark.range(n).selectExpr("'r' as run_id", "id as step"), most + 1).count() <= most + 1


def raw_record(seed=42, basis="sto-3g", **changes):
    initial = {"backend": "qasm_simulator", "num_qubits": 4, "hamiltonian": [{"label": "II", "coefficients": {"real": -1.0, "imaginary": 0.0}}], "num_parameters": 4, "initial_parameters": [0.1, 0.2, 0.3, 0.4], "optimizer": "L-BFGS-B", "ansatz": "OPENQASM 3.0;", "noise_backend": "undef", "default_shots": 1024, "ansatz_reps": 1, "init_strategy": "hf", "seed": seed, "ansatz_name": "EfficientSU2"}
    initial.update(changes.pop("initial", {}))
    its = [{"iteration": i, "parameters": [0.1 + i * 0.05, 0.2, 0.3, 0.4], "result": -1.1 - i * 0.05, "std": 0.01, "energy_delta": None if not i else -0.05, "parameter_delta_norm": None if not i else 0.1, "cumulative_min_energy": -1.1 - i * 0.05} for i in range(2)]
    result = {"initial_data": initial, "iteration_list": its, "minimum": -1.15, "optimal_parameters": [0.15, 0.25, 0.35, 0.45], "minimization_time": 10.0, "nuclear_repulsion_energy": 0.715, "success": True, "nfev": 20, "nit": 2}
    return {"molecule_id": 0, "basis_set": basis, "hamiltonian_time": 1.0, "mapping_time": 0.5, "vqe_time": 10.0, "total_time": 11.5, "molecule": {"molecule_data": {"symbols": ["H", "H"], "coords": [[0.0, 0.0, 0.0], [0.0, 0.0, 0.735]], "multiplicity": 1, "charge": 0, "units": "angstrom"}}, "vqe_result": result | changes}


def write_json(folder, records):
    folder.mkdir(parents=True, exist_ok=True)
    for i, r in enumerate(records):
        (folder / f"{i}.json").write_text(json.dumps(r))


def test_ingest_is_idempotent_and_audited(spark, tmp_path):
    write_json(tmp_path / "bucket" / "empty", [])
    write_json(tmp_path / "bucket" / "runs" / "year=2025" / "hour=01", [raw_record(), raw_record(), raw_record(seed=7), raw_record(basis="6-31g"), raw_record(initial={"init_strategy": None, "ansatz_name": None})])
    bucket, warehouse, now = str(tmp_path / "bucket"), str(tmp_path / "wh"), datetime(2025, 1, 2)
    assert readers.topics(spark, bucket) == ["empty", "runs"] and readers.topics(spark, str(tmp_path / "none")) == []
    first = pipelines.ingest_topics(spark, bucket, warehouse, now)["runs"]
    assert {k: n for k, (_, n) in first.items()} == {"molecules": 4, "ansatz_info": 4, "performance_metrics": 4, "vqe_results": 4, "initial_parameters": 16, "optimal_parameters": 16, "vqe_iterations": 8, "iteration_parameters": 32, "hamiltonian_terms": 4}
    again = pipelines.ingest_topics(spark, bucket, warehouse, now)["runs"]
    assert set(again.values()) == {(None, 0)}
    audit = VersionedTable(spark, f"{warehouse}/processing_metadata").read().collect()
    assert sorted(r.table_versions.count("no_changes") for r in audit) == [0, 9]
    ansatz = VersionedTable(spark, f"{warehouse}/ansatz_info").read()
    assert {(r.init_strategy, r.ansatz_name) for r in ansatz.collect()} == {("hf", "EfficientSU2"), ("random", "EfficientSU2")}
    ids = [r.experiment_id for r in VersionedTable(spark, f"{warehouse}/molecules").read().collect()]
    assert len(set(ids)) == 4 and all(len(i) == 64 and set(i) <= set("0123456789abcdef") for i in ids)
    built = pipelines.build_features(spark, warehouse, now)
    assert built["ml_iteration_features"][1] == 8 and built["ml_run_summary"][1] == 4 and built["quarantine"] == (None, 0)
    assert set(pipelines.build_features(spark, warehouse, now).values()) == {(None, 0)}


def test_json_and_avro_give_one_identity(spark, tmp_path):
    schema = readers.raw_schema(spark)
    record = raw_record()
    write_json(tmp_path / "t" / "a", [record])
    (tmp_path / "t" / "b").mkdir()
    (tmp_path / "t" / "b" / "x.avro").write_bytes(avro.write_container(avro.avro_schema(schema), [record]))
    rows = ingest.with_identity(readers.read_topic(spark, str(tmp_path), "t")).select("experiment_id", "vqe_result.minimum").collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_old_records_read_with_defaults(spark):
    df = spark.createDataFrame([(json.dumps({"vqe_result": {"initial_data": {"backend": "b"}}}),), ("{}",)], "j string")
    rows = readers.with_defaults(df.select(F.from_json("j", readers.raw_schema(spark)).alias("r")).select("r.*")).select("vqe_result.initial_data.*").collect()
    assert (rows[0].init_strategy, rows[0].exact_estimator, rows[0].ansatz_name, rows[0].seed) == ("random", False, "EfficientSU2", None)


def test_avro_codec_round_trip_and_bad_input():
    schema = {"type": "record", "name": "r", "fields": [{"name": "i", "type": "long"}, {"name": "s", "type": ["null", "string"]}, {"name": "a", "type": {"type": "array", "items": "double"}}, {"name": "b", "type": "boolean"}]}
    for i in (0, -1, 63, -64, 64, 2**40, -(2**62)):
        value = {"i": i, "s": None if i < 0 else "é" * (i % 70), "a": [0.5] * (abs(i) % 5), "b": i > 0}
        assert avro.Reader(avro.to_bytes(schema, value)).value(schema) == value
    assert list(avro.read_container(avro.write_container(schema, [], codec="null"))) == []
    assert avro.unframe(avro.frame(9, b"x")) == (9, b"x") and avro.frame(None, b"x") == b"x"
    for bad in (b"", b"\x01abcdef", b"\x00\x00"):
        with pytest.raises(ValueError):
            avro.unframe(bad)
    with pytest.raises(ValueError):
        avro.Reader(b"\x02").value("string")
    newer = {"type": "record", "name": "r", "fields": [{"name": "i", "type": "long"}, {"name": "n", "type": ["null", "int"], "default": None}, {"name": "d", "type": "string", "default": "random"}]}
    assert avro.resolve({"i": 1, "s": "gone"}, newer) == {"i": 1, "n": None, "d": "random"}


def test_schema_store(tmp_path):
    store = avro.SchemaStore(str(tmp_path))
    assert store.register("a", "string") == store.register("a", "string") == 1 and store.register("a", "long") == 2
    assert store.latest("a") == (2, "long") and set(store.by_id()) == {1, 2}
    with pytest.raises(KeyError):
        store.latest("b")
    with pytest.raises(ValueError):
        store.register("a", 3)


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], ["p"])
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = lambda *r: spark.createDataFrame(list(r), "k int, p string, v double")
    assert table.append(rows((1, "a", 1.0), (1, "a", 1.0), (None, "b", 2.0)), "one") == ("one", 1)
    assert table.append(rows((1, "a", 5.0))) == (None, 0)
    assert table.append(rows((2, None, 3.0), (3, "a", None)), "two")[1] == 2
    assert table.read().count() == 3 and table.read("one").count() == 1 and table.read(snapshot=1).count() == 1
    (tmp_path / "t" / "data" / "_commit-dead").mkdir()
    table.compact()
    assert sorted((r.k, r.p, r.v) for r in table.read().collect()) == [(1, "a", 1.0), (2, None, 3.0), (3, "a", None)]
    assert table.read("one").count() == 1 and [s["operation"] for s in table.snapshots()] == ["append", "append", "compact"]
    with pytest.raises(ValueError):
        table.tag("one", 2)


def test_new_records_and_fan_out(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    assert [r.k for r in ingest.new_records(df, df.where("k = 1"), ["k"]).collect()] == [2]
    assert ingest.new_records(df, None, ["k"]).count() == 2
    with pytest.raises(ingest.FanOut):
        ingest.guarded_left_join(df, df.union(df), "k")


def test_perf_delta(spark):
    snap = lambda cpu, gpu, used: json.dumps({"system": {"cpu": {"percent": cpu}, "memory": {"used": used, "percent": 10.0}}, "container_type": "gpu1", "gpu": [{"utilization_gpu": gpu, "power_draw": 1.0}]})
    df = spark.createDataFrame([(snap(25, 10, 2 << 30), snap(75, 80, 4 << 30)), (None, "x"), ("{}", "{}")], "performance_start string, performance_end string")
    rows = [r.d for r in df.select(ingest.perf_delta().alias("d")).collect()]
    assert (rows[0].cpu_percent_delta, rows[0].memory_used_delta_gb, rows[0].gpu[0].utilization_gpu_delta, rows[0].gpu[0]["index"]) == (50.0, 2.0, 70.0, 0)
    assert rows[1].cpu_percent_delta is None and rows[2].gpu is None


def test_accuracy_scores(spark):
    e = spark.createDataFrame([(0.0,), (0.001,), (0.01,), (0.099,), (None,)], "e double")
    rows = [r[0] for r in e.select(observability.accuracy(F.col("e") - 1, F.lit(-1.0))["accuracy_score"]).collect()]
    assert [None if x is None else round(x, 5) for x in rows] == [100.0, 93.9794, 79.17215, 60.0, None]


def test_counters_and_alerts(spark):
    rows = [("a", i, v) for i, v in enumerate([5, 7, 2, 2, 9])]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    assert [r.increase for r in observability.counter_increase(df, "k", "i", "v").orderBy("i").collect()] == [0, 2, 2, 0, 7]
    timed = df.select("k", F.timestamp_seconds(F.col("i") * 300).alias("ts"), "v")
    held = observability.held_alerts(timed, "k", "ts", F.col("v") < 8, 600).collect()
    assert [(r.n, int(r.since.timestamp())) for r in held] == [(4, 0)]


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 0.9, "a"), (1, 0.4, "a"), (0, 0.4, "a"), (0, 0.1, "a"), (1, 0.5, "b")], "label int, score double, g string")
    a, b = sorted(metrics.classification_metrics(df, by=["g"]).collect())
    assert (round(a.roc_auc, 6), round(a.average_precision, 6), round(a.brier, 6), round(a.mcc, 6)) == (0.875, 0.833333, 0.135, 0.57735)
    assert b.roc_auc is None and b.mcc is None and b.n_rows == 1
    assert metrics.classification_metrics(df.limit(0)).count() == 0


def test_small_functions(spark):
    df = spark.createDataFrame([("(0.5-1.5j)", [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0], "OPENQASM 3.0; qubit[2] q; rx(0.1) q[0]; cx q[0], q[1]; rx(0.2) q[1];"), (None, None, None), ("x", [], "")], "c string, f array<double>, q string")
    rows = df.select(metrics.parse_complex(F.col("c")).alias("c"), metrics.reshape_points(F.col("f")).alias("p")).collect()
    assert tuple(rows[0].c) == (0.5, -1.5) and rows[0].p == [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]] and rows[1] == (None, None) and rows[2].p == []
    assert {(r.gate, r.n) for r in metrics.gate_histogram(df, "c", "q").collect()} == {("rx", 2), ("cx", 1)}
    constant = metrics.standardize(spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double"), ["x"]).collect()
    assert [r.x for r in constant] == [0.0, 0.0, None]
    assert [r.x for r in metrics.median_impute(spark.createDataFrame([(None,)], "x double"), ["x"]).collect()] == [0.0]


def test_molecule_files(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([{"symbols": ["H", "H"], "coords": [[0, 0, 0], [0, 0, 1]]}]))
    r = readers.molecules(spark, str(tmp_path)).first()
    assert (r.name, r.multiplicity, r.charge, r.units) == ("HH", 1, 0, "angstrom")
    (tmp_path / "m.json").write_text(json.dumps([{"symbols": ["H"]}]))
    with pytest.raises(Exception, match="needs symbols"):
        readers.molecules(spark, str(tmp_path)).collect()


def test_stream_appends_once(spark, tmp_path):
    write_json(tmp_path / "in", [{"k": i % 5, "v": i} for i in range(12)])
    schema = spark.createDataFrame([], "k int, v int").schema
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    for _ in range(2):
        streams.append_batches(streams.file_stream(spark, str(tmp_path / "in"), schema, per_trigger=3), table, str(tmp_path / "cp"))
        streams.append_batches(streams.file_stream(spark, str(tmp_path / "in"), schema), table, str(tmp_path / f"cp{_}"))
    assert sorted(r.k for r in table.read().collect()) == [0, 1, 2, 3, 4]


def test_failed_batches_go_to_dead_letters(spark, tmp_path):
    write_json(tmp_path / "in", [{"k": 1}])

    class Broken:
        def append(self, batch):
            raise OSError("no store")

    with pytest.raises(Exception, match="no store"):
        streams.append_batches(streams.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], "k int").schema), Broken(), str(tmp_path / "cp"), str(tmp_path / "dead"))
    assert spark.read.json(str(tmp_path / "dead")).count() == 1
    with pytest.raises(ValueError):
        streams.kafka_options("h", "t", "g", "PLAIN")


def test_models_leave_one_group_out(spark, tmp_path):
    rows = readers.synthetic_trajectories(spark, 60, 15, 25)
    df = trajectory.horizon_features(rows, 10).join(rows.select("run_id", "molecule_name", "final_energy", F.col("init_strategy")).distinct(), "run_id").withColumn("label", (F.col("init_strategy") == "hf").cast("int"))
    numeric = ["energy_slope_k10", "energy_std_last5_k10"]
    fitted = models.fit_classifiers(df, numeric, [], "molecule_name", "run_id", estimators={"forest": models.forest(trees=5)})
    assert len({f["held_out"] for f in fitted.folds}) == 6 and all(0 <= f["brier"] <= 1 for f in fitted.folds)
    assert fitted.best("brier", higher=False) == "forest" and fitted.text(["brier"]).startswith("forest: 6 folds, brier ")
    models.save_models(fitted, str(tmp_path / "models"))
    assert models.load_models(spark, str(tmp_path / "models"))["forest"].transform(df.na.fill(0.0)).count() == 60
    assert models.predict(fitted.models["forest"], df.na.fill(0.0), "run_id").count() == 60
    with pytest.raises(ValueError):
        models.fit_classifiers(df.limit(5), numeric, [], "molecule_name", "run_id")


def test_registered_fits_are_those_of_the_operators(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(models, "fit_classifiers", lambda df, numeric, categorical, *a, estimators, suffix, interact, refit: asked.append((len(numeric), categorical, suffix, estimators)) or models.Fitted([{"model": "m", "held_out": "g", "n_rows": 1.0, "roc_auc": 0.5, "brier": 0.1, "mcc": 0.0}]))
    for name in ("forest_fit", "gbt_fit_k20"):
        engine.queries()[name](spark, "/root/testdata/sf0.001")
    assert [s for *_, s, _ in asked] == ["_k10", "_k20", "_k50", "_k20"] and all(n >= 14 and c == ["optimizer", "basis_set"] for n, c, *_ in asked)
    assert asked[0][3]["forest"](0, 0).getNumTrees() == 200 and asked[3][3]["boosted"](0, 0).getMaxIter() == 300
    assert "gbt_regressor_fit_50" in engine.queries()


def test_ridge_penalty_follows_the_training_rows(spark):
    df = spark.range(40).selectExpr("cast(id as double) as x", "3.0 * id + id % 3 as y", "case when id < 30 then 'a' else 'b' end as g")
    seen = []
    models.fit_regressors(df, ["x"], [], "g", "y", {"ridge": lambda n, std: seen.append((n, round(std, 6))) or models.ridge(n, std, label="y")})
    ys = [3.0 * i + i % 3 for i in range(40)]
    assert sorted(seen) == sorted((len(v), round(statistics.pstdev(v), 6)) for v in (ys[:30], ys[30:], ys))


def test_preprocessing_scales_by_the_population_and_multiplies_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 5.0), (8.0, 5.0)], "a double, b double")
    from pyspark.ml import Pipeline

    rows = [r.features.toArray() for r in Pipeline(stages=models.preprocessor(["a", "b"], [], 3, ["a", "b", "absent"])).fit(df).transform(df).collect()]
    za = [(x - 4) / statistics.pstdev([1, 3, 8]) for x in (1, 3, 8)]
    zb = [(x - 4) / statistics.pstdev([2, 5, 5]) for x in (2, 5, 5)]
    assert [[round(v, 9) for v in r] for r in rows] == [[round(v, 9) for v in (a, b, a * b)] for a, b in zip(za, zb, strict=True)]
    weights = models.positives_weighted(spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")).collect()
    assert sorted(r.weight for r in weights) == [1.0, 1.0, 1.0, 3.0]


@pytest.mark.parametrize("values", [[3.0, 1.0, 2.0], [4.0, 1.0, 2.0, 8.0], [5.0] * 7, [None, float("nan"), -1e300, 1e300, 0.0], [None, None], [], [1e-300, 2e-300, -0.0, 7.0, 7.0, 7.0]])
def test_medians_by_counting_are_exact(spark, values):
    df = spark.createDataFrame([(v, 1.0) for v in values], "x double, y double")
    known = [v for v in values if v is not None and v == v]
    want = {"x": statistics.median(known) if known else None, "y": 1.0 if values else None}
    assert metrics.exact_medians(df, ["x", "y"], one_task=0) == want == metrics.exact_medians(df, ["x", "y"])


def test_no_single_task_in_classification_metrics(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 = 0 as int) as label", "(id * 37 % 1000) / 1000.0D as score")
    plan = metrics.classification_metrics(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "__b" in plan and metrics.classification_metrics(df).first().n_rows == 1000


def test_reads_are_one_scan_whatever_the_number_of_commits(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], ["p"])
    for i in range(4):
        table.append(spark.createDataFrame([(i, "a")], "k int, p string"))
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and table.read().count() == 4


def test_a_second_build_reads_only_new_runs(spark, tmp_path):
    warehouse, now = str(tmp_path / "wh"), datetime(2025, 1, 2)
    write_json(tmp_path / "a", [raw_record(), raw_record(seed=7)])
    pipelines.ingest_records(spark, spark.read.schema(readers.raw_schema(spark)).json(str(tmp_path / "a")), warehouse, now)
    assert pipelines.build_features(spark, warehouse, now)["ml_run_summary"][1] == 2
    write_json(tmp_path / "b", [raw_record(), raw_record(seed=9), raw_record(seed=11, initial={"optimizer": None})])
    pipelines.ingest_records(spark, spark.read.schema(readers.raw_schema(spark)).json(str(tmp_path / "b")), warehouse, now)
    ids = pipelines.new_experiments(spark, warehouse)
    assert ids.count() == 2 and pipelines.feature_frame(spark, warehouse, ids).select("run_id").distinct().count() == 2
    built = pipelines.build_features(spark, warehouse, now)
    assert (built["ml_run_summary"][1], built["quarantine"][1]) == (1, 2)
    assert VersionedTable(spark, f"{warehouse}/ml_iteration_features").read().columns == pipelines.ITERATION_COLUMNS
    assert set(pipelines.build_features(spark, warehouse, now).values()) == {(None, 0)}


def test_volume_report_warns_of_cut_messages():
    assert ingest.volume_report({"vqe_results": 3, "vqe_iterations": 2})["warning"] and ingest.volume_report({"vqe_results": 0, "vqe_iterations": 0})["warning"] is None
    assert ingest.volume_report({}) == {"tables": 0, "tables_with_new": 0, "summary": "", "warning": None}


def test_settings_and_primitives():
    import numpy as np

    from trajecta import __main__ as cli
    from trajecta import settings

    assert settings.redact({"a": [{"api_TOKEN": 1, "b": {"Password": "x", "c": 2}}]}) == {"a": [{"api_TOKEN": "***", "b": {"Password": "***", "c": 2}}]}
    assert settings.graph_name("energy", ["H", "H"]) == "energy_H_H" and settings.feature_windows({"HEAD_WINDOW": "3"}) == {"rolling": 5, "head": 3, "tail": 10}
    assert readers.primitive({"x": np.arange(2), "y": [np.float64(1.5), 1j]}) == {"x": [0, 1], "y": [1.5, {"real": 0.0, "imaginary": 1.0}]}
    args = cli.parser().parse_args(["train", "wh", "--fraction", "2"])
    with pytest.raises(ValueError):
        cli.check(args)


def test_command_line_runs_the_pipelines(spark, tmp_path):
    from trajecta import __main__ as cli

    write_json(tmp_path / "bucket" / "runs", [raw_record(), raw_record(seed=7)])
    wh, now = str(tmp_path / "wh"), datetime(2025, 1, 2)
    run = lambda *argv: cli.run(spark, cli.parser().parse_args(list(argv)), now)
    assert run("ingest", str(tmp_path / "bucket"), wh)["runs"]["vqe_results"] == 2 and run("features", wh)["ml_run_summary"] == 2
    state = str(tmp_path / "state.json")
    observability.save_state(spark.createDataFrame([("a", "done", datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 1)), ("b", "pending", None, None), ("c", "failed", None, None)], observability.STATE), state)
    assert run("status", state) == {"total": 3, "done": 1, "pending": 1, "failed": 1, "done_percent": 33, "eta_seconds": 20.0}
    assert observability.read_state(spark, str(tmp_path / "none.json")).count() == 0


def test_avro_maps_enums_and_fixed():
    schema = {"type": "record", "name": "r", "fields": [{"name": "m", "type": {"type": "map", "values": "long"}}, {"name": "e", "type": {"type": "enum", "name": "e", "symbols": ["A", "B"]}}, {"name": "f", "type": {"type": "fixed", "name": "f", "size": 2}}]}
    value = {"m": {"x": 1, "y": -2}, "e": "B", "f": b"ab"}
    assert avro.Reader(avro.to_bytes(schema, value)).value(schema) == value == avro.resolve(value, schema)


def test_streamed_alerts_and_sessions(spark, tmp_path):
    rows = [("a", i * 300, float(v)) for i, v in enumerate([9, 9, 9, 9, 1, 9])]
    df = spark.createDataFrame(rows, "k string, s int, v double").select("k", F.timestamp_seconds("s").alias("ts"), "v")
    df.write.parquet(str(tmp_path / "in"))
    stream = lambda: streams.file_stream(spark, str(tmp_path / "in"), df.schema, "parquet")
    q = streams.held_alerts(stream(), "k", "ts", "v", 5.0, 600).writeStream.format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.since, r.until) for r in spark.table("alerts").collect()] == [(0, 600)]
    streams.object_sink(streams.session_counts(stream(), "k", "ts", "2 minutes", "0 seconds"), str(tmp_path / "out"), str(tmp_path / "c2"), file_format="parquet")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5  # the last session is still open
