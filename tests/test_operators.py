"""Hand-made cases, and the recurrences against loops."""

import datetime as dt
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.config import PRODUCTION, RESEARCH, check_neighbours, from_env
from tidegrid.functions import scalars
from tidegrid.operators import evaluate, fill, grid, ingest, models, neighbors, state, trees
from tidegrid.plans import batch
from tidegrid.plans.pipeline import prepare, reconstruct, run
from tidegrid.sources import readers
from tidegrid.streaming import stream


def series(spark, values, sensor="a"):
    return spark.createDataFrame([(sensor, k, None if v is None else float(v)) for k, v in enumerate(values)], "sensor_id string, slot long, value double")


def tracked(spark, values, sensor="a"):
    return grid.track(grid.classify(series(spark, values, sensor), "value"))


def by_slot(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("sensor_id", "slot").collect()]


def test_rounding_is_half_even(spark):
    t = [dt.datetime(2023, 1, 1, 0, m, s) for m, s in ((2, 30), (7, 30), (12, 30), (7, 45))]
    x = spark.createDataFrame([(x,) for x in t], "ts timestamp_ntz").select(scalars.slot_time(scalars.slot(F.col("ts"), 5), 5).alias("t"))
    assert [r.t.minute for r in x.collect()] == [0, 10, 10, 10]


def test_gap_classes_and_ids(spark):
    n = None
    x = by_slot(tracked(spark, [1, n, 1, n, n, n, n, n, 1, *[n] * 6, 1]), "gap_type", "gap_id", "gap_size")
    assert x[1] == ("isolated", 2, 1) and x[3] == ("medium", 4, 5) and x[9] == ("long", 6, 6) and x[0] == ("original", 0, 0)


def test_interpolation_goes_towards_the_next_value(spark):
    n = None
    x = tracked(spark, [3.0, n, 6.0, n, n, 7.0]).withColumn("k", F.when(F.col("slot").isin(0), 3.0).when(F.col("slot") == 3, 6.0))
    got = by_slot(fill.interpolate_isolated(x, "value", ["value", "k"]), "value", "k", "imputation_method")
    assert got[1] == (4.5, 4.0, "interpolation") and got[3][0] is None and got[3][2] == "unresolved"


def test_jump_correction_matches_a_loop(spark):
    r = random.Random(1)
    v = [r.choice([20.0, 25.0, 100.0, None, 60.0]) for _ in range(200)]
    m = [r.choice(["original", "model"]) for _ in v]
    x = spark.createDataFrame([("a", k, a, b) for k, (a, b) in enumerate(zip(v, m, strict=True))], "sensor_id string, slot long, value double, imputation_method string")
    flagged = fill.jump_flags(x, {"value": 30.0})
    far = lambda a, b: a is not None and b is not None and abs(a - b) > 30
    flags = [m[k] != "original" and (far(v[k], v[k - 1] if k else None) or far(v[k], v[k + 1] if k + 1 < len(v) else None)) for k in range(len(v))]
    assert [f for (f,) in by_slot(flagged, "jump_value")] == flags
    want = list(v)
    for k in range(len(v)):
        near = [want[j] for j in (k - 1, k + 1) if 0 <= j < len(v) and want[j] is not None]
        if flags[k] and near:
            want[k] = 0.6 * want[k] + 0.4 * sum(near) / len(near)
    got = [a for (a,) in by_slot(fill.correct_jumps(flagged, ["value"]), "value")]
    assert got == [pytest.approx(w) if w is not None else None for w in want]


def test_medium_fill_matches_a_loop(spark):
    r = random.Random(2)
    v, gone = [100 + 10 * np.sin(k / 9) + r.random() for k in range(400)], set()
    blocks = ((200, 3), (205, 5), (250, 2), (253, 2), (300, 4))
    for start, size in blocks:
        gone |= set(range(start, start + size))
    v = [None if k in gone else x for k, x in enumerate(v)]
    near = [None if k == 206 else 50 + np.cos(k / 5) for k in range(400)]
    x = tracked(spark, v).join(spark.createDataFrame(list(enumerate(map(lambda n: None if n is None else float(n), near))), "slot long, value_n1 double"), "slot").withColumn("value_n2", F.lit(None).cast("double"))
    more, p = ("value_n1", "value_n2"), replace(PRODUCTION, continuous=("value",))
    for kind in ("xgb", "knn"):
        rows = models.all_features(x, ["value"], 5, more)
        fitted = models.fit_models(rows, spark.createDataFrame([("value", kind)], "var string, kind string"), p, more, rounds=8).persist()
        got = {s.slot: s.filled for s in models.fill_medium(x, fitted, 5, p, ["value"], more).collect()}
        m = fitted.collect()[0]
        assert m.used == [*models.FEATURES, "value_n1"]  # the second neighbour is never there
        model = trees.from_bytes(m.model)
        feats = rows.toPandas().sort_values("slot")
        good = feats.dropna(subset=[*m.used, "y"])
        assert m.n == len(good) and m.medians == pytest.approx(good[m.used].median().tolist())
        clock = feats.set_index("slot")[["hour", "day_of_week", "month"]]
        work = [np.nan if a is None else a for a in v]
        for start, size in sorted(blocks, key=lambda b: (-b[1], b[0])):
            for k in range(start, start + size):
                last = [w for w in work[k - 6 : k] if not np.isnan(w)]
                f = [*clock.loc[k], work[k - 1], work[k - 2], work[k - 3], np.mean(last) if last else np.nan, np.std(last) if last else np.nan, np.nan if near[k] is None else near[k]]
                f = [m.medians[i] if np.isnan(a) else a for i, a in enumerate(f)]
                work[k] = float(model.predict(np.array([f]))[0])
        assert got.keys() == gone
        assert all(got[k] == pytest.approx(work[k], abs=1e-6) for k in gone)


def test_trees_split_as_brute_force_does():
    g = np.random.default_rng(3)
    x, y = g.integers(0, 20, (300, 3)).astype(float), g.normal(size=300)
    y += 3 * (x[:, 1] > 11)
    t = trees.fit_trees(x, y, trees.Setting(rounds=1, depth=1, rate=1.0, rows=1.0, columns=1.0, penalty=0.0))
    sse = lambda m: ((y[m] - y[m].mean()) ** 2).sum() if m.any() else 0.0
    best = min((sse(x[:, f] <= c) + sse(x[:, f] > c), f, c) for f in range(3) for c in range(19))
    assert (t.feature[0, 0], t.threshold[0, 0]) == (best[1], best[2])
    assert ((t.predict(x) - y) ** 2).sum() == pytest.approx(best[0], rel=1e-5)
    for kind in ("xgb", "lgbm", "rf"):
        m = trees.fit(kind, x, y, rounds=20)
        again = trees.from_bytes(trees.to_bytes(m))
        assert (m.predict(x) == again.predict(x)).all() and ((m.predict(x) - y) ** 2).sum() < ((y - y.mean()) ** 2).sum()
        for i in range(5):  # a walk from node to node
            total = m.base
            for feature, threshold, value in zip(m.feature, m.threshold, m.value, strict=True):
                at = 0
                for _ in range(m.depth):
                    at = 2 * at + 1 + int(np.float32(x[i, feature[at]]) > threshold[at])
                total += value[at]
            assert total == pytest.approx(m.predict(x[i : i + 1])[0], rel=1e-5)


def test_nearest_rows_with_ties():
    x, y = np.array([[0.0], [1.0], [1.0], [1.0], [5.0]]), np.arange(5.0)
    assert trees.Nearest(x, y, 2).predict(np.array([[1.0], [0.4]])).tolist() == [1.5, 0.5]
    assert trees.Nearest(x[:1], y[:1]).predict(np.array([[9.0]])).tolist() == [0.0]


def test_long_gap_between_anchors(spark):
    n = None
    x = tracked(spark, [10.0, *[n] * 6, 20.0]).withColumn("k", F.lit(None).cast("double"))
    near = spark.createDataFrame([("a", r, float(r), k, 5.0 if r == 1 else 5.0 + k, None) for r in (1, 2) for k in range(8)], "sensor_id string, rank int, dist_km double, slot long, value double, k double")
    rely = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 1.0)], "sensor_id string, rank int, reliability double")
    for p in (PRODUCTION, RESEARCH):
        out = fill.apply_long(x, fill.long_gap_values(x, near, rely, p), p)
        got = by_slot(out, "value", "imputation_method", "confidence_level")
        assert got[3] == (pytest.approx(10 + 10 * 3 / 7), "neighbor", "Medium")
    zero = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 0.0)], "sensor_id string, rank int, reliability double")
    floor = replace(PRODUCTION, clip={"value": (7.0, 60.0)})
    assert by_slot(fill.apply_long(x, fill.long_gap_values(x, near, zero, floor), floor), "value")[3] == (7.0,)
    assert by_slot(fill.apply_long(x, fill.long_gap_values(x, near, zero, RESEARCH), RESEARCH), "value", "imputation_method")[3] == (None, "unresolved")


def test_rain_rules(spark):
    v = [None if 100 <= k <= 111 else 0.0 for k in range(300)]
    x = tracked(spark, v).withColumn("r", F.col("value")).withColumn("value", F.lit(1.0))
    got = [a for (a,) in by_slot(fill.rain_zero(x, ["r"], [], True, "value"), "r")]
    assert [k for k in range(300) if got[k] is None] == list(range(103, 109))
    assert None not in [a for (a,) in by_slot(fill.rain_zero(x, ["r"], [], False), "r")]


def test_upsert_keeps_real_rows_and_replaces_fills(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, 1.0, None), ("a", 2, 2.0, 1)], "sensor_id string, slot long, value double, filled_flag int")
    new = spark.createDataFrame([("a", 1, 9.0, 1), ("a", 2, 9.0, 1), ("a", 3, 9.0, 1)], old.schema)
    table, outcome = state.upsert(old, new, ["sensor_id", "slot"])
    assert by_slot(table, "value") == [(1.0,), (9.0,), (9.0,)]
    assert by_slot(outcome, "outcome") == [("skipped_existing",), ("written",), ("written",)]
    path = str(tmp_path / "t")
    for rows in (old, new, new):
        state.upsert_into(path, rows, ["sensor_id", "slot"])
    assert by_slot(spark.read.parquet(path), "value") == [(1.0,), (9.0,), (9.0,)]


def test_metrics_and_sample(spark):
    x = spark.createDataFrame([("a", float(k), float(k) + 1) for k in range(6)] + [("b", 1.0, 2.0)] * 6 + [("c", 1.0, 1.0)], "s string, y double, predicted double")
    got = {r.s: r for r in evaluate.metrics(x, ["s"]).collect()}
    assert set(got) == {"a", "b"} and got["a"].mae == 1 and got["a"].bias == 1 and got["b"].r2 is None


def test_csv_reader_and_chart(spark, tmp_path):
    (tmp_path / "s1.csv").write_text("TimeStamp,CurrentTemperature\n2023-01-05 00:00:00,1.5\nnot_a_date,2\n2031-01-01 00:00:00,3\n2023-01-05 00:05:00,null\n2023-01-05T00:10:00.5Z,4\n2023-01-06,5\n")
    got = readers.observations_csv(spark, str(tmp_path), ["CurrentTemperature", "AtmPressure"]).orderBy("ts").collect()
    assert [(r.sensor_id, r.CurrentTemperature, r.AtmPressure) for r in got] == [("s1", 1.5, None), ("s1", None, None), ("s1", 4.0, None), ("s1", 5.0, None)]
    assert readers.mae_chart([]).startswith("<svg") and "polyline" in readers.mae_chart([("t", 1, 0.5), ("t", 3, 1.0)])


def test_config(monkeypatch):
    monkeypatch.setenv("FLAG", "Yes")
    assert from_env("FLAG", kind=bool) is True and from_env("N", "4", int) == 4
    with pytest.raises(ValueError):
        from_env("ABSENT_SETTING")
    with pytest.raises(ValueError):
        check_neighbours([1], [], [])
    with pytest.raises(ValueError):
        neighbors.batches(None, None, 0)


def test_statuses(spark):
    latest = spark.createDataFrame([("a", 5), ("b", 5), ("c", None), ("d", 9)], "sensor_id string, latest_ts int")
    marks = spark.createDataFrame([("a", 5), ("b", 4), ("d", 1)], "sensor_id string, last_ts int")
    work = spark.createDataFrame([("b", True), ("d", False)], "sensor_id string, has_work boolean")
    assert {r.sensor_id: r.status for r in state.statuses(latest, marks, work).collect()} == {"a": "skipped_no_new_data", "b": "ok", "c": "no_data", "d": "skipped_no_gaps"}


START = dt.datetime(2026, 9, 1)
GONE = {100, 200, 201, 202, *range(400, 412)}
SCHEMA = "sensor_id string, ts timestamp_ntz, arrival long, value double, k double, imputation_method string, filled_flag int, unit string"


def network(spark, dark=(), extra=()):
    """Three sensors on 864 slots of 5 minutes; the first lacks GONE, its neighbours the slots ``dark``."""
    rows = list(extra)
    for s, phase in (("216", 0.0), ("217", 0.1), ("218", 0.2)):
        for k in range(864):
            if k not in (GONE if s == "216" else dark):
                rows.append((s, START + dt.timedelta(minutes=5 * k), k, 100 + 20 * float(np.sin(k / 30 + phase)), 50.0, None, None, s))
    topo = spark.createDataFrame([("216", "217", 1, 5.0), ("216", "218", 2, 8.0)], "target_id string, neighbor_id string, rank int, dist_km double")
    return spark.createDataFrame(rows, SCHEMA), topo


def methods(df):
    return {r.imputation_method: r["count"] for r in df.where("sensor_id = '216'").groupBy("imputation_method").count().collect()}


def test_three_classes_end_to_end(spark):
    obs, topo = network(spark)
    done = run(obs, topo, profile=replace(PRODUCTION, rain=()))
    out = done.frame.persist()
    assert methods(out) == {"original": 848, "interpolation": 1, "model": 3, "neighbor": 12}
    truth = {k: 100 + 20 * np.sin(k / 30) for k in GONE}
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp() // 300)
    assert all(abs(r.value - truth[r.slot - base]) < 8 for r in out.where("filled_flag = 1").collect())
    kinds = {(r["sensor_id"], r["var"]): (r["kind"], len(r["used"])) for r in done.models.collect()}
    assert kinds == {("216", "value"): ("xgb", 10), ("216", "k"): ("rf", 10)}  # both neighbours are read
    fixed = reconstruct(obs, topo, 5).where("sensor_id = '216'")
    assert sorted(map(tuple, fixed.collect())) == sorted(map(tuple, out.where("sensor_id = '216'").collect()))
    assert prepare(obs, 5)[0].count() == obs.count()


def test_dark_neighbours_leave_the_long_gap(spark):
    obs, topo = network(spark, dark=range(395, 415))
    assert methods(reconstruct(obs, topo)) == {"original": 848, "interpolation": 1, "model": 3, "unresolved": 12}


def test_earlier_fills_and_other_units_do_not_count(spark):
    old = [("216", START + dt.timedelta(minutes=5 * k + 1), 9000 + k, 1.0, 1.0, "model", 1, "216") for k in (100, 200, 405)]
    old += [("216", START + dt.timedelta(minutes=5 * k), 9500 + k, 500.0, 1.0, None, None, "other") for k in range(400, 405)]
    obs, topo = network(spark, extra=old)
    out = run(obs, topo, unit="unit").frame
    assert methods(out) == {"original": 848, "interpolation": 1, "model": 3, "neighbor": 12}


def test_tournament_profile_and_stored_models(spark, tmp_path):
    obs, topo = network(spark)
    first = run(obs, topo, 5, replace(PRODUCTION, tournament=True, models=("xgb", "lgbm", "rf", "knn")), rounds=4)
    assert {(r["sensor_id"], r["var"]) for r in first.models.collect()} == {("216", "value"), ("216", "k")}
    path = str(tmp_path / "store")
    assert models.load_models(spark, path) is None
    models.save_models(first.models, path)
    again = run(obs, topo, 5, fitted=models.load_models(spark, path))
    assert sorted(map(tuple, again.frame.collect())) == sorted(map(tuple, first.frame.collect()))
    assert all(r["line"].startswith(("value -> ", "k -> ")) for r in models.mapping_lines(first.models).collect())


def test_the_plan_is_not_copied(spark):
    obs, topo = network(spark)
    plan = reconstruct(obs, topo, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMap") == 0 and plan.count("Relation [") < 6  # the fills are behind written tables
    fill_plan = models.fill_medium(prepare(obs, 5)[1], spark.createDataFrame([], models.MODEL), 5, PRODUCTION, ["value", "k"])._jdf.queryExecution().optimizedPlan().toString()
    assert fill_plan.count("FlatMapCoGroups") == 1


def test_batch_over_sensors(spark):
    obs, topo = network(spark)
    empty = spark.createDataFrame([], "sensor_id string, last_ts timestamp_ntz")
    keys = batch.discover(topo, keys=["216#WS/a", "217#WS/b", "999#x", "216#WS/a"])
    done = batch.run_batch(keys, obs.drop("unit"), topo, empty)
    said = {r.sensor_id: r for r in done.results.collect()}
    assert {k: r.status for k, r in said.items()} == {"216": "ok", "217": "skipped_no_gaps", "999": "no_data"}
    assert (said["216"].filled, said["216"].unresolved, said["216"].skipped_existing, said["216"].rows, said["216"].interval_min) == (16, 0, 0, 864, 5.0)
    assert done.table.where("sensor_id = '216'").count() == 864
    one = batch.summary(done.results).first()
    assert (one.sensors, one.reconstructed, one.ok, one.no_data, one.filled) == (3, 1, 1, 1, 16) and batch.exit_code(done.results) == 0
    marks = done.watermarks.persist()
    assert {r.sensor_id: r.filled for r in marks.collect()} == {"216": 16, "217": 0}
    table = done.table.withColumn("arrival", F.xxhash64("ts")).persist()
    again = batch.run_batch(keys, table, topo, marks)
    assert {r.sensor_id: r.status for r in again.results.collect()} == {"216": "skipped_no_new_data", "217": "skipped_no_new_data", "999": "no_data"}
    late = table.unionByName(spark.createDataFrame([("216", START + dt.timedelta(minutes=5 * 401, seconds=20), 1.0, 2.0), ("216", START + dt.timedelta(minutes=5 * 864), 100.0, 50.0)], "sensor_id string, ts timestamp_ntz, value double, k double"), allowMissingColumns=True).withColumn("arrival", F.xxhash64("ts"))
    third = batch.run_batch(keys, late, topo, marks)
    assert third.results.where("sensor_id = '216'").first().status == "ok"
    kept = third.table.where("sensor_id = '216' AND value = 1.0 AND filled_flag IS NULL").count()
    assert kept == 1  # the late reading stays
    code, _ = batch.run_sensor(None, obs, topo)
    assert code == 2 and batch.run_sensor("999#x", obs.drop("unit"), topo)[0] == 1 and batch.run_sensor("216", obs.drop("unit"), topo)[0] == 0


def test_features_of_hidden_blocks():
    v = np.array([1.0, 2.0, np.nan, 4.0, 5.0, 7.0])
    known = np.array([1.0, 2.0, 2.0, 4.0, 5.0, 7.0])
    assert evaluate.lags(known[None], 0)[0].tolist() == pytest.approx([7, 5, 4, known.mean(), known.std(ddof=1)])
    seen = np.array([2.0, 4.0, 5.0, 7.0, 7.0, 7.0])
    assert evaluate.lags(known[None], 2)[0].tolist() == pytest.approx([7, 7, 7, seen.mean(), seen.std(ddof=1)])
    assert np.isnan(evaluate.lags(np.array([[np.nan] * 4 + [1.0, 2.0]]), 0)[0][3:]).all() and v[0] == 1


def test_synthetic_evaluation_hides_the_truth(spark):
    obs, topo = network(spark)
    done = reconstruct(obs, topo, 5).where("sensor_id = '216'").persist()
    gaps = evaluate.blocks(done, (1, 3), n=20).persist()
    p = replace(PRODUCTION, continuous=("value",), jump={"value": 3.0})
    pairs = evaluate.synthetic(done, gaps, spark.createDataFrame([("value", "knn")], "var string, kind string"), 5, p).collect()
    truth = {r.slot: r.value for r in done.collect()}
    starts = {(r.size, r.start + j) for r in gaps.collect() for j in range(r.size)}
    assert {(r.size, r.slot) for r in pairs} == starts and len(gaps.collect()) == 40
    assert all(r.y == truth[r.slot] for r in pairs)
    first = {(r.size, r.start + j): (truth[r.start - 1], truth[r.start + r.size]) for r in gaps.collect() for j in range(r.size)}
    assert all(min(first[r.size, r.slot]) - 3 <= r.predicted <= max(first[r.size, r.slot]) + 3 for r in pairs)


def test_interpolation_takes_time_in_proportion(spark):
    import time

    def seconds(n):
        x = spark.range(n).selectExpr("'a' sensor_id", "id slot", "case when id % 3 <> 1 then cast(id as double) end value", "case when id = 0 or id = {0} then 1.0D end k".format(n - 1))
        x = grid.track(grid.classify(x, "value"))
        began = time.time()
        fill.interpolate_isolated(x, "value", ["value", "k"]).write.format("noop").mode("overwrite").save()
        return time.time() - began

    seconds(1000)
    assert seconds(160_000) < 4 * seconds(80_000) + 2


def test_reports_and_dump(spark, tmp_path):
    x = tracked(spark, [1, None, 3])
    paths = batch.save_reports(str(tmp_path), grid.gap_report(x), state.audit(x, ["value"]), x.limit(1))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["gap_report", "audit_report", "neighbor_quality"]
    assert batch.dump(x, str(tmp_path), "2026-01-01", on=False) is None
    assert spark.read.parquet(batch.dump(x, str(tmp_path), "2026-01-01")).count() == 3


def test_topology_from_coordinates(spark, tmp_path):
    (tmp_path / "c.csv").write_text("device_id,latitude,longitude\na,10,10\nb,10.05,10\nc,10.2,10\nd,60,0\ne,x,1\n")
    got = {r.device_id: [(n.id, n.distance_km) for n in r.neighbors or ()] for r in batch.topology_from_coordinates(spark, str(tmp_path / "c.csv")).collect()}
    assert [n for n, _ in got["a"]] == ["b", "c"] and got["d"] == [] and got["a"][0][1] == pytest.approx(5.56, abs=0.01)


def test_stream_upserts_by_shard(spark, tmp_path):
    obs, topo = network(spark)
    path = str(tmp_path / "in")
    obs.write.parquet(path)
    small = replace(PRODUCTION, continuous=("value",), jump={"value": 40.0}, neighbour_features=())
    handler = stream.on_batch(lambda touched: obs.drop("unit"), topo, str(tmp_path / "out"), 5, small)
    for k in range(2):
        source = spark.readStream.schema(obs.schema).parquet(path)
        stream.start(spark, source, handler, str(tmp_path / f"check{k}")).awaitTermination()
        out = spark.read.parquet(str(tmp_path / "out"))
        assert out.count() == 16 and out.select("shard").distinct().count() == 1


def test_units_and_window(spark):
    x = spark.createDataFrame([("a", "u1", 1.0), ("a", "u2", 1.0), ("a", "u2", 2.0), ("a", None, 2.0), ("b", None, None)], "sensor_id string, unit string, value double")
    assert sorted((r.sensor_id, r.unit) for r in ingest.pick_unit(x, "value").collect()) == [("a", "u2"), ("a", "u2"), ("b", None)]
