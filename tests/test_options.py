"""Solver, expression model, pruning, VARIANT scalars, bucketed table, sketches and publishing."""
import math
import threading

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cellwatch import config as C
from cellwatch import queries as Q
from cellwatch.operators import extract as X
from cellwatch.operators import model as MD
from cellwatch.operators import newton as N
from cellwatch.operators import prune as P
from cellwatch.operators import ranking as R
from cellwatch.operators import sketches as SK
from cellwatch.plans import chain, fleet, observed, risk
from cellwatch.sources import models as MS
from cellwatch.sources import tables as T

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def hourly(spark):
    return Q._hourly(spark, SF)


@pytest.fixture(scope="module")
def daily(hourly):
    return risk.materialized_daily(hourly)


@pytest.fixture(scope="module")
def trained(daily):
    res = risk.train_from_daily(daily)
    yield res
    res.release()


# --- the solver (M6) -----------------------------------------------------------------

def solved(x, y, w, c=1.0):
    xa, b = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    pen = np.r_[np.full(x.shape[1], 1 / c), 0.0]
    for _ in range(200):
        p = 1 / (1 + np.exp(-xa @ b))
        h = xa.T @ (xa * (w * p * (1 - p))[:, None]) + np.diag(pen)
        step = np.linalg.lstsq(h, xa.T @ (w * (p - y)) + pen * b, rcond=None)[0]
        b -= step / max(1.0, np.abs(step).max())
    return b


@pytest.mark.parametrize("case", ["plain", "separable", "rare", "constant feature", "large values"])
def test_newton_reaches_the_minimum(spark, case):
    rng = np.random.default_rng(3)
    n = 400
    x = rng.standard_normal((n, 3)) * (40 if case == "large values" else 1)
    if case == "constant feature":
        x[:, 2] = 0.0
    z = x @ [1.5, -2, 0.5] - (4 if case == "rare" else 0)
    y = (z > 0).astype(float) if case == "separable" else (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)
    w = rng.random(n) + 0.5
    rows = spark.createDataFrame([(*map(float, r), float(a), float(v)) for r, a, v in zip(x, y, w)],
                                 "a double, b double, c double, y double, w double")
    fit = N.minimise(rows, ["a", "b", "c"])
    assert fit.converged and fit.passes < 25
    assert np.allclose(fit.coefficients, solved(x, y, w), atol=1e-6)


def test_steps_that_go_too_far_are_halved(spark):
    """Two far rows of each kind: a full first step raises the objective."""
    rows = [(30.0, 1.0, 1.0), (-30.0, 0.0, 1.0), (0.1, 0.0, 1.0), (900.0, 1.0, 1.0), (-1.0, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, y double, w double")
    fit = N.minimise(df, ["a"], c_inverse=1e6)
    a = np.array(rows)
    assert fit.converged and np.allclose(fit.coefficients, solved(a[:, :1], a[:, 1], a[:, 2], 1e6), atol=1e-5)


def test_extreme_log_odds_do_not_overflow(spark):
    df = spark.createDataFrame([(-5000.0,), (0.0,), (5000.0,)], "z double")
    assert [r[0] for r in df.select(N.sigmoid(F.col("z"))).collect()] == [0.0, 0.5, 1.0]


# --- the model as one expression (M7) ----------------------------------------------------

def test_expression_equals_the_stages(spark, daily, trained, tmp_path):
    odd = daily.withColumns({"fw_version_type": F.when(F.col("session_id") == 0, F.lit("never seen"))
                             .otherwise(F.col("fw_version_type")),
                             "volt_mean": F.when(F.col("session_id") % 2 == 0, F.lit(float("nan")))
                             .otherwise(F.col("volt_mean")),
                             "probability": F.lit("mine")})
    path = MS.save_model(trained.model, str(tmp_path / "m"))
    again = MS.load_model(path)
    scored = MD.predict(again, odd).select(*C.DAILY_KEYS, "risk_prob", "probability")
    staged = trained.model.transform(odd.drop("probability")).select(*C.DAILY_KEYS, F.col("probability").alias("p"))
    diff = scored.join(staged, C.DAILY_KEYS)
    assert diff.count() == daily.count()
    assert diff.where(~F.col("risk_prob").eqNullSafe(F.col("p"))).count() == 0
    assert diff.where("probability <> 'mine' OR risk_prob IS NULL OR risk_prob NOT BETWEEN 0 AND 1").count() == 0
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_both_solvers_score_alike(daily, trained):
    lbfgs = risk.train_from_daily(daily, solver="lbfgs")
    lbfgs.release()
    both = MD.predict(lbfgs.model, MD.predict(trained.model, daily), "other")
    assert both.select(F.max(F.abs(F.col("risk_prob") - F.col("other")))).first()[0] < 1e-6
    a, b = (MD.coefficients(m.model).orderBy("feature").collect() for m in (trained, lbfgs))
    assert [r["feature"] for r in a] == [r["feature"] for r in b]
    with pytest.raises(ValueError):
        MD.build_pipeline(10, solver="guess")


# --- pruned history (S2, W2) ---------------------------------------------------------------

EVENTS = "events_id string, rent string, bloq string, timestamp string, pipeline_ingested_at timestamp, ingest_seq long"


def old_and_new(spark, n=4000):
    """Events of which a tenth has a version in February, a hot id and null ids."""
    from datetime import datetime
    rows = []
    for i in range(n):
        month = 2 if i % 10 == 0 else 1
        rows.append((f"e{i}", f"r{i % 7}", f"b{i % 5}", f"2024-{month:02d}-03T{i % 24:02d}:00:00Z", datetime(2024, 1, 1), i))
        if i % 30 == 0:            # a later version that is old again: this id has no rent in February
            rows.append((f"e{i}", f"r{i % 7}", f"b{i % 5}", "2024-01-05T00:00:00Z", datetime(2024, 3, 1), i))
    rows += [("hot", f"r{i}", "b1", f"2024-02-0{1 + i % 9}T05:00:00Z", datetime(2024, 1, 2), i) for i in range(n // 2)]
    rows += [(None, "r1", "b2", "2024-02-03T01:00:00Z", datetime(2024, 1, 2), 1), ("z", "r", "b3", "bad", datetime(2024, 1, 2), 1)]
    return spark.createDataFrame(rows, EVENTS).repartition(6)


@pytest.mark.parametrize("bits", [7, 23])
def test_pruned_events_give_the_same_rents(spark, monkeypatch, bits):
    events, since = old_and_new(spark), F.lit("2024-02-01").cast("timestamp_ntz")
    real = P.maybe_recent
    monkeypatch.setattr(X, "maybe_recent", lambda df, key, wanted: real(df, key, wanted, bits))
    plain = sorted(map(tuple, X.rents_per_hour(events, since).collect()))
    pruned = X.rents_per_hour(events, since, prune=True)
    assert sorted(map(tuple, pruned.collect())) == plain and plain
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2                        # before the shuffle and after it
    kept = real(events, "events_id", X.S.iso_hour("timestamp") >= since, bits).count()
    needed = events.join(events.where(X.S.iso_hour("timestamp") >= since).select("events_id").distinct(), "events_id").count() + 1
    assert needed <= kept and (bits == 7 or kept <= needed + 20)


def test_filter_size_is_bounded(spark):
    with pytest.raises(ValueError):
        P.key_filter(spark.range(3), "id", bits=P.MAX_BITS + 1)


def test_pruned_extract_shuffles_fewer_rows(spark):
    events = T.raw_events(spark, SF)
    since = F.lit("2024-01-10").cast("timestamp_ntz")
    kept = P.maybe_recent(X.with_device(events), "events_id", X.S.iso_hour("timestamp") >= since).count()
    assert kept < 0.8 * X.with_device(events).count()


# --- JSON scalars (F3, F4, K6) ---------------------------------------------------------------

def test_json_scalars(spark):
    cases = [('{"a":"x"}', "x"), ('{"a":12.5}', "12.5"), ('{"a":7}', "7"), ('{"a":true}', "true"), ('{"a":null}', None),
             ('{"a":{"b":1}}', None), ('{"a":[1]}', None), ('{"a":[]}', None), ('{"a":""}', ""), ("{}", None), ("[1]", None),
             ("{broken", None), ("", None), (None, None), ('{"a":"{\\"b\\":1}"}', '{"b":1}'), ('{"a":"[]"}', "[]")]
    df = spark.createDataFrame([(i, j) for i, (j, _) in enumerate(cases)], "i int, j string")
    got = df.select("i", X.json_scalar(F.try_parse_json("j"), "$.a").alias("v")).orderBy("i").collect()
    assert [r["v"] for r in got] == [v for _, v in cases]


def test_battery_lists(spark):
    bat = '{"batteryName":"BAT1","capacityStateOffCharge":"80","extraInfo":{"battery_serial_number":{"no":1}}}'
    quoted = bat.replace('"', '\\"')
    docs = {"text": f'{{"battery":"[{quoted}, 5, null, [1]]"}}', "real": f'{{"battery":[{bat}]}}', "cut": '{"battery":"[bat1"}',
            "object": f'{{"battery":{bat}}}', "text object": f'{{"battery":"{quoted}"}}', "none": "{}", "null": '{"battery":null}',
            "empty": '{"battery":"[]"}', "not json": "bat1"}
    rows = [Row(snapshot_id=i, bloqs_id=k, metadata='{"bloqitName":["x"]}', details='{"country":{"c":1},"address":5}',
                firmwaredetails=v, hour_bucket="h") for i, (k, v) in enumerate(docs.items())]
    df = spark.createDataFrame(rows)
    found = {r["bloqs_id"]: r for r in X.battery_readings(df).collect()}
    assert set(found) == {"text", "real"}
    one = found["text"]
    assert (one["battery_name"], one["soc"], one["battery_serial_number"]) == ("BAT1", 80.0, None)
    assert (one["bloq_name"], one["country"], one["address"]) == (None, None, "5")
    assert {r["bloqs_id"] for r in X.battery_readings(df, strict=True).collect()} == {"text"}
    bad = X.parse_documents(df).where(X.malformed_list(F.col("_fw"))).select("bloqs_id").collect()
    assert {r[0] for r in bad} == {"cut", "object", "text object"} or {r[0] for r in bad} == {"cut", "object", "text object", "null"}


def test_observed_extract_counts(spark):
    given = observed.extract(T.snapshots(spark, SF), T.raw_events(spark, SF), C.FLEET_AS_OF)
    plain = fleet.fleet_extract(T.snapshots(spark, SF), T.raw_events(spark, SF), C.FLEET_AS_OF)
    assert given.rows_before == plain.count() == given.table.count()
    assert given.malformed_lists and given.snapshots > given.malformed_lists
    empty = observed.readings(plain.limit(0))
    assert (empty.rows_before, empty.rows_after, empty.data_end) == (0, 0, None)
    assert chain.daily_features(empty.table, empty.data_end).count() == 0


# --- the bucketed table (S1) -------------------------------------------------------------------

def test_bucketed_table_needs_no_exchange(spark, hourly, tmp_path):
    table = T.save_hourly(hourly, "hourly_bucketed_test", 4, str(tmp_path / "t"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = chain.labelled(T.load(spark, "hourly_bucketed_test"))._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
        flat = chain.labelled(hourly)._jdf.queryExecution().executedPlan().toString()
        assert flat.count("Exchange hashpartitioning") == 1
        day = table.where("day = DATE '2024-01-12'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in day
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        a, b = (chain.labelled(x).select(*C.DAILY_KEYS, "y_risk", "future_min_soc") for x in (table, hourly))
        assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("DROP TABLE IF EXISTS hourly_bucketed_test")


# --- sketches (A12) ----------------------------------------------------------------------------

@pytest.mark.parametrize("k", [200, 4096])
def test_sketched_quantiles_stay_within_their_error(spark, k):
    n = 200_000
    df = spark.range(n).select(F.expr("cast(id % 17 as int)").alias("day"), F.when(F.col("id") % 50 == 0, None).when(
        F.col("id") % 51 == 0, float("nan")).otherwise(F.pow(F.rand(4), 3) * 100).alias("v"), F.lit(3.0).alias("same"))
    df = C.materialize(df, "sketch-test")
    probs = [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]
    days = SK.sketch_by(df, ["day"], ["v", "same"], k)
    assert days.count() == 34
    values = np.sort(np.array([r[0] for r in df.select("v").where("v IS NOT NULL AND NOT isnan(v)").collect()]))
    got = {(r["feature"], r["prob"]): r for r in SK.merged_quantiles(days, [], probs).collect()}
    for p in probs:
        r = got["v", p]
        assert r["n"] == len(values) and got["same", p]["value"] == 3.0
        lo, hi = (np.searchsorted(values, r["value"], s) / len(values) for s in ("left", "right"))
        assert lo - SK.rank_error(k) <= p <= hi + SK.rank_error(k)
    few = SK.merged_quantiles(days.where("day < 0"), [], probs)
    assert few.count() == 0


def test_small_spans_are_exact(spark):
    df = spark.createDataFrame([(d, float(v)) for d in range(3) for v in range(d, 50, 7)], "day int, v double")
    values = sorted(r["v"] for r in df.collect())
    for r in SK.merged_quantiles(SK.sketch_by(df, ["day"], ["v"]), [], [0.05, 0.5, 0.9, 1.0]).collect():
        assert r["value"] == values[max(1, math.ceil(r["prob"] * len(values))) - 1]


# --- publishing (S9, S10) ------------------------------------------------------------------------

def test_a_scorer_never_meets_half_a_model(spark, trained, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        MS.load_model(f"{folder}/{MS.MODEL_NAME}")
    path = MS.publish_model(trained.model, folder)
    done, errors, seen = threading.Event(), [], []

    def load():
        from pyspark.sql import SparkSession
        SparkSession.builder.getOrCreate()
        while not done.is_set():
            try:
                seen.append(MD.fitted_numbers(MS.load_model(path)))
            except Exception as ex:           # noqa: BLE001
                errors.append(ex)
                return

    reader = threading.Thread(target=load)
    reader.start()
    for _ in range(4):
        assert MS.publish_model(trained.model, folder, keep=3) == path
    done.set()
    reader.join(60)
    assert not errors and seen and all(s == MD.fitted_numbers(trained.model) for s in seen)
    versions = MS.published_versions(spark, path)
    assert len(versions) == 3 and versions == sorted(versions)
    # A version without its mark is not there yet.
    trained.model.save(f"{path}/versions/99999999999999999999-half")
    assert MS.published_versions(spark, path) == versions


# --- places (O1, O3) ----------------------------------------------------------------------------

def test_positions_in_a_global_order(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("g"))
    got = R.positions(df, [F.desc("g"), F.asc("id")]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 1001))
    assert [(r["g"], r["id"]) for r in got] == sorted(((r["g"], r["id"]) for r in got), key=lambda x: (-x[0], x[1]))
    assert R.positions(df.limit(0), [F.asc("id")]).count() == 0
