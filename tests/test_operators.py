"""Hand-written edge cases (FIXTURES.md §3) and cross-checks against independent pandas code."""
import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cellwatch.functions import scalar as S
from cellwatch.operators import clean as CL
from cellwatch.operators import extract as X
from cellwatch.operators import features as FE
from cellwatch.operators import labels as LB
from cellwatch.operators import metrics as ME
from cellwatch.operators import sessions as SE
from cellwatch.operators.quantiles import exact_quantiles
from cellwatch.plans import risk

T0 = datetime(2024, 1, 10)


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_iso_hour_keeps_wall_clock(spark):
    df = one_col(spark, ["2024-01-10T10:30:00Z", "2024-01-10T10:30:00+02:00",
                         "2024-01-10T10:59:59+05:30", "junk"])
    got = [r[0] for r in df.select(S.iso_hour("x")).collect()]
    assert got == [datetime(2024, 1, 10, 10)] * 3 + [None]


def test_partner_from_name(spark):
    df = one_col(spark, [None, "ABCDE", "ABCDEF", "Partner3 0001"])
    assert [r[0] for r in df.select(S.partner_from_name("x")).collect()] == [None, "ABCDE", "A", "Partner3"]


def test_firmware_class(spark):
    vals = [None, "7.1.1", "7.1.2", "7.1.0", "7.1.10", "7.2.0", "7x1.3"]
    got = [r[0] for r in one_col(spark, vals).select(S.firmware_class("x")).collect()]
    assert got == ["old", "old", "old", "recent", "recent", "old", "old"]


def test_clean_serial(spark):
    vals = ["", " ", "N/A", " nan ", "None", "n/a", " SN-1 ", None]
    got = [r[0] for r in one_col(spark, vals).select(S.clean_serial("x")).collect()]
    assert got == [None, None, None, None, None, "n/a", "SN-1", None]


def test_voltage_band_and_flags(spark):
    df = one_col(spark, [12.69, 12.7, 12.9, 12.91, None], "double")
    assert [r[0] for r in df.select(S.voltage_band("x")).collect()] == \
        ["Warning", "Early Warning", "Early Warning", "OK", "OK"]
    df = one_col(spark, [0.8, 0.7999, None, float("nan")], "double")
    assert [r[0] for r in df.select(S.flag_at_least("x", 0.8)).collect()] == [1, 0, 0, 0]
    assert [r[0] for r in df.select(S.flag_below("x", 0.8)).collect()] == [0, 1, 0, 0]


def test_filename_datetime(spark):
    df = one_col(spark, ["202602181520_battery.csv", "20260421_deploy.csv", "deploy.csv"])
    got = [r[0] for r in df.select(S.filename_datetime("x")).collect()]
    assert got == [datetime(2026, 2, 18, 15, 20), datetime(2026, 4, 21), None]


def hourly_rows(spark, rows):
    """rows: (bloq, battery, hours_after_T0, serial, soc, voltage, rents)"""
    data = [Row(hour_bucket=T0 + timedelta(hours=h), bloqs_id=b, battery_name=n,
                battery_serial_number=s, soc=soc, voltage=str(v) if v is not None else None,
                temperature="20", rents=r, fw_version_type="recent", country="PT",
                address="A", point_code="P", partner="x", bloq_name="x")
            for b, n, h, s, soc, v, r in rows]
    schema = ("hour_bucket timestamp_ntz, bloqs_id string, battery_name string, "
              "battery_serial_number string, soc double, voltage string, temperature string, "
              "rents long, fw_version_type string, country string, address string, "
              "point_code string, partner string, bloq_name string")
    return spark.createDataFrame(data, schema)


def test_clean_drops_bad_readings(spark):
    rows = [("b", "BAT1", 0, "s", 50.0, 12.5, 1), ("b", "BAT1", 1, "s", float("nan"), 12.5, 1),
            ("b", "BAT1", 2, "s", None, 12.5, 1), ("b", "BAT1", 3, "s", 0.0, 12.5, 1),
            ("b", "BAT1", 4, "s", -1.0, 12.5, 1), ("b", "BAT1", 5, "s", 10.0, 0.0, 1),
            ("b", "BAT1", 6, "s", 10.0, None, 1), ("b", "BAT1", 7, "s", 10.0, "NaN", 1)]
    out = CL.clean(hourly_rows(spark, rows))
    assert sorted(r.soc for r in out.collect()) == [0.0, 50.0]


def sessions_of(spark, serials, battery="BAT1", bloq="b"):
    rows = [(bloq, battery, i, s, 50.0, 12.5, 1) for i, s in enumerate(serials)]
    out = SE.assign_sessions(CL.clean(hourly_rows(spark, rows))).orderBy("timestamp").collect()
    return [r.session_id for r in out], [r.battery_serial_number for r in out]


@pytest.mark.parametrize("serials,sessions,filled", [
    ([None, None, "a", "a"], [0, 0, 0, 0], [None, None, "a", "a"]),             # leading nulls
    (["a", None, "a"], [0, 0, 0], ["a", "a", "a"]),                              # a -> null -> a
    (["a", None, "b"], [0, 0, 1], ["a", "a", "b"]),                              # a -> null -> b
    (["a", "b", "a"], [0, 1, 2], ["a", "b", "a"]),                               # three sessions
    (["N/A", "a", " b "], [0, 0, 1], [None, "a", "b"]),                          # K5
])
def test_session_assignment(spark, serials, sessions, filled):
    assert sessions_of(spark, serials) == (sessions, filled)


def test_two_batteries_are_separate(spark):
    rows = [("b", "BAT1", 0, "a", 50.0, 12.5, 1), ("b", "BAT2", 1, "x", 50.0, 12.5, 1),
            ("b", "BAT1", 2, "a", 50.0, 12.5, 1), ("b", "BAT2", 3, "y", 50.0, 12.5, 1)]
    out = SE.assign_sessions(CL.clean(hourly_rows(spark, rows)))
    got = {(r.battery_name, r.session_id) for r in out.collect()}
    assert got == {("BAT1", 0), ("BAT2", 0), ("BAT2", 1)}


def test_days_left_rounding_and_censoring(spark):
    # session a ends at 30h; data end at 100h. Gaps 6, 18, 30 h -> 0.2, 0.8, 1.2 (half to even)
    rows = [("b", "BAT1", 0, "a", 50.0, 12.5, 1), ("b", "BAT1", 12, "a", 50.0, 12.5, 1),
            ("b", "BAT1", 24, "a", 50.0, 12.5, 1), ("b", "BAT1", 30, "a", 50.0, 12.5, 1),
            ("b", "BAT1", 99, "b", 50.0, 12.5, 1), ("c", "BAT1", 100, "z", 50.0, 12.5, 1)]
    out = {(r.bloqs_id, r.timestamp): r for r in
           SE.add_sessions(CL.clean(hourly_rows(spark, rows))).collect()}
    a = [out[("b", T0 + timedelta(hours=h))] for h in (0, 12, 24, 30)]
    assert [r.days_left for r in a] == [1.2, 0.8, 0.2, 0.0]
    assert all(r.is_censored == 0 and r.battery_end_time == T0 + timedelta(hours=30) for r in a)
    late = out[("b", T0 + timedelta(hours=99))]   # ends exactly 1 h before the data end
    assert late.is_censored == 1 and late.battery_end_time is None and late.days_left is None


def test_censor_boundary(spark):
    rows = [("b", "BAT1", 0, "a", 50.0, 12.5, 1), ("c", "BAT1", 2, "z", 50.0, 12.5, 1)]
    df = hourly_rows(spark, rows).withColumn(
        "hour_bucket", F.when(F.col("bloqs_id") == "b", F.col("hour_bucket") + F.expr("INTERVAL 59 MINUTES"))
        .otherwise(F.col("hour_bucket")))
    out = {r.bloqs_id: r for r in SE.add_sessions(CL.clean(df)).collect()}
    assert out["b"].is_censored == 0          # ends 1 h 1 min before the end
    rows = [("b", "BAT1", 1, "a", 50.0, 12.5, 1), ("c", "BAT1", 2, "z", 50.0, 12.5, 1)]
    out = {r.bloqs_id: r for r in SE.add_sessions(CL.clean(hourly_rows(spark, rows))).collect()}
    assert out["b"].is_censored == 1          # ends exactly 1 h before


def test_daily_rollup_first_non_null_and_rents(spark):
    rows = [("b", "BAT1", 0, "a", 50.0, 12.5, None), ("b", "BAT1", 1, "a", 40.0, 12.7, None)]
    df = SE.add_sessions(CL.clean(hourly_rows(spark, rows)))
    df = df.withColumn("country", F.when(F.col("soc") == 50.0, None).otherwise("ES"))
    d = FE.daily_rollup(df).collect()
    assert len(d) == 1
    r = d[0]
    assert r.country == "ES" and r.rents_sum == 0.0 and r.soc_min == 40.0 and r.soc_mean == 45.0
    assert math.isclose(r.volt_mean, 12.6)


def test_daily_rollup_drops_null_battery(spark):
    rows = [("b", None, 0, "a", 50.0, 12.5, 1), ("b", "BAT1", 1, "a", 40.0, 12.7, 1)]
    d = FE.daily_rollup(SE.add_sessions(CL.clean(hourly_rows(spark, rows)))).collect()
    assert [r.battery_name for r in d] == ["BAT1"]


def _pandas_features(series: list[float]) -> pd.DataFrame:
    """Independent reference: pandas rolling windows with numpy polyfit."""
    s = pd.Series(series)

    def slope(y):
        x = np.arange(len(y)) - (len(y) - 1) / 2          # covariance over variance of the places
        return float((x * (y - y.mean())).sum() / (x * x).sum())
    return pd.DataFrame({
        "s3": s.rolling(3, min_periods=2).apply(slope, raw=False),
        "s7": s.rolling(7, min_periods=3).apply(slope, raw=False),
        "v7": s.rolling(7, min_periods=3).std().fillna(0),
    })


@pytest.mark.parametrize("n", [1, 2, 3, 8, 15])
def test_rolling_features_match_pandas(spark, n):
    rng = np.random.default_rng(n)
    vals = (12 + rng.normal(0, 0.3, n)).round(4).tolist()
    rows = [Row(bloqs_id="b", battery_name="BAT1", session_id=0,
                date=(T0 + timedelta(days=2 * i)).date(),   # gaps do not widen windows (K7)
                volt_mean=v, soc_mean=v * 5) for i, v in enumerate(vals)]
    d = FE.add_rolling(spark.createDataFrame(rows)).orderBy("date").toPandas()
    ref = _pandas_features(vals)
    np.testing.assert_allclose(d["volt_slope_3d"].astype(float), ref["s3"], atol=1e-9)
    np.testing.assert_allclose(d["volt_slope_7d"].astype(float), ref["s7"], atol=1e-9)
    np.testing.assert_allclose(d["volt_vol_7d"].astype(float), ref["v7"], atol=1e-9)


def daily_series(spark, soc_mins, sessions=None):
    sessions = sessions or [0] * len(soc_mins)
    rows = [Row(bloqs_id="b", battery_name="BAT1", session_id=s, date=(T0 + timedelta(days=i)).date(),
                soc_min=float(v)) for i, (v, s) in enumerate(zip(soc_mins, sessions))]
    return spark.createDataFrame(rows)


def test_label_frame_k1(spark):
    series = [10, 90, 80, 70, 95, 85, 75, 65, 99, 88, 50, 97]
    out = LB.add_label(daily_series(spark, series)).orderBy("date").collect()
    assert [r.future_min_soc for r in out] == [90, 80, 70, 70, 70, 70, 65, 65, 65, 50, 50, 50]
    ref = pd.Series(series).shift(-1).rolling(7, min_periods=1).min()
    assert [r.future_min_soc for r in out] == ref.tolist()
    assert [r.y_risk for r in out] == [0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 1]


def test_label_single_day_session_is_zero(spark):
    out = LB.add_label(daily_series(spark, [10, 10], sessions=[0, 1])).collect()
    assert all(r.future_min_soc is None and r.y_risk == 0 for r in out)


def test_latest_per_battery_prefers_later_session(spark):
    rows = [Row(bloqs_id="b", battery_name="BAT1", session_id=s, date=d)
            for s, d in [(0, T0.date()), (0, (T0 + timedelta(days=1)).date()),
                         (1, (T0 + timedelta(days=1)).date())]]
    out = risk.latest_per_battery(spark.createDataFrame(rows)).collect()
    assert [(r.session_id, r.date) for r in out] == [(1, (T0 + timedelta(days=1)).date())]


def test_split_is_disjoint_and_sized(spark):
    rows = [Row(bloqs_id=f"b{i % 37}", battery_name=f"BAT{i % 2}", session_id=i % 5, v=i)
            for i in range(2000)]
    df = spark.createDataFrame(rows)
    split = LB.split_sessions(df).collect()
    n = len(split)
    assert n == len({(r.bloqs_id, r.battery_name, r.session_id) for r in split})
    assert sum(r.is_train for r in split) == math.floor(0.8 * n)
    train, test = LB.session_split(df)
    keys = ["bloqs_id", "battery_name", "session_id"]
    assert train.select(*keys).intersect(test.select(*keys)).count() == 0
    assert train.count() + test.count() == df.count()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(0, 1, 3000).round(3), np.full(1500, 0.25)])  # hot value
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]
    got = exact_quantiles(df.withColumn("none", F.lit(None)), ["none", "x"], probs)
    assert got["none"] == [None] * len(probs)
    got = got["x"]
    np.testing.assert_allclose(got, np.quantile(vals, probs), rtol=0, atol=1e-12)


def _brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(scores, labels):
    P = sum(labels)
    ap = 0.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 1)
        fp = sum(1 for s, y in zip(scores, labels) if s >= t and y == 0)
        ap += sum(1 for s, y in zip(scores, labels) if s == t and y == 1) / P * tp / (tp + fp)
    return ap


def test_ranking_metrics_against_brute_force(spark):
    rng = np.random.default_rng(3)
    scores = (rng.integers(0, 40, 600) / 40).tolist()        # many ties
    labels = [int(rng.random() < 0.2 + 0.6 * s) for s in scores]
    df = spark.createDataFrame(list(zip(scores, labels)), "risk_prob double, y_risk int")
    r = ME.ranking_metrics(df).first()
    assert math.isclose(r.roc_auc, _brute_auc(scores, labels), abs_tol=1e-12)
    assert math.isclose(r.average_precision, _brute_ap(scores, labels), abs_tol=1e-12)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol="risk_prob", labelCol="y", metricName="areaUnderROC")
    ev.setNumBins(0)
    assert math.isclose(ev.evaluate(df.withColumn("y", F.col("y_risk").cast("double"))), r.roc_auc, abs_tol=1e-9)


def test_metrics_single_class_and_no_alert(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "risk_prob double, y_risk int")
    r = ME.ranking_metrics(df).first()
    assert r.roc_auc is None and r.average_precision is None
    assert not ME.evaluable(df)
    t = ME.threshold_metrics(df).first()
    assert t.alert_rate == 0.0 and t.precision == 0.0 and t.recall == 0.0 and t.balanced_accuracy is None


def test_extract_edge_cases(spark):
    fw_ok = '{"firmwareVersion":"7.1.5","battery":"[{\\"batteryName\\":\\"BAT1\\",\\"capacityStateOffCharge\\":\\"50\\"},{\\"batteryName\\":\\"BAT2\\",\\"capacityStateOffCharge\\":\\"\\"}]"}'
    real_array = '{"battery":[{"batteryName":"BAT1","capacityStateOffCharge":"10"},null],"x":"bat2"}'
    cases = [fw_ok, real_array, '{"battery":"[]","a":"bat1 bat2"}', '{"battery":null,"a":"bat1bat2"}',
             '{"a":"bat1 bat2"}', '{"battery":"not json","a":"bat1 bat2"}']
    rows = [Row(snapshot_id=i, bloqs_id=f"b{i}", metadata="{}", details="{}", firmwaredetails=fw,
                system_updated_at=T0, powersource="BATTERY", lifecyclestatus="live", active="true")
            for i, fw in enumerate(cases)]
    out = X.hourly_readings(spark.createDataFrame(rows), "2024-01-20").collect()
    got = sorted((r.bloqs_id, r.battery_name, r.soc) for r in out)
    assert got == [("b0", "BAT1", 50.0), ("b1", "BAT1", 10.0)]


def test_latest_snapshot_tie_break(spark):
    fw = '{"battery":"[{\\"batteryName\\":\\"BAT1\\",\\"capacityStateOffCharge\\":\\"1\\"}]","n":"bat2"}'
    rows = [Row(snapshot_id=i, bloqs_id="b", metadata="{}", details="{}", firmwaredetails=fw,
                system_updated_at=T0 + timedelta(minutes=m), powersource="BATTERY",
                lifecyclestatus="live", active="true") for i, m in [(1, 5), (2, 30), (3, 30), (4, 61)]]
    out = X.hourly_latest(spark.createDataFrame(rows), "2024-01-20").collect()
    assert sorted(r.snapshot_id for r in out) == [3, 4]


def test_evaluate_matches_separate_metrics(spark):
    rng = np.random.default_rng(11)
    scores = (rng.integers(0, 50, 800) / 50).tolist()
    labels = [int(rng.random() < s) for s in scores]
    df = spark.createDataFrame(list(zip(scores, labels)), "risk_prob double, y_risk int")
    one = ME.evaluate(df).first().asDict()
    two = {**ME.ranking_metrics(df).first().asDict(), **ME.threshold_metrics(df).first().asDict()}
    for k, v in two.items():
        assert one[k] == pytest.approx(v, abs=1e-12), k
    assert one["evaluable"] is True


def test_strict_sessions_and_notebook_scoring(spark):
    rows = [("b", "BAT1", 0, "a", 50.0, 12.5, 1)]
    df = CL.clean(hourly_rows(spark, rows)).drop("country")
    out = SE.add_sessions(df)                                   # tolerant: adds missing optional
    assert "country" in out.columns
    with pytest.raises(KeyError):
        SE.add_sessions(df.drop("partner"), strict=True)


def test_score_leaves_incomplete_rows_unscored(spark):
    from cellwatch import queries as Q
    res = risk.train(Q._hourly(spark, "/root/testdata/sf0.01"))
    daily = risk.materialized_daily(Q._hourly(spark, "/root/testdata/sf0.001"))
    one = daily.select("bloqs_id", "battery_name").orderBy("bloqs_id", "battery_name").first()
    hit = (F.col("bloqs_id") == one.bloqs_id) & (F.col("battery_name") == one.battery_name)
    daily = daily.withColumn("volt_slope_7d", F.when(hit, None).otherwise(F.col("volt_slope_7d")))
    canon = {(r.bloqs_id, r.battery_name): r for r in risk.score_from_daily(daily, res.model).collect()}
    nb = {(r.bloqs_id, r.battery_name): r for r in
          risk.score_from_daily(daily, res.model, notebook=True).collect()}
    key = (one.bloqs_id, one.battery_name)
    assert canon[key].risk_prob is None and canon[key].model_alert == 0        # D7 canonical
    assert nb[key].risk_prob is not None                                        # imputed
    assert set(canon) == set(nb) and len(canon) == daily.select("bloqs_id", "battery_name").distinct().count()
    others = [k for k in canon if canon[k].risk_prob is not None]
    assert others
    assert all(canon[k].risk_prob == pytest.approx(nb[k].risk_prob) for k in others)


def test_hot_device_hour_keeps_exactly_the_newest(spark):
    """A third of all rows on one device-hour: the map-side top-1 still yields one row."""
    fw = '{"battery":"[{\\"batteryName\\":\\"BAT1\\",\\"capacityStateOffCharge\\":\\"1\\"}]","n":"bat2"}'
    base = spark.range(0, 9000).selectExpr(
        "id AS snapshot_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('b', CAST(id AS STRING)) END AS bloqs_id",
        "'{}' AS metadata", "'{}' AS details", f"'{fw}' AS firmwaredetails",
        "TIMESTAMP_NTZ '2024-01-10 05:00:00' + make_dt_interval(0, 0, 0, id % 3600) AS system_updated_at",
        "'BATTERY' AS powersource", "'live' AS lifecyclestatus", "'true' AS active").repartition(8)
    out = X.hourly_latest(base, "2024-01-20").filter("bloqs_id = 'hot'").collect()
    hot_max = base.filter("bloqs_id = 'hot'").selectExpr("max(system_updated_at) AS m").first().m
    newest = base.filter(F.col("bloqs_id") == "hot").filter(F.col("system_updated_at") == hot_max) \
                 .agg(F.max("snapshot_id")).first()[0]
    assert len(out) == 1 and out[0].snapshot_id == newest


def test_ranking_metrics_over_many_scores(spark):
    rng = np.random.default_rng(5)
    scores = (rng.integers(0, 300, 900) / 300).tolist()
    labels = [int(rng.random() < s) for s in scores]
    df = spark.createDataFrame(list(zip(scores, labels)), "risk_prob double, y_risk int")
    t = ME.score_table(df)
    got = t.agg(F.sum(F.col("pos") * (2 * F.col("neg_lt") + F.col("neg"))).alias("a"),
                F.max("P").alias("P"), F.max("N").alias("N")).first()
    assert math.isclose(got.a / (2.0 * got.P * got.N), _brute_auc(scores, labels), abs_tol=1e-12)


def test_ranking_metrics_of_billions(spark):
    """Products of class counts past 2**63 neither overflow nor lose the result."""
    big = 3_000_000_000
    per = spark.createDataFrame([(0.1, 0, big), (0.5, big, big), (0.9, big, 0)], "score double, pos bigint, neg bigint")
    got = ME.ranking_of(ME.ranked_scores(per)).first()
    assert math.isclose(got.roc_auc, 0.875, rel_tol=1e-12)
    assert math.isclose(got.average_precision, 0.5 * 1 + 0.5 * 2 / 3, rel_tol=1e-12)


def test_rows_without_battery_stay_out_of_the_session_windows(spark):
    rows = [("b", None if i % 3 == 0 else "BAT1", i, "a", 50.0, 12.5, 1) for i in range(30)]
    df = CL.clean(hourly_rows(spark, rows))
    out = SE.add_sessions(df)
    assert out.filter("battery_name IS NULL AND session_id IS NULL AND is_censored = 0").count() == 10
    assert out.count() == 30 and SE.add_sessions(df, keyed_only=True).count() == 20
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "isnotnull(battery_name" in below


def test_hour_floor_does_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:15.25' AS t, '2024-03-10T02:59:59+02:00' AS s").select(
            S.hour_floor("t").cast("string").alias("t"), S.iso_hour("s").cast("string").alias("s")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.t, r.s) == ("2024-03-10 02:00:00", "2024-03-10 02:00:00")


def test_intermediates_need_a_shared_folder_on_a_cluster():
    from cellwatch import config

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": lambda self, k, d=None: d})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        config.ensure_checkpoint_dir(Session())
