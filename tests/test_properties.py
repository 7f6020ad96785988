"""Property tests: Spark operators against independent plain-Python / pandas versions."""
from datetime import datetime, timedelta

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from cellwatch.operators import clean as CL
from cellwatch.operators import labels as LB
from cellwatch.operators import sessions as SE

T0 = datetime(2024, 1, 10)
SERIALS = st.sampled_from([None, "a", "b", "c", "N/A", " a ", ""])
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def expected_sessions(serials):
    """ffill of cleaned serials; a new session where the filled value changes between two
    known values; first row session 0."""
    out, known, prev, sid = [], None, None, 0
    for i, s in enumerate(serials):
        s = None if s is None else s.strip()
        s = None if s in ("", "N/A", "nan", "None") else s
        known = s if s is not None else known
        if i > 0 and known is not None and prev is not None and known != prev:
            sid += 1
        out.append((sid, known))
        prev = known
    return out


@SETTINGS
@given(st.lists(SERIALS, min_size=1, max_size=25), st.lists(SERIALS, min_size=1, max_size=25))
def test_sessions_match_reference(spark, s1, s2):
    rows = [Row(hour_bucket=T0 + timedelta(hours=i), bloqs_id="b", battery_name=name,
                battery_serial_number=s, soc=50.0, voltage="12.5", temperature="20", rents=1)
            for name, seq in [("BAT1", s1), ("BAT2", s2)] for i, s in enumerate(seq)]
    df = spark.createDataFrame(rows, "hour_bucket timestamp_ntz, bloqs_id string, battery_name string, "
                                     "battery_serial_number string, soc double, voltage string, "
                                     "temperature string, rents long")
    got = SE.assign_sessions(CL.clean(df)).orderBy("battery_name", "timestamp").collect()
    want = expected_sessions(s1) + expected_sessions(s2)
    assert [(r.session_id, r.battery_serial_number) for r in got] == want


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=100), min_size=1, max_size=20),
       st.booleans())
def test_label_matches_pandas(spark, values, lookahead):
    rows = [Row(bloqs_id="b", battery_name="BAT1", session_id=0,
                date=(T0 + timedelta(days=i)).date(), soc_min=float(v)) for i, v in enumerate(values)]
    got = LB.add_label(spark.createDataFrame(rows), lookahead=lookahead).orderBy("date").collect()
    s = pd.Series(values, dtype=float)
    if lookahead:
        ref = pd.Series([s.iloc[i + 1:i + 8].min() if i + 1 < len(s) else float("nan")
                         for i in range(len(s))])
    else:
        ref = s.shift(-1).rolling(7, min_periods=1).min()
    for r, e in zip(got, ref):
        assert (r.future_min_soc is None and pd.isna(e)) or r.future_min_soc == e
        assert r.y_risk == int((not pd.isna(e)) and e < 60)
