"""Property test: date-key standardisation of ISO, day-first and mixed text
columns against Python's own date parsing."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from moldwise.operators import joins as jn

dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2090, 12, 31))
styles = st.sampled_from(["iso", "dmy"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(dates, styles), min_size=1, max_size=60), st.sampled_from(["iso", "dmy", "mixed"]))
def test_date_keys(spark, items, mode):
    def fmt(d, style):
        if mode != "mixed":
            style = mode
        return d.strftime("%Y-%m-%d") if style == "iso" else d.strftime("%d-%m-%Y")

    rows = [(i, fmt(d, s)) for i, (d, s) in enumerate(items)]
    want = {i: d.isoformat() for i, (d, _s) in enumerate(items)}
    df = spark.createDataFrame(rows, "i int, d string")
    got = {r["i"]: r["date_key"] for r in jn.standardize_date(df, "d").collect()}
    assert got == want
