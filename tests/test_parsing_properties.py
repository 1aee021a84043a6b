"""Property tests: the Spark parsers against plain-Python statements of the
same rules, on generated strings (one Spark job per generated batch)."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moldwise.functions import columns as fn

NUMBER = re.compile(r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$")


def py_number(s):
    if s is None:
        return None
    t = s.strip()
    if not NUMBER.match(t):
        return None
    v = float(t)
    return None if math.isnan(v) else v


def py_duration(s):
    if s is None:
        return None
    parts = s.strip().split(":")
    vals = [py_number(p) for p in parts]
    if len(parts) == 3 and None not in vals:
        return vals[0] * 3600 + vals[1] * 60 + vals[2]
    if len(parts) == 2 and None not in vals:
        return vals[0] * 60 + vals[1]
    return None


ALPHABET = "0123456789:. +-eEinfty"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=10)), min_size=1, max_size=200)


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isinf(a) or math.isinf(b):
        return a == b
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


@settings(max_examples=25, deadline=None)
@given(texts)
def test_number_and_duration_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select("s", fn.to_number(F.col("s")).alias("n"), fn.duration_seconds(F.col("s")).alias("d")).collect()
    for r in rows:
        assert _same(r["n"], py_number(r["s"])), r
        assert _same(r["d"], py_duration(r["s"])), r
