"""Property checks of the column helpers against their Python definitions."""

import string

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from priceloom.functions import numerics as N

ASCII_TEXT = st.lists(st.text(alphabet=string.ascii_letters + string.digits + " '-_&#/.", max_size=24),
                      min_size=1, max_size=60)
DOUBLES = st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False),
                   min_size=1, max_size=200)


@settings(max_examples=15, deadline=None)
@given(ASCII_TEXT)
def test_title_case_equals_str_title(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    assert [r[0] for r in df.select(N.title_case("s")).collect()] == [w.title() for w in words]


@settings(max_examples=15, deadline=None)
@given(DOUBLES, st.integers(min_value=0, max_value=4))
def test_rounding_equals_numpy(spark, xs, n):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in df.select(N.r("x", n)).collect()] == [float(np.round(x, n)) for x in xs]
