"""Property-based checks (hypothesis) of PSI and chi-square against NumPy
and against their own invariants."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from driftline.operators import drift as D
from test_drift import psi_numpy, sides_frame

values = st.lists(st.one_of(st.integers(-5, 5).map(float),
                            st.floats(-1e3, 1e3, allow_nan=False, allow_infinity=False),
                            st.just(float("nan"))),
                  min_size=1, max_size=60)

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


@SETTINGS
@given(base=values, new=values)
def test_psi_matches_numpy(spark, base, new):
    got = D.psi(sides_frame(spark, base, new), ["x"]).collect()[0].psi
    ref = psi_numpy(base, new)
    if math.isnan(ref):
        assert got is None
    else:
        assert got == pytest.approx(ref, rel=1e-9, abs=1e-12)
        assert got >= -1e-15


@SETTINGS
@given(base=st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=40),
       new=st.lists(st.sampled_from(["a", "b", "c", "e"]), min_size=1, max_size=40))
def test_chi_square_symmetric_and_bounded(spark, base, new):
    def frame(x, y):
        return spark.createDataFrame([("base", v) for v in x] + [("new", v) for v in y],
                                     "side string, c string")
    a = D.chi_square(frame(base, new), ["c"]).collect()[0]
    b = D.chi_square(frame(new, base), ["c"]).collect()[0]
    assert a.k == len(set(base) | set(new))
    assert a.statistic == pytest.approx(b.statistic, rel=1e-9, abs=1e-12)
    assert 0.0 <= a.p_value <= 1.0
