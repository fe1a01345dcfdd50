import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rastercube.operators.quantile import grouped_summary

values = st.one_of(
    st.floats(min_value=-1.0, max_value=1.0, allow_nan=False, width=32),
    st.sampled_from([0.0, -0.0, 1e-30, -1e-30, 0.5, -0.5]),
)
groups = st.dictionaries(st.sampled_from(["a", "b", "c"]), st.lists(values, min_size=1, max_size=60), min_size=1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=groups, p=st.sampled_from([0.0, 0.25, 0.5, 0.75, 0.9, 1.0]))
def test_exact_percentile_property(spark, data, p):
    rows = [(g, float(v)) for g, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in grouped_summary(df, ["g"], "v", [p], exact_rows=8, refine_buckets=4).collect()}
    for g, vs in data.items():
        a = np.array(vs, dtype=np.float64)
        r = got[g]
        assert r.n == len(a)
        assert r.p0 == pytest.approx(float(np.percentile(a, p * 100, method="linear")), abs=1e-12)
        assert r.mean == pytest.approx(float(a.mean()), abs=1e-12)
        if len(a) > 1:
            assert r.std == pytest.approx(float(a.std(ddof=1)), rel=1e-9, abs=1e-12)
        else:
            assert r.std is None
