"""Property: the split lag equals the plain window on arbitrary small frames."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from lakestrata.operators.series import previous_values
from tests.conftest import rows

ROW = st.tuples(
    st.sampled_from(["a", "b", None]),                                   # key part 1
    st.sampled_from(["x", None]),                                        # key part 2
    st.one_of(st.none(), st.integers(0, 6).map(lambda d: dt.date(2024, 1, 1) + dt.timedelta(d))),
    st.integers(0, 10 ** 6),                                             # unique tie-breaker
    st.one_of(st.none(), st.integers(-100, 100)),                        # value
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(ROW, max_size=40, unique_by=lambda r: r[3]), ignore=st.booleans(),
       split_above=st.sampled_from([0, 3]))
def test_split_equals_plain(spark, data, ignore, split_above):
    df = spark.createDataFrame(data, "k1 string, k2 string, d date, t int, v int")
    kw = {"ignore_nulls": ignore}
    plain = previous_values(df, ["k1", "k2"], ["d", "t"], ["v"], split_above=None, **kw)
    split = previous_values(df, ["k1", "k2"], ["d", "t"], ["v"], split_above=split_above, **kw)
    assert rows(split) == rows(plain)
