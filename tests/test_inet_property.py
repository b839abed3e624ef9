"""The INET validity predicate against Python's ipaddress module."""

import ipaddress

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions.inet import is_inet

v4 = st.integers(0, 2**32 - 1).map(lambda n: str(ipaddress.IPv4Address(n)))
v6 = st.integers(0, 2**128 - 1).flatmap(lambda n: st.sampled_from(
    [ipaddress.IPv6Address(n).compressed, ipaddress.IPv6Address(n).exploded]))
valid = st.one_of(
    v4, v6,
    st.tuples(v4, st.integers(0, 32)).map(lambda t: f"{t[0]}/{t[1]}"),
    st.tuples(v6, st.integers(0, 128)).map(lambda t: f"{t[0]}/{t[1]}"),
)
invalid = st.one_of(
    st.tuples(st.integers(256, 999), st.integers(0, 255)).map(lambda t: f"{t[0]}.{t[1]}.1.1"),
    st.tuples(v4, st.integers(33, 99)).map(lambda t: f"{t[0]}/{t[1]}"),
    st.tuples(v6, st.integers(129, 999)).map(lambda t: f"{t[0]}/{t[1]}"),
    st.sampled_from(["", "1.2.3", "1.2.3.4.5", "abc", "1::2::3", "12345::", "::g", "1.2.3.4/"]),
)


def _check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ip string")
    return {r.ip: r.ok for r in df.select("ip", is_inet(F.col("ip")).alias("ok")).collect()}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(valid, min_size=1, max_size=200), st.lists(invalid, min_size=1, max_size=50))
def test_is_inet_agrees_with_ipaddress(spark, good, bad):
    for v in good:
        ipaddress.ip_interface(v)  # the generator only makes valid text
    got = _check(spark, good + bad)
    assert all(got[v] for v in good)
    assert not any(got[v] for v in bad)


def test_inet_edges(spark):
    good = ["::abcd:1.2.3.4", "1::2:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "::", "::1.2.3.4", "::1:2:3:4:5:6:7", "1:2:3:4:5:6:7::", "1:2:3:4:5::1.2.3.4"]
    bad = ["1.2.3.4\n", "::1\n", "1:2:3:4:5:6:7:8::", "1:2:3:4:5:6::1.2.3.4", "1::2::3", "1.2.3.4 ", "1:2:3:4:5:6:7:1.2.3.4"]
    got = _check(spark, good + bad)
    assert [v for v in good if not got[v]] == [] and [v for v in bad if got[v]] == []
