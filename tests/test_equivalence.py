"""Property: the marts equal the brute-force statement (tests/brute.py) on
random snapshots with repeated ids, nulls and ties."""
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from staylens.plans import marts
from tests import brute
from tests.helpers import dims, rows_of, snap_row

MONTHS = ["2020-05", "2020-06", "2020-07", None]
NBS = ["A", "B", "C", None]


@pytest.fixture(scope="module", autouse=True)
def one_partition(spark):
    """Tiny frames: one shuffle partition and no re-planning."""
    small = {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@st.composite
def snapshots(draw):
    n = draw(st.integers(min_value=2, max_value=14))
    rows = []
    for _ in range(n):
        month = draw(st.sampled_from(MONTHS))
        rows.append(snap_row(
            draw(st.integers(1, 4)), month if month else "2020-05",
            nb=draw(st.sampled_from(NBS)),
            price=draw(st.one_of(st.none(), st.integers(10, 60))),
            active=draw(st.sampled_from(["t", "f", "f", None])),
            avail=draw(st.one_of(st.none(), st.integers(0, 30))),
            rating=draw(st.one_of(st.none(), st.floats(50, 100).map(lambda x: round(x, 1)))),
            host=draw(st.sampled_from(["h1", "h2", "h3", None])),
            superhost=draw(st.sampled_from(["t", "f", None])),
            host_nb=draw(st.sampled_from(NBS)),
            ptype=draw(st.sampled_from(["House", "Flat", None])),
            rtype=draw(st.sampled_from(["Entire", "Room"])),
            acc=draw(st.sampled_from([1, 2, None]))))
        if month is None:
            rows[-1]["scraped_date"] = None
    return rows


def _norm(rows):
    def key(v):
        return (v is None, str(v))
    return sorted((tuple(sorted(r.items())) for r in rows), key=lambda t: [key(v) for _, v in t])


def _both(fast, slow, spark, rows):
    ld, hd = dims(spark, rows)
    return _norm(rows_of(slow(ld, hd))), _norm(rows_of(fast(ld, hd)))


SETTINGS = settings(max_examples=50, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

#: For what shares its builder with another test.
FEWER = settings(SETTINGS, max_examples=15)


@SETTINGS
@given(rows=snapshots())
def test_mart1_equivalent(spark, rows):
    a, b = _both(lambda l, h: marts.listing_neighbourhood_mart(l, h, True),
                 lambda l, h: brute.listing_mart(l, h, ["listing_neighbourhood"], True), spark, rows)
    assert a == b


@FEWER
@given(rows=snapshots())
def test_mart2_equivalent(spark, rows):
    a, b = _both(lambda l, h: marts.property_type_mart(l, h, True),
                 lambda l, h: brute.listing_mart(l, h, list(marts.PROPERTY_KEYS), True), spark, rows)
    assert a == b


@SETTINGS
@given(rows=snapshots())
def test_mart3_equivalent(spark, rows):
    a, b = _both(lambda l, h: marts.host_neighbourhood_mart(l, h),
                 lambda l, h: brute.host_neighbourhood_mart(l, h), spark, rows)
    assert a == b


@SETTINGS
@given(rows=snapshots())
def test_active_listing_stats_equivalent(spark, rows):
    a, b = _both(lambda l, h: marts.active_listing_stats(l, h, ["listing_neighbourhood"]),
                 lambda l, h: brute.active_listing_stats(l, h, ["listing_neighbourhood"]), spark, rows)
    assert a == b


@FEWER
@given(rows=snapshots())
def test_distinct_hosts_same_with_and_without_broadcast(spark, rows):
    from staylens.operators import fanout
    ld, hd = dims(spark, rows)
    keys = ["property_type", "room_type"]
    with_bc = _norm(rows_of(fanout.keyed_month_distinct_hosts(ld, hd, keys, drop_null_keys=False)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        without = _norm(rows_of(fanout.keyed_month_distinct_hosts(ld, hd, keys, drop_null_keys=False)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert with_bc == without
