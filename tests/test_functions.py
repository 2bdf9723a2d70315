from decimal import Decimal

from staylens.functions import lga_code_of, month_of, pct_change, ratio6, hundred


def test_ratio6_half_up_and_scale(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (-1, 3), (1, 0), (16773026970, 177)], "a long, b long")
    out = df.select(ratio6("a", "b").alias("r"), (ratio6("a", "b") * hundred()).alias("p")).collect()
    assert str(out[0].r) == "0.333333" and str(out[0].p) == "33.333300"
    assert str(out[1].r) == "0.666667"
    assert str(out[2].r) == "-0.333333"
    assert out[3].r is None                      # zero denominator -> null, not an error
    assert out[4].r == Decimal("94762864.237288")
    assert df.select(ratio6("a", "b")).schema[0].dataType.simpleString() == "decimal(38,6)"


def test_pct_change_rounds_before_multiplying(spark):
    df = spark.createDataFrame([(2, 3), (4, 3), (5, None)], "cur long, prev long")
    out = [r.c for r in df.select(pct_change("cur", "prev").alias("c")).collect()]
    assert [str(x) if x is not None else None for x in out] == ["-33.333300", "33.333300", None]


def test_month_and_code(spark):
    df = spark.createDataFrame([("2020-05-17", "LGA10050")], "d string, c string")
    r = df.select(month_of("d").alias("m"), lga_code_of("c").alias("k")).first()
    assert r.m == "2020-05" and r.k == 10050


def test_golden_ratios(spark):
    """Published (revenue, hosts) pairs give the published revenue per host to six
    digits, half up. Fixed values."""
    golden = [(16773026970, 177, "94762864.237288"), (1, 3, "0.333333"), (2, 3, "0.666667"), (1, 7, "0.142857"),
              (5, 2, "2.500000"), (10**15, 7, "142857142857142.857143"), (1, 2_000_000, "0.000001"),
              (1, 2_000_001, "0.000000"), (0, 9, "0.000000")]
    df = spark.createDataFrame(golden, "revenue long, hosts long, expected string")
    for r in df.select(ratio6("revenue", "hosts").cast("string").alias("g"), "expected").collect():
        assert Decimal(r.g) == Decimal(r.expected)
