from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from trendlens.functions import scalar as fx
from trendlens.streaming.control import parse_setting


@pytest.mark.parametrize(
    "size, text",
    [
        (0, "0.00 B"), (1, "1.00 B"), (1023, "1023.00 B"), (1024, "1.00 KB"), (1152, "1.12 KB"), (1536, "1.50 KB"), (10**6, "976.56 KB"),
        (1048576, "1.00 MB"), (5 * 1024**3 + 7, "5.00 GB"), (3 * 1024**4, "3.00 TB"), (1024**5, None),
    ],
)
def test_format_bytes(spark, size, text):
    assert spark.range(1).select(fx.format_bytes(F.lit(size)).alias("t")).first()["t"] == text


@pytest.mark.parametrize(
    "prefix, expected",
    [
        ("search_snapshot", "search_snapshot"),
        ("a b/c", "a_b_c"),
        ("__x__", "x"),
        ("???", "snapshot"),
        ("", "snapshot"),
        ("热词-导出", "热词-导出"),
        ("https://x.org/a?b=1", "https___x_org_a_b_1"),
    ],
)
def test_clean_prefix(spark, prefix, expected):
    got = spark.range(1).select(fx.clean_prefix(F.lit(prefix)).alias("p")).first()["p"]
    assert got == expected


def test_freshness(spark):
    row = spark.range(1).select(
        fx.freshness_seconds(F.lit(0), 100).alias("a"),
        fx.freshness_seconds(F.lit(90), 100).alias("b"),
        fx.freshness_seconds(F.lit(150), 100).alias("c"),
    ).first()
    assert (row["a"], row["b"], row["c"]) == (-1, 10, 0)


def test_parse_with_default(spark):
    row = spark.range(1).select(
        fx.parse_long(F.lit("12")).alias("a"),
        fx.parse_long(F.lit("x"), 7).alias("b"),
        fx.parse_double(F.lit("bad"), 1.0).alias("c"),
    ).first()
    assert (row["a"], row["b"], row["c"]) == (12, 7, 1.0)


@pytest.mark.parametrize("text, expected", [("10", 10), ("3000000000", 50), ("2147483646", 2147483646), ("2147483647", 50), ("abc", 50), ("0", 50), ("-3", 50), (None, 50), (" 7 ", 7)])
def test_control_setting_rule(text, expected):
    assert parse_setting(text, 50) == expected


def test_stamp_is_utc_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = spark.range(1).select(fx.stamp(F.lit(1_735_689_600)).alias("s")).first()["s"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == fx.stamp_text(1_735_689_600) == "20250101_000000"


def test_format_bytes_many_sizes_and_ties(spark):
    import random

    rnd = random.Random(5)
    sizes = [rnd.randrange(0, 1024 ** rnd.randint(1, 5) * 3) for _ in range(2000)]
    sizes += [k * 1024**e // 8 for k in range(1, 800, 7) for e in range(1, 5)]  # exact halves and eighths
    df = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", fx.format_bytes(F.col("s")).alias("t"))
    for r in df.collect():
        power = max(0, (r["s"].bit_length() - 1) // 10)
        want = Decimal(r["s"]) / Decimal(1024) ** power
        want = None if power > 4 else f"{want.quantize(Decimal('0.01'), ROUND_HALF_EVEN)} {('B', 'KB', 'MB', 'GB', 'TB')[power]}"
        assert r["t"] == want, r["s"]


def test_clean_prefix_matches_the_rule_on_table_text(spark):
    from conftest import SF001

    pages = spark.read.parquet(f"{SF001}/pages.parquet").select(F.col("url").alias("p"))
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.substring("text", 1, 40).alias("p"))
    rows = pages.unionByName(docs).select("p", fx.clean_prefix(F.col("p")).alias("c")).collect()
    assert len(rows) > 100
    for r in rows:
        kept = [a for a, b in zip(r["p"], "?" * len(r["p"])) if a.isalnum() or a == "-"]
        assert [a for a in r["c"] if a != "_"] == kept or (r["c"] == "snapshot" and not kept), r["p"]
        assert r["c"] == r["c"].strip("_")
