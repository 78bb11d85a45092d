"""Pages in the order of keys of any kind, against sorted lists."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from changeloom.operators import scale
from changeloom.sources import snapshot as snap

KEYS = {
    "text": ("string", lambda d: d.choice((None, "", "a", "Z", "é", "𝒳", "a" * 500)) or None if d.random() < 0.1 else f"k{d.randrange(999)}"),
    "wide": ("bigint", lambda d: d.choice((-(2**63), 2**63 - 1, 0, d.randrange(-(2**62), 2**62)))),
    "day": ("date", lambda d: date(2020, 1, 1 + d.randrange(28))),
    "number": ("decimal(20,2)", lambda d: d.choice((None, 1)) and __import__("decimal").Decimal(d.randrange(-99, 99)) / 4),
    "bytes": ("binary", lambda d: bytes([d.randrange(256), d.randrange(3)])),
}


def order(values):
    return [(v is None, v if v is not None else 0) for v in values]


@pytest.mark.parametrize("kinds", (("text",), ("wide", "text"), ("day", "number"), ("bytes",)))
def test_numbers_are_those_of_a_sort(spark, kinds):
    draw = random.Random(len(kinds))
    rows = [(*[KEYS[k][1](draw) for k in kinds], n) for n in range(1500)]
    table = spark.createDataFrame(rows, ", ".join(f"`k.{k}` {KEYS[k][0]}" for k in kinds) + ", n int").repartition(7)
    key = [f"k.{k}" for k in kinds]
    got = scale.numbered(table, key, "rn").collect()
    assert sorted(r.rn for r in got) == list(range(1, 1501)) and sorted(r.n for r in got) == list(range(1500))
    inorder = [order(r[k] if not isinstance(r[k], bytearray) else bytes(r[k]) for k in key) for r in sorted(got, key=lambda r: r.rn)]
    assert inorder == sorted(inorder, key=lambda x: [(n, v.encode() if isinstance(v, str) else v) for n, v in x])


def test_one_key_in_most_rows_is_spread(spark):
    """Ranges of a key that two thirds of the rows share, and of rows that are equal altogether, are of about one size."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.when(F.col("id") % 3 == 1, F.col("id")).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paged = snap.pages(rows, ["k"], 1000)
        sizes = [r["count"] for r in paged.groupBy("page").count().collect()]
        assert sizes == [1000] * 30
        ranges = [r["count"] for r in scale.in_ranges(rows, ["k"], "at").groupBy(F.shiftright("at", 33)).count().collect()]
        assert sum(ranges) == 30_000 and len(ranges) == 8 and max(ranges) < 8_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    last = paged.where("k is null").agg(F.min("page")).first()[0]
    assert last == 10


def test_bounds_and_what_is_left(spark):
    draw = random.Random(9)
    rows = [(draw.choice((None, 1, 2, 3)), draw.choice((None, "a", "b", "c")), n) for n in range(200)]
    table, key = spark.createDataFrame(rows, "a int, b string, n int"), ["a", "b"]
    place = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    inorder = sorted(rows, key=place)
    bounds = {r.page: r for r in snap.page_bounds(snap.pages(table, key, 30), key).collect()}
    assert len(bounds) == 7 and bounds[6].n == 20
    for p, r in bounds.items():
        assert tuple(r.first) == inorder[30 * p][:2] and tuple(r.last) == inorder[min(199, 30 * p + 29)][:2]
    for after in {r[:2] for r in rows}:
        got = sorted(r.n for r in snap.rest_from(table, key, after).collect())
        assert got == sorted(r[2] for r in rows if place(r) > place(after))


def test_pages_of_little(spark):
    table = spark.createDataFrame([], "k string, page_ int")
    assert snap.pages(table, ["k"], 10).count() == 0 and snap.page_bounds(snap.pages(table, ["k"], 10), ["k"]).count() == 0
    odd = spark.createDataFrame([(1, {"a": 1}), (2, None)], "k int, m map<string,int>")
    assert sorted((r.k, r.page) for r in snap.pages(odd, ["k"], 1).collect()) == [(1, 0), (2, 1)]
    assert sorted(r.page for r in snap.pages(odd, [], 1).collect()) == [0, 1]
