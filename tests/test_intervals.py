"""Assembly by stretches of positions: any width, transactions over many stretches, large ones left out before they move."""

import pytest
from pyspark.sql import functions as F

from changeloom.functions import cells
from changeloom.model import MESSAGE
from changeloom.operators import assemble, scale
from tests.test_log import AT, expected, found, random_log, rel


@pytest.mark.parametrize(("width", "most", "broadcast"), [(1, 400, 10**6), (3, 400, 0), (7, 0, 10**6), (50, 250, 1), (10**9, 400, 10**6)])
def test_any_width(spark, width, most, broadcast):
    rows = random_log(width % 97, n=150, slots=("a", None, "b"))
    rows = [(r[0], r[1] * (1 << 31 if r[1] % 50 > 40 else 1) + 5 * r[1], *r[2:]) for r in rows]  # places far apart, as between files
    rows = [(*r[:1], k, *r[2:]) if width == 7 else r for k, r in enumerate(sorted(rows, key=lambda r: (str(r[0]), r[1])))]
    got = assemble.assemble(spark.createDataFrame(rows, MESSAGE).repartition(5), most, width=width, max_broadcast=broadcast)
    named = lambda x: sorted(map(str, x))
    assert named(found_any(got.events)) == named(expected_any(rows, most if most > 0 else 10**9))
    inside = {(r.slot, r.seq) for r in assemble.assemble(spark.createDataFrame(rows, MESSAGE), 0, width=width).events.collect()}
    outside = {(r.slot, r.seq) for r in got.outside.collect()}
    assert outside == stray(rows) and not inside & outside


def found_any(events):
    return [(r.slot, r.xid, r.ordinal, r.seq, r.op, r.commit_lsn) for r in events.collect()]


def expected_any(rows, most):
    out = []
    for slot in {r[0] for r in rows}:
        out += [(slot, *x[1:]) for x in expected([("s", *r[1:]) for r in rows if r[0] == slot], most)]
    return out


def stray(rows):
    out = set()
    for slot in {r[0] for r in rows}:
        inside = False
        for r in sorted((r for r in rows if r[0] == slot), key=lambda r: r[1]):
            inside = r[3] == "B" or inside and r[3] != "C"
            if r[3] in "IUD" and not inside:
                out.add((slot, r[1]))
    return out


def half_log(n):
    """One transaction of half the log among transactions of five changes."""
    row = lambda seq, kind, **f: ("s", seq, seq, kind, f.get("xid"), f.get("lsn"), AT if kind in "BC" else None, f.get("rel_id"), f.get("rel"), None, f.get("new"))
    rows, seq = [row(0, "R", rel_id=1, rel=rel("email"))], 1
    for xid, size in ((k, n if k == 20 else 5) for k in range(40)):
        rows.append(row(seq, "B", xid=xid, lsn=seq))
        rows += [row(seq + j, "I", rel_id=1, new=[("t", str(j)), ("t", "x" * 20)]) for j in range(1, size + 1)]
        seq += size + 2
        rows.append(row(seq - 1, "C", lsn=seq))
    return rows


def test_one_transaction_of_half_the_log(spark, monkeypatch):
    rows = half_log(3000)
    table = spark.createDataFrame(rows, MESSAGE).repartition(4)
    whole = assemble.assemble(table, 0, width=100)
    assert found(whole.events) == expected(rows, 10**9)
    big = whole.events.where("xid = 20")
    assert [r.ordinal for r in big.orderBy("seq").select("ordinal").collect()] == list(range(1, 3001))
    seen, own = [], assemble.outside_of

    def counted(changes, spans, width):
        left = own(changes, spans, width)
        seen.append((changes.count(), left.count()))
        return left

    monkeypatch.setattr(assemble, "outside_of", counted)
    small = assemble.assemble(table, 10_000, width=100)
    assert found(small.events) == expected(rows, 10_000) and small.events.where("xid = 20").count() == 0
    assert seen == [(3195, 195)]  # its changes go before anything is dealt out


def test_tuples_are_dealt_out_once_and_never_by_transaction(spark):
    events = assemble.assemble(spark.createDataFrame(half_log(50), MESSAGE), 0).events
    plan = events._jdf.queryExecution().sparkPlan().toString() + events._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert any("_by" in line for line in moved)
    text = events._jdf.queryExecution().executedPlan().toString()
    # the tuples stand above one exchange, by stretch; the others are of numbers out of the stored parts
    for k, line in enumerate(text.split("\n")):
        if "Exchange hashpartitioning" in line and "_by" not in line:
            assert "before#" not in text.split("\n")[k + 1] or "before_n" in text.split("\n")[k + 1]


def test_running_sums_deal_out_once(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scale.running_sum(rows, F.col("at") % 5, "total", ["k"], "at", width=50)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(_by") == 4  # the rows once; the others are of a row for each stretch
        draw, want = {}, {}
        for k in range(1000):
            key = k % 3 or None
            draw[key] = draw.get(key, 0) + k % 5
            want[k] = draw[key]
        assert {r["at"]: r.total for r in got.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bytes_of_tuples_that_are_not_decoded(spark):
    """As of decoded ones: without a relation, with more cells than columns, nulls, texts beyond ASCII, no tuple."""
    column, cell = "struct<name:string,type_oid:bigint,is_key:boolean>", "array<struct<kind:string,text:string>>"
    tuples = [None, [], [("t", "é𝒳"), ("n", None)], [("u", None)] * 12, [("t", ""), ("t", None), ("t", "abc")]]
    named = [None, [], [("id", 20, True)], [("näme", 25, False), (None, None, None), ("c", 1, True)]]
    rows = [(k, old, new, rel) for k, (old, new, rel) in enumerate((a, b, c) for a in tuples for b in tuples for c in named)]
    table = spark.createDataFrame(rows, f"k int, old {cell}, new {cell}, rel array<{column}>")
    sides = [cells.decoded(F.col(x), F.col("rel")) for x in ("old", "new")]
    for r in table.select("k", cells.change_bytes(*sides).alias("a"), cells.logged_bytes(F.col("old"), F.col("new"), F.col("rel")).alias("b")).collect():
        size = 64
        for c in (rows[r.k][1] or []) and enumerate(rows[r.k][1]):
            size += one_cell(c, rows[r.k][3])
        for c in (rows[r.k][2] or []) and enumerate(rows[r.k][2]):
            size += one_cell(c, rows[r.k][3])
        assert r.a == r.b == size


def one_cell(placed, columns):
    k, (kind, text) = placed
    if columns is None:
        return 32 + len(f"col_{k}")
    name = columns[k][0] if k < len(columns) else ""
    return 32 + len((name or "").encode()) + (len((text or "").encode()) if kind == "t" else 0)
