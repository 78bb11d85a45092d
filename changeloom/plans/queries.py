"""The registered queries of the change-log engine, each with the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.functions import cells, names, pgtypes
from changeloom.functions.lsn import commit_time, lsn_number
from changeloom.model import VALUE
from changeloom.operators import assemble, envelope, metrics, mirror, progress, publish, scale
from changeloom.operators.kept_mirror import KeptMirror
from changeloom.plans import log
from changeloom.sinks import FileSink, batch_name
from changeloom.sources import snapshot as snap
from changeloom.sources import wal
from changeloom.streaming import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DATABASE = "shop"
NOW = datetime(2030, 1, 1)

CTE = """with wal as (select event_id as seq, (16777216 + event_id * 64)::bigint as lsn, floor(event_id / 5)::bigint as txid, user_id,
  case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op, event_type, value, props, ts from events)
"""


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL; {wal} stands for the changes of events."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql.replace("{wal}", CTE.strip())
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return log.event_changes(table(spark, sf, "events"))


def timed(spark, sf):
    return changes(spark, sf).withColumn("at", F.col("ts").cast("timestamp"))


def event_number(lsn):
    return ((lsn - log.LSN_BASE) / log.LSN_STEP).cast("bigint")


def messages(spark, sf):
    return log.messages_from_events(table(spark, sf, "events"))


LSN_SQL = "printf('%X/%X', lsn >> 32, lsn & 4294967295)"
SECONDS_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"


@query("""{wal}, r as (select *, row_number() over (partition by user_id order by txid desc, lsn desc) rn from wal)
select user_id, event_type, value, txid as ver, lsn from r where rn = 1 and op <> 'd'""")
def q01_mirror_latest(spark, sf):
    return mirror.latest(changes(spark, sf), ["user_id"], ["txid", "lsn"], F.col("op") == "d").select("user_id", "event_type", "value", F.col("txid").alias("ver"), "lsn")


@query("{wal} select seq, 'cdc' source, 'shop' \"database\", 'public' \"schema\", 'events' \"table\", op, txid, " + LSN_SQL + " lsn, " + SECONDS_SQL.replace("ts,", "max(ts) over (partition by txid),") + " commit_ts, false snapshot, 'cdc.shop.public.events' topic from wal")
def q02_envelope_flat(spark, sf):
    rows = envelope.envelopes(assemble.assemble(messages(spark, sf)).events, envelope.Output(database=DATABASE))
    return rows.select(event_number(lsn_number(F.col("lsn"))).alias("seq"), "source", "database", "schema", "table", "op", "txid", "lsn", "commit_ts", "snapshot", "topic")


@query("""{wal} select seq, '{"event_type":"' || event_type || '","user_id":"' || user_id || '"}' "key" from wal""")
def q03_message_key(spark, sf):
    rows = changes(spark, sf)
    columns = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(25).cast("bigint").alias("type_oid"), F.lit(k).alias("is_key")) for n, k in (("user_id", True), ("event_type", True), ("value", False))])
    after = cells.decoded(F.array(log.cell(F.col("user_id").cast("string")), log.cell(F.col("event_type")), log.cell(F.col("value").cast("string"))), columns)
    return rows.select("seq", cells.json(cells.sorted_map(cells.image(cells.key_values(F.lit(None).cast(f"array<{VALUE}>"), after)))).alias("key"))


ROUTED = {"customer": "c_custkey", "orders": "o_orderkey", "nation": "n_nationkey"}
ROUTED_SQL = " union all ".join(f"select '{t}' tab, {k}::bigint id from {t}" for t, k in ROUTED.items())


def routed(spark, sf):
    parts = [table(spark, sf, t).select(F.lit(t).alias("tab"), F.col(k).cast("bigint").alias("id")) for t, k in ROUTED.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"select 'cdc.shop.public.' || tab topic, count(*) n, min(id) first_id from ({ROUTED_SQL}) group by 1")
def q04_topic_routing(spark, sf):
    rows = routed(spark, sf).withColumn("topic", names.topic(F.lit(DATABASE), F.lit("public"), F.col("tab")))
    return rows.groupBy("topic").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(f"select 'cdc-all-events' topic, count(*) n from ({ROUTED_SQL})")
def q05_topic_single(spark, sf):
    rows = routed(spark, sf).withColumn("topic", names.topic(F.lit(DATABASE), F.lit("public"), F.col("tab"), "single", single="cdc-all-events"))
    return rows.groupBy("topic").agg(F.count("*").alias("n"))


#: A change's bytes: 64, and name, value and 32 for each cell. A deletion sends the key and three nulls; from
#: transaction 1000 on the column value is called amount, one byte longer.
BYTES_SQL = """64 + 4 * 32 + length('user_idevent_typevalueprops') + (txid >= 1000)::int
  + strlen(user_id::varchar) + case when op = 'd' then 0 else strlen(event_type) + strlen(value_text) + case when op = 'c' then strlen(props) else 0 end end"""


def tx_bytes(spark, sf):
    return assemble.assemble(messages(spark, sf))


SIZED = "{wal}, w as (select *, value::varchar value_text from wal), b as (select *, (" + BYTES_SQL + ")::bigint bytes from w)"


@query("{wal} select txid xid, " + SECONDS_SQL.replace("ts,", "max(ts),") + " commit_ts, max(lsn) + 8 commit_lsn, count(*) n_events, min(case op when 'c' then 'c' when 'd' then 'd' else 'u' end) first_op from wal group by txid")
def q06_tx_assembly(spark, sf):
    got = assemble.assemble(messages(spark, sf))
    ops = got.events.groupBy("slot", "tx_no").agg(F.min("op").alias("first_op"))
    return got.transactions.join(ops, ["slot", "tx_no"]).select("xid", commit_time(F.col("commit_ts")).alias("commit_ts"), "commit_lsn", "n_events", "first_op")


@query(SIZED + " select txid xid, sum(bytes)::bigint n_bytes from b group by txid")
def q07_tx_bytes(spark, sf):
    return tx_bytes(spark, sf).transactions.select("xid", "n_bytes")


OVERSIZED = 1150


@query(SIZED + f" select seq, op from b where txid in (select txid from b group by txid having sum(bytes) <= {OVERSIZED})")
def q08_oversized_drop(spark, sf):
    events = assemble.assemble(messages(spark, sf), OVERSIZED).events
    return events.select(event_number(F.col("event_lsn")).alias("seq"), "op")


@query("""{wal}, t as (select txid, max(lsn) + 8 lsn, max(ts) ts, count(*) n from wal group by txid)
select 'cdc.shop.public.events' topic, ord::bigint ordinal, txid, '{"source":"cdc","database":"shop","op":"' || op || '","txid":' || txid || ',"lsn":"' || """ + LSN_SQL + """ || '","commit_ts":"' || """ + SECONDS_SQL + """ || '","event_count":' || n || '}' "value"
from t, lateral (select 0 ord, 'begin' op union all select n + 1, 'commit') m""")
def q09_tx_markers(spark, sf):
    got, out = assemble.assemble(messages(spark, sf)), envelope.Output(database=DATABASE)
    rows = envelope.markers(envelope.envelopes(got.events, out), got.transactions, out)
    return rows.select("topic", "ordinal", F.get_json_object("value", "$.txid").cast("bigint").alias("txid"), "value")


@query("""{wal} select seq, case when txid >= 1000 then 'amount' else 'value' end column_name, 4::bigint n_columns from wal""")
def q10_relation_asof(spark, sf):
    rows = messages(spark, sf)
    joined = assemble.with_relation(rows.where(F.col("msg").isin("I", "U", "D")), rows)
    return joined.select(event_number(F.col("wal_start")).alias("seq"), F.col("rel.columns")[2]["name"].alias("column_name"), F.size("rel.columns").cast("bigint").alias("n_columns"))


#: Transactions by a running count of the begins that are left; each ends at the first commit after its begin.
LOST_SQL = """{wal}, tx as (select distinct txid from wal),
m as (select txid, 0 place, 'B' msg from tx where txid % 11 <> 5
  union all select txid, 1 + seq % 5, 'change' from wal
  union all select txid, 6, 'C' from tx where txid % 7 <> 3),
n as (select *, txid * 8 + place pos, sum((msg = 'B')::int) over (order by txid, place) no from m),
t as (select no, min(txid) filter (msg = 'B') xid, min(pos) filter (msg = 'C') until from n where no > 0 group by no)
"""


def lossy_messages(spark, sf):
    """Every seventh commit and every eleventh begin is lost."""
    tx = F.floor(F.col("seq") / 8) - 1
    lost = ((F.col("msg") == "C") & (tx % 7 == 3)) | ((F.col("msg") == "B") & (tx % 11 == 5))
    return messages(spark, sf).where(~lost)


@query(LOST_SQL + "select xid, count(*) filter (msg = 'change' and pos < until) n_events from n join t using (no) where until is not null group by xid")
def q11_begin_without_commit(spark, sf):
    """What is open at the next begin is discarded, and where a commit and the next begin are both lost the open
    transaction takes in the next one's changes and commit."""
    return assemble.assemble(lossy_messages(spark, sf)).transactions.select("xid", "n_events")


ACKED = "(lsn // 64) % 997 <> 996"


@query("{wal}, a as (select txid, max(lsn) lsn from wal group by txid), k as (select *, " + ACKED + " ok from a) select max(lsn) lsn, count(*) n from k where txid < coalesce((select min(txid) from k where not ok), 9223372036854775807) having count(*) > 0")
def q12_contiguous_ckpt(spark, sf):
    acks = changes(spark, sf).groupBy("txid").agg(F.max("lsn").alias("lsn")).select(F.lit("events").alias("slot"), F.col("txid").alias("ord"), "lsn", (F.floor(F.col("lsn") / 64) % 997 != 996).alias("acked"))
    return progress.contiguous(acks).select("lsn", "n")


@query("{wal}, c as (select seq, (lsn * 7919) % 1000003 lsn from wal) select seq, lsn, max(lsn) over (order by seq rows unbounded preceding) pending, coalesce(lsn > max(lsn) over (order by seq rows between unbounded preceding and 1 preceding), true) moved from c")
def q13_monotone_confirm(spark, sf):
    confirms = changes(spark, sf).select(F.lit("events").alias("slot"), "seq", ((F.col("lsn") * 7919) % 1000003).alias("lsn"))
    return progress.confirmed(confirms, ["slot"], "seq").select("seq", "lsn", "pending", "moved")


ORDER_KEY_SQL = """'{"o_orderkey":"' || o_orderkey || '"}'"""
ORDER_SQL = "'{' || " + " || ',' || ".join(f"""'"{c}":"' || {c} || '"'""" for c in ("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")) + " || '}'"


@query("select " + ORDER_KEY_SQL + """ "key", 'cdc.shop.public.orders' topic, '{"source":"cdc","database":"shop","schema":"public","table":"orders","op":"r","txid":0,"lsn":"0/0","commit_ts":"2030-01-01T00:00:00Z","snapshot":true,"key":' || """ + ORDER_KEY_SQL + " || ',\"before\":null,\"after\":' || " + ORDER_SQL + """ || '}' "value" from orders""")
def q14_snapshot_orders(spark, sf):
    rows = envelope.envelopes(snap.snapshot(table(spark, sf, "orders"), "orders", ["o_orderkey"], NOW), envelope.Output(database=DATABASE))
    return envelope.change_records(rows).select("key", "topic", "value")


@query("select o_orderkey, ((row_number() over (order by o_orderkey) - 1) // 1000)::bigint page from orders")
def q15_snapshot_pages(spark, sf):
    return snap.pages(table(spark, sf, "orders"), ["o_orderkey"], 1000).select("o_orderkey", "page")


@query("select 'customer' tab, count(*) n from customer union all select 'orders', count(*) from orders union all select 'nation', count(*) from nation")
def q16_snapshot_multi(spark, sf):
    rows = snap.snapshots({t: (table(spark, sf, t), [k]) for t, k in ROUTED.items()}, NOW)
    return rows.groupBy(F.col("rel.table").alias("tab")).agg(F.count("*").alias("n"))


def images(spark, sf, unchanged):
    got = assemble.assemble(messages(spark, sf))
    rows = envelope.envelopes(got.events.withColumn("xid", F.col("event_lsn")), envelope.Output(unchanged=unchanged))
    return rows.select(event_number(F.col("txid")).alias("seq"), F.col("after")["event_type"].alias("event_type"), F.map_contains_key("after", F.lit("props")).alias("has_props"), F.col("after")["props"].alias("props"), F.col("before")["user_id"].alias("old_user"))


IMAGE_SQL = "{wal} select seq, case when op <> 'd' then event_type end event_type, case op when 'c' then true when 'u' then %s end has_props, case op when 'c' then props when 'u' then %s end props, case when op = 'd' then user_id::varchar end old_user from wal"


@query(IMAGE_SQL % ("false", "null"))
def q17_toast_omit(spark, sf):
    return images(spark, sf, "omit")


@query(IMAGE_SQL % ("true", "'__toast_unchanged'"))
def q18_toast_sentinel(spark, sf):
    return images(spark, sf, "sentinel")


@query("{wal} select op, count(*) n from wal group by op")
def q19_ops_histogram(spark, sf):
    return metrics.counted(assemble.assemble(messages(spark, sf)).events, ["op"])


HIST_SQL = " union all ".join([f"select '{b}' le, count(*) filter (n <= {b}) n from t" for b in metrics.TX_BYTES_BUCKETS] + ["select '+Inf', count(*) from t"])


@query(SIZED + ", t as (select sum(bytes) n from b group by txid) " + HIST_SQL)
def q20_tx_bytes_hist(spark, sf):
    return metrics.histogram(tx_bytes(spark, sf).transactions, F.col("n_bytes"), metrics.TX_BYTES_BUCKETS)


@query("{wal} select count(distinct txid) transactions_total, 0::bigint oversized_total, (max(lsn) + 8)::bigint last_read_lsn, greatest(0, epoch_us(timestamp '2030-01-01') - epoch_us(max(ts)))::bigint commit_lag_micros from wal")
def q21_commit_lag(spark, sf):
    return metrics.gauges(assemble.assemble(messages(spark, sf)).transactions, F.lit(NOW).cast("timestamp"))


@query("{wal} select txid, max(lsn)::bigint read_lsn, greatest(0, max(lsn) - max(case when seq % 3 = 0 then lsn else 0 end))::bigint lag_bytes from wal group by txid")
def q22_lag_bytes(spark, sf):
    rows = changes(spark, sf).groupBy("txid").agg(F.max("lsn").alias("read_lsn"), F.max(F.when(F.col("seq") % 3 == 0, F.col("lsn")).otherwise(0)).alias("done"))
    return rows.select("txid", "read_lsn", metrics.lag_bytes(F.col("read_lsn"), F.col("done")).alias("lag_bytes"))


@query("{wal} select txid, seq, ((row_number() over (partition by txid order by seq) - 1) // 2)::bigint chunk from wal")
def q23_chunking(spark, sf):
    return publish.chunked(changes(spark, sf), ["txid"], ["seq"], 2).select("txid", "seq", "chunk")


@query("{wal}, s as (select *, strlen(props) size from wal) select txid, count(*) n, sum(size)::bigint total_bytes, max(size)::bigint max_bytes, arg_max(event_type, row(size, -seq)) max_topic from s group by txid")
def q24_batch_summary(spark, sf):
    return publish.summary(changes(spark, sf), ["txid"], F.octet_length("props"), "seq", "event_type")


@query("select doc_id, strlen(text)::bigint bytes, 'record of ' || strlen(text) || ' bytes on topic docs exceeds 8000 bytes; raise the topic''s max.message.bytes' error from documents where strlen(text) > 8000")
def q25_too_large(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.lit("docs").alias("topic"), F.lit(None).cast("string").alias("key"), F.col("text").alias("value"))
    large = publish.split_oversized(rows, publish.record_bytes(F.col("key"), F.col("value")), 8000)[1]
    return large.select("doc_id", F.col("bytes").cast("bigint").alias("bytes"), "error")


@query("""with s as (select c_custkey, nullif(c_mktsegment, 'BUILDING') seg from customer),
m as (select c_custkey, case when c_custkey % 13 = 0 then 'X' else nullif(c_mktsegment, 'BUILDING') end seg from customer where c_custkey % 17 <> 0 union all select -c_custkey, 'Y' from customer where c_custkey % 19 = 0)
select coalesce(s.c_custkey, m.c_custkey) c_custkey, case when m.c_custkey is null then 'missing' when s.c_custkey is null then 'extra' else 'changed' end difference
from s full join m on s.c_custkey = m.c_custkey where m.c_custkey is null or s.c_custkey is null or s.seg is distinct from m.seg""")
def q26_parity_diff(spark, sf):
    source = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    kept = source.where("c_custkey % 17 <> 0").withColumn("seg", F.when(F.col("c_custkey") % 13 == 0, "X").otherwise(F.col("seg")))
    extra = table(spark, sf, "customer").where("c_custkey % 19 = 0").select((-F.col("c_custkey")).alias("c_custkey"), F.lit("Y").alias("seg"))
    return mirror.parity(source, kept.unionByName(extra), ["c_custkey"], ["seg"])


@query("{wal} select txid, seq, op from wal where txid % 4 <> 0")
def q27_dedup_replay(spark, sf):
    rows = changes(spark, sf)
    twice = rows.unionByName(rows.where("seq % 10 = 0"))
    return mirror.unpublished(twice, rows.where("txid % 4 = 0"), ["txid", "seq"]).select("txid", "seq", "op")


@query("""with b as (select min(ts) a, max(ts) z, 16777216 + max(event_id) * 64 lsn from events)
select 'cdc.__heartbeat' topic, regexp_replace(strftime(t, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z' as_of, """ + LSN_SQL + """ lsn from b, lateral (select unnest(generate_series(a, z, interval '5 hours 59 minutes 59.75 seconds')) t) s""")
def q28_heartbeats(spark, sf):
    span = table(spark, sf, "events").agg(F.min("ts").cast("timestamp").alias("start"), F.max("ts").cast("timestamp").alias("end"), (F.lit(log.LSN_BASE) + F.max("event_id") * log.LSN_STEP).alias("lsn"))
    return envelope.heartbeats(span, "5 hours 59 minutes 59.75 seconds", envelope.Output(database=DATABASE)).select("topic", F.col("timestamp").alias("as_of"), "lsn")


@query("""with v as (select event_id, (event_id % 41 - 20)::int m, (event_id % 5)::int d, ((event_id * 7654321) % 20000000001 - 10000000000)::bigint us from events),
p as (select *, abs(us) a, case when us < 0 then '-' else '' end s from v),
x as (select event_id, 'P' || case when m // 12 <> 0 and abs(m) >= 12 then trunc(m / 12)::int || 'Y' else '' end || case when m % 12 <> 0 then m % 12 || 'M' else '' end || case when d <> 0 then d || 'D' else '' end ||
 case when us = 0 then '' else 'T' || case when a // 3600000000 <> 0 then s || a // 3600000000 || 'H' else '' end || case when (a // 60000000) % 60 <> 0 then s || (a // 60000000) % 60 || 'M' else '' end ||
 case when a % 60000000 <> 0 then s || (a % 60000000) // 1000000 || case when a % 1000000 <> 0 then '.' || rtrim(lpad((a % 1000000)::varchar, 6, '0'), '0') else '' end || 'S' else '' end end t from p)
select event_id, case when t = 'P' then 'PT0S' else t end iso from x""")
def q29_interval_iso(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select("event_id", pgtypes.interval_text((e % 41 - 20).cast("int"), (e % 5).cast("int"), (e * 7654321) % 20000000001 - 10000000000).alias("iso"))


@query("select event_id, substr(lpad(bin(event_id % 65536), 16, '0'), 1, (event_id % 17)::int) bits from events")
def q30_bits(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select("event_id", pgtypes.bits_text(F.unhex(F.lpad(F.hex(e % 65536), 4, "0")), e % 17).alias("bits"))


RANGE_SQL = "case when event_id % 7 = 0 then 'empty' else case when event_id % 2 = 0 then '[' else '(' end || case when event_id % 3 = 0 then '' else (event_id % 100)::varchar end || ',' || (event_id % 100 + 9) || case when event_id % 5 = 0 then ']' else ')' end end"


def range_of(e):
    lower = F.when(e % 3 == 0, "u").when(e % 2 == 0, "i").otherwise("e")
    return pgtypes.range_text((e % 100).cast("string"), (e % 100 + 9).cast("string"), lower, F.when(e % 5 == 0, "i").otherwise("e"), e % 7 == 0)


@query("select event_id, " + RANGE_SQL.replace("case when event_id % 2 = 0 then '['", "case when event_id % 2 = 0 and event_id % 3 <> 0 then '['") + " range_text from events")
def q31_range_text(spark, sf):
    return table(spark, sf, "events").select("event_id", range_of(F.col("event_id")).alias("range_text"))


@query("select event_id, case event_id % 4 when 0 then '{}' when 1 then null else '{[1,' || event_id || '),[' || event_id + 5 || ',' || event_id + 9 || ')}' end multi from events")
def q32_multirange_text(spark, sf):
    e = F.col("event_id")
    part = lambda a, b: pgtypes.range_text(a.cast("string"), b.cast("string"), F.lit("i"), F.lit("e"), F.lit(False))
    ranges = F.when(e % 4 == 0, F.array().cast("array<string>")).when(e % 4 != 1, F.array(part(F.lit(1), e), part(e + 5, e + 9)))
    return table(spark, sf, "events").select("event_id", pgtypes.multirange_text(ranges).alias("multi"))


@query(r"select event_id, regexp_replace(md5(event_id::varchar), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') uuid, case when event_id % 2 = 0 then 'x' || event_id end plain from events")
def q33_uuid_text(spark, sf):
    e = F.col("event_id").cast("string")
    return table(spark, sf, "events").select("event_id", pgtypes.uuid_text(F.unhex(F.md5(e))).alias("uuid"), pgtypes.uuid_text(F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("x"), e).cast("binary"))).alias("plain"))


@query("""select event_id, 'kind="' || event_type || '"|props=' || case when event_id % 3 = 0 then 'null' else to_json(props)::varchar end || '|user="' || user_id || '"' key_string from events""")
def q34_key_string(spark, sf):
    m = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), F.col("event_type"), F.lit("props"), F.when(F.col("event_id") % 3 != 0, F.col("props")))
    return table(spark, sf, "events").select("event_id", cells.key_string(m).alias("key_string"))


@query("{wal}, k as (select * from wal where seq % 3 <> 0) select case op when 'c' then 'I' when 'u' then 'U' else 'D' end msg, count(*) n from k group by 1 union all select unnest(['B', 'C']), count(distinct txid) from wal group by 1 union all select 'R', 2")
def q35_publication_filter(spark, sf):
    """Every third change is of a table that isn't published; begins and commits all stay."""
    other = F.col("msg").isin("I", "U", "D") & (event_number(F.col("wal_start")) % 3 == 0)
    rows = messages(spark, sf).withColumn("rel_id", F.when(other, 2).otherwise(F.col("rel_id")))
    named = rows.where("msg = 'R'").withColumns({"rel_id": F.lit(2).cast("bigint"), "rel": F.col("rel").withField("schema", F.lit("audit"))})
    return metrics.counted(assemble.relevant(rows.unionByName(named), spark.createDataFrame([("public", "events")], "schema string, table string")), ["msg"])


@query("""select p_partkey, case when p_partkey % 3 = 0 then 'public' when p_partkey % 3 = 1 then p_brand else 'none' end "schema", 't' || p_partkey tab, p_partkey % 3 < 2 and p_partkey % 4 in (0, 1) there from part""")
def q36_existing_tables(spark, sf):
    """Tables, partitioned tables, views and indexes by turns; every third name is in a schema that has none."""
    k, tab = F.col("p_partkey"), F.concat(F.lit("t"), F.col("p_partkey").cast("string"))
    parts = table(spark, sf, "part")
    catalog = parts.select(F.when(k % 3 == 0, "public").otherwise(F.col("p_brand")).alias("schema"), tab.alias("table"), F.substring(F.lit("rpvi"), (k % 4 + 1).cast("int"), F.lit(1)).alias("kind"))
    wanted = parts.select("p_partkey", F.when(k % 3 == 0, tab).when(k % 3 == 1, F.concat("p_brand", F.lit("."), tab)).otherwise(F.concat(F.lit("none."), tab)).alias("name"))
    there, gone = snap.existing(wanted.select("name"), catalog)
    marked = there.withColumn("there", F.lit(True)).unionByName(gone.withColumn("there", F.lit(False)))
    return marked.join(wanted, "name").select("p_partkey", "schema", F.col("table").alias("tab"), "there")


@query("select p_partkey, case when p_partkey % 3 = 0 then p_brand else 's' || p_size end \"schema\", p_name tab from (select *, case when p_partkey % 3 = 0 then p_brand || '.' || p_name else 's' || p_size || '.' || p_name end q from part) where p_partkey % 5 <> 0 union all select p_partkey, 'public', replace(p_name, '.', '') from part where p_partkey % 5 = 0")
def q37_qualified_name(spark, sf):
    p = table(spark, sf, "part")
    name = F.when(F.col("p_partkey") % 5 == 0, F.regexp_replace("p_name", r"\.", "")).when(F.col("p_partkey") % 3 == 0, F.concat("p_brand", F.lit("."), "p_name")).otherwise(F.concat(F.lit("s"), F.col("p_size").cast("string"), F.lit("."), "p_name"))
    return p.select("p_partkey", names.schema_of(name).alias("schema"), names.table_of(name).alias("tab"))


@query("{wal}, o as (select *, lag(event_type) over (partition by user_id order by seq) old_type from wal) select seq, user_id, old_type, event_type new_type from o where op = 'u' and old_type is not null")
def q38_before_after_update(spark, sf):
    """Updates that log the whole row as it was before, as they do where a table's identity is the full row."""
    user = F.coalesce(F.col("after")[0]["text"], F.col("before")[0]["text"])
    events = changes(spark, sf).select(F.col("lsn").alias("_lsn"), F.lag("event_type").over(Window.partitionBy("user_id").orderBy("seq")).alias("_old"))
    rows = messages(spark, sf).join(events, F.col("wal_start") == F.col("_lsn"), "left")
    before = F.array(log.cell(user), log.cell(F.col("_old")), log.unchanged_cell(), log.unchanged_cell())
    rows = rows.withColumn("before", F.when((F.col("msg") == "U") & F.col("_old").isNotNull(), before).otherwise(F.col("before"))).drop("_lsn", "_old")
    got = envelope.envelopes(assemble.assemble(rows).events).where("op = 'u' and before is not null")
    return got.select(event_number(lsn_number(F.col("lsn"))).alias("seq"), F.col("after")["user_id"].cast("bigint").alias("user_id"), F.col("before")["event_type"].alias("old_type"), F.col("after")["event_type"].alias("new_type"))


@query("{wal} select txid, count(*) n, count(distinct user_id) users from wal where op <> 'd' group by txid")
def q39_json_extract(spark, sf):
    """Records are parsed again, as a consumer would."""
    got = assemble.assemble(messages(spark, sf))
    records = envelope.change_records(envelope.envelopes(got.events, envelope.Output(database=DATABASE)))
    rows = mirror.from_records(records, {"user_id": "bigint", "event_type": "string"}, ["user_id"])
    return rows.where("op <> 'd'").groupBy(F.col("ver").alias("txid")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("{wal} select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M') \"hour\", op, count(*) n from wal group by 1, 2")
def q40_changes_per_hour(spark, sf):
    return windows.changes_per_window(timed(spark, sf), "at", ["op"], "1 hour").select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "op", "n")


@query("""{wal}, g as (select *, case when ts < lag(ts) over w + interval 6 hour then 0 else 1 end new from wal window w as (partition by user_id order by ts, seq)),
s as (select *, sum(new) over (partition by user_id order by ts, seq rows unbounded preceding) no from g)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') "start", count(*) n from s group by user_id, no""")
def q41_session_changes(spark, sf):
    return windows.sessions(timed(spark, sf), "at", ["user_id"], "6 hours").select("user_id", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("{wal} select op, event_type, count(*) n from wal group by cube (op, event_type)")
def q42_cube_ops(spark, sf):
    return changes(spark, sf).cube("op", "event_type").agg(F.count("*").alias("n"))


@query("{wal} select txid, 'o' || count(*) || '-' || string_agg(op, '' order by seq) shape from wal group by txid")
def q43_event_order(spark, sf):
    events = assemble.assemble(messages(spark, sf)).events
    return events.groupBy(F.col("xid").alias("txid")).agg(F.array_sort(F.collect_list(F.struct("ordinal", "op"))).alias("x")).select("txid", F.concat(F.lit("o"), F.size("x").cast("string"), F.lit("-"), F.array_join(F.transform("x", lambda y: y["op"]), "")).alias("shape"))


@query("{wal} select seq, (seq % 4 + 1)::bigint in_flight from wal where seq % 8 < 4")
def q44_in_flight(spark, sf):
    """Four batches begin, then four end; how many are on their way at each begin."""
    batches = changes(spark, sf).select(F.lit("events").alias("slot"), "seq", F.when(F.col("seq") % 8 < 4, "start").otherwise("done").alias("event"))
    return progress.in_flight(batches, ["slot"], "seq").where("event = 'start'").select("seq", "in_flight")


@query("{wal} select seq, op from wal where txid = 5")
def q45_outside_changes(spark, sf):
    """Changes after a commit, whose begin was lost, stand in no transaction."""
    tx = F.floor(F.col("seq") / 8) - 1
    rows = messages(spark, sf).where(~((F.col("msg") == "B") & (tx == 5)))
    out = assemble.assemble(rows).outside
    op = F.when(F.col("msg") == "I", "c").when(F.col("msg") == "U", "u").otherwise("d")
    return out.select(event_number(F.col("wal_start")).alias("seq"), op.alias("op"))


@query("""select 'source' side, c_custkey from customer where c_custkey % 17 = 0 and c_custkey <> 0 union all select 'mirror', -c_custkey from customer where c_custkey % 19 = 0 and c_custkey <> 0""")
def q46_set_difference(spark, sf):
    source = table(spark, sf, "customer").select("c_custkey")
    other = source.where("c_custkey % 17 <> 0").unionByName(source.where("c_custkey % 19 = 0").select((-F.col("c_custkey")).alias("c_custkey")))
    return mirror.difference(source, other).select("side", "c_custkey")


@query("select s_suppkey, to_json({'s_acctbal': null, 's_name': s_name, 's_suppkey': s_suppkey::varchar})::varchar \"key\" from supplier")
def q47_key_without_primary(spark, sf):
    """A table without a key: all columns are the key, nulls too."""
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.lit(None).cast("double").alias("s_acctbal"))
    out = envelope.envelopes(snap.snapshot(rows, "supplier", [], NOW), envelope.Output(database=DATABASE))
    return out.select(F.col("after")["s_suppkey"].cast("bigint").alias("s_suppkey"), cells.json(F.col("key")).alias("key"))


@query("{wal} select max(lsn) - min(lsn) bytes_read, count(*) + 2 * count(distinct txid) + 2 messages, count(distinct txid) transactions from wal")
def q48_wal_counters(spark, sf):
    rows = messages(spark, sf)
    read = F.max(F.when(F.col("msg").isin("I", "U", "D"), F.col("wal_start"))) - F.min(F.when(F.col("msg").isin("I", "U", "D"), F.col("wal_start")))
    return rows.agg(read.alias("bytes_read"), F.count("*").alias("messages"), F.count_if(F.col("msg") == "C").alias("transactions"))


@query("""select o_orderkey, '{"at":["' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '"],"bits":"' || substr(lpad(bin(o_orderkey % 256), 8, '0'), 1, (o_orderkey % 9)::int) || '","codes":[' || (o_orderkey % 7) || ',null],"days":"[' || strftime(o_orderdate, '%Y-%m-%d') || ',)","gone":null,"held":["P' || (o_orderkey % 3 + 1) || 'M","PT0S"],"id":"' || regexp_replace(md5(o_orderkey::varchar), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') || '","ids":["' || regexp_replace(md5('x' || o_orderkey), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') || '"],"many":"{[1,' || o_orderkey % 50 + 2 || '),empty}","ok":' || (o_orderkey % 2 = 0) || ',"price":' || o_totalprice || ',"span":"P' || (o_orderkey % 5 + 1) || 'DT1.5S","times":"(,' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || ']"}' "after", '{"id":"' || regexp_replace(md5(o_orderkey::varchar), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') || '"}' "key" from orders""")
def q49_typed_snapshot(spark, sf):
    """Native values of a snapshot as JSON has them: UUIDs, intervals, bit strings, ranges, multiranges and arrays."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    interval = lambda months, days, micros: F.struct(F.lit(months).cast("int").alias("months") if not isinstance(months, Column) else months.cast("int").alias("months"), (F.lit(days) if not isinstance(days, Column) else days).cast("int").alias("days"), F.lit(micros).cast("bigint").alias("micros"))
    ends = lambda low, high, low_type, high_type: F.struct(low.alias("lower"), high.alias("upper"), F.lit(low_type).alias("lower_type"), F.lit(high_type).alias("upper_type"))
    none = F.lit(None).cast("bigint")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.unhex(F.md5(k.cast("string"))).alias("id"), F.array(F.unhex(F.md5(F.concat(F.lit("x"), k.cast("string"))))).alias("ids"), interval(0, k % 5 + 1, 1_500_000).alias("span"),
        F.array(interval(k % 3 + 1, 0, 0), interval(0, 0, 0)).alias("held"), F.struct(F.unhex(F.lpad(F.hex(k % 256), 2, "0")).alias("bits"), (k % 9).alias("length")).alias("bits"),
        ends(F.to_date(day), F.lit(None).cast("date"), "i", "u").alias("days"), ends(F.lit(None).cast("timestamp"), day.cast("timestamp"), "u", "i").alias("times"),
        F.array(ends(F.lit(1).cast("bigint"), k % 50 + 2, "i", "e"), ends(none, none, "empty", "empty")).alias("many"), F.array(k % 7, none).alias("codes"),
        (k % 2 == 0).alias("ok"), F.col("o_totalprice").alias("price"), F.array(day.cast("timestamp")).alias("at"), F.lit(None).cast("string").alias("gone"),
    )
    got = snap.snapshot(rows, "orders", ["id"], NOW, typed=True, oids={"id": 2950, "ids": 2951, "many": 4536})
    got = got.withColumns({"o_orderkey": F.filter("after", lambda v: v["name"] == "o_orderkey")[0]["text"].cast("bigint"), "after": F.filter("after", lambda v: v["name"] != "o_orderkey")})
    records = envelope.envelopes(got.withColumn("slot", F.col("o_orderkey").cast("string")), envelope.Output(database=DATABASE, typed="snapshot"))
    return records.select(F.col("slot").cast("bigint").alias("o_orderkey"), cells.json(F.col("after")).alias("after"), cells.json(F.col("key")).alias("key"))


@query("{wal} select seq, '{\"event_type\":\"' || event_type || '\",\"props\":{\"k\":' || regexp_extract(props, '[0-9]+') || '},\"user_id\":' || user_id || ',\"value\":\"' || value || '\"}' \"after\" from wal where op = 'c' and txid < 1000")
def q50_typed_log(spark, sf):
    """Logged text as JSON values of its type; 701 is compared as text, since the engines print doubles differently."""
    relation = lambda rel: rel.withField("columns", F.transform(rel["columns"], lambda c: c.withField("type_oid", F.when(c["type_oid"] == 701, 25).otherwise(c["type_oid"]).cast("bigint"))))
    rows = messages(spark, sf).withColumn("rel", relation(F.col("rel")))
    got = envelope.envelopes(assemble.assemble(rows).events.where("op = 'c' and xid < 1000"), envelope.Output(typed="all"))
    return got.select(event_number(lsn_number(F.col("lsn"))).alias("seq"), cells.json(F.col("after")).alias("after"))


START = log.LSN_BASE + 64 * 503


@query("{wal} select txid xid, count(*) n_events from wal where txid > 100 group by txid")
def q51_start_position(spark, sf):
    """Reading from a position within a transaction: its begin is gone, so it goes too; relations before it stay."""
    path = scale.shared_path(spark, "log")
    messages(spark, sf).write.parquet(path)
    got = assemble.assemble(wal.read_messages(spark, path, START))
    named = got.events.where("rel.table = 'events'").groupBy("slot", "tx_no").agg(F.count("*").alias("n"))
    return got.transactions.join(named, ["slot", "tx_no"]).where("n = n_events").select("xid", "n_events")


@query("select n_regionkey::bigint region, case when n_regionkey % 2 = 0 then 'region,nation' else 'nation,region,name' end pk from nation group by n_regionkey")
def q52_primary_keys(spark, sf):
    """Key columns in the order of the index and not of the table; indexes that aren't primary don't count."""
    r = F.col("n_regionkey")
    regions = table(spark, sf, "nation").select("n_regionkey").distinct()
    name = [F.lit("public").alias("schema"), F.concat(F.lit("t"), r.cast("string")).alias("table")]
    indexes = regions.select(*name, F.when(r % 2 == 0, F.array(F.lit(3), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(3), F.lit(2))).alias("columns"), F.lit(True).alias("is_primary"))
    other = regions.select(*name, F.array(F.lit(2)).alias("columns"), F.lit(False).alias("is_primary"))
    attributes = regions.select(*name, F.posexplode(F.array(F.lit("nation"), F.lit("name"), F.lit("region"))).alias("number", "name")).withColumn("number", F.col("number") + 1)
    got = snap.primary_keys(indexes.unionByName(other), attributes)
    return got.select(F.substring("table", 2, 9).cast("bigint").alias("region"), F.array_join("pk", ",").alias("pk"))


@query("{wal} select op, count(*) n from wal group by op")
def q53_ignored_kinds(spark, sf):
    """Truncate, type, origin and unknown messages between the others change nothing."""
    rows = messages(spark, sf)
    odd = rows.where("msg in ('I', 'U')").withColumn("msg", F.element_at(F.array(*[F.lit(x) for x in "TYOM"]), (F.col("seq") % 4 + 1).cast("int")))
    return metrics.counted(assemble.assemble(rows.unionByName(odd)).events, ["op"])


@query(LOST_SQL + "select count(*) filter (msg = 'C') - (select count(*) from t where until is not null) ignored, (select count(*) from t where until is null) discarded, count(*) filter (msg = 'change' and (until is not null and pos > until or no = 0)) outside from n left join t using (no)")
def q54_stray_messages(spark, sf):
    """Commits that end nothing, begins that nothing ends, and changes outside of transactions."""
    rows = lossy_messages(spark, sf)
    got = assemble.assemble(rows)
    tagged = [df.select(F.lit(name).alias("what")) for name, df in (("commit", rows.where("msg = 'C'")), ("begin", rows.where("msg = 'B'")), ("kept", got.transactions), ("outside", got.outside))]
    n = lambda what: F.count_if(F.col("what") == what)
    return functools.reduce(DataFrame.unionByName, tagged).agg((n("commit") - n("kept")).alias("ignored"), (n("begin") - n("kept")).alias("discarded"), n("outside").alias("outside"))


@query("{wal} select txid, count(*) n from wal group by txid")
def q55_mirror_without_markers(spark, sf):
    """A topic that holds changes, transaction markers and heartbeats: only changes reach the mirror."""
    got, out = assemble.assemble(messages(spark, sf)), envelope.Output(database=DATABASE)
    rows = envelope.envelopes(got.events, out)
    records = envelope.change_records(rows).select("topic", "key", "value").unionByName(envelope.markers(rows, got.transactions, out).select("topic", "key", "value"))
    span = spark.range(1).select(F.lit(NOW).cast("timestamp").alias("start"), F.lit(NOW).cast("timestamp").alias("end"), F.lit(1).cast("bigint").alias("lsn"))
    records = records.unionByName(envelope.heartbeats(span, "1 hour", out).select("topic", "key", "value"))
    return metrics.counted(mirror.from_records(records, {"user_id": "bigint"}, ["user_id"]).select(F.col("ver").alias("txid")), ["txid"])


@query("{wal} select seq, lsn \"write\", case when seq % 3 = 0 then lsn else lsn - 64 end \"flush\", case when seq % 2 = 0 and lsn > 16777216 then lsn end flushed from wal")
def q56_standby_status(spark, sf):
    """What a reader reports, and what is to be flushed."""
    rows = changes(spark, sf).withColumn("confirmed", F.when(F.col("seq") % 3 == 0, 0).otherwise(F.col("lsn") - 64)).withColumn("status", progress.standby_status(F.col("lsn"), F.col("confirmed")))
    due = progress.to_flush(rows.select("seq", F.col("lsn").alias("pending"), F.when(F.col("seq") % 2 == 0, F.lit(16777216)).otherwise(F.col("lsn")).alias("flushed")))
    return rows.join(due.select("seq", F.col("pending").alias("flushed")), "seq", "left").select("seq", "status.write", "status.flush", "flushed")


@query(SIZED + f""", t as (select txid, sum(bytes) n, max(lsn) + 8 lsn from b group by txid)
select 'transactions_total' name, count(*) filter (n <= {OVERSIZED}) "value" from t union all select 'oversized_total', count(*) filter (n > {OVERSIZED}) from t union all select 'last_read_lsn', max(lsn) filter (n <= {OVERSIZED}) from t
union all select 'relation_cache', 2 union all select 'wal_messages_total', count(*) + 4 * count(distinct txid) + 4 from wal""")
def q57_engine_metrics(spark, sf):
    """Counters and gauges of a log in which some transactions are too large; relations count by their newest version."""
    rows = messages(spark, sf)
    doubled = rows.unionByName(rows.where("msg in ('B', 'C', 'R')").withColumns({"slot": F.lit("idle"), "rel_id": F.when(F.col("msg") == "R", 2).cast("bigint")}))
    got = metrics.gauges(assemble.assemble(rows, OVERSIZED).transactions, F.lit(NOW).cast("timestamp")).drop("commit_lag_micros")
    long = lambda df: df.unpivot([], df.columns, "name", "value")
    return long(got).unionByName(long(metrics.log_counters(doubled)))


PARTS = 5
PART_SQL = f"select *, seq * {PARTS} // (max(seq) over () + 1) part from wal"


def kept_mirror_of_parts(spark, sf, parts: int) -> KeptMirror:
    """The log in batches by position, each applied as it comes. After the third all is compacted; then come the second
    once more under its own number, and the third as if it were another."""
    rows = changes(spark, sf)
    end = (rows.agg(F.max("seq")).first()[0] or 0) + 1
    part = lambda k: rows.where(F.floor(F.col("seq") * PARTS / end) == k)
    kept = KeptMirror(spark, scale.shared_path(spark, "kept-mirror"), ["user_id"], ["txid", "lsn"], "lsn")
    for k in range(parts):
        kept.apply(part(k), k, F.col("op") == "d")
        if k == 2:
            kept.compact(frontier=log.LSN_BASE + log.LSN_STEP * (-(-3 * end // PARTS) - 1))
            kept.apply(part(1), 1, F.col("op") == "d")
            kept.apply(part(2), "late", F.col("op") == "d")
    return kept


MIRROR = ["user_id", "event_type", "value", "txid as ver", "lsn"]
MIRROR_SQL = "r as (select *, row_number() over (partition by user_id order by txid desc, lsn desc) rn from {rows}) select user_id, event_type, value, txid as ver, lsn from r where rn = 1 and op <> 'd'"


@query("{wal}, " + MIRROR_SQL.replace("{rows}", "wal"))
def q58_mirror_kept(spark, sf):
    """A mirror that batches are added to, compacted on the way, holds what the whole history gives."""
    return kept_mirror_of_parts(spark, sf, PARTS).read().selectExpr(*MIRROR)


@query("{wal}, p as (" + PART_SQL + "), " + MIRROR_SQL.replace("{rows}", "p where part < 2"))
def q59_mirror_as_of(spark, sf):
    """The same mirror as it was after its second batch, read when later ones and a compaction are there."""
    return kept_mirror_of_parts(spark, sf, PARTS).read(version=2).selectExpr(*MIRROR)


@query("{wal}, " + MIRROR_SQL.replace("{rows}", "wal") + " and user_id in (select c_custkey from customer where c_custkey % 20 = 3)")
def q60_mirror_lookup(spark, sf):
    """Rows of some keys, out of the files of their buckets alone."""
    keys = table(spark, sf, "customer").where("c_custkey % 20 = 3").select(F.col("c_custkey").alias("user_id"))
    return kept_mirror_of_parts(spark, sf, PARTS).lookup(keys).selectExpr(*MIRROR)


@query("select conv_id, turn, ((row_number() over (order by conv_id, turn) - 1) // 100)::bigint page from conversations")
def q61_pages_two_columns(spark, sf):
    return snap.pages(table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id", "turn"], 100).select("conv_id", "turn", "page")


@query("select p_name, p_partkey, ((row_number() over (order by p_name, p_partkey) - 1) // 64)::bigint page from part")
def q62_pages_text_key(spark, sf):
    return snap.pages(table(spark, sf, "part"), ["p_name", "p_partkey"], 64).select("p_name", "p_partkey", "page")


@query(r"""with k as (select regexp_replace(md5(o_orderkey::varchar), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') id from orders),
p as (select id, (row_number() over (order by id) - 1) // 500 page from k)
select page::bigint page, min(id) first_id, max(id) last_id, count(*) n from p group by page""")
def q63_page_bounds_uuid(spark, sf):
    """First and last key of each page of a table whose key is a UUID."""
    rows = table(spark, sf, "orders").select(pgtypes.uuid_text(F.unhex(F.md5(F.col("o_orderkey").cast("string")))).alias("id"))
    bounds = snap.page_bounds(snap.pages(rows, ["id"], 500), ["id"])
    return bounds.select("page", F.col("first.id").alias("first_id"), F.col("last.id").alias("last_id"), "n")


@query("""with p as (select c_mktsegment seg, c_custkey k, row_number() over (order by c_mktsegment, c_custkey) rn, count(*) over () n from customer)
select k c_custkey, seg from p where rn > n // 3""")
def q64_snapshot_resumed(spark, sf):
    """A snapshot that stopped after a third of its rows goes on after the last key that it had."""
    rows, key = table(spark, sf, "customer"), ["c_mktsegment", "c_custkey"]
    stop = rows.count() // 3
    at = scale.numbered(rows.select(*key), key, "rn").where(F.col("rn") == stop).first()
    rest = rows if at is None else snap.rest_from(rows, key, [at[k] for k in key])
    return rest.select("c_custkey", F.col("c_mktsegment").alias("seg"))


@query(SIZED + f""", t as (select txid, sum(bytes) n, max(lsn) last from b group by txid),
s as (select 'events' slot, txid, last + 8 lsn, n <= {OVERSIZED} and (last // 64) % 997 = 996 as waits from t
  union all select 'audit', txid, last + 8, n <= {OVERSIZED} and txid % 331 = 330 from t where txid % 2 = 0),
f as (select slot, min(txid) filter (waits) stop from s group by slot)
select slot, coalesce(max(lsn) filter (stop is null or txid < stop), 0)::bigint lsn, count(*) filter (stop is null or txid < stop) n, count(*) filter (txid >= stop) "open" from s join f using (slot) group by slot""")
def q65_slot_frontier(spark, sf):
    """Two slots of which some transactions aren't acknowledged, and those that are too large needn't be."""
    rows = messages(spark, sf)
    other = rows.where((F.col("msg") == "R") | ((F.floor(F.col("seq") / 8) - 1) % 2 == 0)).withColumn("slot", F.lit("audit"))
    got = assemble.assemble(rows.unionByName(other), OVERSIZED).transactions
    acked = F.when(F.col("slot") == "audit", F.col("xid") % 331 != 330).otherwise(F.floor((F.col("commit_lsn") - 8) / 64) % 997 != 996)
    return progress.frontier(got, got.select("slot", "tx_no", acked.alias("acked")))


@query("{wal} select event_type topic, (seq % 4)::varchar batch, count(*) n, sum(strlen(props))::bigint bytes from wal group by all")
def q66_file_batches(spark, sf):
    """Batches of files, one of them written twice and one by a writer that was lost before its commit."""
    records = changes(spark, sf).select("seq", F.col("event_type").alias("topic"), F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"))
    sink = FileSink(scale.shared_path(spark, "batches"))
    sink.save(records, "records", batch_name(0, ""), "lost", True)
    for k in (0, 1, 2, 3, 1):
        sink.write(records.where(F.col("seq") % 4 == k).drop("seq"), k)
    return sink.read(spark).groupBy("topic", F.col("batch").cast("int").cast("string").alias("batch")).agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).cast("bigint").alias("bytes"))
