"""Tuples of cells: decoding, keys, before and after images, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeloom.model import BOOLEAN_OID, INTEGER_OIDS, JSON_OIDS, NUMBER_OIDS, UNCHANGED


def decoded(cells: Column, columns: Column) -> Column:
    """Cells with their columns, by place. A cell beyond the columns has the name '' and type 0; with no relation at
    all names are col_0, col_1, ... and every value is null, as nothing says how to read it. Null stays null."""

    def known(cell: Column, i: Column) -> Column:
        text, column = F.when(cell["kind"].isin("n", "u"), F.lit(None)).otherwise(cell["text"]), F.get(columns, i)
        return F.struct(F.coalesce(column["name"], F.lit("")).alias("name"), F.coalesce(column["type_oid"], F.lit(0).cast("bigint")).alias("type_oid"), cell["kind"].alias("kind"), text.alias("text"), F.coalesce(column["is_key"], F.lit(False)).alias("is_key"))

    def unknown(cell: Column, i: Column) -> Column:
        return F.struct(F.concat(F.lit("col_"), i.cast("string")).alias("name"), F.lit(0).cast("bigint").alias("type_oid"), F.lit("n").alias("kind"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("is_key"))

    return F.when(columns.isNull(), F.transform(cells, unknown)).otherwise(F.transform(cells, known))


def let(value: Column, body) -> Column:
    """body(value) with value computed once for each row, however often body refers to it."""
    return F.transform(F.array(value), body)[0]


def image(values: Column, unchanged: str = "omit", typed: bool = False) -> Column:
    """name -> text of a decoded tuple, by sorted names, null for an empty one; typed: name -> its variant. Values that
    the log didn't send are left out, or stand as a sentinel where unchanged is "sentinel". The last of equal names
    counts. The names are sorted once, so the cost is about linear in the columns."""
    kept = values if unchanged == "sentinel" else F.filter(values, lambda v: v["kind"] != "u")
    sent = lambda v: v["value"] if typed else v["text"]
    sentinel = F.lit(UNCHANGED).cast("variant") if typed else F.lit(UNCHANGED)

    def mapped(v: Column) -> Column:
        order = F.sort_array(F.transform(v, lambda x, i: F.struct(x["name"].alias("name"), i.alias("at"))))  # no element is null
        last = let(order, lambda o: F.filter(o, lambda x, i: ~x["name"].eqNullSafe(F.get(o, i + 1)["name"])))
        entry = lambda x: F.struct(x["name"].alias("key"), let(F.get(v, x["at"]), lambda c: F.when(c["kind"] == "u", sentinel).otherwise(sent(c))).alias("value"))
        return F.when(F.size(v) > 0, F.map_from_entries(F.transform(last, entry)))

    return let(kept, mapped)


def key_values(before: Column, after: Column) -> Column:
    """The values of the key: of the after image if it has any, else of the before image; all of them where no column
    is a key. A key that the log didn't send with the after image comes from before, where that has it."""
    old = lambda v: F.filter(before, lambda b: (b["name"] == v["name"]) & (b["kind"] == "t"))[0]
    known = lambda v: F.when((v["kind"] == "u") & before.isNotNull(), F.coalesce(old(v), v)).otherwise(v)

    def chosen(row: Column) -> Column:
        return let(F.filter(row, lambda v: v["is_key"]), lambda keyed: F.transform(F.when(F.size(keyed) > 0, keyed).otherwise(row), known))

    return let(F.when(F.size(after) > 0, after).otherwise(before), chosen)


def sorted_map(m: Column) -> Column:
    """A map with its keys in order, so that its JSON is the same wherever it is written."""
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def typed_values(values: Column) -> Column:
    """A decoded tuple with the field value: the text as a variant by its type, so that numbers, booleans and JSON are
    such in the output. Text that isn't of its type, like NaN, stays text."""

    def one(v: Column) -> Column:
        text, oid = v["text"], v["type_oid"]
        as_ = lambda c: c.cast("variant")
        number = F.when(oid.isin(*INTEGER_OIDS), as_(text.try_cast("bigint"))).when(oid.isin(*NUMBER_OIDS), F.try_parse_json(text))
        other = F.when(oid == BOOLEAN_OID, as_(text.isin("t", "true"))).when(oid.isin(*JSON_OIDS), F.try_parse_json(text))
        value = F.when(text.isNotNull(), F.coalesce(number, other, as_(text)))
        return F.struct(*[v[c].alias(c) for c in ("name", "type_oid", "kind", "text", "is_key")], value.alias("value"))

    return F.transform(values, one)


def json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_scalar(text: Column) -> Column:
    """A string as JSON has it; null is null."""
    return F.coalesce(F.regexp_extract(json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit("null"))


def key_string(m: Column) -> Column:
    """k=json|k=json by sorted keys of a map of texts; nothing for an empty or null map."""
    part = lambda k: F.concat(k, F.lit("="), json_scalar(m[k]))
    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_keys(m)), part), "|"), F.lit(""))


def tuple_bytes(values: Column) -> Column:
    """What a decoded tuple counts for: bytes of each name and value, and 32 for each cell."""
    return F.coalesce(F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + F.octet_length(v["name"]) + F.coalesce(F.octet_length(v["text"]), F.lit(0)) + 32), F.lit(0).cast("bigint"))


def change_bytes(before: Column, after: Column) -> Column:
    return F.lit(64) + tuple_bytes(before) + tuple_bytes(after)


def logged_bytes(before: Column, after: Column, columns: Column) -> Column:
    """change_bytes() of tuples that aren't decoded."""
    known = lambda c, i: 32 + F.coalesce(F.octet_length(F.get(columns, i)["name"]), F.lit(0)) + F.when(c["kind"].isin("n", "u"), 0).otherwise(F.coalesce(F.octet_length(c["text"]), F.lit(0)))
    unknown = lambda c, i: 32 + F.octet_length(F.concat(F.lit("col_"), i.cast("string")))
    summed = lambda sizes: F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    of = lambda cells: F.coalesce(summed(F.when(columns.isNull(), F.transform(cells, unknown)).otherwise(F.transform(cells, known))), F.lit(0).cast("bigint"))
    return F.lit(64) + of(before) + of(after)
