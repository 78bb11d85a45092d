"""URL filters: curated rules by host and path, and rules that Spark's FP-growth mines from labelled URLs."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.text import ascii_lower, let, small_side, stored

#: The curated rules: verdict and host with path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
LABEL = "label="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z lower-cased. Path: from there up to ? or #. Without ://, or for
    null, both are empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. A rule fits its host and its subdomains if
    the path starts with the rule's path."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, tail = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + tail)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: each suffix of the host, words of the host, segments of the path with digits as 0."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = let(labels, lambda h: F.transform(F.sequence(F.lit(1), F.size(h)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(h, i, F.size(h)), "."))))
    words = F.transform(F.filter(F.split(host, r"[.-]+"), lambda x: x != ""), lambda x: F.concat(F.lit("word="), x))
    parts = F.filter(F.split(F.regexp_replace(ascii_lower(path), "[0-9]+", "0"), "/"), lambda x: x != "")
    parts = F.transform(parts, lambda x: F.concat(F.lit("path="), x))
    return F.array_distinct(F.when(F.length(host) > 0, F.concat(suffixes, words, parts)).otherwise(parts))


class Mined(NamedTuple):
    """rules: items (array, sorted), verdict, confidence, support. members: token, item; an item stands for tokens that
    always come together among the labelled URLs, and a URL has it if it has one of them."""

    rules: DataFrame
    members: DataFrame


RULE = "items array<string>, verdict string, confidence double, support double"


def frequent_items(baskets: DataFrame, least: int) -> DataFrame:
    """Of baskets (basket, tokens, verdict) the tokens that at least `least` of them hold: token, item, uses, and
    verdict where all baskets with the token have the same one. Tokens that the same baskets hold, by two 64-bit sums
    over these, are one item, named by the least of them. There are at most all tokens / least such rows."""
    seen = baskets.select("basket", F.xxhash64("verdict").alias("v"), F.explode("tokens").alias("token"))
    stats = seen.groupBy("token").agg(
        F.count("*").alias("uses"), F.bit_xor(F.xxhash64("basket")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "basket")).alias("y"), F.min("v").alias("low"), F.max("v").alias("high"),
    )
    stats = stored(stats.where(F.col("uses") >= least), "url-tokens")
    items = stats.groupBy("uses", "x", "y").agg(F.min("token").alias("item"))
    names = baskets.select("verdict").distinct().select(F.xxhash64("verdict").alias("low"), "verdict")
    pure = stats.join(items, ["uses", "x", "y"]).join(names, "low").withColumn("verdict", F.when(F.col("low") == F.col("high"), F.col("verdict")))
    return pure.select("token", "item", "uses", "verdict")


def indexed(rules: DataFrame) -> DataFrame:
    """An inverted index of rules: each once, under the item that the fewest rules have."""
    posting = rules.select("items", F.explode("items").alias("item"))
    spread = posting.groupBy("item").agg(F.count("*").alias("uses"))
    rarest = posting.join(spread, "item").groupBy("items").agg(F.min_by("item", F.struct("uses", "item")).alias("item"))
    return rules.join(rarest, "items").select(F.col("items").alias("rule_items"), "verdict", "confidence", "support", "item")


def pruned(rules: DataFrame) -> DataFrame:
    """rules without those that only narrow a rule for the same verdict of at least the same confidence."""
    wider = indexed(rules).select("rule_items", "item", "verdict", F.col("confidence").alias("wider_confidence"))
    narrow = rules.withColumn("item", F.explode("items")).join(wider, ["item", "verdict"])
    covered = narrow.where((F.size("rule_items") < F.size("items")) & (F.col("wider_confidence") >= F.col("confidence")) & (F.size(F.array_except("rule_items", "items")) == 0))
    return rules.join(covered.select("items", "verdict").distinct(), ["items", "verdict"], "left_anti").select("items", "verdict", "confidence", "support")


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.9, min_count: int = 20, max_broadcast: int = 100_000) -> Mined:
    """Association rules from labelled (tokens, verdict), by FP-growth over the tokens with the verdict as one more
    item; each URL is one basket, however long. A rule holds for min_support of the baskets and for min_count of them
    at least, so a few URLs make no rule, and has min_confidence. Of rules for one verdict, those that only narrow a
    rule of at least the same confidence go.

    Item sets grow as 2 to the power of a basket's items, so baskets first lose what can't change these rules: tokens
    below the support; and all but one of the tokens that the same baskets hold, since they make the same rules. A token
    that only ever comes with one verdict gets a basket of its own, with that verdict, for each URL that has it: FP-growth
    finds its rule there, of confidence 1, and every rule of more items with it would narrow that one, or have
    confidence 0. So all rules come out of FP-growth's frequent sets. No labelled rows give no rules.
    """
    spark = labelled.sparkSession
    baskets = stored(labelled.where((F.size("tokens") > 0) & F.col("verdict").isNotNull()).select("tokens", "verdict", F.monotonically_increasing_id().alias("basket")), "url-baskets")
    n = baskets.count()
    least = max(math.ceil(min_support * n), min_count)
    if n < least:
        return Mined(spark.createDataFrame([], RULE), spark.createDataFrame([], "token string, item string"))
    frequent = stored(frequent_items(baskets, least), "url-items")
    known = frequent.where("verdict is null or token = item").select("token", "item", F.when(F.col("verdict").isNotNull(), F.col("item")).alias("alone"))
    held = baskets.select("basket", "verdict", F.explode("tokens").alias("token")).join(small_side(known, max_broadcast), "token")
    reduced = held.groupBy("basket", "verdict", "alone").agg(F.collect_set("item").alias("items")).select(F.concat("items", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    reduced = stored(reduced, "url-reduced")
    n_reduced = reduced.count()
    if n_reduced < least:
        return Mined(spark.createDataFrame([], RULE), spark.createDataFrame([], "token string, item string"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_reduced, minConfidence=min_confidence, numPartitions=parts).fit(reduced)
    is_label = lambda x: x.startswith(LABEL)
    found = model.associationRules.where(is_label(F.col("consequent")[0]) & ~F.exists("antecedent", is_label))
    found = found.select(F.sort_array("antecedent").alias("items"), F.substring(F.col("consequent")[0], len(LABEL) + 1, 1000).alias("verdict"), "confidence", (F.col("support") * n_reduced / n).alias("support"))
    rules = pruned(stored(found, "url-found"))
    rules = stored(rules, "url-rules")
    return Mined(rules, frequent.select("token", "item").join(rules.select(F.explode("items").alias("item")).distinct(), "item", "left_semi"))


def match_rules(pages: DataFrame, mined: Mined, max_broadcast: int = 100_000) -> DataFrame:
    """The best mined rule that holds for pages (host, path, tokens): host, path and mined (confidence, support, size,
    verdict, rule_items), a row for each pair of host and path that has one. A page looks up its items in the inverted
    index of the rules, and the rest of a rule is checked on the spot."""
    tokens_of = pages.select("host", "path", "tokens").dropDuplicates(["host", "path"]).select("host", "path", F.explode("tokens").alias("token"))
    items = tokens_of.join(small_side(stored(mined.members, "url-members"), max_broadcast), "token").groupBy("host", "path").agg(F.collect_set("item").alias("items"))
    looked = items.select("host", "path", F.col("items").alias("all_items"), F.explode("items").alias("item"))
    index = stored(indexed(mined.rules), "url-index")
    fits = looked.join(small_side(index, max_broadcast), "item").where(F.size(F.array_except("rule_items", "all_items")) == 0)
    best = F.struct("confidence", "support", F.size("rule_items").alias("size"), "verdict", "rule_items")
    return fits.groupBy("host", "path").agg(F.max(best).alias("mined"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", min_support: float = 0.002, min_confidence: float = 0.9, min_count: int = 20) -> DataFrame:
    """id_col, host, path, rule, verdict and mined (the items of the mined rule that decided, or null), a row for each
    row of pages.

    The longest fitting curated rule decides. Other URLs get the verdict of the best mined rule that holds for them,
    by confidence, then support, then length, and allow where none does. Rules are mined from labels (id_col,
    verdict), where given, and else from the pages that the curated rules judge. A null URL, or one without ://, has
    neither host nor tokens and is allowed. Each row is judged by its own host and path, so null and repeated ids,
    like repeated URLs, are rows as any others. Other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    own = rows.withColumn("tokens", tokens(F.col("host"), F.col("path")))
    if labels is None:
        labelled = own.where("fit is not null").select("tokens", F.col("fit.verdict").alias("verdict"))
    else:
        labelled = own.join(labels.select(F.col(id_col).alias("page"), "verdict").where("verdict is not null"), "page").select("tokens", "verdict")
    found = match_rules(own.where("fit is null"), mine_rules(labelled, min_support, min_confidence, min_count))
    judged = rows.join(found, ["host", "path"], "left")
    mined = F.when(F.col("fit").isNull(), F.col("mined.rule_items"))
    verdict = F.coalesce("fit.verdict", F.when(F.col("fit").isNull(), F.col("mined.verdict")), F.lit("allow"))
    return judged.select(F.col("page").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), mined.alias("mined"))
