"""Nulls, repeats, ties, long texts and clashing names where operators meet them, against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changeloom.llm import decontaminate, jaccard, line_dedup, mixing, phrases, quality, secret_scan, token_io
from tests.llm.test_exact import linked


def docs(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + more)


def test_pages_of_one_template(spark):
    """A large group of rows that share a template and are no copies of one another, with near copies among them."""
    draw = random.Random(11)
    template = [f"t{k}" for k in range(60)]
    own = lambda n: [f"o{draw.randrange(10**9)}" for _ in range(n)]
    texts = [" ".join(template + own(draw.choice((4, 9, 14, 18, 25)))) for _ in range(150)]
    texts += [" ".join(own(1) + template[:50] + own(6)) for _ in range(40)]
    texts += [t + " extra" for t in texts[:10]]
    for wide in (3, 8):
        got = jaccard.similar_documents(docs(spark, list(enumerate(texts))), wide=wide, block=16)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == linked(texts)


def test_pairs_of_a_full_bucket_come_in_parts():
    import numpy as np

    rows, columns = 64, 3000
    column = np.repeat(np.arange(columns, dtype=np.uint64), rows)
    row = np.tile(np.arange(rows, dtype=np.int64), columns)
    block = jaccard.packed(column, row, np.full(len(row), 3000, np.uint32), np.zeros(len(row), np.uint32))
    parts = list(jaccard.bucket_product(iter([[block]]), False, 64, 80, most_pairs=100_000))
    assert len(parts) > 10 and max(p.shape[1] for p in parts) == rows * (rows - 1) // 2
    shared = Counter()
    for p in parts:
        shared.update(dict(zip(zip(p[0], p[1], strict=True), map(int, p[4]), strict=True)))
    assert len(shared) == rows * (rows - 1) // 2
    tied = jaccard.packed(column, row, np.full(len(row), 3000, np.uint32), np.ones(len(row), np.uint32))
    assert not sum(p.shape[1] for p in jaccard.bucket_product(iter([[tied]]), False, 64, 80))
    wide = list(jaccard.bucket_product(iter([[block], [block]]), False, 63, 80, most=1000))
    assert {(int(a), int(b)) for p in wide for a, b in zip(p[0], p[1], strict=True)} == {(r, c) for r in range(rows) for c in range(columns)} and not any(p[4].any() for p in wide)


def test_lines_of_null_and_repeated_ids(spark):
    line, other = "a line that is shared", "another line of its own"
    rows = [(None, line), (None, line), (5, f"{line}\n{other}"), (5, f"{other}\n{line}"), (7, line), (7, None), (9, f"{line}\n\n{line.upper()} "), (3, other)]
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs(spark, rows)).collect())
    assert got == Counter([(None, line, 1, 0)] * 2 + [(5, line, 2, 1), (5, line, 2, 1), (7, "", 1, 1), (7, "", 1, 0), (9, "", 3, 2), (3, other, 1, 0)])
    long = "\n".join([line] + [f"line number {k} of many" for k in range(50_000)])
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs(spark, [(1, line), (2, long)])).collect()}
    assert got[2].n_dropped == 1 and got[2].text == long.split("\n", 1)[1]


def test_hits_by_shuffled_hashes(spark):
    """Beyond both bounds nothing is broadcast, and numbers alone are exploded and shuffled."""
    draw = random.Random(3)
    item = lambda n: " ".join(draw.choice("abcdefghij") + str(draw.randrange(9)) for _ in range(n))
    items = [(str(k), item(draw.choice((3, 12, 20, 40)))) for k in range(30)]
    texts = [item(draw.randrange(80)) + " " + draw.choice(items)[1][: draw.randrange(120)] for _ in range(80)]
    rows = [(draw.choice((None, k, 4)), t) for k, t in enumerate([*texts, None, "", texts[0], items[0][1] * 300])]
    table = docs(spark, [(*r, "x", 1) for r in rows], ", items string, n_words int")
    windows = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id string, text string"))
    few = decontaminate.contamination(table, windows)
    for bound in (10**6, 0):
        many = decontaminate.contamination(table, windows, max_broadcast_windows=1, max_broadcast_hashes=bound)
        assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
    assert few.where("n_hit > 0").count() > 20
    source = table.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"), "text")
    near = decontaminate.near_windows(source, windows, [3, 12, 13], 0)
    assert near.dtypes == [("id", "bigint"), ("version", "bigint"), ("cands", "array<struct<at:int,width:int>>")]


def test_mixing_of_tied_rows_repeats(spark):
    rows = [(k % 3, " ".join(f"{x}{k}" for x in "abc"), "s") for k in range(60)] + [(9, "a b c d e f", "t")]
    schema = "doc_id long, text string, source string"
    one = mixing.mix(spark.createDataFrame(rows, schema)).collect()
    two = mixing.mix(spark.createDataFrame(rows[::-1], schema).repartition(7)).collect()
    taken = lambda got: Counter((r.doc_id, r.text, r.copies) for r in got)
    assert taken(one) == taken(two) and len({r.copies for r in one if r.source == "s"}) == 2
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0


def test_token_files_of_null_and_repeated_ids(spark):
    rows = [(3, "b c"), (None, "x"), (3, "a"), (None, None), (1, ""), (2, "word " * 3000)]
    got = token_io.round_trip(docs(spark, rows)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 3]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))] and got[0].n_tokens == 1
    text = spark.createDataFrame([("7", "a"), ("12", "b")], "doc_id string, text string")
    assert [r.doc_id for r in token_io.round_trip(text).orderBy("start").collect()] == [7, 12]


def test_secrets_of_odd_rows(spark):
    long = "plain words of prose and then some " * 6000
    rows = [(None, "secret=abcdefghijkl"), (None, "secret=abcdefghijkl"), (1, "x"), (1, long + "AKIA" + "Z9" * 10), (2, None)]
    got = Counter((r.doc_id, tuple((s.start, s.end, s.kind) for s in r.spans)) for r in secret_scan.scan(docs(spark, rows)).collect())
    assert got == Counter([(None, ((0, 19, "assign"),))] * 2 + [(1, ()), (1, ((len(long), len(long) + 24, "access"),)), (2, ())])
    assert secret_scan.scan(docs(spark, [])).count() == 0


def test_fingerprints_of_odd_rows(spark):
    rows = [(None, "b"), (None, "a"), (2, "d" * 10), (2, "c" * 10), (5, None)]
    got = phrases.with_next(docs(spark, rows)).collect()
    order = ["a", "b", "c" * 10, "d" * 10, ""]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(order, order[1:] + order[:1], strict=True)]
    assert Counter(r.edited_sha256 for r in got) == Counter(hashlib.sha256(e.encode()).hexdigest() for e in edited)
    assert phrases.with_next(docs(spark, [])).count() == 0
    alone = phrases.with_next(docs(spark, [(1, "one text that is its own next " * 9)])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_likeness_follows_what_texts_share():
    """Sketches against the share of common words of texts that keep more and more of one another."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=7))
    base = [word() for _ in range(1200)]
    means = []
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        cut = int(share * len(base))
        other = [" ".join([word() for _ in range(len(base) - cut)] + base[len(base) - cut :]) for _ in range(3)]
        own, *theirs = phrases.sketches([" ".join(base), *other])
        means.append(sum(phrases.likeness(own, x) for x in theirs) / 3)
        assert means[-1] == pytest.approx(share / (2 - share), abs=0.12)
    assert means == sorted(means) and means[-1] == 1.0


def test_quality_beats_the_commoner_label(spark):
    """Accuracy and the area under the curve on labels that taught nothing."""
    sf = "/root/testdata/sf0.01"
    table, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(table, labels).select("doc_id", "score", "predicted", "held_out").collect()}
    held = [(got[r.doc_id].score, got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, _, y in held if y == 1], [s for s, _, y in held if y == 0]
    common = max(len(good), len(bad)) / len(held)
    assert sum(p == y for _, p, y in held) / len(held) > common + (1 - common) / 2
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert quality.classify(docs(spark, []), labels).count() == 0
