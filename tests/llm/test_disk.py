"""What the n-gram Jaccard join keeps on disk and shuffles."""

import random

import corpus_pipeline
import numpy as np

from changeloom.llm import jaccard
from changeloom.operators import scale


def alike(pairs=40, crowd=30):
    """Texts of which some are near copies by twos, and others have 60 of 100 words in common, which is no link."""
    draw, word = random.Random(3), lambda: f"w{draw.randrange(10**6)}"
    texts = []
    for _ in range(pairs):
        base = [word() for _ in range(100)]
        texts += [" ".join(base), " ".join(base[:99] + [word()])]
    passage = [word() for _ in range(60)]
    return texts + [" ".join(passage + [word() for _ in range(40)]) for _ in range(crowd)]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_whole_sets_are_fetched_for_likely_links_alone(spark, monkeypatch):
    rows = {}

    def noted(df, name, store=jaccard.stored):
        out = store(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", noted)
    got = {r.doc_id: r.component_id for r in jaccard.similar_documents(docs(spark, alike())).collect()}
    assert got == {k: k - k % 2 if k < 80 else k for k in range(110)}
    assert rows["sets"] == [80]  # and not of all that share many columns


def test_shuffle_files_go_with_each_stored_table(spark):
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in (str(x.toString()) for x in list_of(disk.getAllFiles())) if "shuffle_" in f}

    def list_of(seq):
        return [seq.apply(k) for k in range(seq.size())]

    before = shuffled()
    was = spark.conf.get(scale.CLEANUP, None)
    scale.stored_alone(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "sevens")
    assert not shuffled() - before and spark.conf.get(scale.CLEANUP, None) == was


def test_bit_maps_bound_what_sets_share():
    draw = np.random.default_rng(1)
    some = lambda n: np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
    a = [some(n) for n in (0, 1, 31, 33, 64, 65, 500, 501, 3000) for _ in range(20)]
    b = [np.unique(np.concatenate([g[: int(len(g) * draw.random())], some(int(draw.integers(0, 700)))])) for g in a]
    of = lambda x, y: jaccard.most_shared([jaccard.bit_map(g) for g in x], [jaccard.bit_map(g) for g in y], np.array([len(g) for g in x]), np.array([len(g) for g in y]))
    assert (of(a, b) >= [len(np.intersect1d(x, y)) for x, y in zip(a, b, strict=True)]).all()
    assert (of(a, a) == [len(x) for x in a]).all()
    big = [some(500) for _ in range(40)]
    assert (of(big[:20], big[20:]) < 400).all()


def test_surprising_columns_lead():
    counts = np.zeros(jaccard.WORD_SLOTS, np.int64)
    common = [f"c{k}" for k in range(4)]
    text = " ".join(common * 30 + [f"r{k}" for k in range(30)] + common * 3)
    for *_, words in jaccard.grouped([text], 5):
        counts += np.bincount(jaccard.slots(words), minlength=len(counts))
    (g,), (odds,), _ = jaccard.shingled([text], 5, jaccard.surprise(counts))
    assert (g == jaccard.shingle_sets([text])[0]).all()
    first = jaccard.led(g, np.zeros(0, np.uint64), 20, odds)
    assert not np.isin(first, jaccard.shingle_sets([" ".join(common * 3)])[0]).any()
    assert not np.isin(jaccard.led(g, np.sort(first), len(g) - 20, odds), first).any()  # frequent ones come after all others


def test_texts_are_not_shuffled_to_leave_copies_out(spark, tmp_path):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.keep_one_of_each_group(spark, docs(spark, alike(pairs=4, crowd=2)), str(tmp_path))
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        assert {r.doc_id for r in kept.collect()} == {0, 2, 4, 6, 8, 9}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
