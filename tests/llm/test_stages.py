"""Stages of the corpus pipeline: the rows that they keep, on small tables with null ids, copies and planted passages."""

from collections import Counter

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, more=""):
    return spark.createDataFrame([(k, t, "en", "web", len(t or ""), *x) for k, t, *x in rows], COLUMNS + more)


def kept(docs):
    return Counter((r.doc_id, r.text) for r in docs.collect())


def test_benchmark_copies_go(spark, tmp_path):
    item = [f"q{k}" for k in range(15)]
    spark.createDataFrame([("7", " ".join(item))], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    bad, clean = "so: " + " ".join(item) + " end", "nothing of the kind"
    rows = [(None, bad), (None, clean), (None, None), (1, bad), (1, bad), (2, bad), (2, clean), (3, clean), (3, clean), (4, "")]
    got = kept(corpus_pipeline.drop_benchmark_copies(spark, table(spark, rows), str(tmp_path)))
    windows = {tuple(item[k : k + 13]) for k in range(3)}
    hit = lambda t: any(tuple(w[k : k + 13]) in windows for w in [(t or "").split()] for k in range(len(w)))
    assert got == Counter(r for r in rows if not hit(r[1])) and sum(got.values()) == 6


def test_spans_of_null_and_repeated_ids(spark):
    from changeloom.llm import decontaminate

    items = spark.createDataFrame([("7", "tiny item")], "item_id string, text string")
    docs = table(spark, [(None, "a tiny item b"), (1, "tiny item c"), (1, "d tiny item"), (1, "e")])
    found = decontaminate.contamination(docs, decontaminate.benchmark_windows(items))
    assert kept(decontaminate.remove_spans(docs, found)) == Counter([(None, "a   b"), (1, "  c"), (1, "d  "), (1, "e")])


def test_one_of_each_group_stays(spark):
    copy, own = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(4, copy), (2, copy), (9, copy), (None, copy), (None, own), (5, own), (6, ""), (7, None)]
    got = kept(corpus_pipeline.keep_one_of_each_group(spark, table(spark, rows), ""))
    assert got == Counter([(2, copy), (None, copy), (None, own), (5, own), (6, ""), (7, None)])


def test_mixing_keeps_columns_of_any_name(spark):
    from changeloom.llm import mixing

    names = ("n", "rate", "draw", "at", "part", "start", "plan_source", "group", "size", "source_size", "target", "copies", "copy", "row", "col")
    rows = [(k if k % 9 else None, f"w{k} " * (k % 7), *[f"{n}{k}" for n in names]) for k in range(40)]
    docs = table(spark, rows, "".join(f", {n} string" for n in names))
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    copies = {r.text: r.copies for r in mixing.mix(plain.where("doc_id is not null")).collect()}
    got = corpus_pipeline.mix_sources(spark, docs.where("doc_id is not null"), "")
    assert got.columns == docs.columns
    by_row = Counter(tuple(r) for r in got.collect())
    want = {tuple(r): copies[r.text] for r in docs.where("doc_id is not null and text <> ''").collect()}
    assert {r: n for r, n in by_row.items() if r[1]} == {r: n for r, n in want.items() if n}
    assert Counter(r[1] for r in corpus_pipeline.mix_sources(spark, docs, "").collect()) == Counter(r.text for r in mixing.repeated(plain).collect())


def test_documents_that_the_classifier_rejects_go(spark):
    from changeloom.llm import quality

    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in quality.classify(docs, labels).where("score >= 0.3").select("doc_id").collect()}
    got = corpus_pipeline.keep_quality(spark, docs, sf)
    assert got.columns == docs.columns
    assert Counter(map(tuple, got.collect())) == Counter(tuple(r) for r in docs.collect() if r.doc_id in good)
    assert 0 < len(good) < docs.count()
    own = docs.selectExpr("*", "lang as score", "doc_id as Predicted", "n_chars as held_out")
    again = corpus_pipeline.keep_quality(spark, own, sf)
    assert again.columns == own.columns and Counter(map(tuple, again.collect())) == Counter(tuple(r) for r in own.collect() if r.doc_id in good)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(good & bad) < 0.3 * len(bad)


def test_token_files_hold_every_document(spark):
    from changeloom.llm import token_counts

    rows = [(3, "some words"), (3, "some words"), (None, "x"), (1, None), (2, "word " * 500)]
    docs = table(spark, rows)
    counts = Counter((r.doc_id, r.n_tokens + 1) for r in token_counts.count_tokens(docs).collect())
    got = corpus_pipeline.write_token_files(spark, docs, "").collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == counts
