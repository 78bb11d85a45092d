"""Secret scan, fingerprints, quality classifier and pipeline: base spans by re, invariants, held-out accuracy."""

import hashlib
import random
import re
import string

from changeloom.llm import phrases, quality, queries, secret_scan

SF = "/root/testdata/sf0.001"
BASE = (
    ("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
)


def base_spans(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, e, keep) in enumerate(BASE) for m in re.finditer(e, text or "") if keep(m)]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def test_secrets(spark):
    draw = random.Random(2)
    texts = [None, "", "Password = 'hunter2hunter2x' é token:short", "𝒳 api_key=" + "ab12" * 5, "AKIA" + "Q7" * 8, "deadbeef" * 3, "secret: " + "." * 12]
    texts += ["plain prose of many words here " * 5 + "".join(draw.choices(string.ascii_letters + string.digits, k=40)) + " end" for _ in range(60)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in r.spans] for r in secret_scan.scan(docs).collect()}
    for k, text in enumerate(texts):
        assert [s for s in got[k] if not s.startswith("random")] == base_spans(text)
    assert sum(any(s.startswith("random") for s in got[k]) for k in range(7, 67)) > 40
    rows = {r.doc_id: r for r in queries.op4_secret_scan(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert rows[d.doc_id].base_sha256 == hashlib.sha256(",".join(base_spans(d.text)).encode()).hexdigest()


def test_fingerprints(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices(string.ascii_lowercase, k=6))
    texts = [" ".join(word() for _ in range(300)) for _ in range(30)] + ["", None, "a", "é北" * 40, "aaaa" * 500]
    texts.append(texts[0])
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = phrases.with_next(docs).orderBy("doc_id").collect()
    plain = [t or "" for t in texts]
    for k, r in enumerate(got):
        t, following = plain[k], plain[(k + 1) % len(plain)]
        cut = len(t) // 4
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest()
    assert got[0].fingerprint == got[-1].fingerprint and got[-1].near_next == 1.0
    assert sum(r.near_edited for r in got[:29]) / 29 > 0.4 > 0.1 > sum(r.near_next for r in got[:29]) / 29


def test_quality_on_held_out_labels(spark):
    got = {r.doc_id: r for r in queries.op7_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].predicted == r.quality for r in labels) / len(labels)
    assert right > 0.8
    assert all(0 <= r.score <= 1 for r in got.values())
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(1, None), (None, ""), (1, "x y")], "doc_id long, text string")
    assert [r.score for r in quality.classify(odd, none).collect()] == [0.5] * 3


def test_pipeline_keeps_whole_documents(spark):
    import corpus_pipeline

    sizes = [n for n, _ in corpus_pipeline.STAGES]
    assert len(sizes) == 5
    rows = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
