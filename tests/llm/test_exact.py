"""Operators with one right answer, against brute force on small tables of awkward rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from changeloom.llm import decontaminate, encoding, jaccard, line_dedup, mixing, token_counts, token_io, url_rules

WORDS = [f"w{k}" for k in range(40)]
DOCS = "doc_id long, text string, source string, n_words int, digest string"


def table(spark, texts, ids=None):
    """Texts with extra columns whose names clash with those that operators use."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, 1, "x") for i, t in zip(ids, texts, strict=True)], DOCS)


def copies(seed, groups=30, edits=(0, 1, 2, 4, 9)):
    draw, out = random.Random(seed), [None, "", " \t\n", "one two", "One TWO", "a b c d e", "\x0bA b\tc  d e\n"]
    for _ in range(groups):
        base = [draw.choice(WORDS) + draw.choice("abcdef") for _ in range(draw.choice((5, 20, 60, 150)))]
        for _ in range(draw.choice((1, 2, 5))):
            words = list(base)
            for _ in range(draw.choice(edits)):
                words[draw.randrange(len(words))] = draw.choice(WORDS)
            out.append(" ".join(words))
    template = [f"t{k}" for k in range(80)]
    for _ in range(90):  # a large group of near copies, and a passage that others share
        words = list(template)
        words[draw.randrange(80)] = f"n{draw.randrange(1000)}"
        out.append(" ".join(words))
    out += [" ".join([f"p{draw.randrange(10**6)}" for _ in range(draw.choice((30, 60)))] + template[:25]) for _ in range(90)]
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def linked(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return [(k, len(s), find(k)) for k, s in enumerate(sets)]


@pytest.mark.parametrize(("seed", "wide"), [(1, 64), (2, 8), (3, 3)])
def test_jaccard(spark, seed, wide):
    """Narrow columns make most groups wide, which takes the other ways through the product."""
    texts = copies(seed)
    got = jaccard.similar_documents(table(spark, texts), wide=wide, block=16)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == linked(texts)


def test_jaccard_of_nothing_and_null_ids(spark):
    assert jaccard.similar_documents(table(spark, [])).count() == 0
    got = jaccard.similar_documents(table(spark, ["a b c d e f", "a b c d e f", "a b c d e f"], [None, 4, 4])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 2, 0), (4, 2, 4), (4, 2, 4)]


def test_line_dedup(spark):
    texts = ["shared line here\nown\nshared line here", "SHARED LINE HERE \nshort\n\tother long line", None, "", "short\n\n", "a long line twice\na long line twice"]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(table(spark, texts)).collect()}
    assert got[0].text == texts[0] and got[1].text == "short\n\tother long line" and (got[1].n_lines, got[1].n_dropped) == (3, 1)
    assert got[2].text == "" and got[2].n_lines == 1 and got[4].text == "short\n\n" and got[5].n_dropped == 0
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0


def test_decontaminate(spark):
    item = " ".join(f"q{k}" for k in range(15))
    items = spark.createDataFrame([("7", item), ("12", "Tiny Item!"), ("x", None), ("y", "...")], "item_id string, text string")
    texts = [f"intro, {item.upper()}; end", "a tiny item", " ".join(f"q{k}" for k in range(12)), None, "", "tiny " * 100 + "item " + "z " * 200, "q3 " + item]
    got = {r.doc_id: r for r in decontaminate.contamination(table(spark, texts), decontaminate.benchmark_windows(items)).collect()}
    assert [(got[k].n_words, got[k].n_hit, got[k]["items"]) for k in range(7)] == [(17, 15, ["7"]), (3, 2, ["12"]), (12, 0, []), (0, 0, []), (0, 0, []), (301, 2, ["12"]), (16, 15, ["7"])]
    many = decontaminate.contamination(table(spark, texts), decontaminate.benchmark_windows(items), max_broadcast_windows=1)
    assert sorted(map(str, many.collect())) == sorted(map(str, got.values()))
    docs = table(spark, texts)
    assert [r.doc_id for r in decontaminate.remove_documents(docs, many).orderBy("doc_id").collect()] == [2, 3, 4, 5]
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, many).collect()}
    assert cut[1] == "a  " and cut[2] == texts[2] and cut[0].startswith("intro, ") and "Q3" not in cut[0]
    assert all(r.n_hit == 0 for r in decontaminate.contamination(docs, decontaminate.benchmark_windows(items.limit(0))).collect())


def filled(sizes, weights=(3, 1, 2)):
    """Targets by repeated clamping."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    capped, target = set(), {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: 2 * sizes[s] for s in capped} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        more = {s for s in free if target[s] > 2 * sizes[s]}
        if not more:
            return target
        capped |= more


@pytest.mark.parametrize("seed", (1, 2, 3))
def test_mixing(spark, seed):
    draw = random.Random(seed)
    names = ["b", "a", None, "Z", "é"]
    rows = [(k, " ".join("w" * draw.randrange(60)), draw.choices(names, (9, 1, 2, 5, 1))[0]) for k in range(900)] + [(5, None, "b"), (None, "x y", "a")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), group_rows=100).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 2
    target = filled(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r.target == pytest.approx(target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 60 * (1 + sizes[s] / 30 / 100 + 3)
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string"), group_rows=100)
    assert sorted(map(str, again.select(sorted(again.columns)).collect())) == sorted(map(str, spark.createDataFrame(got, again.schema).select(sorted(again.columns)).collect()))


ODD = [
    None, "", " ", "plain words, here. It's fine!", "two  spaces \n\n newline\n", "x" * 300, "word\nnext line\n- item", "<|endoftext|> in a text<|endoftext|>", "a\u0085b ᠎ c\x1cd", "été naïve — “quoted” 北京 1234 5x",
    "don't we'll I'D", "end. \tTab", "\n\nlead", "trail \n", "a .b ,c", "hello<|endoftext|>. x", "́ combining é", "word.word;word:word!word?", "x\n<|endoftext|>\ny z",
]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encoding.default_path())


def random_texts(n, seed=5):
    draw = random.Random(seed)
    bits = ["the ", "quick", " ", "\n", "  ", "é", "北", "'s", "'", ".", ",", "12", "<|endoftext|>", "<|endof", "\t", "A", "z ", " ", "—", "word"]
    return ["".join(draw.choices(bits, k=draw.randrange(80))) for _ in range(n)]


def test_encoding_is_the_library_s():
    texts = [t or "" for t in ODD] + random_texts(1500)
    want = [bytes(memoryview(b"".join(i.to_bytes(4, "little") for i in e.ids))) for e in library().encode_batch(texts, add_special_tokens=False)]
    assert encoding.Encoder(encoding.default_path()).ids(texts) == want


@pytest.mark.parametrize("overlap", (6, 60))
def test_overlapping_chunks_of_long_texts(overlap):
    texts = ["".join(random_texts(60, k)) for k in range(6)] + ["x" * 3000, " " * 2500 + "a", "ab" * 900 + " c" * 900, "<|endoftext|>" * 150]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    own = encoding.Encoder(encoding.default_path(), chunk_chars=200, overlap=overlap)
    assert [[int.from_bytes(x[k : k + 4], "little") for k in range(0, len(x), 4)] for x in own.ids(texts)] == want


def test_token_counts_and_files(spark):
    texts = ODD + random_texts(100) + ["long text " * 3000]
    want = [e.ids for e in library().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    counts = token_counts.count_tokens(table(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in counts] == [(len((t or "").encode()), len(w), len(w) > 1024) for t, w in zip(texts, want, strict=True)]
    got = token_io.round_trip(table(spark, texts)).orderBy("doc_id").collect()
    start = 0
    for r, ids in zip(got, want, strict=True):
        raw = b"".join(i.to_bytes(4, "little") for i in [*ids, 0])
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) + 1, zlib.crc32(raw))
        start += len(ids) + 1
    assert token_io.round_trip(table(spark, [])).count() == 0


def test_token_file_blocks():
    import numpy as np

    draw = np.random.default_rng(3)
    for n in (0, 1, 63, 1024, 5000):
        ids = draw.integers(0, 200, n).astype(np.uint32)
        ids[:: 40] = draw.integers(0, 2**32, len(ids[::40]), dtype=np.uint32)  # exceptions
        data = token_io.encode_file(ids, [(None, 0), (-3, n)])
        back, documents = token_io.decode_file(data)
        assert (back == ids).all() and [tuple(d) for d in documents] == [(0, 1, 0), (-3, 0, n)]
        if n > 2048:
            assert (token_io.decode_file(data, slice(1, 2))[0] == ids[1024:2048]).all()
            assert len(data) < 0.6 * ids.nbytes
    with pytest.raises(ValueError, match="cut off"):
        token_io.decode_file(data[:-9])


def test_urls(spark):
    urls = ["http://Example.NET/en/x?q", "http://a.example.net/de/", "https://www.example.com/de/a#b", "http://x.org/fr/", "http://x.org/en", None, "no scheme", "http://", "ftp://net", "http://notexample.net/en/", "http://h.net#/a"]
    got = {r.page_id: r for r in url_rules.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert [got[k].rule for k in range(11)] == ["example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None, None, None, "net/", None]
    assert [got[k].verdict for k in (0, 1, 2, 3, 5)] == ["allow", "block", "block", "allow", "allow"]
    assert (got[0].host, got[0].path, got[5].host, got[8].host, got[8].path) == ("example.net", "/en/x", "", "net", "")


def test_mined_url_rules(spark):
    pages = [(k, f"http://shop{k % 5}.net/spam/deal{k}") for k in range(200)] + [(200 + k, f"http://news{k % 5}.example.net/en/story{k}") for k in range(200)] + [(400, "http://other.io/spam/deal7"), (401, "http://other.io/about"), (401, "http://news1.other.io/en/story1")]
    got = {(r.page_id, r.host): r for r in url_rules.judge_urls(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert got[(400, "other.io")].verdict == "block" and got[(400, "other.io")].rule is None and got[(400, "other.io")].mined
    assert len(got) == 403 or len(got) == 402
    assert url_rules.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_sha_of_queries(spark):
    from changeloom.llm import queries

    rows = queries.op2_line_dedup(spark, "/root/testdata/sf0.001").where("n_dropped = 0").select("doc_id", "kept_sha256").limit(20).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.col("doc_id").isin([r.doc_id for r in rows])).collect()}
    assert all(hashlib.sha256(texts[r.doc_id].encode()).hexdigest() == r.kept_sha256 for r in rows)


def test_new_words_encoded_together_have_their_own_ids():
    own = encoding.Encoder(encoding.default_path())
    words = [f"{w}{k}" for k in range(150) for w in ("word", "Été", "数字", "ⅷx", "x²", "Ġa", "endoftext")]
    assert own.words(words) == own.plain([" " + w for w in words]) and own.words([]) == []
    for s in ("a", "ab,", ",", "é!", "a\nb", "a,\nb", "x..", "\n"):
        assert b"".join(own.plain(encoding.atoms(s))) == own.plain([" " + s])[0], s
