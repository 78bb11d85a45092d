"""Random spans of the secret scan: the battery against plain loops, texts of many secrets, values beside names and paths, and single tokens of rare lengths."""

import math
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from changeloom.llm import secret_scan
from tests.llm.test_models import base_spans

PROSE = "Some words of plain prose stand before it and tell of nothing at all, as prose in such Texts often does "


def random_spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "random"] for r in secret_scan.scan(docs).collect()}


def test_values_beside_names_and_paths(spark):
    draw = random.Random(5)
    text = lambda letters, n: "".join(draw.choices(letters, k=n))
    plain = string.ascii_letters + string.digits
    before = ("auth=", "pwd=", "access_key=", "https://example.com/a?sig=", "my-bucket/", "a_b+c/")
    values = [text(plain + ("+/" if "/" in b and "=" not in b else ""), 40) for b in before for _ in range(25)]
    texts = [PROSE + b + v + " end" for b, v in zip([b for b in before for _ in range(25)], values, strict=True)]
    got = random_spans(spark, texts)
    for k, b in enumerate(before):
        rows = range(25 * k, 25 * k + 25)
        covered = [any(s <= texts[r].index(values[r]) + 20 < e for s, e in got[r]) for r in rows]
        assert sum(covered) > 15, b
        if b.endswith("=") and "/" not in b:
            at = [(texts[r].index(values[r]), texts[r].index(values[r]) + 40) for r in rows]
            assert sum(got[r] == [x] for r, x in zip(rows, at, strict=True)) > 15
    assert all(e <= s for spans in got.values() for (_, e), (s, _) in zip(spans, spans[1:], strict=False))


def test_single_tokens_of_rare_lengths(spark):
    draw = random.Random(6)
    letters = string.ascii_letters + string.digits
    for n, before in ((40, PROSE), (300, PROSE), (40, "")):
        for _ in range(50):  # one whose tests give no extreme p-value, as 95 of 100 do
            value = "".join(draw.choices(letters, k=n))
            if spark.range(1).select(secret_scan.randomness(F.lit(value)) > 0.1).first()[0]:
                break
        assert random_spans(spark, [before + value + " end"]) == {0: [(len(before), len(before) + n)]}
    words = ["some-long-name-of-a-page", "averylongwordwithoutanyspaceinit", "AnotherNameOfManyWordsInOne", "counter_of_all_requests_by_host"]
    assert random_spans(spark, [PROSE + w for w in words]) == {k: [] for k in range(len(words))}


def plain_p(token):
    """The battery by loops: chi-squared over nine bins, runs about the middle, correlation of neighbours, Fisher."""
    alphabet = next(a for e, a in secret_scan.ENCODINGS if re.search(e, token))
    at = [alphabet.index(c) for c in token.rstrip("=")]
    n, size, bins = len(at), len(alphabet), secret_scan.BINS
    if n < 8:
        return None
    chi = 0.0
    for b in range(bins):
        letters = [i for i in range(size) if i * bins // size == b]
        due = n * len(letters) / size
        chi += (sum(i in letters for i in at) - due) ** 2 / due
    chi_p = math.exp(-chi / 2) * sum((chi / 2) ** k / math.factorial(k) for k in range((bins - 1) // 2))
    high = [2 * i >= size for i in at]
    ups = sum(high)
    due = 2 * ups * (n - ups) / n + 1
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    runs_p = math.erfc(abs(runs - due) / math.sqrt((due - 1) * (due - 2) / (n - 1)) / math.sqrt(2)) if due > 2 else 1e-9
    mean = sum(at) / n
    var = sum((i - mean) ** 2 for i in at)
    r = sum((a - mean) * (b - mean) for a, b in zip(at, at[1:], strict=False)) / var if var else None
    serial_p = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2)) if r is not None else 1e-9
    x = -2 * sum(math.log(max(p, 1e-300)) for p in (chi_p, runs_p, serial_p))
    return max(math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(3)), 1e-300)


def test_battery_against_plain_loops(spark):
    draw = random.Random(7)
    kinds = [a for _, a in secret_scan.ENCODINGS]
    tokens = ["".join(draw.choices(draw.choice(kinds), k=draw.choice((8, 20, 33, 64, 200)))) for _ in range(150)]
    tokens += ["a" * 30, "ab" * 20, "abc1234567", "0" * 40, "thisislikeproseoverletters" * 3, "AbCdEfGh12+/34==", "A1B2-_c3d4e5f6g7h8"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(tokens)], "k int, t string").select("k", secret_scan.randomness(F.col("t")).alias("p")).collect()
    for r in got:
        p = plain_p(tokens[r.k])
        assert r.p == pytest.approx(p, rel=2e-3, abs=2e-7), tokens[r.k]


def test_texts_of_many_secrets_cost_what_they_hold(spark):
    """Blocks give the places that plain matches have, far beyond one block; costs are about linear in the secrets."""
    draw = random.Random(8)
    hexes = ["".join(draw.choices("0123456789abcdef", k=40)) for _ in range(5000)]
    text = "é\n".join(f"x{k} {h} password={h[:14]} Q!" for k, h in enumerate(hexes))
    lines = "\n".join("".join(draw.choices(string.ascii_letters + string.digits + "+/", k=76)) for _ in range(3000))
    docs = spark.createDataFrame([(0, text), (1, lines), (2, "".join(f"{h}+{h[:9].upper()}/" for h in hexes))], "doc_id long, text string")
    got = {r.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in r.spans] for r in secret_scan.scan(docs).collect()}
    for k, t in enumerate((text, lines)):
        assert [s for s in got[k] if not s.startswith("random")] == base_spans(t)
    starts = {m.start() for m in re.finditer(r"[A-Za-z0-9+/]{76}", lines)}
    assert len(starts) == 3000 and sum(int(s.split(":")[1]) in starts for s in got[1]) > 2900
    spans = sorted((int(a), int(b)) for s in got[2] for a, b in [s.split(":")[1:]] if s.startswith("random"))
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_all_prose_gives_the_chances(spark):
    """Every letter of every text stands in a string, however many texts there are; each width has one in every round."""
    widths = {8: 20, 9: 23, 10: 32}
    texts = ["".join(chr(97 + (k + i) % 26) for i in range(n)) for k, n in enumerate((5, 20, 30, 50, 75, 200, 1000))] * 900
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {(r["class"], r.string): r["count"] for r in secret_scan.prose_strings(docs, widths).groupBy("class", "string").count().collect()}
    want = {}
    for t in texts:
        own = [w for k, w in enumerate(widths.values()) if sum(list(widths.values())[: k + 1]) <= len(t)]
        if own:
            spare, rounds = len(t) - sum(own), math.ceil((len(t) - sum(own)) / sum(own)) + 1
            for i in range(rounds):
                at = i * spare // max(1, rounds - 1)
                for c, w in zip(widths, own, strict=False):
                    want[c, t[at : at + w]] = want.get((c, t[at : at + w]), 0) + 1
                    at += w
    assert got == want
    chances = secret_scan.prose_chances(docs, [10])
    assert chances[10][0] == sum(n for (c, _), n in want.items() if c == 10) + spark.range(1).select(F.size(secret_scan.evenly(F.regexp_replace(F.lit(secret_scan.PROSE), "[^A-Za-z0-9]+", ""), F.lit(32), F.lit(8)))).first()[0]


def test_compiled_steps_are_those_of_the_battery(spark):
    draw = random.Random(9)
    kinds = [a for _, a in secret_scan.ENCODINGS]
    tokens = ["".join(draw.choices(draw.choice(kinds), k=draw.choice((5, 8, 20, 23, 64, 200)))) for _ in range(200)]
    tokens += ["", "=" * 20, "a" * 30, "ab" * 20, "a-b+c" * 5, "thisislikeproseoverletters", "ThisIsLikeProseOfManyWords", "Ab12+/" * 5 + "==", "é" * 20, None]
    tokens += [secret_scan.PROSE.replace(" ", "").replace("\n", "")[k : k + 23] for k in range(0, 900, 9)]
    docs = spark.createDataFrame(list(enumerate(tokens)), "k int, token string")
    got = {r.k: r.step for r in secret_scan.steps_of(docs).collect()}
    want = {r.k: r.step for r in docs.select("k", secret_scan.step(secret_scan.randomness(F.col("token"))).alias("step")).collect()}
    assert got == want and len(set(got.values())) > 20


def test_long_prose_is_cut_in_linear_time(spark):
    text = "".join(random.Random(10).choices(string.ascii_lowercase, k=2_000_000))
    docs = spark.createDataFrame([(text,)], "text string")
    began = time.monotonic()
    got = secret_scan.prose_strings(docs, {8: 20, 9: 23}).groupBy("class").count().collect()
    assert {r["class"]: r["count"] for r in got} == {8: 46512, 9: 46512}
    assert time.monotonic() - began < 20  # over a minute when every cut counted letters from the start of the text
