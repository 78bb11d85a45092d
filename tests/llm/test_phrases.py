"""The parser of fingerprints against a plain one, and what must not change a text's phrases."""

import random

import numpy as np
import pytest

from changeloom.llm import phrases

MASK = 2**64 - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def toss(label, before):
    low = ((label ^ before) & -(label ^ before)).bit_length() - 1
    return low << 1 | (label >> low) & 1


def plain_levels(text):
    """The names of each level of one text, in order, by loops over lists."""
    symbols, level, out = [ord(c) for c in text], 0, []
    while True:
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        symbols = [s | (n - 1) << 21 if level == 0 else mix((s + n * 0xD6E8FEB86659FD93) & MASK) if n > 1 else s for s, n in runs]
        labels = symbols
        for _ in range(3):
            labels = [toss(x, labels[k - 1]) if k else x & 1 for k, x in enumerate(labels)]
        n = len(symbols)
        starts = [0] + [k for k in range(2, n - 1) if labels[k] > labels[k - 1] and labels[k] > labels[k + 1]]
        level += 1
        names = []
        for a, b in zip(starts, [*starts[1:], n], strict=True):
            total = sum(mix((s + k * 0x9E3779B97F4A7C15) & MASK) for k, s in enumerate(symbols[a:b]))
            names.append(mix((total + (b - a) + level * 0x51ED2701) & MASK))
        out.append(names)
        if len(names) == 1:
            return out
        symbols = names


def plain_sketch(text):
    if not text:
        return bytes(8) + np.full(phrases.SLOTS, phrases.EMPTY, ">u2").tobytes()
    levels, slots = plain_levels(text), [phrases.EMPTY] * phrases.SLOTS
    for name in {x for k, names in enumerate(levels, 1) if k >= phrases.LEAST_LEVEL or k == len(levels) for x in names}:
        drawn = mix(name ^ 0xA0761D6478BD642F)
        slots[drawn % phrases.SLOTS] = min(slots[drawn % phrases.SLOTS], drawn >> 48, phrases.EMPTY - 1) if slots[drawn % phrases.SLOTS] != phrases.EMPTY else min(drawn >> 48, phrases.EMPTY - 1)
    return levels[-1][0].to_bytes(8, "little") + np.array(slots, ">u2").tobytes()


def texts(draw):
    word = lambda: "".join(draw.choices("abcdé𝒳 ", k=draw.randrange(1, 9)))
    out = ["", "a", "aa", "ab", "aba", "abab" * 50, "a" * 2048, "a" * 2049, "a" * 5000, "é" * 3000 + "x", "\n".join("-" * n for n in (3, 2047, 2048, 2049, 9000))]
    return out + [" ".join(word() for _ in range(draw.choice((1, 5, 60, 400)))) for _ in range(40)]


@pytest.mark.parametrize("seed", (1, 2))
def test_sketches_are_those_of_a_plain_parser(seed):
    some = texts(random.Random(seed))
    assert phrases.sketches(some) == [plain_sketch(t) for t in some]


def test_other_texts_of_a_batch_change_nothing():
    draw = random.Random(3)
    some = texts(draw)
    alone = [phrases.sketches([t])[0] for t in some]
    for _ in range(5):
        order = draw.sample(range(len(some)), len(some))
        assert phrases.sketches([some[k] for k in order]) == [alone[k] for k in order]


def test_long_runs_differ():
    runs = [phrases.sketches(["a" * n])[0] for n in (2047, 2048, 2049, 4096, 1_000_000)]
    assert len(set(runs)) == 5 and phrases.likeness(runs[1], runs[4]) == 0
    prose = "Some words before a ruler and as many after it, for good measure.\n"
    a, b = phrases.sketches([prose + "-" * 2048 + prose, prose + "-" * 9000 + prose])
    assert a != b and 0 < phrases.likeness(a, b) < 1


def test_equal_passages_have_equal_phrases_inside():
    """Wherever a passage stands, its phrases but for some at its ends are the same ones."""
    draw = random.Random(5)
    passage = "".join(draw.choices("abcdefgh ", k=3000))
    inside = [set(names) for names in plain_levels(passage)[:4]]
    for before in (1, 2, 17, 400):
        other = plain_levels("".join(draw.choices("ijklmnop ", k=before)) + passage + "".join(draw.choices("qrstuv ", k=50)))
        for level, names in enumerate(inside):
            assert len(names - set(other[level])) <= 12 and len(names & set(other[level])) > 0.7 * len(names) or len(names) < 30
