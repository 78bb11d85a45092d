"""Exact token ids of texts, for byte-level BPE files of the tokenizers library.

Facts that make the work cheap, both from how such a tokenizer first splits a text with one regular expression that
looks no further than one character ahead:

- before a single space with a character other than white space on either side the split always ends a piece, so
  what lies between such spaces can be encoded on its own, and equal stretches once;
- it also ends a piece between a Latin letter and a mark of .,;:!? and on both sides of a line end between a
  character other than white space and a Latin letter, so a stretch not met before is put together of smaller parts;
- from a place where two splits of overlapping chunks both end a piece, both go on alike (see Encoder.long).
"""

from __future__ import annotations

import ctypes
import json
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np

CUT = re.compile(r"(?<=\S) (?=\S)")
NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
#: Counted as white space by some versions of Unicode only; texts with it are not cut.
UNSURE = "᠎"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def can_cut(spec: dict) -> bool:
    """Whether the facts above hold for a tokenizer file."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = not spec.get("normalizer") and not spec.get("post_processor") and not spec.get("truncation") and not spec.get("padding")
    added = all(not re.search(r"\s", a["content"]) and not a["lstrip"] and not a["rstrip"] and not a["single_word"] for a in spec.get("added_tokens", []))
    return plain and added and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")


def latin(c: str) -> bool:
    return c < "\u0250" and c.isalpha()


def atoms(stretch: str) -> list[str]:
    """A stretch and the space before it, in parts that encode on their own."""
    if "\n" not in stretch:
        marked = len(stretch) > 1 and stretch[-1] in ".,;:!?" and latin(stretch[-2])
        return [" " + stretch[:-1], stretch[-1]] if marked else [" " + stretch]
    lines = (" " + stretch).split("\n")
    if len(lines) > 1 and not all(a and b and not a[-1].isspace() and latin(b[0]) for a, b in zip(lines, lines[1:], strict=False)):
        lines = [" " + stretch]
    out = []
    for k, line in enumerate(lines):
        if k:
            out.append("\n")
        if line[-1] in ".,;:!?" and len(line) > 2 and latin(line[-2]):
            out += (line[:-1], line[-1])
        else:
            out.append(line)
    return out


def packed(ids: list[int]) -> bytes:
    """Little-endian uint32."""
    return array("I", ids).tobytes() if NATIVE else np.asarray(ids, "<u4").tobytes()


class Known(dict):
    """Stretch without the space before it -> its ids. What no longer fits is found in spare, which learn() empties."""

    spare: dict[str, bytes]

    def __init__(self):
        self.spare = {}

    def __missing__(self, key: str) -> bytes:
        return self.spare[key]


class Encoder:
    """ids(texts) gives each text's ids as little-endian uint32 bytes, as the library gives them without added
    special tokens. Keeps up to cache_size stretches of at most 64 characters."""

    def __init__(self, path: str, cache_size: int = 600_000, chunk_chars: int = 50_000, overlap: int = 400):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.tokenizer = Tokenizer.from_file(path)
        self.cut, self.cache_size = can_cut(spec), cache_size
        self.cache = Known()
        self.tails: dict[str, bytes] = {}  # parts of stretches other than their first
        self.chunk, self.overlap = chunk_chars, overlap
        added = {a["id"] for a in spec.get("added_tokens", [])}
        ids_of_vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(ids_of_vocabulary.values(), default=0) + 1, bool)  # ids whose token begins with a space
        self.opens[[i for t, i in ids_of_vocabulary.items() if t[:1] == "\u0120" and i not in added]] = True
        self.margin = 2 + max([0, *(len(a["content"]) for a in spec.get("added_tokens", []))])

    def plain(self, texts: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each of some words of letters and digits and the space before it. Many make one text, which costs less than
        each by itself: words have no space inside, so one begins at each token that begins with a space."""
        out: list[bytes] = []
        for at in range(0, len(words), 200):
            some = words[at : at + 200]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(some) or starts[0]:
                out += self.plain([" " + w for w in some])
                continue
            raw, ends = ids.tobytes(), (4 * starts).tolist() + [4 * len(ids)]
            out += [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return out

    def learn(self, stretches: list[str]) -> None:
        """Make the ids of clean stretches that follow a space known, until the next call where the cache is full."""
        unmet = set(stretches)
        words = [s for s in unmet if s.isalnum() and len(s) <= 64]  # these have one part
        made = {s: atoms(s) for s in unmet.difference(words) if s and len(s) <= 64 and not s[0].isspace() and not s[-1].isspace()}
        known = self.cache
        known.spare = {}
        heads = words + list({parts[0][1:] for parts in made.values() if parts[0][1:] not in known}.difference(words))
        tails = list({a for parts in made.values() for a in parts[1:]}.difference(self.tails))
        for at in range(0, len(tails), 5000):
            self.tails.update(zip(tails[at : at + 5000], self.plain(tails[at : at + 5000]), strict=True))
        fresh: dict[str, bytes] = {}
        plain = [h for h in heads if h.isalnum()]
        fresh.update(zip(plain, self.words(plain), strict=True))
        others = [h for h in heads if not h.isalnum()]
        for at in range(0, len(others), 5000):
            some = others[at : at + 5000]
            fresh.update(zip(some, self.plain([" " + h for h in some]), strict=True))
        for s, (head, *rest) in made.items():
            if head[1:] in fresh:
                ids, into = fresh[head[1:]], known.spare  # of words met once few come again, least of all with a mark
            else:
                ids, into = known[head[1:]], known if rest and "\n" not in s and len(known) < self.cache_size else known.spare
            into[s] = b"".join([ids, *(self.tails[a] for a in rest)]) if rest else ids
        if len(known) + len(words) <= self.cache_size:
            known.update((h, fresh[h]) for h in words)
            heads = heads[len(words) :]
        for head in heads:
            (known if len(known) < self.cache_size and "\n" not in head else known.spare)[head] = fresh[head]
        if len(self.tails) > self.cache_size // 8:
            for a in tails:
                del self.tails[a]

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.cut:
            return self.plain(texts)
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:  # groups of about a million characters, however long the texts are
            group.append(text)
            size += len(text)
            if size > 1_000_000:
                out += self.group(group)
                group, size = [], 0
        return out + self.group(group)

    def group(self, texts: list[str]) -> list[bytes]:
        parts = [[t] if len(t) > self.chunk or UNSURE in t else t.split(" ") for t in texts]
        known = self.cache
        self.learn([s for p in parts for s in p[1:] if s not in known])
        heads = self.plain([p[0] if len(p[0]) <= self.chunk and not p[0][-1:].isspace() else "" for p in parts])
        ids_of: Callable[[str], bytes] = known.__getitem__
        out: list[bytes] = []
        for text, p, head in zip(texts, parts, heads, strict=True):
            if len(text) > self.chunk:
                out.append(self.long(text))
                continue
            try:
                if p[0][-1:].isspace() or not p[0]:
                    raise KeyError
                out.append(head + b"".join(map(ids_of, p[1:])))
            except KeyError:
                out.append(self.careful(text))
        return out

    def careful(self, text: str) -> bytes:
        """A text with longer white space or long stretches."""
        if UNSURE in text:
            return self.plain([text])[0]
        first, *rest = CUT.split(text)
        odd = list({s for s in rest if s not in self.cache and s not in self.cache.spare})
        own = dict(zip(odd, self.plain([" " + s for s in odd]), strict=True))
        return self.plain([first])[0] + b"".join(own[s] if s in own else self.cache[s] for s in rest)

    def starts(self, encoding, base: int) -> dict[int, int]:
        """Place in the text of each piece's first token -> index of that token."""
        found: dict[int, int] = {}
        last = object()
        for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
            if word != last or word is None:
                found[base + start] = i
            last = word
        return found

    def long(self, text: str) -> bytes:
        """A huge text, by chunks that overlap.

        Chunk A covers [a, e), the next chunk B begins at b < e. Take a place p at which both end a piece, at least
        margin characters after b and before e. Pieces of A before p are those of the whole text: they saw the
        character at p, and no special token that A cuts off reaches back so far. From p on, the pieces of B are
        those of the whole text, since the expression starts afresh at p and no special token that b cuts reaches p.
        So A's ids before p and B's from p on are right, and by induction those of all chunks. Where no such place
        exists, B begins earlier, and where that would be before A's own splice, A is encoded again twice as long.
        """
        out: list[bytes] = []
        begin, skip, length = 0, 0, self.chunk  # where the chunk begins, and its ids that the chunk before gave
        here = self.tokenizer.encode(text[begin : begin + length], add_special_tokens=False)
        floor = 0  # place of the last splice
        while begin + length < len(text):
            end, overlap, places = begin + length, self.overlap, self.starts(here, begin)
            while True:
                b = end - overlap
                if b <= max(floor, begin):
                    length *= 2
                    here = self.tokenizer.encode(text[begin : begin + length], add_special_tokens=False)
                    break
                there = self.tokenizer.encode(text[b : b + max(self.chunk, 2 * overlap)], add_special_tokens=False)
                next_places = self.starts(there, b)
                common = [p for p in next_places if b + self.margin <= p <= end - self.margin and p in places and places[p] >= skip]
                if common:
                    p = common[len(common) // 2]
                    out.append(np.asarray(here.ids[skip : places[p]], "<u4").tobytes())
                    begin, length, skip, floor, here = b, max(self.chunk, 2 * overlap), next_places[p], p, there
                    break
                overlap *= 2
        return b"".join(out) + np.asarray(here.ids[skip:], "<u4").tobytes()


_made: dict[str, Encoder] = {}


def encoder(path: str | None, chunk_chars: int = 50_000) -> Encoder:
    """This process's encoder for a file; tasks of a worker share its cache."""
    path = path or default_path()
    key = f"{path}/{chunk_chars}"
    if key not in _made:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _made[key] = Encoder(path, chunk_chars=chunk_chars)
    return _made[key]


def release() -> None:
    """Give freed memory back to the system. Spark uses its Python workers again, and what an idle one holds counts
    against its executor."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def forget() -> None:
    """Let go of this process's encoders. Spark uses its workers again, and other operators have no use for them."""
    if _made:
        _made.clear()
        release()
