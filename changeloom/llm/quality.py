"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm import encoding
from changeloom.llm.text import ship, stored, tidy

STATISTICS = (
    "log words", "mean word bytes", "long words", "letters beyond ASCII", "capitals", "capital words", "digits", "punctuation", "commonest punctuation",
    "punctuated words", "white space", "distinct words", "repeated neighbours", "distinct lines", "log line bytes",
)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()])


def statistics(text: str | None) -> list[float]:
    """The STATISTICS of a whole text; of an empty one zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(data, np.uint8)
    of = np.bincount(raw, minlength=256)
    size, marks, lines = len(data), of[_PUNCTUATION], data.split(b"\n")
    letters = max(1, int(of[65:91].sum() + of[97:123].sum() + of[192:].sum()))
    distinct = len(set(words))
    return [
        float(np.log1p(n)), size / n, sum(len(w) > 15 for w in words) / n, of[192:].sum() / letters, of[65:91].sum() / letters,
        sum(map(bytes.isupper, words)) / n, of[48:58].sum() / size, marks.sum() / size, marks.max() / size,
        sum(not _LETTER[w[-1]] for w in words) / n, (of[32] + of[9:14].sum()) / size, distinct / n**0.85, sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines), float(np.log1p(size / len(lines))),
    ]


@dataclass
class Model:
    """Standardisation, random features, weights, and the steps of the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases)), np.ones((len(x), 1))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return np.full(len(x), 0.5)
        return np.interp(self.features(x) @ self.weights, self.steps, self.levels)


def pooled(values: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of label sums over counts at ascending values: pools neighbours that are out of order."""
    blocks: list[list[float]] = []  # first value, last value, label sum, count
    for v, s, c in zip(values, labels, counts, strict=True):
        blocks.append([v, v, s, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, last, s2, c2 = blocks.pop()
            blocks[-1][1:] = [last, blocks[-1][2] + s2, blocks[-1][3] + c2]
    # A little towards the middle, so that no score claims certainty from few rows.
    level = [(b[2] + 0.5) / (b[3] + 1) for b in blocks]
    level = np.maximum.accumulate(level)
    return np.array([x for b in blocks for x in b[:2]]), np.repeat(level, 2)


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(id_col).cast("string")) % 5


def summed(rows: DataFrame, part, width: int, groups: int = 16) -> np.ndarray:
    """Sum over all rows of vectors that part (statistics, labels -> vector) makes of batches: each task sums its own,
    groups of tasks are summed next, and the driver adds what these leave."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += part(np.array(batch.column("x").to_pylist(), float), np.array(batch.column("y").to_pylist(), float))
        yield pa.RecordBatch.from_pydict({"g": pa.array([TaskContext.get().partitionId() % groups], pa.int32()), "v": [total.tobytes()]})

    def together(table: pa.Table) -> pa.Table:
        return pa.table({"v": [np.sum([np.frombuffer(v) for v in table.column("v").to_pylist()], axis=0).tobytes()]})

    got = rows.mapInArrow(tidy(tasks), "g int, v binary").groupBy("g").applyInArrow(together, "v binary").collect()  # groups rows
    return np.sum([np.frombuffer(r["v"]) for r in got], axis=0) if got else np.zeros(width)


def measured(texts: pa.Array) -> list:
    encoding.forget()
    return [statistics(x) for x in texts.to_pylist()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 20_000, n_features: int = 256, ridge: float = 1e-3, seed: int = 7, n_bins: int = 2000) -> Model:
    """A model of label_col (0 or 1) from documents whose remainder() is not 0.

    At most max_rows labels are used, those whose hashed id is smallest, whatever the size of docs; that bound lets
    their ids be broadcast, and only their documents' statistics are computed. Statistics are standardised, mapped to
    n_features random Fourier features of a Gaussian kernel, and ridge weights solve the normal equations, which
    tasks sum. A fourth of the documents (remainder 4) is kept from that and calibrates the scores, by isotonic
    regression over n_bins bins.

    Null ids and labels teach nothing; an id with several labels counts with each. With no labels all scores are 0.5.
    """
    ship(docs.sparkSession)
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (remainder(id_col) != 0))
    chosen = chosen.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.select("id", "y", F.arrow_udf(lambda t: pa.array(measured(t), pa.list_(pa.float64())), "array<double>")("text").alias("x"))
    rows = stored(rows, "quality-rows")
    calibrating = remainder("id") == 4
    train, held = rows.where(~calibrating), rows.where(calibrating)

    d, m = len(STATISTICS), n_features + 1
    sums = summed(train, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]), 1 + 2 * d)
    n = max(1.0, sums[0])
    mean = sums[1 : d + 1] / n
    scale = np.sqrt(np.maximum(sums[d + 1 :] / n - mean**2, 1e-12))
    draw = np.random.default_rng(seed)
    model = Model(mean, np.maximum(scale, 1e-6), draw.normal(0, 1 / np.sqrt(d), (d, n_features)), draw.uniform(0, 2 * np.pi, n_features), np.zeros(m), np.zeros(0), np.zeros(0))

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        f = model.features(x)
        return np.concatenate([(f.T @ f).ravel(), f.T @ y])

    both = summed(train, normal, m * m + m)
    model.weights = np.linalg.solve(both[: m * m].reshape(m, m) + ridge * n * np.eye(m) / m, both[m * m :])

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((model.features(x) @ model.weights + 1) / 3 * n_bins).astype(int), 0, n_bins - 1)
        return np.concatenate([np.bincount(at, y, n_bins), np.bincount(at, minlength=n_bins)])

    bins = summed(held, binned, 2 * n_bins)
    full = np.flatnonzero(bins[n_bins:])
    if len(full):
        model.steps, model.levels = pooled((full + 0.5) / n_bins * 3 - 1, bins[full], bins[n_bins + full])
    return model


def score(model: Model, text: Column) -> Column:
    """A text's calibrated score, from 0 to 1; null and empty texts have one, too."""
    return F.arrow_udf(lambda t: pa.array(model.scores(np.array(measured(t), float).reshape(-1, len(STATISTICS)))), "double")(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """docs with score, held_out (the id's remainder is 0; false for null) and predicted (1 from threshold on).
    Columns of docs with those names are replaced. Every row is scored by its text alone."""
    model = fit(docs, labels, id_col, text_col, label_col)
    out = docs.withColumn("score", score(model, F.col(text_col)))
    return out.withColumns({"held_out": F.coalesce(remainder(id_col) == 0, F.lit(False)), "predicted": (F.col("score") >= threshold).cast("int")})
