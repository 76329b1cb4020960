"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

The n-grams of a text are its byte trigrams, the pairs of its words' shapes (kinds of first and last character, length,
whether it repeats the word before), and marks for the share of words in five-word windows that recur in the text;
only presence counts. Each indicator is scaled by its class log-count ratio, and a linear hinge-loss model is fitted
to them by dual coordinate descent. A logistic curve through held-back training margins turns margins into scores.

It is fitted on at most `sample` labelled documents, those whose ids hash lowest, of the rows whose
crc32(id as text) mod 5 is not 0. Labels, language, source and id are never inputs of a score.

Defined results. Null or empty text: no n-grams, so it gets the score of the bare intercept. Null id: never held out
(no remainder), scored like any other. Repeated rows: each is scored. No usable labels, or labels of one kind: the
score is their smoothed share, 0.5 without any. Very long texts are read whole. Ids of labelled rows are integers; others
are an error. Empty table: no rows. Other columns pass through; one named as `into` (score) is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.quality_rules import labelled_sample
from tessera.llm.statistics import repeated_words
from tessera.llm.words import Words, release, slices

SAMPLE = 6_000
THRESHOLD = 0.3
FOLDS = 5

_TRIGRAMS, _SHAPES, _MARKS = 1 << 17, 1 << 15, 16
SIZE = _TRIGRAMS + _SHAPES + _MARKS

#: Kinds of bytes: other, lower case, upper case, digit, sentence mark, symbol, beyond ASCII.
_KIND = np.zeros(256, dtype=np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[list(b".,;:!?")] = 4
_KIND[list(b"#*$%&|<>=_@~^")] = 5
_KIND[128:] = 6


def _hashed(x: np.ndarray, bits: int) -> np.ndarray:
    return ((x.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int64)


def indicators(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text, as indexes below SIZE."""
    last_seen = np.zeros(SIZE, dtype=np.int64)
    for a, b in slices(texts):
        words = Words(texts.slice(a, b - a))
        data, bounds, n = words.data, words.bounds, words.counts()
        wide = data.astype(np.uint32)
        grams = _hashed(wide[:-2] | (wide[1:-1] << np.uint32(8)) | (wide[2:] << np.uint32(16)), 17) if len(data) > 2 else np.zeros(0, dtype=np.int64)
        hashes = words.hashes()
        shapes = np.zeros(0, dtype=np.int64)
        if len(hashes):
            shape = (_KIND[data[words.starts]] * 7 + _KIND[data[words.ends - 1]]) * 8 + np.minimum(words.ends - words.starts, 7)
            shape = shape * 2 + np.append(0, hashes[1:] == hashes[:-1])
            shapes = _TRIGRAMS + _hashed(np.append(shape[:-1] * 1024 + shape[1:], 0), 15)
        share = repeated_words(hashes, words.first) / np.maximum(n, 1)
        for i in range(b - a):
            marks = SIZE - _MARKS + np.arange(int(10 * share[i]) + 1)
            own = np.concatenate([grams[bounds[i] : max(bounds[i + 1] - 2, bounds[i])], shapes[words.first[i] : max(words.first[i + 1] - 1, words.first[i])], marks])
            if bounds[i] == bounds[i + 1]:
                own = own[:0]
            at = np.arange(len(own))
            last_seen[own] = at
            yield own[last_seen[own] == at]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def score(self, grams: np.ndarray) -> float:
        margin = self.intercept + (self.weights[grams].sum() / np.sqrt(len(grams)) if len(grams) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35))))


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; the intercept is the weight of a constant input."""
    order = np.random.default_rng(7)
    w, b, alpha = np.zeros(SIZE), 0.0, np.zeros(len(rows))
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slack = y[i] * (w[rows[i]] @ values[i] + b) - 1
            new = min(max(alpha[i] - slack / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * values[i]
                b += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w * ratio, b


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with softened targets so that separable margins stay finite."""
    positive, negative = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -35, 35)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * slope, (p - target).sum()])
        v = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * margins**2).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 20, cost: float = 1.0, smoothing: float = 1.0) -> Model:
    """One row in four is held back for the curve. Both classes weigh the same."""
    y = np.where(labels > 0, 1.0, -1.0)
    if not len(y) or abs(y.sum()) == len(y):
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return Model(np.zeros(SIZE), 0.0, 1.0, float(np.log(share / (1 - share))))
    back = np.arange(len(y)) % 4 == 3
    if len(set(y[back])) < 2 or len(set(y[~back])) < 2:
        back = np.zeros(len(y), dtype=bool)
    inside = np.flatnonzero(~back)
    counts = {s: np.full(SIZE, smoothing) for s in (1.0, -1.0)}
    for i in inside:
        counts[y[i]][rows[i]] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    share = (y[inside] > 0).mean()
    costs = np.where(y[inside] > 0, cost / (2 * share), cost / (2 * (1 - share)))
    weights, intercept = _descend([rows[i] for i in inside], y[inside], ratio, costs, epochs)
    raw = Model(weights, intercept, 1.0, 0.0)
    fitted_on = np.flatnonzero(back) if back.any() else inside
    margins = np.array([raw.intercept + (raw.weights[rows[i]].sum() / np.sqrt(len(rows[i])) if len(rows[i]) else 0.0) for i in fitted_on])
    return Model(weights, intercept, *_curve(margins, y[fitted_on]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = pa.array([g.astype(np.int32).tobytes() for g in indicators(batch.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), grams], names=["id", "label", "grams"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    open_labels = labels.where(~held_out(F.col("doc_id")))
    seen = labelled_sample(docs, open_labels, label, sample, id_col, text_col)
    grams = seen.select(F.col("id").cast("long").alias("id"), "label", "text").mapInArrow(_grams, "id long, label int, grams binary")
    one = grams.groupBy("id").agg(F.min(F.struct("grams", "label")).alias("r"))  # rows that repeat an id count once
    rows = sorted((r.id, bytes(r.r.grams), r.r.label) for r in one.collect())
    return fit_rows([np.frombuffer(g, dtype=np.int32).astype(np.int64) for _, g, _ in rows], np.array([x for _, _, x in rows]))


def scorer(model: Model) -> Callable:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scores = [model.score(g) for g in indicators(texts)]
        release()
        return pa.array(scores, pa.float64())

    return score


def score_quality(docs: DataFrame, labels: DataFrame, into: str = "score", text_col: str = "text", **options) -> DataFrame:
    """`docs` with a column `into`: how likely label 1 is, from 0 to 1."""
    return docs.withColumn(into, scorer(fit(docs, labels, text_col=text_col, **options))(F.col(text_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every document's score, and whether its label was held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
