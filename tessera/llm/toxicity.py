"""Toxicity: misspelled lexicon terms, weighed by the words around them.

The lexicon is learned. Of near copies in the labelled sample one stays (texts that share one of `SKETCH` minima of their
shingles). In two thirds of the rest, words and stems outside quotation marks are counted by their distinct neighbours,
and terms that stand in far more contexts in toxic texts than in others are kept.
Their trie is intersected with Levenshtein automata (one edit for terms of `FUZZY_FROM` letters or more) and compiled to
one table. Every match is then weighed by its window: how quotation marks and the words around it tell mentions in other
texts from those in toxic ones. Terms whose misspellings are words of other texts must be spelled exactly; elsewhere a
misspelled match counts `DAMP` of a term. The last third fits a logistic curve over a text's weighted matches.

It is fitted on at most `sample` labelled documents, those whose ids hash lowest, of the rows whose crc32(id as text)
mod 5 is not 0. Labels, language, source and id are never inputs of a score. Scoring is one pass without a shuffle.

Defined results. Null or empty text: no matches, so it gets the score of a text without any. Null id: never held out
(no remainder), scored like any other. Repeated rows: each is scored. No usable labels, or labels of one kind: the
score is their smoothed share, 0.5 without any. Very long texts are read whole. Ids of labelled rows are integers; others
are an error. Empty table: no rows. Other columns pass through; one named as `into` (score) is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.durable import checkpoint
from tessera.llm.levenshtein import Automaton, Term, code_points, word_bounds
from tessera.llm.quality_classifier import held_out
from tessera.llm.quality_rules import labelled_sample
from tessera.llm.shingles import MinHash, shingle_sets
from tessera.llm.words import release, slices

SAMPLE = 12_000
THRESHOLD = 0.5
#: Terms that the lexicon holds at most, and how a term must stand out.
MOST_TERMS, LEAST_CONTEXTS, LEAST_RATIO = 300, 5, 20.0
#: Contexts that a term needs for each toxic document of the sample.
CONTEXT_SHARE = 0.03
#: Letters of stems, and words that a stem must begin.
STEMS, STEM_WORDS = range(4, 8), 4
#: Letters from which a term may be misspelled, what such a match counts, and how it must stand out, as LEAST_RATIO.
FUZZY_FROM, DAMP, FUZZY_RATIO = 5, 0.6, 5.0
#: Words to each side of a match, and how many hashed words its window is judged by.
WINDOW, BUCKETS = 6, 1 << 12
#: Minima of a text's shingles by which near copies in the sample are told.
SKETCH = 8

_QUOTATION = r'"[^"\n]*"|«[^»\n]*»|„[^“\n]*“|“[^”\n]*”'



@dataclass(frozen=True)
class Context:
    """Log-ratios of a window's words and of quotation: above zero, a match is rather abuse than a mention."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    quoted: float = -2.0
    open: float = 0.0

    def weigh(self, quoted: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
        words = np.array([np.clip(self.words[w].sum(), -3, 3) for w in windows]) if self.words.any() else 0.0
        margin = 3.0 + np.where(quoted, self.quoted, self.open) + words
        return 1 / (1 + np.exp(-margin))


@dataclass(frozen=True)
class Matches:
    """Of some texts: each match's text, term, edits, whether it is quoted, and its window's hashed words; words of each text."""

    text: np.ndarray
    term: np.ndarray
    edits: np.ndarray
    quoted: np.ndarray
    windows: list[np.ndarray]
    n_words: np.ndarray


def _quoted(points: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether an opened quotation of the same line holds each place."""
    lines = np.unique(np.append(bounds[:-1], np.flatnonzero(points == 10)))
    head = lines[np.searchsorted(lines, at, side="right") - 1] if len(at) else at

    def since(marks: str) -> np.ndarray:
        total = np.append(0, np.cumsum(np.isin(points, [ord(c) for c in marks])))
        return total[at] - total[head]

    low, high = since("„"), since("“")  # the mark that opens in one language closes in another
    return (since('"') % 2 == 1) | (since("«‹") > since("»›")) | np.where(low > 0, low > high, high > since("”"))


def find_matches(automaton: Automaton, texts: list[str], windows: bool = True) -> Matches:
    points, bounds = code_points(texts)
    starts, ends, first = word_bounds(points, bounds)
    hits, term, edits = automaton.walk(points, starts, ends)
    text = np.searchsorted(first, hits, side="right") - 1
    around = []
    for i, t in zip(hits.tolist(), text.tolist(), strict=True) if windows else ():
        near = [j for j in range(max(i - WINDOW, first[t]), min(i + WINDOW + 1, first[t + 1])) if j != i]
        around.append(np.unique([zlib.crc32(points[starts[j] : ends[j]].astype("<u4").tobytes()) % BUCKETS for j in near]).astype(np.int64))
    return Matches(text, term, edits, _quoted(points, bounds, starts[hits]), around, np.diff(first))


@dataclass(frozen=True)
class Model:
    automaton: Automaton | None
    context: Context
    weights: np.ndarray

    def features(self, texts: list[str]) -> np.ndarray:
        """Of each text: strength of its matches, their strength a word, how many terms; all as logarithms, and one."""
        out = np.zeros((len(texts), 4))
        out[:, 3] = 1
        if self.automaton is None:
            return out
        found = find_matches(self.automaton, texts, bool(self.context.words.any()))
        own = np.array([t.weight for t in self.automaton.terms])[found.term]
        own = own * np.where(found.edits > 0, DAMP, 1.0) * self.context.weigh(found.quoted, found.windows)
        strength = np.bincount(found.text, weights=own, minlength=len(texts))
        pairs = np.unique(np.stack([found.text, found.term], axis=1)[own > 0.5], axis=0) if len(own) else np.zeros((0, 2), dtype=int)
        out[:, 0] = np.log1p(strength)
        out[:, 1] = np.log1p(100 * strength / np.maximum(found.n_words, 1))
        out[:, 2] = np.log1p(np.bincount(pairs[:, 0], minlength=len(texts)))
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.features(texts) @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic curve, the intercept last. Matches never count against abuse: their weights below zero are dropped."""
    use = np.ones(x.shape[1], dtype=bool)
    while True:
        w = np.zeros(x.shape[1])
        for _ in range(60):
            p = _sigmoid(x @ w)
            gradient = (x.T @ (p - y) + ridge * w)[use]
            hessian = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x + ridge * np.eye(x.shape[1])
            step = np.linalg.solve(hessian[np.ix_(use, use)], gradient)
            w[use] -= np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-8:
                break
        low = np.flatnonzero(w[:-1] < 0)
        if not len(low):
            return w
        use[low[np.argmin(w[low])]] = False


def _contexts(sample: DataFrame) -> DataFrame:
    """term, stem, toxic and clean: distinct neighbours of each word and stem in toxic and in other texts; words a stem begins."""
    said = F.regexp_replace(F.lower("text"), _QUOTATION, " ")  # a mention tells nothing of the term itself
    words = F.regexp_extract_all(said, F.lit(r"([\p{L}\p{N}@$]+)"), F.lit(1))
    each = sample.select("label", words.alias("w")).select("label", "w", F.posexplode("w").alias("i", "word"))
    near = F.xxhash64(F.expr("get(w, i - 1)"), F.expr("get(w, i + 1)"))
    seen = each.where(F.length("word").between(3, 40)).select("label", "word", near.alias("near")).distinct()
    by_word = checkpoint(seen.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")))
    stems = F.expr(f"transform(sequence({STEMS[0]}, least({STEMS[-1]}, length(word) - 1)), k -> substring(word, 1, k))")
    by_stem = by_word.where(F.length("word") > STEMS[0]).select(F.explode(stems).alias("term"), "toxic", "clean")
    begun = by_stem.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("begun"))
    whole = by_word.select(F.col("word").alias("term"), F.lit(False).alias("stem"), "toxic", "clean")
    return whole.unionByName(begun.where(F.col("begun") >= STEM_WORDS).select("term", F.lit(True).alias("stem"), "toxic", "clean"))


def learn_terms(sample: DataFrame, most: int = MOST_TERMS) -> list[Term]:
    """The terms that tell toxic texts of `sample` (text, label) from the others."""
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return []
    ratio = F.log((F.col("toxic") + 0.5) / n[1]) - F.log((F.col("clean") + 0.5) / n[0])
    least = max(LEAST_CONTEXTS, CONTEXT_SHARE * n[1])
    stands_out = _contexts(sample).withColumn("ratio", ratio).where((F.col("toxic") >= least) & (F.col("ratio") >= float(np.log(LEAST_RATIO))))
    rows = stands_out.orderBy(F.desc("toxic"), "term", "stem").limit(4 * most).collect()
    stems = {r.term: r for r in rows if r.stem}
    for text in sorted(stems, key=len, reverse=True):  # of nested stems the shorter one stays if it finds clearly more
        if (parent := stems.get(text[:-1])) and text in stems:
            del stems[text if parent.toxic >= 1.2 * stems[text].toxic else text[:-1]]
    kept = [*stems.values(), *(r for r in rows if not r.stem and not any(r.term.startswith(s) for s in stems))]
    kept.sort(key=lambda r: (-r.toxic, r.term))
    return [Term(r.term, float(np.clip(r.ratio, 1, 6)), r.stem, int(not r.stem and len(r.term) >= FUZZY_FROM)) for r in kept[:most]]


def match_counts(automaton: Automaton, texts: list[str], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Counts by label of texts, exact matches, quoted ones, each hashed word of their windows, and each term's misspelled matches."""
    out = {"texts": np.bincount(labels, minlength=2).astype(float), "n": np.zeros(2), "quoted": np.zeros(2), "words": np.zeros((2, BUCKETS)), "fuzzy": np.zeros((2, len(automaton.terms)))}
    found = find_matches(automaton, texts)
    for t, term, e, q, w in zip(found.text.tolist(), found.term.tolist(), found.edits.tolist(), found.quoted.tolist(), found.windows, strict=True):
        if e:
            out["fuzzy"][labels[t], term] += 1
            continue
        out["n"][labels[t]] += 1
        out["quoted"][labels[t]] += q
        out["words"][labels[t]][w] += 1
    return out


def exact_where_common(terms: list[Term], texts: np.ndarray, fuzzy: np.ndarray) -> list[Term]:
    """`terms`, without edits for those whose misspellings are seen in other texts and don't stand out in toxic ones."""
    ratio = np.log((fuzzy[1] + 1.0) / max(texts[1], 1)) - np.log((fuzzy[0] + 0.5) / max(texts[0], 1))
    return [replace(t, edits=0) if seen >= 3 and r < np.log(FUZZY_RATIO) else t for t, r, seen in zip(terms, ratio, fuzzy[0], strict=True)]


def context_of(n: np.ndarray, quoted: np.ndarray, words: np.ndarray) -> Context:
    """With prior counts, as mentions may be rare: one abuse in ten is quoted, and half of the mentions."""
    share = (quoted + np.array([5.0, 1.0])) / (n + 10.0)
    ratio = np.zeros(BUCKETS)
    if n.min() >= 20:
        p = (words + 1.0) / (n[:, None] + 2.0)
        ratio = np.where(words.sum(axis=0) >= 5, np.log(p[1]) - np.log(p[0]), 0.0)
    clip = lambda x: float(np.clip(x, -4, 1))
    return Context(ratio, clip(np.log(share[1] / share[0])), clip(np.log((1 - share[1]) / (1 - share[0]))))


def _count_rows(automaton: Automaton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text")):
                counts = match_counts(automaton, batch.column("text").slice(a, b - a).to_pylist(), batch.column("label").slice(a, b - a).to_numpy())
                yield pa.RecordBatch.from_pydict({"kind": list(counts), "of": [x.tobytes() for x in counts.values()]})

    return run


def _feature_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text")):
                texts = batch.column("text").slice(a, b - a).to_pylist()
                yield pa.RecordBatch.from_pydict({"label": batch.column("label").slice(a, b - a), "features": [x.tobytes() for x in model.features(texts)]})

    return run


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    minima = MinHash(SKETCH)
    for batch in batches:
        own = [[] if not len(x) else (minima.signature(x).astype(np.int64) + (np.arange(SKETCH) << 32)).tolist() for x in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.list_(pa.int64()))], names=["id", "label", "text", "minima"])


def distinct_texts(sample: DataFrame) -> DataFrame:
    """id, label, text of those rows that share no minimum with one of the same label and a smaller id."""
    sketched = checkpoint(sample.mapInArrow(_sketch, "id long, label int, text string, minima array<long>"))
    each = sketched.select("id", "label", F.explode("minima").alias("m"))
    later = each.join(each.groupBy("label", "m").agg(F.min("id").alias("least")), ["label", "m"]).where(F.col("id") > F.col("least"))
    return checkpoint(sketched.drop("minima").join(later.select("id").distinct(), "id", "left_anti").dropDuplicates(["id"]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    chosen = labelled_sample(docs, labels.where(~held_out(F.col("doc_id"))), label, sample, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    once = distinct_texts(chosen.select(F.col("id").cast("long").alias("id"), F.when(F.col("label") > 0, 1).otherwise(0).alias("label"), text.alias("text")))
    learning, fitting = (once.where(F.pmod(F.xxhash64("id", F.lit(12)), F.lit(3)) != 0), once.where(F.pmod(F.xxhash64("id", F.lit(12)), F.lit(3)) == 0))
    seen = {r.label: r.n for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = (seen.get(1, 0) + 1) / (sum(seen.values()) + 2)
        return Model(None, Context(), np.array([0, 0, 0, np.log(share / (1 - share))]))
    terms = learn_terms(learning.select("label", "text"))
    automaton, context = Automaton(terms) if terms else None, Context()
    if automaton:
        rows = learning.select("label", "text").mapInArrow(_count_rows(automaton), "kind string, of binary").collect()
        total = lambda kind: sum(np.frombuffer(r["of"]) for r in rows if r.kind == kind)
        context = context_of(total("n"), total("quoted"), total("words").reshape(2, BUCKETS))
        automaton = Automaton(exact_where_common(terms, total("texts"), total("fuzzy").reshape(2, -1)))
    model = Model(automaton, context, np.zeros(4))
    rows = sorted((r.label, bytes(r.features)) for r in fitting.select("label", "text").mapInArrow(_feature_rows(model), "label int, features binary").collect())
    y = np.array([r[0] for r in rows], dtype=float)
    if len(set(y.tolist())) < 2:  # too few to fit a curve: one clear match decides
        return replace(model, weights=np.array([3.0, 0.0, 0.0, -3.0]))
    return replace(model, weights=_curve(np.array([np.frombuffer(r[1]) for r in rows]), y))


def scorer(model: Model) -> Callable:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [model.score(texts.slice(a, b - a).to_pylist()) for a, b in slices(texts)]
        release()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, into: str = "score", text_col: str = "text", **options) -> DataFrame:
    """`docs` with a column `into`: how likely label 1 is, from 0 to 1."""
    return docs.withColumn(into, scorer(fit(docs, labels, text_col=text_col, **options))(F.col(text_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every document's score, and whether its label was held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
