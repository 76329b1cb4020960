"""Phrase collocations: which runs of two to five words stand together more often than their parts would by chance.

Words that occur `LEAST` times or more in their language get ids; pieces break at all others, which can be in no phrase.
Every place where two or more words with ids follow each other gives one fixed-width binary key: the ids of the next
five words, with zeros after the break. Keys are dealt out by ranges cut at quantiles of sampled keys, radix sorted
there and counted by run length; a run of equal prefixes is the count of a shorter phrase, so one sorted list counts all
lengths. What a range's first and last runs hold meets in a sum by key. A slice counts its equal keys before it sends
them, so neither a hot phrase nor a hot word fills one range.

The dictionary is broadcast as sorted 64-bit hashes if it has at most `MOST_WORDS` words (32 MB); beyond that the hashes
themselves are the ids, keys are 40 bytes wide, and pieces break nowhere else. Both give the same counts. Words are told
apart by 64-bit hash: with v words in the corpus about v * v / 2**65 of them meet another by chance.

Defined results. Null or empty text, or one of separators only: no words. Null language: `und`. Repeated rows: each
counts. A very long text is read whole; a piece may be as long as its text. Ties in score and count: by the phrase's
UTF-8 bytes. Empty table: no rows. Ids aren't read, nor other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.durable import checkpoint
from tessera.llm.packed import gather, rows_of
from tessera.llm.words import Words, mix, pack, release, slices, unpack

LEAST = 100
LONGEST = 5
TOP = 2000
#: Words that the broadcast dictionary holds at most.
MOST_WORDS = 4_000_000
#: Keys that the driver sees at most for the cuts between ranges: the sample is of the cuts only, counts cover all.
SAMPLED_KEYS = 200_000
#: One key in so many goes into that sample at first.
STRIDE = 1024
PACKED_BYTES = 4 << 20
NO_LANG = "und"

_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _BREAKS.copy()
_APART[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Pieces(Words):
    """Lower-cased words, hashed with their language, and whether each follows the word before it in one piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        super().__init__(texts, _APART, _LOWER)
        coded = langs.fill_null(NO_LANG).dictionary_encode()
        self.names = coded.dictionary.to_pylist()
        seeds = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in self.names], dtype=np.uint64)
        self.lang = np.repeat(np.asarray(coded.indices), self.counts())
        self.keys = mix(self.hashes() ^ seeds[self.lang]) if len(self) else np.zeros(0, dtype=np.uint64)

    def follows(self) -> np.ndarray:
        breaks = np.flatnonzero(_BREAKS[self.data])
        piece = np.searchsorted(breaks, self.starts)
        out = np.zeros(len(self), dtype=bool)
        out[1:] = piece[1:] == piece[:-1]
        out[self.first[:-1][self.counts() > 0]] = False
        return out


_COUNTED = pa.schema([("lang", pa.string()), ("word", pa.string()), ("hash", pa.int64()), ("n", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each slice: its distinct words with their counts, and a row without word for each language's sum."""
    for batch in batches:
        for a, b in slices(batch.column("text"), PACKED_BYTES):
            words = _Pieces(batch.column("text").slice(a, b - a), batch.column("lang").slice(a, b - a))
            if not len(words):
                continue
            _, first, counts = np.unique(words.keys, return_index=True, return_counts=True)
            starts, sizes = words.starts[first], words.ends[first] - words.starts[first]
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int64)
            spelled = words.data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)]
            column = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(spelled)).cast(pa.string())
            names = pa.array(words.names, pa.string())
            sums = np.bincount(words.lang, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(words.lang[first])), column, pa.array(words.keys[first].view(np.int64)), pa.array(counts.astype(np.int64))], schema=_COUNTED)
            yield pa.RecordBatch.from_arrays([names, pa.nulls(len(names), pa.string()), pa.nulls(len(names), pa.int64()), pa.array(sums)], schema=_COUNTED)
            del words, first, counts, starts, sizes, offsets, spelled
            release()


class Dictionary:
    """Ids of words from their hashes: the rank of each known hash from 1 on and 0 for all others; without known ones
    the hash itself. `digits` 16-bit digits hold an id."""

    def __init__(self, known: np.ndarray | None):
        self.known = known
        self.digits = 4 if known is None else 1 if len(known) < (1 << 16) - 1 else 2
        self.dtype = {1: np.uint16, 2: np.uint32, 4: np.uint64}[self.digits]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if self.known is None:
            return np.maximum(hashes, np.uint64(1))
        at = np.searchsorted(self.known, hashes)
        found = self.known[np.minimum(at, max(len(self.known) - 1, 0))] == hashes if len(self.known) else np.zeros(len(hashes), dtype=bool)
        return np.where(found, at + 1, 0).astype(self.dtype)

    def matrix(self, ids: np.ndarray) -> np.ndarray:
        """Ids (n, k) as digits (n, k * digits), the highest first."""
        big = np.ascontiguousarray(ids.astype(np.dtype(self.dtype).newbyteorder(">")))
        return big.view(">u2").astype(np.uint16).reshape(len(ids), -1)


def as_bytes(matrix: np.ndarray) -> np.ndarray:
    """Each row of digits as a binary key; keys sort as the rows do."""
    return np.ascontiguousarray(matrix.astype(">u2")).view(f"S{2 * matrix.shape[1]}").ravel()


def radix_order(matrix: np.ndarray) -> np.ndarray:
    """The stable order of rows of 16-bit digits, from the last digit to the first."""
    order = np.arange(len(matrix))
    for c in range(matrix.shape[1] - 1, -1, -1):
        digit = matrix[order, c]
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit, kind="stable")]
    return order


def run_lengths(matrix: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in order, and the sum of the counts of each."""
    if not len(matrix):
        return matrix, counts
    order = radix_order(matrix)
    matrix, counts = matrix[order], counts[order]
    heads = np.flatnonzero(np.append(True, (matrix[1:] != matrix[:-1]).any(axis=1)))
    return matrix[heads], np.add.reduceat(counts, heads)


def _windows(stream: np.ndarray) -> np.ndarray:
    """The ids of LONGEST words from each place that has a word and one after it; zeros after the break."""
    padded = np.concatenate([stream, np.zeros(LONGEST, dtype=stream.dtype)])
    at = np.flatnonzero((padded[: len(stream)] != 0) & (padded[1 : len(stream) + 1] != 0))
    out = np.zeros((len(at), LONGEST), dtype=stream.dtype)
    inside = np.ones(len(at), dtype=bool)
    for k in range(LONGEST):
        own = padded[at + k]
        inside = inside & (own != 0)
        out[:, k] = np.where(inside, own, 0)
    return out


_STREAM = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("sample", pa.list_(pa.binary()))])


def _encode(dictionary):
    """Of each slice: the ids of its words, with one zero between runs, and a few of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = dictionary.value
        for batch in batches:
            for a, b in slices(batch.column("text"), PACKED_BYTES):
                words = _Pieces(batch.column("text").slice(a, b - a), batch.column("lang").slice(a, b - a))
                if not len(words):
                    continue
                ids = book.ids(words.keys)
                breaks = np.flatnonzero(~words.follows())
                stream = np.insert(ids, breaks, 0)
                full = np.append(stream != 0, False)
                beside = np.append(False, full[:-2]) | full[1:]  # words alone between breaks are in no phrase
                stream = stream[(full[:-1] & beside) | (np.append(False, full[:-2]) & ~full[:-1])]
                if not len(stream):
                    continue
                some = np.unique(as_bytes(book.matrix(_windows(stream))[:: STRIDE + 1]))
                width = 2 * LONGEST * book.digits
                yield pa.RecordBatch.from_pylist([{"n": len(stream), "ids": pack(stream), "sample": [x.ljust(width, b"\0") for x in some.tolist()]}], schema=_STREAM)
                del words, ids, stream, full, beside
                release()

    return run


_RUNS = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _deal(dictionary, cuts):
    """Of each slice: its distinct keys with their counts, packed by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, bounds = dictionary.value, cuts.value
        for batch in batches:
            for row in rows_of(pa.Table.from_batches([batch])):
                matrix = book.matrix(_windows(unpack(row["ids"], row["n"], book.dtype)))
                keys, counts = run_lengths(matrix, np.ones(len(matrix), dtype=np.int64))
                ends = np.append(np.searchsorted(as_bytes(keys), bounds), len(keys))
                rows, start = [], 0
                for k, end in enumerate(ends.tolist()):
                    if end > start:
                        flat = np.ascontiguousarray(keys[start:end]).view(f"V{2 * keys.shape[1]}").ravel()
                        rows.append({"bucket": k, "n": end - start, "keys": pack(flat), "counts": pack(counts[start:end].astype(np.uint32))})
                    start = end
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RUNS)
                del matrix, keys, counts, rows
                release()

    return run


_PHRASES = pa.schema([("phrase", pa.binary()), ("a", pa.int64())])


def _count_runs(digits: int, least: int):
    """Of one range: the phrases of each length that reach `least`, and those at its ends, which may go on elsewhere."""
    width = LONGEST * digits

    def run(table: pa.Table) -> pa.Table:
        parts = [(unpack(r["keys"], r["n"], np.dtype(f"V{2 * width}")).view(np.uint16).reshape(-1, width), unpack(r["counts"], r["n"], np.uint32).astype(np.int64)) for r in rows_of(table)]
        keys, counts = run_lengths(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        del parts
        found, totals = [], []
        change = np.append(True, np.zeros(len(keys) - 1, dtype=bool))
        for k in range(1, LONGEST + 1):
            digit = keys[:, (k - 1) * digits : k * digits]
            change[1:] |= (digit[1:] != digit[:-1]).any(axis=1)
            if k == 1:
                continue
            heads = np.flatnonzero(change)
            sums = np.add.reduceat(counts, heads)
            whole = digit[heads].any(axis=1)
            keep = whole & (sums >= least)
            keep[[0, -1]] = whole[[0, -1]]
            spelled = as_bytes(keys[heads[keep]][:, : k * digits]).tolist()
            found += [x.ljust(2 * k * digits, b"\0") for x in spelled]
            totals.append(sums[keep])
        release()
        return pa.Table.from_arrays([pa.array(found, pa.binary()), pa.array(np.concatenate(totals))], schema=_PHRASES)

    return run


def _keyed_words(dictionary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = dictionary.value
        for batch in batches:
            ids = book.ids(np.ascontiguousarray(batch.column("hash").to_numpy(zero_copy_only=False)).view(np.uint64))
            keys = [x.ljust(2 * book.digits, b"\0") for x in as_bytes(book.matrix(ids.reshape(-1, 1))).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(batch.column(c) for c in ("lang", "word", "n"))], names=["key", "lang", "word", "n"])

    return run


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame, int]:
    """Words (key, lang, word, f, n: words of the language), phrases (phrase: the keys of its words, a), and a key's bytes."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"))
    counted = texts.mapInArrow(_count_words, "lang string, word string, hash long, n long").groupBy("hash", "lang", "word").agg(F.sum("n").alias("n"))
    counted = checkpoint(counted.where(F.col("word").isNull() | (F.col("n") >= least)))
    frequent = counted.where(F.col("word").isNotNull())
    known = None
    if frequent.count() <= most_words:
        hashes = frequent.select("hash").toArrow().column("hash").to_numpy()
        known = np.unique(np.ascontiguousarray(hashes).view(np.uint64))
    book = Dictionary(known)
    dictionary = spark.sparkContext.broadcast(book)
    streams = checkpoint(texts.mapInArrow(_encode(dictionary), "n int, ids binary, sample array<binary>"))
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sampled = streams.select(F.explode("sample").alias("key"))
    n = streams.agg(F.coalesce(F.sum(F.size("sample")), F.lit(0))).first()[0]
    if n > SAMPLED_KEYS:
        sampled = sampled.sample(SAMPLED_KEYS / n, seed=5)
    some = np.sort(np.array(sampled.toArrow().column("key").to_pylist(), dtype=f"S{2 * LONGEST * book.digits}"))
    cuts = spark.sparkContext.broadcast(np.unique(some[np.arange(1, ranges) * len(some) // ranges]) if len(some) else some)
    runs = streams.select("n", "ids").mapInArrow(_deal(dictionary, cuts), "bucket int, n int, keys binary, counts binary")
    phrases = runs.groupBy("bucket").applyInArrow(_count_runs(book.digits, least), "phrase binary, a long").groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    totals = counted.where(F.col("word").isNull()).select("lang", F.col("n").alias("total"))
    words = frequent.select("hash", "lang", "word", "n").mapInArrow(_keyed_words(dictionary), "key binary, lang string, word string, n long")
    words = words.join(totals, "lang").select("key", "lang", "word", F.col("n").alias("f"), F.col("total").alias("n"))
    return checkpoint(words), checkpoint(phrases), 2 * book.digits


def score_phrases(words: DataFrame, phrases: DataFrame, width: int) -> DataFrame:
    """phrase, a, l, r, n, score, lang: of each phrase its lowest-scoring cut, the first of several."""
    first = words.select(F.col("key").alias("head"), "lang", "n")
    known = phrases.withColumn("head", F.substring("phrase", 1, width)).join(first, "head").drop("head")
    counts = words.select("key", "f").unionAll(phrases.select(F.col("phrase").alias("key"), F.col("a").alias("f")))
    cut = F.explode(F.expr(f"sequence(1, octet_length(phrase) div {width} - 1)")).alias("k")
    cuts = known.select("*", cut).select("*", F.expr(f"substring(phrase, 1, k * {width})").alias("left"), F.expr(f"substring(phrase, k * {width} + 1)").alias("right"))
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("f").alias("l")), "left").join(counts.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    exact = F.expr("cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(18, 0)))")
    lowest = cuts.withColumn("score", exact).groupBy("phrase", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("phrase", "a", "lang", "n", "cut.score", "cut.l", "cut.r")


def drop_contained(scored: DataFrame, phrases: DataFrame, width: int, share: int = 100) -> DataFrame:
    """`scored` without phrases that a longer one holds with `share` percent of their count or more.

    A longer phrase is never more frequent than one inside it, so those with one more word decide for all."""
    longer = phrases.where(F.octet_length("phrase") > 2 * width)
    parts = F.array(F.expr(f"substring(phrase, 1, octet_length(phrase) - {width})"), F.expr(f"substring(phrase, {width} + 1)"))
    held = longer.select(F.explode(parts).alias("phrase"), F.col("a").alias("held")).groupBy("phrase").agg(F.max("held").alias("held"))
    return scored.join(held, "phrase", "left").where(F.col("held").isNull() | (F.lit(100) * F.col("held") < F.lit(share) * F.col("a"))).drop("held")


def spell(scored: DataFrame, words: DataFrame, width: int) -> DataFrame:
    """`scored` with its phrases' words, joined by one space."""
    places = F.expr(f"transform(sequence(0, octet_length(phrase) div {width} - 1), i -> struct(i as i, substring(phrase, i * {width} + 1, {width}) as key))")
    single = scored.select("phrase", F.explode(places).alias("p")).select("phrase", "p.i", "p.key").join(words.select("key", "word"), "key")
    spelled = single.groupBy("phrase").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("spelled"))
    return scored.join(spelled, "phrase").drop("phrase").withColumnRenamed("spelled", "phrase")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, share: int = 100, most_words: int = MOST_WORDS) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every phrase that isn't part of an equally frequent longer one."""
    words, phrases, width = count_phrases(docs, text_col, lang_col, least, most_words)
    return spell(drop_contained(score_phrases(words, phrases, width), phrases, width, share), words, width)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: each language's first phrases by score."""
    found = collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM w, range(1, 6) AS r(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 100),
s AS (SELECT c.lang, c.k, c.phrase, c.a, x.f AS l, y.f AS r, n.n, ((1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score, row_number() OVER (PARTITION BY c.lang, c.k, c.phrase ORDER BY (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f), j) AS nth
  FROM c JOIN n USING (lang), unnest(range(1, c.k)) AS t(j) JOIN g x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ') JOIN g y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
h AS (SELECT c.lang, m AS k, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS held FROM c, range(2, 5) AS r(m), unnest(range(1, len(w) - m + 2)) AS t(i) WHERE m < c.k GROUP BY ALL),
b AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank FROM s LEFT JOIN h ON h.lang = s.lang AND h.k = s.k AND h.phrase = s.phrase WHERE nth = 1 AND (held IS NULL OR 100 * held < 100 * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM b WHERE rank <= 2000"""
