"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items fall into classes by their number of distinct five-word shingles. Of each item a bottom-k MinHash sketch
is kept, the k of its shingles that come first under a fixed permutation: all of them in the smallest class, 16 or 32
in the others. A document is never sketched: each of its shingles is looked up among the sketches, so the shares of
sketch and item that it holds agree, however long it is and however far apart the item's shingles lie in it. A document
that holds as much of a sketch as containment asks for (in the smallest class exactly, in the others less a margin that an item
at the threshold misses with a chance below MISS) is a candidate, and is verified by the exact share of the item's
shingles that the whole document holds. Items of the smallest class are never missed.

Up to MOST_ITEMS items of MOST_CHARS characters in all, which is checked, their index goes to every worker. Beyond, a
document's shingles that pass a bitmap of a fixed 2**BITMAP_BITS bits are joined with the sketches, and those of
candidates with the items. Both give the same candidates.

Defined results. Item ids are integers, or text that holds one; any other is an error. Null text, or fewer than five
words, on either side: no shingles, nothing found. Null ids: kept as they are. Repeated items or documents: each is
reported. Very long texts are read whole, in slices. Empty tables: no rows. Other columns pass through, but for one of the name `into`, which is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.durable import checkpoint
from tessera.llm.shingles import SHINGLE_WORDS
from tessera.llm.words import Words, mix, release, slices, window_hashes, window_starts

CONTAINMENT = 0.8
#: Size classes: up to so many shingles, and how many of them are kept (None: all).
CLASSES = ((16, None), (256, 16), (1 << 62, 32))
MISS = 1e-6
MOST_ITEMS, MOST_CHARS = 20_000, 32_000_000
BITMAP_BITS = 27
#: Parts that a shingle's documents are dealt to, as one may stand in most of them.
SALTS = 16

FOUND = "array<struct<item:bigint,n_shingles:bigint,n_shared:bigint>>"
_FOUND = pa.list_(pa.struct([("item", pa.int64()), ("n_shingles", pa.int64()), ("n_shared", pa.int64())]))


def shingles_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of slices of texts: the first row, each shingle's hash and its row from there. None for fewer words than a shingle has."""
    for a, b in slices(texts):
        words = Words(texts.slice(a, b - a))
        starts, counts = window_starts(words.first, SHINGLE_WORDS)
        yield a, window_hashes(words.hashes(), starts, SHINGLE_WORDS), np.repeat(np.arange(b - a), counts)


@lru_cache
def need(kept: int, containment: float) -> int:
    """How much of a sketch a document must hold: one that holds the least share of the item has less with a chance below MISS."""
    below, t = 0.0, 0
    while True:
        below += comb(kept, t) * containment**t * (1 - containment) ** (kept - t)
        if below >= MISS:
            return max(t, 1)
        t += 1


def sketch(shingles: np.ndarray, containment: float) -> tuple[np.ndarray, int]:
    """An item's sketch and how much of it a document must hold."""
    kept = next(kept for most, kept in CLASSES if len(shingles) <= most)
    if kept is None:
        return shingles, max(1, ceil(containment * len(shingles) - 1e-9))
    return shingles[np.argpartition(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), kept)[:kept]], need(kept, containment)


@dataclass(frozen=True)
class Index:
    """Items: ids, distinct shingles and needs; sorted sketch hashes, the item of each, and a bitmap that passes few others."""

    ids: list
    shingles: list[np.ndarray]
    needs: np.ndarray
    hashes: np.ndarray
    items: np.ndarray
    bitmap: np.ndarray

    @staticmethod
    def build(ids: list, texts: pa.Array, containment: float) -> Index:
        kept = []
        for first, hashes, rows in shingles_of(texts):
            kept += [(ids[first + i], np.unique(hashes[rows == i])) for i in np.unique(rows).tolist()]
        sketches = [sketch(s, containment) for _, s in kept]
        hashes = np.concatenate([h for h, _ in sketches]) if kept else np.zeros(0, dtype=np.uint64)
        items = np.repeat(np.arange(len(kept)), [len(h) for h, _ in sketches]) if kept else np.zeros(0, dtype=np.int64)
        order = np.argsort(hashes, kind="stable")
        bits = min(24, max(16, (16 * len(hashes)).bit_length()))
        bitmap = np.zeros(1 << bits, dtype=bool)
        bitmap[hashes >> np.uint64(64 - bits)] = True
        return Index([i for i, _ in kept], [s for _, s in kept], np.array([n for _, n in sketches], dtype=np.int64), hashes[order], items[order], bitmap)

    def candidates(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of shingles and their rows: the rows and items that may match, by row, then item."""
        shift = np.uint64(65 - len(self.bitmap).bit_length())
        some = np.flatnonzero(self.bitmap[hashes >> shift])
        hashes, rows = hashes[some], rows[some]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        some = np.flatnonzero(self.hashes[at] == hashes)
        pairs = np.unique(np.stack([rows[some].astype(np.uint64), hashes[some]], axis=1), axis=0)
        begin, end = (np.searchsorted(self.hashes, pairs[:, 1], side=side) for side in ("left", "right"))
        count = end - begin
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        both = np.stack([np.repeat(pairs[:, 0].astype(np.int64), count), self.items[np.repeat(begin, count) + place]], axis=1)
        both, held = np.unique(both, axis=0, return_counts=True)
        both = both[held >= self.needs[both[:, 1]]]
        return both[:, 0], both[:, 1]

    def search(self, texts: pa.Array, containment: float) -> list[list[dict]]:
        """What each text holds."""
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        if not self.ids:
            return out
        for first, hashes, rows in shingles_of(texts):
            near, items = self.candidates(hashes, rows)
            last = own = None
            for row, i in zip(near.tolist(), items.tolist(), strict=True):
                if row != last:
                    begin, end = np.searchsorted(rows, [row, row + 1])
                    last, own = row, np.unique(hashes[begin:end])
                item = self.shingles[i]
                at = np.minimum(np.searchsorted(own, item), len(own) - 1)
                shared = int((own[at] == item).sum())
                if shared >= containment * len(item):
                    out[first + row].append({"item": self.ids[i], "n_shingles": len(item), "n_shared": shared})
        return out


def _searcher(index: Index, containment: float) -> Callable:
    @F.arrow_udf(FOUND)
    def search(texts: pa.Array) -> pa.Array:
        found = pa.array(index.search(texts, containment), _FOUND)
        release()
        return found

    return search


def _item_shingles(containment: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, rows in shingles_of(batch.column("text")):
                for i in np.unique(rows).tolist():
                    own = np.unique(hashes[rows == i])
                    kept, least = sketch(own, containment)
                    n = len(own)
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column("item_key")[first + i].as_py()] * n, pa.binary()), pa.array(own.view(np.int64)), pa.array(np.isin(own, kept)), pa.array([least] * n, pa.int32()), pa.array([n] * n, pa.int64())], names=["item_key", "hash", "kept", "need", "n"])

    return run


def _document_shingles(bitmap):
    """A document's distinct shingles that pass the bitmap (a broadcast array of words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bitmap.value
        for batch in batches:
            keys = batch.column("key")
            for first, hashes, rows in shingles_of(batch.column("text")):
                bit = hashes >> np.uint64(64 - BITMAP_BITS)
                some = np.flatnonzero((words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1))
                pairs = np.unique(np.stack([rows[some].astype(np.uint64), hashes[some]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(pairs[:, 0].astype(np.int64) + first)), pa.array(pairs[:, 1].view(np.int64))], names=["key", "hash"])
            release()

    return run


def _bitmap(hashes: DataFrame):
    """Which of 2**BITMAP_BITS parts the hashes fall into, as a broadcast of 64-bit words: a fixed size for any number."""
    part = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), part.bitwiseAND(F.lit(63)).cast("int"))
    found = hashes.select(F.shiftright(part, 6).alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    words = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    words[found["word"].to_numpy(dtype=np.int64)] = found["mask"].to_numpy(dtype=np.int64)
    return hashes.sparkSession.sparkContext.broadcast(words.view(np.uint64))


def _by_shuffle(docs: DataFrame, items: DataFrame, text_col: str, into: str, containment: float) -> DataFrame:
    """The same search with the items spread out. Only hashes that pass the bitmap are shuffled, never texts; each item is
    met over SALTS parts of the documents, so that a passage in most of them comes to no single task."""
    digest = lambda text: F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = lambda rows: rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    texts = docs.select(digest(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))
    item_keys = items.select("item", "text", digest(F.col("text")).alias("item_key"))
    item_rows = checkpoint(item_keys.select("item_key", "text").dropDuplicates(["item_key"]).mapInArrow(_item_shingles(containment), "item_key binary, hash long, kept boolean, need int, n long"))
    held = checkpoint(texts.mapInArrow(_document_shingles(_bitmap(item_rows)), "key binary, hash long").distinct())
    sketches = item_rows.where("kept").withColumn("salt", salts)
    looked_up = salted(held).join(sketches, ["hash", "salt"])
    near = looked_up.groupBy("key", "item_key").agg(F.count("*").alias("held"), F.min("need").alias("need")).where("held >= need").select("key", "item_key")
    shared = salted(near).join(item_rows.select("item_key", "hash", "n").withColumn("salt", salts), ["item_key", "salt"]).join(held, ["key", "hash"])
    verified = shared.groupBy("key", "item_key").agg(F.count("*").alias("n_shared"), F.min("n").alias("n_shingles")).where(F.col("n_shared") >= containment * F.col("n_shingles"))
    named = salted(verified).join(item_keys.select("item", "item_key").withColumn("salt", salts), ["item_key", "salt"])
    found = named.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("item", "n_shingles", "n_shared"))).alias("__found"))
    joined = docs.withColumn("__key", digest(F.col(text_col))).join(found.withColumnRenamed("key", "__key"), "__key", "left")
    return joined.withColumn(into, F.coalesce("__found", F.array().cast(FOUND))).drop("__key", "__found")


def find_leaks(docs: DataFrame, items: DataFrame, into: str = "leaks", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", containment: float = CONTAINMENT, most_items: int = MOST_ITEMS, most_chars: int = MOST_CHARS) -> DataFrame:
    """`docs` with an array column `into`: each item that the document holds, its shingles, and how many it shares."""
    items = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    if size.n > most_items or size.chars > most_chars:
        return _by_shuffle(docs, items, text_col, into, containment)
    rows = sorted(((r["item"], r["text"]) for r in items.collect()), key=lambda r: (r[0] is None, r[0], r[1] or ""))
    index = Index.build([r[0] for r in rows], pa.array([r[1] for r in rows], pa.string()), containment)
    return docs.withColumn(into, _searcher(index, containment)(F.col(text_col)))


def drop_leaking(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no item."""
    into = "__leaks"
    return find_leaks(docs, items, into=into, **options).where(F.size(into) == 0).drop(into)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every pair of a document and a benchmark item that it holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leak: Column = F.col("leak")
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", leak["item"].alias("item_id"), leak["n_shingles"].alias("n_shingles"), leak["n_shared"].alias("n_shared"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SHINGLES = f"""SELECT DISTINCT id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT {{id}} AS id, {_WORDS} AS w FROM {{table}}) AS t, unnest(range(1, len(w) - 3)) AS u(i)"""
ORACLE = f"""
WITH d AS ({_SHINGLES.format(id='doc_id', table='documents')}), b AS ({_SHINGLES.format(id='item_id', table='benchmark')}),
n AS (SELECT id, count(*) AS n_shingles FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, n.n_shingles, count(*) AS n_shared
FROM b JOIN d USING (s) JOIN n ON n.id = b.id GROUP BY ALL HAVING count(*) >= 0.8 * n.n_shingles"""
