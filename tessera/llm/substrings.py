"""Substring dedup over words.

Rabin-Karp hashes of every window of a fixed number of words are dealt out by hash and counted; a window that also
starts in a document with a smaller id is removed, and neighbouring ones merge into maximal intervals of words.

The exchange carries each window once, as eight bytes of hash and about one of position: a slice of documents
becomes one packed row for each bucket of hashes, in document order. A bucket holds about half of what a
shuffle partition should hold, so `spark.sql.shuffle.partitions` is the one thing to size. Of a window that a slice holds
in several documents only the least one's are sent to be compared, so a hot window costs its bucket an entry a slice.

Windows are compared by 64-bit hash. With n windows in the corpus about n * n / 2**65 of them meet another by chance.

Defined results. Null text: no words. Text shorter than the window: nothing is removed. Null id: after all ids, and
never before another null. Rows with the same id: they never remove each other's words. Repeated rows: each gets the
same result. Very long texts are read whole, one to a slice. Ids are integers, or text that holds one; any other is an error. Empty table: no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.packed import BLOB, NO_ID, SCHEMA, as_settled, bucket_bits, gather, is_settled, keyed, pack_positions, rows_of, runs_of, settled, unpack_positions
from tessera.llm.words import Words, pack, release, slices, unpack, window_hashes, window_starts

#: Bytes of text to a packed slice: with larger ones the documents' ids weigh less.
PACKED_BYTES = 4 << 20
HASHED = f"{BLOB}, hashes binary"
_HASHED_SCHEMA = SCHEMA.append(pa.field("hashes", pa.binary()))


def _hash_windows(length: int, bits: int, targets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            for a, b in slices(batch.column("text"), PACKED_BYTES):
                words = Words(batch.column("text").slice(a, b - a))
                starts, counts = window_starts(words.first, length)
                if not len(starts):
                    continue
                hashes = window_hashes(words.hashes(), starts, length)
                doc = np.repeat(np.arange(b - a), counts)
                at = starts - words.first[doc]
                doc_ids, doc_keys = ids[a:b][doc], keys[a:b][doc]
                # Within the slice only a window's least document is in question; the others are repeats already.
                order, heads = runs_of(hashes)
                least = np.empty(len(order), dtype=np.int64)
                least[order] = np.repeat(np.minimum.reduceat(doc_ids[order], heads), np.diff(np.append(heads, len(order))))
                known = np.flatnonzero(doc_ids > least)
                rows = [row for row, _ in settled(bits, targets, doc_ids[known], doc_keys[known], at[known])]
                asked = np.flatnonzero(doc_ids == least)
                for k, own in gather(hashes[asked] >> np.uint64(64 - bits)):
                    own = asked[own]
                    rows.append(pack_positions(k, doc_ids[own], doc_keys[own], at[own]) | {"hashes": pack(hashes[own])})
                yield pa.RecordBatch.from_pylist(rows, schema=_HASHED_SCHEMA)
                del words, starts, hashes, doc, at, doc_ids, doc_keys, order, heads, least, known, asked, rows
                release()

    return run


def _repeats(targets: int, bits: int):
    """Of one bucket of hashes: the windows that also start in a document with a smaller id, dealt out by document."""

    def run(table: pa.Table) -> pa.Table:
        if is_settled(table, bits):
            return as_settled(table, bits, SCHEMA)
        parts = [(*unpack_positions(row), unpack(row["hashes"], row["n"], np.uint64)) for row in rows_of(table)]
        ids, keys, at, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.argsort(hashes)
        same = hashes[order][1:] == hashes[order][:-1]
        own = order[np.append(same, False) | np.append(False, same)]
        if not len(own):
            return SCHEMA.empty_table()
        heads = np.flatnonzero(np.append(True, hashes[own][1:] != hashes[own][:-1]))
        least = np.repeat(np.minimum.reduceat(ids[own], heads), np.diff(np.append(heads, len(own))))
        own = own[ids[own] > least]
        ids, keys, at = ids[own], keys[own], at[own]
        order = np.lexsort((at, keys, ids))
        ids, keys, at = ids[order], keys[order], at[order]
        rows = [pack_positions(k, ids[o], keys[o], at[o]) for k, o in gather((ids ^ keys) % targets)]
        del hashes, same, own, least, order
        release()
        return pa.Table.from_pylist(rows, schema=SCHEMA)

    return run


_INTERVALS = pa.schema([("id", pa.int64()), ("key", pa.int32()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


def _intervals(length: int):
    """Of one share of the documents: the maximal intervals of words that their removed windows cover."""

    def run(table: pa.Table) -> pa.Table:
        ids, keys, at = (np.concatenate(x) for x in zip(*map(unpack_positions, rows_of(table)), strict=True))
        order = np.lexsort((at, keys, ids))
        ids, keys, at = ids[order], keys[order], at[order]
        doc = np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))
        new = doc | np.append(True, np.diff(at) > length)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(at)) - 1
        offsets = np.append(np.searchsorted(heads, np.flatnonzero(doc)), len(heads)).astype(np.int32)
        begins, ends = at[heads].astype(np.int32), (at[tails] + length).astype(np.int32)
        return pa.Table.from_arrays([pa.array(ids[doc]), pa.array(keys[doc]), pa.ListArray.from_arrays(offsets, begins), pa.ListArray.from_arrays(offsets, ends)], schema=_INTERVALS)

    return run


_KEPT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("kept_text", pa.string())])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, begins, ends in zip(batch.column("text"), batch.column("begins"), batch.column("ends"), strict=True):
            words = (text.as_py() or "").encode().split()
            n_words.append(len(words))
            if begins.is_valid:
                stay, last = [], 0
                for begin, end in zip(begins.as_py(), ends.as_py(), strict=True):
                    stay += words[last:begin]
                    last = end
                stay += words[last:]
            else:
                stay = words
            n_removed.append(len(words) - len(stay))
            kept.append(b" ".join(stay))
        columns = [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), batch.column("begins"), batch.column("ends"), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, schema=_KEPT)
        del kept, columns
        release()


def removal_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """id, key (of the text), begins, ends: the removed intervals of words of each document that has any."""
    bits = bucket_bits(docs)
    targets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = keyed(docs, id_col, text_col).mapInArrow(_hash_windows(window, bits, targets), HASHED)
    repeats = hashed.groupBy("bucket").applyInArrow(_repeats(targets, bits), BLOB)
    return repeats.groupBy("bucket").applyInArrow(_intervals(window), "id long, key int, begins array<int>, ends array<int>")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """A row for each document: its id, n_words, n_removed, removed (intervals of words, ends exclusive), kept_text
    (the other words, joined by one space)."""
    intervals = removal_intervals(docs, id_col, text_col, window)
    joined = keyed(docs, id_col, text_col).join(intervals, ["id", "key"], "left").select("id", "text", "begins", "ends")
    kept = joined.mapInArrow(_keep, "id long, n_words long, n_removed long, begins array<int>, ends array<int>, kept_text string")
    spans = F.transform(F.arrays_zip("begins", "ends"), lambda x: F.struct(x["begins"].alias("begin"), x["ends"].alias("end")))
    return kept.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col),
        "n_words",
        "n_removed",
        F.coalesce(spans, F.array().cast("array<struct<begin:int,end:int>>")).alias("removed"),
        "kept_text",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every document's words and kept text after 13-word windows that occur earlier are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS f FROM x),
g AS (SELECT DISTINCT doc_id, i + k AS p FROM m, range(13) AS r(k) WHERE f < doc_id),
p AS (SELECT doc_id, i AS p, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM p ANTI JOIN g USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""
