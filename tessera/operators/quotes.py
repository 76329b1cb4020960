"""Which unit of its document holds a quote, without comparing all quotes with all units (survey F2, F3, H8).

An inverted index of minimizers: of every `WINDOW` neighbouring strings of `GRAM` bytes in a text the one that hashes lowest.
A unit that holds a quote of `LEAST` bytes or more has all minimizers of the quote, so the quote is looked up by the one
that the fewest units have; shorter quotes are looked up as they are. Token sets are looked up by their rarest token. A unit
meets the places of its own document's keys and the sizes of its quotes; only keys of such a size and place leave its task, so that
the index grows with the quotes and not with all text. An exact check follows, so hashes can't make or lose a match. Equal texts of a document are
indexed once, under their first unit, and equal quotes asked once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.durable import Scratch
from tessera.functions.text import collapse_whitespace, nfkc, token_set
from tessera.operators.joins import may_hold

GRAM, WINDOW = 8, 8
LEAST = GRAM + WINDOW - 1
#: Places of a document's keys, 8 kB at most. With more keys than places more pass, never fewer.
PLACES = 1 << 12
#: Bytes of text that are hashed at once, if more than one unit.
CHUNK = 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(28))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _lanes(data: bytes) -> np.ndarray:
    """The eight bytes from each place on, as numbers; zeros after the end."""
    padded = np.frombuffer(data + b"\0" * 7, dtype=np.uint8)
    return np.ndarray(shape=(len(data),), dtype="<u8", buffer=padded.tobytes(), strides=(1,))


def minimizers(data: bytes) -> np.ndarray:
    """The lowest hash of each window, once; none for texts shorter than LEAST."""
    if len(data) < LEAST:
        return np.zeros(0, dtype=np.uint64)
    hashes = _mix(_lanes(data)[: len(data) - GRAM + 1])
    return np.unique(np.lib.stride_tricks.sliding_window_view(hashes, WINDOW).min(axis=1))


def strings(data: bytes, length: int) -> np.ndarray:
    """A hash of each string of `length` bytes, at most LEAST - 1."""
    if len(data) < length:
        return np.zeros(0, dtype=np.uint64)
    lanes, n = _lanes(data), len(data) - length + 1
    first = lanes[:n] & np.uint64((1 << (8 * min(length, 8))) - 1)
    rest = lanes[8 : 8 + n] & np.uint64((1 << (8 * (length - 8))) - 1) if length > 8 else np.zeros(n, dtype=np.uint64)
    return np.unique(_mix(_mix(first + np.uint64(length)) ^ rest))


def _own(data: bytes) -> np.ndarray:
    """The keys by which a quote can be looked up."""
    return minimizers(data) if len(data) >= LEAST else strings(data, len(data))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quotes (id, salt: a hash of the document, text) -> (id, salt, key)."""
    for batch in batches:
        salts = batch.column("salt").to_numpy().view(np.uint64)
        each = [_mix(_own((text.as_py() or "").encode()) ^ salt) for text, salt in zip(batch.column("text"), salts, strict=True)]
        yield _postings(batch, np.repeat(np.arange(len(each)), np.array([len(k) for k in each], dtype=np.int64)), np.concatenate([np.zeros(0, dtype=np.uint64), *each]))


def _postings(batch: pa.RecordBatch, rows: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    at = pa.array(rows.astype(np.int64))
    return pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("salt").take(at), pa.array(keys.view(np.int64))], names=["id", "salt", "key"])


def _chunk_keys(texts: list[bytes], salts: np.ndarray, document: np.ndarray, wanted: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of texts, once: keys of the sizes that the quotes of a row's document have, at a place that they have. Documents
    are rows of `wanted`, by place, and of `sizes`.

    All texts at once, as one string; what begins in a text and ends in the next is passed over."""
    n = np.array([len(t) for t in texts])
    row, data = np.repeat(np.arange(len(texts)), n), b"".join(texts)
    left = np.cumsum(n)[row] - np.arange(len(data))
    lanes = _lanes(data)
    rows, keys = [], []
    for size in np.flatnonzero(sizes.any(axis=0)):
        at = np.flatnonzero(sizes[document, size][row] & (left >= size))
        if size == LEAST:
            hashes = _mix(lanes)
            own = hashes[at]
            for k in range(1, WINDOW):
                own = np.minimum(own, hashes[at + k])
            new = np.ones(len(at), dtype=bool)  # neighbouring windows mostly have one minimum
            new[1:] = (own[1:] != own[:-1]) | (row[at[1:]] != row[at[:-1]])
            at, own = at[new], own[new]
        else:
            first = lanes[at] & np.uint64((1 << (8 * min(int(size), 8))) - 1)
            rest = lanes[at + 8] & np.uint64((1 << (8 * (int(size) - 8))) - 1) if size > 8 else np.uint64(0)
            own = _mix(_mix(first + np.uint64(size)) ^ rest)
        of = row[at]
        own = _mix(own ^ salts[of])
        met = wanted[document[of], (own % np.uint64(PLACES)).astype(np.int64)]
        rows.append(of[met])
        keys.append(own[met])
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    found = np.unique(np.rec.fromarrays([np.concatenate(rows), np.concatenate(keys)], names="row,key"))
    return found["row"], found["key"]


def _unit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units (id, salt, text, places of their document's keys, sizes of its quotes, LEAST for larger) -> (id, salt, key): the keys at one of the places."""
    for batch in batches:
        salts = batch.column("salt").to_numpy().view(np.uint64)
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        ends = np.cumsum([len(t) for t in texts])
        start = 0
        while start < len(texts):
            end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHUNK, side="right")))
            _, first, document = np.unique(salts[start:end], return_index=True, return_inverse=True)
            wanted, sizes = np.zeros((len(first), PLACES), dtype=bool), np.zeros((len(first), LEAST + 1), dtype=bool)
            for i, f in enumerate(first):
                wanted[i, batch.column("places")[start + int(f)].values.to_numpy()] = True
                sizes[i, batch.column("sizes")[start + int(f)].values.to_numpy()] = True
            part = batch.slice(start, end - start)
            yield _postings(part, *_chunk_keys(texts[start:end], salts[start:end], document, wanted, sizes))
            start = end


def _rarest(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """(quote, unit) pairs: each quote by that of its keys which the fewest units have; one that a key of has none is in none."""
    n = postings.groupBy("key").agg(F.count("*").alias("n"))
    best = asked.join(n, "key", "left").groupBy(F.col("id").alias("quote")).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("b"))
    return best.where("b.n > 0").select("quote", F.col("b.key").alias("key")).join(postings.select("key", F.col("id").alias("unit")), "key").select("quote", "unit")


def _pairs(spark: SparkSession, quotes: DataFrame, units: DataFrame) -> DataFrame:
    """(quote, unit) of texts (id, salt, text) that may hold a quote (id, salt, text)."""
    scratch = Scratch(spark)
    kind = "id long, salt long, key long"
    asked = scratch.put(quotes.mapInArrow(_keys, kind))
    place = F.pmod("key", F.lit(PLACES)).cast("short")  # PLACES divides 2**64, so signs make no difference
    sizes = quotes.groupBy("salt").agg(F.collect_set(F.least(F.octet_length("text"), F.lit(LEAST)).cast("short")).alias("sizes"))
    wanted = asked.groupBy("salt").agg(F.collect_set(place).alias("places")).join(sizes, "salt")
    met = units.join(wanted.hint("merge"), "salt").select("id", "salt", "text", "places", "sizes")
    postings = scratch.put(met.mapInArrow(_unit_keys, kind))
    return _rarest(asked, postings)


def _numbered(scratch: Scratch, rows: DataFrame) -> DataFrame:
    return scratch.put(rows.withColumn("id", F.monotonically_increasing_id()))


def first_units(quotes: DataFrame, units: DataFrame) -> DataFrame:
    """(document_id, candidate_id, unit) of quotes (document_id, candidate_id, source_quote, quote_match_mode): the first unit of
    the document that holds the quote as it is, else with white space collapsed, else (token_set, tables only) all its
    tokens. Units: document_id, unit_id, unit_type, sequence_no, text. Rows without a document have no unit."""
    spark = quotes.sparkSession
    scratch = Scratch(spark)
    table = F.lower("unit_type").isin("table", "table_row")
    texts = units.where("document_id IS NOT NULL AND text IS NOT NULL").groupBy("document_id", F.coalesce(table, F.lit(False)).alias("tabular"), "text").agg(F.min(F.struct("sequence_no", "unit_id")).alias("first"))
    texts = texts.withColumn("text", nfkc(F.col("text")))
    texts = _numbered(scratch, texts.withColumn("salt", F.xxhash64("document_id"))).withColumn("flat", collapse_whitespace(F.col("text")))
    asked = quotes.where("document_id IS NOT NULL").withColumn("quote", nfkc(F.coalesce("source_quote", F.lit(""))))
    asked = asked.withColumn("by_tokens", F.coalesce(F.col("quote_match_mode") == "token_set", F.lit(False)))
    each = asked.select("document_id", "quote", "by_tokens").distinct()
    each = _numbered(scratch, each.withColumns({"flat_quote": collapse_whitespace(F.col("quote")), "salt": F.xxhash64("document_id")}))
    as_quote = each.where("flat_quote <> ''").select("id", "salt", F.col("flat_quote").alias("text"))
    pairs = _pairs(spark, as_quote, texts.select("id", "salt", F.col("flat").alias("text")))
    tokens = lambda rows, text: rows.select("id", F.explode(token_set(F.col(text))).alias("token"), "salt").select("id", F.xxhash64("salt", "token").alias("key"))
    by_tokens = each.where("by_tokens")
    words = scratch.put(tokens(by_tokens, "quote"))
    tabular = scratch.put(tokens(may_hold(texts.where("tabular"), "salt", by_tokens.select(F.col("salt").alias("asked")), "asked"), "text").join(words.select("key").distinct(), "key", "left_semi"))
    pairs = pairs.unionByName(_rarest(words, tabular))
    blank = each.where("flat_quote = ''").select(F.col("id").alias("quote"), "document_id").join(texts.select("document_id", F.col("id").alias("unit")), "document_id").select("quote", "unit")
    pairs = scratch.put(pairs.unionByName(blank).distinct())
    both = pairs.join(each.select(F.col("id").alias("quote"), F.col("document_id"), F.col("quote").alias("raw"), "flat_quote", "by_tokens"), "quote")
    held = may_hold(texts, "id", pairs, "unit")
    both = both.join(held.select(F.col("id").alias("unit"), F.col("document_id").alias("unit_document"), "tabular", "text", "flat", "first").hint("merge"), "unit").where("document_id = unit_document")
    all_tokens = F.col("by_tokens") & F.col("tabular") & (F.size(token_set(F.col("raw"))) > 0) & (F.size(F.array_except(token_set(F.col("raw")), token_set(F.col("text")))) == 0)
    rank = F.when(F.contains(F.col("text"), F.col("raw")), 1).when(F.contains(F.col("flat"), F.col("flat_quote")), 2).when(all_tokens, 3)
    best = both.withColumn("rank", rank).where("rank IS NOT NULL").groupBy("document_id", "raw", "by_tokens").agg(F.min(F.struct("rank", "first")).alias("best"))
    named = asked.select("document_id", "candidate_id", F.col("quote").alias("raw"), "by_tokens")
    return named.join(best, ["document_id", "raw", "by_tokens"]).select("document_id", "candidate_id", F.col("best.first.unit_id").alias("unit"))
