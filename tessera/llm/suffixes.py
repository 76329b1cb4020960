"""Suffix-array dedup by a common-prefix-aware distributed merge sort.

A byte goes if a string of `length` bytes covers it that also starts earlier in the corpus. Sorting every suffix would
move a hundred times the corpus, so only suffixes at anchors are sorted: the anchor of a string is the place, in its
first half, whose next GRAM bytes hash lowest (the leftmost of equals). Equal strings have their anchors at the same
offset, so nothing is lost: two strings are equal if, from their anchors, enough of what follows and all of what
precedes is equal.

1. Each anchor sends the hash of the bytes that all its strings share to the right, packed, once. Anchors whose hash
   is alone in the corpus are done with.
2. The others send their suffixes, cut to `length`, with the bytes before: each slice of documents is one sorted,
   front-coded run for each bucket. Equal contexts in a slice are one entry, the earliest; the others are repeats.
3. A bucket merges its runs with a loser tree whose nodes know the common prefix with what was put out last, so that
   no known prefix is compared again, and gets a suffix array with its longest common prefixes.
4. Over that array, for each offset, suffixes that agree far enough form classes; of a class with equal bytes before,
   all but the earliest string are repeats. Repeats become intervals, merged for each document.

Hashes are 64 bits wide: step 1 only ever keeps too many anchors; in step 4 the up to half of a string that lies
before an anchor is compared by hash.

Defined results. Null text: empty. Texts shorter than `length`: nothing removed. Null id: after all ids. Rows with one
id: one document after the other, in the order of a hash of their texts; rows that repeat id and text are one document
and get the same result. Ids are integers, or text that holds one; any other is an error. Very long texts are read whole,
one to a slice. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.packed import BLOB, NO_ID, SCHEMA, as_settled, bucket_bits, gather, is_settled, keyed, pack_positions, rows_of, runs_of, settled, unpack_positions
from tessera.llm.words import mix, pack, raw_bytes, release, slices, unpack

LENGTH = 100
GRAM = 12
#: Bytes of text to a sorted run.
RUN_BYTES = 4 << 20
#: Stands for bytes past the end; UTF-8 has no such byte.
PAST = 0xFF


def zone(length: int) -> int:
    """The number of places in a string where its anchor may be."""
    if length < 4 * GRAM:
        raise ValueError(f"strings of {length} bytes are too short; at least {4 * GRAM} are needed")
    return length // 2 - GRAM + 1


class Anchors:
    """Of some texts the anchors of all their strings: place in `data`, text, and the first and last offset at which a
    string begins before the anchor."""

    def __init__(self, texts: pa.Array, length: int):
        data, bounds = raw_bytes(texts)
        self.data, self.bounds, self.length, places = data, bounds, length, zone(length)
        self.padded = np.concatenate([data, np.full(length + 16, PAST, dtype=np.uint8)])
        starts = np.maximum(bounds[1:] - bounds[:-1] - length + 1, 0)
        ends = np.cumsum(starts)
        total = int(ends[-1]) if len(ends) else 0
        if not total:
            self.place = self.text = self.first = self.last = np.zeros(0, dtype=np.int64)
            return
        n = len(data)
        lanes = np.ndarray(shape=(n,), dtype="<u8", buffer=self.padded, strides=(1,))
        tails = np.ndarray(shape=(n,), dtype="<u4", buffer=self.padded, offset=8, strides=(1,))
        least = np.ascontiguousarray(lanes)
        least *= np.uint64(0x9E3779B97F4A7C15)
        least ^= least >> np.uint64(29)
        least += np.ascontiguousarray(tails)
        least *= np.uint64(0xBF58476D1CE4E5B9)
        least >>= np.uint64(32)
        least <<= np.uint64(32)
        least |= np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= places:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < places:
            least = np.minimum(least[: len(least) - (places - width)], least[places - width :])
        begin = np.arange(total) + np.repeat(bounds[:-1] - (ends - starts), starts)
        anchor = (least[begin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        heads = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        tails_at = np.append(heads[1:], total) - 1
        self.place = anchor[heads]
        self.text = np.searchsorted(bounds, self.place, side="right") - 1
        self.last, self.first = self.place - begin[heads], self.place - begin[tails_at]

    def hashes(self) -> np.ndarray:
        """Of the bytes after each anchor that all its strings hold."""
        shared = self.length - zone(self.length) + 1
        lanes = np.ndarray(shape=(len(self.padded) - 8,), dtype="<u8", buffer=self.padded, strides=(1,))
        h = np.full(len(self.place), 0x9E3779B97F4A7C15, dtype=np.uint64)
        for at in [*range(0, shared - 8, 8), shared - 8]:
            h = (h ^ lanes[self.place + at]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        return mix(h)

    def contexts(self, own: np.ndarray) -> np.ndarray:
        """Rows of bytes: what follows the chosen anchors, what precedes them read backwards, first and last offset."""
        before = zone(self.length) - 1
        place, text = self.place[own], self.text[own]
        after = place[:, None] + np.arange(self.length)
        right = self.padded[np.minimum(after, len(self.padded) - 1)]
        right[after >= self.bounds[1:][text][:, None]] = PAST
        back = np.arange(before)
        left = self.padded[np.maximum(place[:, None] - 1 - back, 0)]
        left[back >= self.last[own][:, None]] = PAST
        return np.concatenate([right, left, self.first[own][:, None].astype(np.uint8), self.last[own][:, None].astype(np.uint8)], axis=1)


def _hash_anchors(length: int, bits: int, targets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            for a, b in slices(batch.column("text"), RUN_BYTES):
                anchors = Anchors(batch.column("text").slice(a, b - a), length)
                if not len(anchors.place):
                    continue
                hashes, at = anchors.hashes(), anchors.place - anchors.bounds[anchors.text]
                doc_ids, doc_keys = ids[a:b][anchors.text], keys[a:b][anchors.text]
                # Anchors with one hash within the slice are shared already; one of them asks for the other slices'.
                order, heads = runs_of(hashes)
                sizes = np.repeat(np.diff(np.append(heads, len(order))), np.diff(np.append(heads, len(order))))
                known = order[sizes > 1]
                rows = [row for row, _ in settled(bits, targets, doc_ids[known], doc_keys[known], at[known])]
                asked = np.sort(order[heads])
                for bucket, own in gather(hashes[asked] >> np.uint64(64 - bits)):
                    own = asked[own]
                    rows.append(pack_positions(bucket, doc_ids[own], doc_keys[own], at[own]) | {"hashes": pack(hashes[own])})
                yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA.append(pa.field("hashes", pa.binary())))
                del anchors, hashes, at, doc_ids, doc_keys, order, heads, sizes, known, asked, rows
                release()

    return run


def _shared(targets: int, bits: int):
    """Of a bucket: the anchors whose hash another one has too, dealt out by document."""

    def run(table: pa.Table) -> pa.Table:
        if is_settled(table, bits):
            return as_settled(table, bits, SCHEMA)
        parts = [(*unpack_positions(row), unpack(row["hashes"], row["n"], np.uint64)) for row in rows_of(table)]
        ids, keys, at, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.argsort(hashes)
        same = hashes[order][1:] == hashes[order][:-1]
        own = order[np.append(same, False) | np.append(False, same)]
        ids, keys, at = ids[own], keys[own], at[own]
        order = np.lexsort((at, keys, ids))
        ids, keys, at = ids[order], keys[order], at[order]
        out = pa.Table.from_pylist([pack_positions(k, ids[o], keys[o], at[o]) for k, o in gather((ids ^ keys) % targets)], schema=SCHEMA)
        release()
        return out

    return run


def _of_document(table: pa.Table) -> pa.Table:
    ids, keys, at = (np.concatenate(x) for x in zip(*map(unpack_positions, rows_of(table)), strict=True))
    order = np.lexsort((at, keys, ids))
    ids, keys, at = ids[order], keys[order], at[order]
    once = np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (at[1:] != at[:-1]))
    ids, keys, at = ids[once], keys[once], at[once]
    new = np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))
    offsets = np.append(np.flatnonzero(new), len(at)).astype(np.int32)
    return pa.Table.from_arrays([pa.array(ids[new]), pa.array(keys[new]), pa.ListArray.from_arrays(offsets, at.astype(np.int32))], names=["id", "key", "anchors"])


REMOVED = f"{BLOB}, sizes binary"
_REMOVED = SCHEMA.append(pa.field("sizes", pa.binary()))
#: A run's strings, or settled rows of REMOVED, whose run columns are null.
RUN = f"{REMOVED}, lcps binary, tails binary, n_tail long, places binary"
_RUN = pa.schema([*_REMOVED, ("lcps", pa.binary()), ("tails", pa.binary()), ("n_tail", pa.int64()), ("places", pa.binary())])


def front_code(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows of bytes: each one's common prefix with the one before, and all that lies beyond, end to end."""
    lcps = np.zeros(len(rows), dtype=np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        lcps[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return lcps, rows[np.arange(rows.shape[1]) >= lcps[:, None]]


def _sorted_runs(length: int, bits: int, targets: int):
    before = zone(length) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            chosen = batch.column("anchors")
            for a, b in slices(batch.column("text"), RUN_BYTES):
                anchors = Anchors(batch.column("text").slice(a, b - a), length)
                lists = chosen.slice(a, b - a)
                counts = lists.value_lengths().to_numpy()
                wanted = lists.flatten().to_numpy() + np.repeat(anchors.bounds[:-1], counts)
                own = np.flatnonzero(np.isin(anchors.place, wanted))
                if not len(own):
                    continue
                buckets = (anchors.hashes()[own] >> np.uint64(64 - bits)).astype(np.int64)
                contexts = anchors.contexts(own)
                width = contexts.shape[1]
                text = anchors.text[own]
                doc_ids, doc_keys, place = ids[a:b][text], keys[a:b][text], anchors.place[own] - anchors.bounds[text]
                rows, followers = [], []
                for bucket, mine in gather(buckets):
                    mine = mine[np.lexsort((place[mine], doc_keys[mine], doc_ids[mine]))]
                    text_rows = np.ascontiguousarray(contexts[mine])
                    order = np.argsort(text_rows.view(f"V{width}").ravel().view(f"S{width}"), kind="stable")
                    mine, text_rows = mine[order], text_rows[order]
                    new = front_code(text_rows)[0] < width
                    heads = np.flatnonzero(new)
                    # Of equal contexts in the slice the earliest asks; the others repeat it whole, but for its own double.
                    leader = mine[heads][np.cumsum(new) - 1]
                    double = (doc_ids[mine] == doc_ids[leader]) & (doc_keys[mine] == doc_keys[leader]) & (place[mine] == place[leader])
                    followers.append(mine[~double])
                    lcps, tails = front_code(text_rows[heads])
                    asks = mine[heads]
                    rows.append(
                        {
                            "bucket": bucket, "n": len(heads), "lcps": pack(lcps), "tails": pa.compress(tails.tobytes(), codec="zstd", asbytes=True), "n_tail": tails.size,
                            "ids": pack(doc_ids[asks]), "keys": pack(doc_keys[asks]), "places": pack(place[asks].astype(np.uint32)),
                        }
                    )
                whole = np.concatenate(followers)
                first, last = (contexts[whole, length + before + i].astype(np.int64) for i in range(2))
                for row, own_rows in settled(bits, targets, doc_ids[whole], doc_keys[whole], place[whole] - last):
                    rows.append(row | {"sizes": pack((last - first + length)[own_rows].astype(np.uint16))})
                yield pa.RecordBatch.from_pylist(rows, schema=_RUN)
                del anchors, contexts, rows, followers, whole
                release()

    return run


class Run:
    """A sorted run, read string by string: `lcp` with the string before, and the string itself."""

    def __init__(self, lcps: list[int], tails: bytes, width: int):
        self.lcps, self.tails, self.width, self.at, self.next, self.string = lcps, tails, width, 0, 0, b""

    def advance(self) -> int:
        """Moves on; the new string's common prefix with the last, or -1 at the end."""
        if self.next == len(self.lcps):
            return -1
        lcp = self.lcps[self.next]
        end = self.at + self.width - lcp
        self.string = self.string[:lcp] + self.tails[self.at : end]
        self.at, self.next = end, self.next + 1
        return lcp


def merge_runs(runs: list[Run], width: int) -> Iterator[tuple[int, bytes, int]]:
    """(run, string, common prefix with the string put out before) in order, by a loser tree.

    Every string in play carries its common prefix with the last output. Of two, the one with the longer prefix is the
    smaller; only if they are equal, bytes beyond them are compared, and the loser keeps what was learnt."""
    size = 1 << max(0, len(runs) - 1).bit_length()
    loser, known = [0] * size, [-1] * size

    def play(n: int) -> tuple[int, int]:
        if n >= size:
            return n - size, runs[n - size].advance() if n - size < len(runs) else -1
        (r, h), (s, g) = play(2 * n), play(2 * n + 1)
        if g > h:
            r, h, s, g = s, g, r, h
        elif g == h >= 0:
            x, y = runs[r].string, runs[s].string
            common = _common(x, y, h)
            if y < x:
                r, s = s, r
            g = common
        loser[n], known[n] = s, g
        return r, h

    def _common(x: bytes, y: bytes, h: int) -> int:
        if x == y:
            return width
        if x[h] != y[h]:
            return h
        return width - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8

    r, h = play(1)
    while h >= 0:
        yield r, runs[r].string, h
        n, h = (r + size) >> 1, runs[r].advance()
        while n:
            g = known[n]
            if g > h:
                loser[n], r = r, loser[n]
                known[n], h = h, g
            elif g == h and h >= 0:
                s = loser[n]
                x, y = runs[r].string, runs[s].string
                known[n] = _common(x, y, h)
                if y < x:
                    loser[n], r = r, s
            n >>= 1


def repeats(strings: np.ndarray, lcps: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Of a suffix array of distinct contexts: for each, and each offset, whether the string that begins so far before
    the anchor also begins in a context of lower rank."""
    before = zone(length) - 1
    first, last = strings[:, length + before].astype(np.int64), strings[:, length + before + 1].astype(np.int64)
    weights = np.multiply.accumulate(np.full(before, 0x9E3779B97F4A7C15, dtype=np.uint64)) if before else np.zeros(0, dtype=np.uint64)
    out = np.zeros((len(strings), before + 1), dtype=bool)
    by_rank = np.argsort(rank)
    left = np.zeros(len(strings), dtype=np.uint64)
    for offset in range(before + 1):
        if offset:
            left = left + (strings[:, length + offset - 1].astype(np.uint64) + np.uint64(1)) * weights[offset - 1]
        valid = by_rank[(first[by_rank] <= offset) & (offset <= last[by_rank])]
        if len(valid) < 2:
            continue
        classes = np.cumsum(lcps < length - offset).astype(np.uint64)
        key = mix(left[valid]) ^ mix(classes[valid] + np.uint64(offset << 40))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        out[valid[order[1:][same]], offset] = True
    return out


def _merged(length: int, targets: int, bits: int):
    """Of a bucket of runs: the bytes that its repeats cover, as intervals dealt out by document."""
    width = length + zone(length) + 1

    def run(table: pa.Table) -> pa.Table:
        if is_settled(table, bits):
            return as_settled(table, bits, _REMOVED)
        runs, ids, keys, places = [], [], [], []
        for row in rows_of(table):
            runs.append(Run(unpack(row["lcps"], row["n"], np.uint8).tolist(), pa.decompress(row["tails"], decompressed_size=row["n_tail"], codec="zstd", asbytes=True), width))
            for into, name, kind in ((ids, "ids", np.int64), (keys, "keys", np.int32), (places, "places", np.uint32)):
                into.append(unpack(row[name], row["n"], kind))
        offset = np.cumsum([0, *(len(i) for i in ids)])
        ids, keys, places = (np.concatenate(x) for x in (ids, keys, places))
        entry, lcps, strings = [], [], []
        for r, string, lcp in merge_runs(runs, width):
            entry.append(offset[r] + runs[r].next - 1)
            lcps.append(lcp)
            if lcp < width:
                strings.append(string)
        # In the order of the suffix array; context has the number of each entry's distinct context.
        entry, lcps = np.array(entry), np.array(lcps)
        strings = np.frombuffer(b"".join(strings), dtype=np.uint8).reshape(-1, width)
        context = np.cumsum(lcps < width) - 1
        ids, keys, places = ids[entry], keys[entry], places[entry].astype(np.int64)
        order = np.lexsort((places, keys, ids))
        other = np.append(False, (np.diff(ids[order]) != 0) | (np.diff(keys[order]) != 0) | (np.diff(places[order]) != 0))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(other)  # repeated rows are one
        holder = order[np.append(True, other[1:])]
        heads = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        least = np.minimum.reduceat(rank, heads)
        known = repeats(strings, lcps[lcps < width], least, length)
        before = zone(length) - 1
        first, last = (strings[:, length + before + i].astype(np.int64) for i in range(2))
        # The earliest member of a context has the repeats of its context; all the others repeat it whole.
        edges = np.diff(np.pad(known, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, low = np.nonzero(edges == 1)
        high = np.nonzero(edges == -1)[1] - 1
        leader = holder[least[who]]
        rest = np.flatnonzero(rank != least[context])
        one = np.concatenate([leader, rest])
        low, high = np.concatenate([low, first[context[rest]]]), np.concatenate([high, last[context[rest]]])
        begin, size = places[one] - high, high - low + length
        ids, keys = ids[one], keys[one]
        order = np.lexsort((begin, keys, ids))
        ids, keys, begin, size = ids[order], keys[order], begin[order], size[order]
        rows = [pack_positions(k, ids[o], keys[o], begin[o]) | {"sizes": pack(size[o].astype(np.uint16))} for k, o in gather((ids ^ keys) % targets)]
        release()
        return pa.Table.from_pylist(rows, schema=_REMOVED)

    return run


def _intervals(table: pa.Table) -> pa.Table:
    """Of one share of the documents: the maximal intervals of bytes that go."""
    parts = [(*unpack_positions(row), unpack(row["sizes"], row["n"], np.uint16).astype(np.int64)) for row in rows_of(table)]
    ids, keys, begin, size = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((begin, keys, ids))
    ids, keys, begin, end = ids[order], keys[order], begin[order], (begin + size)[order]
    doc = np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))
    # Documents laid end to end, so that one running maximum serves all.
    shift = np.cumsum(doc) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    heads = np.flatnonzero(np.append(True, (begin + shift)[1:] > reach[:-1]))
    tails = np.append(heads[1:], len(begin)) - 1
    offsets = np.append(np.searchsorted(heads, np.flatnonzero(doc)), len(heads)).astype(np.int32)
    ends = (reach - shift)[tails]
    return pa.Table.from_arrays([pa.array(ids[doc]), pa.array(keys[doc]), pa.ListArray.from_arrays(offsets, begin[heads].astype(np.int32)), pa.ListArray.from_arrays(offsets, ends.astype(np.int32))], names=["id", "key", "begins", "ends"])


_KEPT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("kept", pa.binary())])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_bytes, kept = [], []
        for text, begins, ends in zip(batch.column("text"), batch.column("begins"), batch.column("ends"), strict=True):
            data = (text.as_py() or "").encode()
            n_bytes.append(len(data))
            if begins.is_valid:
                data = b"".join(data[a:b] for a, b in zip([0, *ends.as_py()], [*begins.as_py(), len(data)], strict=True))
            kept.append(data)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_bytes, pa.int64()), batch.column("begins"), batch.column("ends"), pa.array(kept, pa.binary())], schema=_KEPT)
        del kept
        release()


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """A row for each document: its id, n_bytes, n_removed, removed (maximal runs of bytes, ends exclusive), kept (the
    other bytes)."""
    zone(length)
    targets, bits = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), bucket_bits(docs)
    texts = keyed(docs, id_col, text_col)
    hashed = texts.mapInArrow(_hash_anchors(length, bits, targets), f"{BLOB}, hashes binary")
    shared = hashed.groupBy("bucket").applyInArrow(_shared(targets, bits), BLOB)
    chosen = shared.groupBy("bucket").applyInArrow(_of_document, "id long, key int, anchors array<int>")
    # Both joins deal out the texts alike, so that they are shuffled once.
    runs = texts.join(chosen, ["id", "key"]).mapInArrow(_sorted_runs(length, bits, targets), RUN)
    removed = runs.groupBy("bucket").applyInArrow(_merged(length, targets, bits), REMOVED)
    spans = removed.groupBy("bucket").applyInArrow(_intervals, "id long, key int, begins array<int>, ends array<int>")
    joined = texts.join(spans, ["id", "key"], "left").select("id", "text", "begins", "ends")
    kept = joined.mapInArrow(_keep, "id long, n_bytes long, begins array<int>, ends array<int>, kept binary")
    found = F.coalesce(F.transform(F.arrays_zip("begins", "ends"), lambda x: F.struct(x["begins"].alias("begin"), x["ends"].alias("end"))), F.array().cast("array<struct<begin:int,end:int>>"))
    return kept.select(F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), found.alias("removed"), "kept")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: every document's bytes after 100-byte strings that start earlier are removed."""
    kept = dedup_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_bytes", F.col("n_removed").cast("long").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte, CASE WHEN i + 100 <= n THEN substr(h, 2 * i + 1, 200) END AS s FROM d, unnest(range(n)) AS t(i)),
r AS (SELECT doc_id, i, byte, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM p),
c AS (SELECT doc_id, i, byte, coalesce(i - max(CASE WHEN again THEN i END) OVER w < 100, false) AS gone FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM c),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""
