"""Positions in documents as packed rows: a slice of documents sends one row to each bucket it has something for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import pack, unpack

#: Stands for a null id, which comes last.
NO_ID = (1 << 63) - 1
BLOB = "bucket int, n int, n_docs int, ids binary, keys binary, counts binary, at binary"
SCHEMA = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("n_docs", pa.int32()), *((x, pa.binary()) for x in ("ids", "keys", "counts", "at"))])


def bucket_bits(df: DataFrame) -> int:
    """As many bits of a hash as give two buckets to a shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4, (2 * partitions - 1).bit_length())


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (never null), key (a hash of the text, to tell rows with one id apart) and text."""
    text = F.col(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.hash(text).alias("key"), text.alias("text"))


def gather(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, with the places where it does, in order."""
    buckets = buckets.astype(np.int64)
    order = np.argsort(buckets.astype(np.uint16) if len(buckets) and buckets.max() < 1 << 16 else buckets, kind="stable")
    ends = np.cumsum(np.bincount(buckets, minlength=1))
    for k, (s, e) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)):
        if e > s:
            yield k, order[s:e]


def pack_positions(bucket: int, ids: np.ndarray, keys: np.ndarray, at: np.ndarray) -> dict:
    """Positions that rise within each document, as one row; `at` is kept as steps. A repeated row begins anew."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (at[1:] < at[:-1])
    heads = np.flatnonzero(new)
    steps = np.diff(at, prepend=0)
    steps[heads] = at[heads]
    counts = np.diff(np.append(heads, len(at)))
    return {
        "bucket": bucket,
        "n": len(at),
        "n_docs": len(heads),
        "ids": pack(ids[heads]),
        "keys": pack(keys[heads]),
        "counts": pack(counts.astype(np.uint32)),
        "at": pack(steps.astype(np.uint32)),
    }


def unpack_positions(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, keys and places of a packed row."""
    n, docs = row["n"], row["n_docs"]
    counts = unpack(row["counts"], docs, np.uint32).astype(np.int64)
    steps = np.cumsum(unpack(row["at"], n, np.uint32).astype(np.int64))
    heads = np.cumsum(counts) - counts
    before = np.where(heads > 0, steps[heads - 1], 0)
    return np.repeat(unpack(row["ids"], docs, np.int64), counts), np.repeat(unpack(row["keys"], docs, np.int32), counts), steps - np.repeat(before, counts)


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal values stand together, stable, and where in it each run of them begins."""
    order = np.argsort(values, kind="stable")
    return order, np.flatnonzero(np.append(True, values[order][1:] != values[order][:-1]))


def settled(bits: int, targets: int, ids: np.ndarray, keys: np.ndarray, at: np.ndarray) -> Iterator[tuple[dict, np.ndarray]]:
    """Positions whose answer is known before any exchange, in rows for the buckets past the last: 2**bits + target.

    They skip the bucket's work, so that a hot value costs a bucket an entry for each slice and no more."""
    order = np.lexsort((at, keys, ids))
    ids, keys, at = ids[order], keys[order], at[order]
    for k, own in gather((ids ^ keys) % targets):
        yield pack_positions((1 << bits) + k, ids[own], keys[own], at[own]), order[own]


def is_settled(table: pa.Table, bits: int) -> bool:
    return table.column("bucket")[0].as_py() >= 1 << bits


def as_settled(table: pa.Table, bits: int, schema: pa.Schema) -> pa.Table:
    """Settled rows as they leave the bucket stage: dealt out by target."""
    bucket = pa.array(np.asarray(table.column("bucket")) - (1 << bits), pa.int32())
    return pa.Table.from_arrays([bucket, *(table.column(n) for n in schema.names[1:])], schema=schema)


def rows_of(table: pa.Table) -> Iterator[dict]:
    for batch in table.to_batches(max_chunksize=64):
        yield from batch.to_pylist()
