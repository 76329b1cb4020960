"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources, in code point order with null last, weigh `weights`, repeating, and share all words; a target stops at `most`
times its source's words, and the excess is shared again by weight until none is above. A source's documents fall by
hash into blocks, which are permuted. Its quota is as many whole passes over its blocks as its target holds, then
blocks in their permuted order until the target is met; of the block in which that happens, documents are taken in
random order as they fit, and one more if that comes nearer.

The quotas of all sources are split between the two halves of the output shards by a multivariate-hypergeometric
draw, each half likewise, down to single shards, WAYS at a time, each node of the tree in a task of its own. So every shard gets
an exact number of block draws of every source, its own range of the source's permuted draws, and shuffles what it
drew by a hash of its own. What the mix takes of a document is what the shards drew. Every random choice comes from
`seed` and hashes, so that reruns agree.

Nothing is collected. A row for each source passes through one task, and the tree's root is one vector over all
sources; their table is broadcast only if a count finds it short. Blocks number at most MOST_BLOCKS a source, and ALL_BLOCKS and one a source in all, beyond which they hold more documents;
so fewer than 10**9 draws are ever split, which the generator needs, up to 10**8 sources.

Defined results. Null text: size 0. Null source: a source of its own, the last. Size 0: in the mix where its block is.
Rows that repeat both id and text are taken together, and count with all their words. Null ids: as one more id. No
document has more than `most` copies. Very long texts are one row as any. Empty table: no rows. Other columns pass through `mix`, but for mix_copy,
mix_shard and mix_place, which it replaces: a mix can be mixed again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.durable import checkpoint
from tessera.llm.words import Words, release, slices

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 20
#: Documents to a block at least; blocks to a source, and to all sources, at most.
BLOCK_DOCS, MOST_BLOCKS, ALL_BLOCKS = 64, 1 << 16, 1 << 26
#: Up to so many sources their table is broadcast; beyond, rows of a source are dealt over SALTS parts and joined.
FEW_SOURCES, SALTS = 10_000, 64
#: Parts that a node of the tree is split into in one go.
WAYS = 64


@F.arrow_udf(T.LongType())
def n_words(texts: pa.Array) -> pa.Array:
    parts = [Words(texts.slice(a, b - a)).counts() for a, b in slices(texts)]
    release()
    return pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), pa.int64())


def targets(sizes: np.ndarray, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> np.ndarray:
    """Each source's target in words; `sizes` are in the sources' order."""
    sizes = np.asarray(sizes, dtype=float)
    weight = np.resize(np.array(weights, dtype=float), len(sizes))
    found, left, open_ = np.zeros(len(sizes)), sizes.sum(), np.ones(len(sizes), dtype=bool)
    while open_.any():
        share = left * weight / weight[open_].sum()
        full = open_ & (share > most * sizes)
        if not full.any():
            found[open_] = share[open_]
            break
        found[full] = most * sizes[full]
        left -= found[full].sum()
        open_ &= ~full
    return found


def split_counts(counts: np.ndarray, left: int, right: int, seed: int, ways: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """A node of the tree, the draws `counts` of each source over shards `left` to `right`, as at most `ways` nodes below
    it: their shards, the draws of each source before them in this node, and their own. Draws are shared by numbers of shards."""
    out = []

    def split(left: int, right: int, before: np.ndarray, counts: np.ndarray, ways: int) -> None:
        if ways < 2 or right - left == 1:
            out.append((left, right, before, counts))
            return
        middle, total = (left + right) // 2, int(counts.sum())
        rng = np.random.default_rng([seed, left, right])
        mine = rng.multivariate_hypergeometric(counts, total * (middle - left) // (right - left)) if total else counts
        split(left, middle, before, mine, ways // 2)
        split(middle, right, before + mine, counts - mine, ways // 2)

    counts = np.asarray(counts, dtype=np.int64)
    split(left, right, np.zeros_like(counts), counts, ways)
    return out


def _stride(blocks: int, seed: int) -> int:
    """A step that visits all of `blocks` blocks once."""
    step = 1 + (seed * 2654435761) % max(blocks, 1)
    while np.gcd(step, blocks) != 1:
        step += 1
    return int(step)


def _fits(room: float, sizes: np.ndarray) -> np.ndarray:
    """Which documents to take, in order: those that still fit, then the smallest left if that comes nearer."""
    took = np.zeros(len(sizes), dtype=bool)
    for i, size in enumerate(sizes.tolist()):
        if size <= room:
            took[i], room = True, room - size
    left = np.flatnonzero(~took)
    if len(left) and abs(sizes[left].min() - room) < room:
        took[left[sizes[left].argmin()]] = True
    return took


def _take(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["lot", "size"], kind="stable")
    return pd.DataFrame({"at": pdf["at"], "lot": pdf["lot"], "took": _fits(float(pdf["room"].iloc[0]), pdf["size"].to_numpy())})


def _marks(id_col: str, text_col: str, source_col: str, seed: int) -> tuple[Column, Column]:
    """A document's source, told from null, and its lot: the random number that all its repeated rows share."""
    source = F.col(source_col).cast("string")
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


_SOURCES = "at string, source_size long, target double, blocks int, stride int, passes int, rest double"
_NODES = "lo int, hi int, at string, first long, n long"


def _planner(weights: tuple[float, ...], most: int, seed: int):
    """From a row for each source, their targets, blocks and passes. "n" marks null, "s" and its name any other."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((pdf["at"].map(lambda x: x.encode("utf-32-be")), pdf["at"] == "n"))
        pdf = pdf.iloc[order]
        size, docs = pdf["size"].to_numpy(dtype=np.int64), pdf["docs"].to_numpy(dtype=np.int64)
        goal = targets(size, weights, most)
        per_block = max(BLOCK_DOCS, -(-int(docs.sum()) // ALL_BLOCKS))
        blocks = np.minimum(MOST_BLOCKS, -(-docs // per_block))
        stride = [_stride(int(n), seed + i) for i, n in enumerate(blocks)]
        passes = np.minimum(goal // np.maximum(size, 1), most).astype(np.int64)
        return pd.DataFrame({"at": pdf["at"], "source_size": size, "target": goal, "blocks": blocks, "stride": stride, "passes": passes, "rest": goal - passes * size})

    return run


def _splitter(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        at, first = pdf["at"].to_numpy(), pdf["first"].to_numpy(dtype=np.int64)
        parts = []
        for lo, hi, before, counts in split_counts(pdf["n"].to_numpy(dtype=np.int64), int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0]), seed, WAYS):
            some = np.flatnonzero(counts)
            parts.append(pd.DataFrame({"lo": lo, "hi": hi, "at": at[some], "first": first[some] + before[some], "n": counts[some]}))
        return pd.concat(parts)

    return run


def shard_ranges(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(at, shard, first, n): the draws of each source (at, n) that each shard gets, n from the first on, where any."""
    nodes = quotas.where("n > 0").select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "at", F.lit(0).cast("long").alias("first"), "n")
    width = shards
    while width > 1:
        nodes = nodes.groupBy("lo", "hi").applyInPandas(_splitter(seed), _NODES)
        width = -(-width // WAYS)
    return nodes.select("at", F.col("lo").alias("shard"), "first", "n")


def _by_source(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """`rows` (at, lot) with their source's columns."""
    if few:
        return rows.join(F.broadcast(sources), "at")
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return rows.withColumn("salt", F.pmod("lot", F.lit(SALTS)).cast("int")).join(sources.select("*", salt), ["at", "salt"]).drop("salt")


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST, shards: int | None = None, seed: int = SEED, few_sources: int = FEW_SOURCES) -> tuple[DataFrame, DataFrame]:
    """Documents (id, source, at, lot, size, source_size, target) and draws (at, lot, copy, shard, place): each draw is
    one copy of the documents of that source and lot in a shard, whose order is by place."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at, lot = _marks(id_col, text_col, source_col, seed)
    sized = checkpoint(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), at.alias("at"), lot.alias("lot"), n_words(F.col(text_col)).alias("size")))
    totals = sized.groupBy("at").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    sources = checkpoint(totals.groupBy(F.lit(0).alias("all")).applyInPandas(_planner(weights, most, seed), _SOURCES))
    few = sources.count() <= few_sources

    placed = _by_source(sized.groupBy("at", "lot").agg(F.sum("size").alias("size")), sources, few)
    placed = placed.withColumn("turn", F.pmod(F.pmod(F.col("lot"), F.col("blocks")) * F.col("stride"), F.col("blocks")))
    block_rows = placed.groupBy("at", "turn", "rest", "passes").agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("at").orderBy("turn")  # at most MOST_BLOCKS rows each
    before = F.coalesce(F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    block_rows = block_rows.withColumns({"room": F.col("rest") - before, "rank": F.row_number().over(in_order) - 1})
    # A block with room for all its words is drawn once more; one with room for some of them is the last.
    state = F.when(F.col("room") <= 0, 0).when(F.col("words") <= F.col("room"), 1).otherwise(2)
    block_rows = checkpoint(block_rows.select("at", "turn", "rank", "room", "passes", state.alias("state")))

    # Draws of a source in order: its blocks by rank, pass after pass, then the ones that are drawn once more.
    quotas = block_rows.groupBy("at").agg(F.count("*").alias("blocks"), F.sum(F.col("passes") + (F.col("state") > 0).cast("int")).alias("n"))
    ranges = shard_ranges(quotas.select("at", "n"), shards, seed).join(quotas.select("at", "blocks"), "at")
    draw = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))
    block_draws = ranges.select("at", "shard", "blocks", draw.alias("draw")).select("at", "shard", (F.col("draw") % F.col("blocks")).cast("int").alias("rank"), F.floor(F.col("draw") / F.col("blocks")).cast("int").alias("copy"))
    block_draws = block_draws.join(block_rows, ["at", "rank"]).select("at", "turn", "copy", "shard", "state", "passes", "room")

    drawn = placed.select("at", "turn", "lot", "size").join(block_draws, ["at", "turn"])
    in_part = (F.col("state") == 2) & (F.col("copy") == F.col("passes"))
    taken = drawn.where(in_part).select("at", "turn", "lot", "size", "room").groupBy("at", "turn").applyInPandas(_take, "at string, lot long, took boolean")
    some = drawn.where(in_part).select("at", "lot", "copy", "shard").join(taken.where("took"), ["at", "lot"]).drop("took")
    draws = drawn.where(~in_part).select("at", "lot", "copy", "shard").unionByName(some)
    draws = draws.withColumn("place", F.xxhash64(F.lit(seed + 1), "shard", "lot", "copy"))
    return _by_source(sized, sources.select("at", "source_size", "target"), few), draws


MIX_COLUMNS = ("mix_copy", "mix_shard", "mix_place")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int | None = None, seed: int = SEED, **options) -> DataFrame:
    """The mix: `docs`, a row for each draw, with `mix_copy`, `mix_shard` and, in `mix_place`, the shard's order."""
    docs = docs.drop(*MIX_COLUMNS)
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _, draws = plan_mix(docs, id_col, text_col, source_col, shards=shards, seed=seed, **options)
    draws = draws.select(F.col("at").alias("__at"), F.col("lot").alias("__lot"), F.col("copy").alias("mix_copy"), F.col("shard").alias("mix_shard"), F.col("place").alias("mix_place"))
    at, lot = _marks(id_col, text_col, source_col, seed)
    mixed = docs.withColumns({"__at": at, "__lot": lot}).join(draws, ["__at", "__lot"]).drop("__at", "__lot")
    return mixed.repartitionById(shards, F.col("mix_shard")).sortWithinPartitions("mix_shard", "mix_place")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every document's size, its source's size and target, and the words that the mix's shards take of it; `drawn`
    lists the shards that drew it, by copy, each with the document's place in the shard's order."""
    planned, draws = plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    drawn = draws.groupBy("at", "lot").agg(F.array_sort(F.collect_list(F.struct("copy", "shard", "place"))).alias("drawn"))  # at most MOST
    listed = F.array_join(F.transform(F.coalesce("drawn", F.array()), lambda x: F.concat_ws(":", x["shard"].cast("string"), x["place"].cast("string"))), ",")
    copies = F.coalesce(F.size("drawn"), F.lit(0))
    joined = planned.join(drawn, ["at", "lot"], "left")
    return joined.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), listed.alias("drawn"))
