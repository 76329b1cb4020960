"""Strongly connected components of large graphs, for cycles of any length (survey K2, K3).

First each task searches the edges of a range of ids, as ids often lie near those that they refer to: components within a
range become one node, and what leads nowhere else goes. That is repeated on what is left, in ranges of bounded size, as long as
half of it goes or there are fewer ranges. The rest is reduced: nodes without a way in or out go, and runs of nodes with one way in and one way out become one
edge. Runs are found by doubling pointers, so long chains, trees and ladders vanish in about log n rounds. Of what is left each
node points at one of its ways in; the cycles of pointers, found by doubling too, become one node each, as long as that takes
a quarter of the nodes at least, so rings with chords need no round for each of their steps. The rest is
coloured: each node takes the least node that reaches it, by hash order, first along a way whose length doubles each round,
then along all edges. Within a colour, the nodes that reach their colour's node are one component. Every
round handles a row for each edge and node, never a pair of nodes that reach each other."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.durable import Scratch

#: Characters of the hash in front of a node's id, by which nodes are ordered.
_HASH = 16
#: Cycles of pointers are merged again after such a part of the nodes went, else what is left is coloured.
_MERGED = 1 / 4
#: Edges of a range of ids, about.
_PART = 50_000


def _trimmed(edges: DataFrame) -> DataFrame:
    inner = edges.join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
    return inner.join(edges.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").select("src", "dst")


def _run_ends(scratch: Scratch, after: DataFrame) -> DataFrame:
    """after (node, to: the next node of the run or null) -> node, last: of nodes whose run ends.

    Pointers double until a round ends none: rings are left, as a run would have had one at half its length to end."""
    state = scratch.put(after.select("node", F.coalesce("to", "node").alias("to"), F.col("to").isNull().alias("ended")), "pointers")
    left, before = state.where("NOT ended").count(), None
    while left and left != before:
        ahead = state.select(F.col("node").alias("to"), F.col("to").alias("further"), F.col("ended").alias("their_end"))
        moved = state.where("NOT ended").join(ahead, "to").select("node", F.col("further").alias("to"), F.col("their_end").alias("ended"))
        state = scratch.put(state.where("ended").unionByName(moved), "pointers")
        left, before = state.where("NOT ended").count(), left
    return state.where("ended").select("node", F.col("to").alias("last"))


def _compressed(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Edges with each run of one-way nodes as one edge; runs (last, u, e: the nodes before and after); their nodes (node, last); how many."""
    single = lambda own: edges.groupBy(F.col(own).alias("node")).agg(F.count("*").alias("n")).where("n = 1").select("node")
    through = scratch.put(single("src").join(single("dst"), "node", "left_semi"))
    ways = edges.join(through, edges["src"] == through["node"]).select("node", F.col("dst").alias("next"))
    after = ways.join(through.select(F.col("node").alias("next"), F.col("node").alias("to")), "next", "left").select("node", "to")
    n = 0 if through.isEmpty() else (nodes := scratch.put(_run_ends(scratch, after))).count()
    if not n:
        return edges, edges, through, 0
    inside = nodes.select("node")
    entering = edges.join(inside, edges["src"] == inside["node"], "left_anti").join(nodes, edges["dst"] == nodes["node"]).select(F.col("src").alias("u"), "last")
    leaving = ways.join(nodes.select(F.col("last").alias("node")).distinct(), "node").select(F.col("node").alias("last"), F.col("next").alias("e"))
    runs = scratch.put(entering.join(leaving, "last"))
    apart = edges.join(inside, edges["src"] == inside["node"], "left_anti").join(inside, edges["dst"] == inside["node"], "left_anti")
    return scratch.put(apart.unionByName(runs.select(F.col("u").alias("src"), F.col("e").alias("dst"))).distinct()), runs, nodes, n


def _reduced(scratch: Scratch, edges: DataFrame, levels: list, loops: list) -> DataFrame:
    """What is left when nothing can be trimmed or compressed. Adds (runs, nodes) to `levels` and nodes on loops to `loops`."""
    n = edges.count()
    while n:
        loops.append(edges.where("src = dst").select(F.col("src").alias("node")))
        edges = scratch.put(_trimmed(edges.where("src <> dst")))
        left = edges.count()
        if left > n // 2:
            edges, runs, nodes, gone = _compressed(scratch, edges)
            if gone:
                levels.append((runs, nodes))
                left = edges.count()
            elif left == n:
                return edges
        n = left
    return edges


def _into(scratch: Scratch, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between what nodes (node, into, closed) became, but those of closed nodes and from a node to itself."""
    own = lambda c: nodes.select(F.col("node").alias(c), F.col("into").alias(f"{c}_into"), F.col("closed").alias(f"{c}_closed"))
    both = edges.join(own("src"), "src", "left").join(own("dst"), "dst", "left").where("NOT coalesce(src_closed, false) AND NOT coalesce(dst_closed, false)")
    return scratch.put(both.select(F.coalesce("src_into", "src").alias("src"), F.coalesce("dst_into", "dst").alias("dst")).where("src <> dst").distinct())


def _components_of_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (src, dst: null where nothing leads on) of some nodes, all of theirs -> node, into, closed: nodes on cycles of these edges
    with the least node of their component, and nodes all whose ways end among these edges. Tarjan's search.

    Of many more edges than a part should have the first are searched for components only."""
    ways: dict[str, list[str | None]] = {}
    n, whole = 0, True
    for batch in batches:
        if n < 4 * _PART:
            for a, b in zip(batch.column("src").to_pylist(), batch.column("dst").to_pylist(), strict=True):
                ways.setdefault(a, []).append(b)
        n += batch.num_rows
        whole = n <= 4 * _PART
    at: dict[str, int] = {}
    low: dict[str, int] = {}
    into: dict[str | None, str] = {}
    closed: set[str | None] = {None}
    stack: list[str] = []
    for root in ways:
        path = [] if root in at else [(root, iter(ways[root]))]
        while path:
            node, rest = path[-1]
            if node not in at:
                at[node] = low[node] = len(at)
                stack.append(node)
            for to in rest:
                if to in ways and to not in at:
                    path.append((to, iter(ways[to])))
                    break
                if to in ways and to not in into:
                    low[node] = min(low[node], at[to])
            else:
                path.pop()
                if path:
                    low[path[-1][0]] = min(low[path[-1][0]], low[node])
                if low[node] == at[node]:
                    members = [stack.pop()]
                    while members[-1] != node:
                        members.append(stack.pop())
                    head = min(members)
                    into.update(dict.fromkeys(members, head))
                    if whole and all(to in closed or into.get(to) == head for m in members for to in ways[m]):
                        closed.update(members)
    rows = [(m, head, m in closed) for m, head in into.items() if m != head or m in closed]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.bool_()))], names=["node", "into", "closed"])


def _merged_in_parts(scratch: Scratch, edges: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """Edges with the components within each of so many ranges of ids as one node; (node, into, closed) of what changed."""
    on = edges.select(F.col("src").alias("dst"), F.col("src").alias("on")).distinct()
    met = edges.join(on, "dst", "left").select("src", F.col("on").alias("dst"))
    nodes = scratch.put(met.repartitionByRange(parts, F.substring("src", _HASH + 1, 1 << 30)).mapInArrow(_components_of_part, "node string, into string, closed boolean"))
    return _into(scratch, edges, nodes), nodes.where("node <> into")


def _merged(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Edges with each cycle of pointers as its least node; the nodes that went (node, into: that node); how many; of how many.

    Each node, all having a way in, points at its least way in. The nodes that pointers of 2**k steps lead to get fewer with k until
    those on cycles are left. The least node of a cycle is known once no node finds a lesser one in a round."""
    state = scratch.put(edges.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("up")).select("node", "up", F.col("node").alias("least"), F.lit(True).alias("moved")), "merging")
    led_to, moved = None, True
    while True:
        ahead = state.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("least").alias("their"))
        state = scratch.put(state.join(ahead, "up").select("node", F.col("further").alias("up"), F.least("least", "their").alias("least"), (F.col("their") < F.col("least")).alias("moved")), "merging")
        before, (led_to, moved, n) = led_to, state.agg(F.count_distinct("up"), F.bool_or("moved"), F.count("*")).first()
        if not moved and led_to == before:
            break
    on_cycle = state.select(F.col("up").alias("node")).distinct()
    nodes = scratch.put(state.where("node <> least").join(on_cycle, "node", "left_semi").select("node", F.col("least").alias("into"), F.lit(False).alias("closed")))
    return _into(scratch, edges, nodes), nodes, nodes.count(), n


def _least_reaching(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """node, least: the least node that each is reached by, itself among them.

    First along one way in for each node, whose length doubles each round until none finds less; then along all edges and
    to the colour's own colour."""
    name = uuid.uuid4().hex  # the last round's table is read on
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    up = edges.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("up"))
    state = scratch.put(nodes.join(up, "node", "left").select("node", F.coalesce("up", "node").alias("up"), F.col("node").alias("least"), F.lit(True).alias("moved")), name)
    while not state.where("moved").isEmpty():
        ahead = state.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("least").alias("their"))
        state = scratch.put(state.join(ahead, "up").select("node", F.col("further").alias("up"), F.least("least", "their").alias("least"), (F.col("their") < F.col("least")).alias("moved")), name)
    state = scratch.put(state.select("node", "least", F.lit(True).alias("moved")), name)
    while not state.where("moved").isEmpty():
        along = state.where("moved").join(edges, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(F.min("least").alias("new"))
        wanted = state.select(F.col("least").alias("at")).distinct()
        colours = state.join(wanted, F.col("node") == F.col("at")).select(F.col("node").alias("least"), F.col("least").alias("new")).where("new < least")
        jumps = state.select("node", "least").join(colours, "least").select("node", "new")
        news = along.unionByName(jumps).groupBy("node").agg(F.min("new").alias("new"))
        state = scratch.put(state.join(news, "node", "left").select("node", F.least("least", "new").alias("least"), F.coalesce(F.col("new") < F.col("least"), F.lit(False)).alias("moved")), name)
    return state.select("node", "least")


def cycle_components(graph: DataFrame) -> DataFrame:
    """(id, component) of every node of `graph` (src, dst) on a cycle; nodes on one cycle have one component, named by one of its nodes."""
    ordered = lambda c: F.concat(F.lpad(F.hex(F.xxhash64(c)), _HASH, "0"), F.col(c))
    scratch = Scratch(graph.sparkSession)
    edges = scratch.put(graph.where("src IS NOT NULL AND dst IS NOT NULL").select(ordered("src").alias("src"), ordered("dst").alias("dst")).distinct())
    levels: list[tuple[DataFrame | None, DataFrame]] = []  # (runs, nodes) that were compressed, (None, nodes) that were merged
    loops = [edges.where("src = dst").select(F.col("src").alias("node"))]
    found = edges.limit(0).select(F.col("src").alias("node"), F.col("dst").alias("component"))
    n = edges.count()
    parts = max(int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // _PART))
    while n:
        edges, nodes = _merged_in_parts(scratch, edges, parts)
        levels.append((None, nodes))
        before, n = n, edges.count()
        fewer = max(1, -(-n // _PART))
        if n > before // 2 and fewer >= parts:
            break
        parts = fewer
    while not (edges := _reduced(scratch, edges, levels, loops)).isEmpty():
        edges, nodes, gone, n = _merged(scratch, edges)
        if gone:
            levels.append((None, nodes))
        if gone >= n * _MERGED:
            continue
        colour = _least_reaching(scratch, edges)
        own = lambda c: colour.select(F.col("node").alias(c), F.col("least").alias(f"{c}_colour"))  # noqa: B023, E731
        same = scratch.put(edges.join(own("src"), "src").join(own("dst"), "dst").where("src_colour = dst_colour").select("src", "dst", F.col("src_colour").alias("colour")))
        back = _least_reaching(scratch, same.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        ends = same.select(F.explode(F.array("src", "dst")).alias("node"), "colour").distinct()
        inside = scratch.put(ends.join(back, "node").where("least = colour").select("node", F.col("colour").alias("component")))
        found = found.unionByName(inside.join(inside.groupBy("component").agg(F.count("*").alias("n")).where("n > 1"), "component").select("node", "component"))
        out = inside.select("node")
        edges = scratch.put(same.join(out, same["src"] == out["node"], "left_anti").join(out, same["dst"] == out["node"], "left_anti").select("src", "dst"))
    looped = scratch.put(reduce(DataFrame.unionByName, loops).distinct())
    as_own = lambda rows: rows.select("node", F.col("node").alias("component"))
    runs_nodes = reduce(DataFrame.unionByName, (nodes.select("node") for _, nodes in levels), looped.limit(0))
    found = scratch.put(found.unionByName(as_own(looped.join(found, "node", "left_anti").join(runs_nodes, "node", "left_anti"))))
    for runs, nodes in reversed(levels):  # what stood around a run when it was compressed, or was merged into, is known by now
        if runs is None:
            heads = scratch.put(nodes.select("into").distinct().join(found.withColumnRenamed("node", "into"), "into", "left"))
            inside = nodes.join(heads, "into").select("node", F.coalesce("component", "into").alias("component"))
            found = scratch.put(found.unionByName(inside).unionByName(as_own(heads.where("component IS NULL").select(F.col("into").alias("node")))))
            continue
        part = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))  # noqa: B023, E731
        joined = runs.join(part("u"), "u", "left").join(part("e"), "e", "left")
        closed = joined.where("u = e OR u_part = e_part").groupBy("last").agg(F.min(F.coalesce("u_part", "u")).alias("component"))
        inside = scratch.put(nodes.join(closed, "last").select("node", "component"))
        alone = as_own(looped.join(nodes, "node", "left_semi").join(inside, "node", "left_anti"))
        found = scratch.put(found.unionByName(inside).unionByName(alone))
    plain = lambda c: F.substring(c, _HASH + 1, 1 << 30)
    return found.select(plain("node").alias("id"), plain("component").alias("component"))
