"""The reference graph: edges, validation, traces to sources, root sources (survey K1-K7, F6-F8, G6, J4, J5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.durable import Scratch, checkpoint
from tessera.functions.schemas import ADVISORY, ID_PREFIXES, REFERENCES
from tessera.operators.components import cycle_components
from tessera.operators.joins import lacking, may_hold

MAX_DEPTH = 64
_KNOWN = rf"\A(?:{'|'.join(ID_PREFIXES.values())})"
#: Parts that edges are dealt into: so many times the session's shuffle partitions, but not raised beyond the second number, up
#: to which Spark's writers sort nothing. Being given, they aren't merged into larger ones.
_PARTS = (4, 200)


def extract_edges(objects: DataFrame) -> DataFrame:
    """(src, dst, field, dependency), one for each (src, dst, dependency): the first field wins.

    `objects` has id, object_type, and any of: source_refs, derivation_links (object_id, relation_type),
    origin_object_ids, processing_run_id, and the reference fields of its types; columns it lacks are passed over."""
    have = {f.name: f.dataType for f in objects.schema.fields}
    as_array = lambda name: F.col(name) if isinstance(have[name], T.ArrayType) else F.array(F.col(name))
    edge = lambda rank, values, field, dependency, when=None: F.transform(F.when(when, values) if when is not None else values, lambda v: F.struct(F.lit(rank).alias("rank"), v.alias("dst"), F.lit(field).alias("field"), F.lit(dependency).alias("dependency")))
    found = []
    if "source_refs" in have:
        found.append(edge(0, as_array("source_refs"), "source_refs", True))
    if "derivation_links" in have:
        found.append(F.transform("derivation_links", lambda x: F.struct(F.lit(1).alias("rank"), x["object_id"].alias("dst"), F.concat(F.lit("provenance.derivation_links."), x["relation_type"]).alias("field"), F.lit(True).alias("dependency"))))
    if "origin_object_ids" in have:
        found.append(edge(2, as_array("origin_object_ids"), "provenance.origin_object_ids", True))
    if "processing_run_id" in have:
        found.append(edge(3, as_array("processing_run_id"), "provenance.processing_run_id", False))
    for kind, fields in REFERENCES.items():
        for i, field in enumerate(fields):
            if field in have:
                found.append(edge(4 + i, as_array(field), field, (kind, field) not in ADVISORY, F.col("object_type") == kind))
    kind = "array<struct<rank:int,dst:string,field:string,dependency:boolean>>"
    edges = F.concat(*(F.coalesce(f.cast(kind), F.array().cast(kind)) for f in found))
    rows = objects.select(F.col("id").alias("src"), F.explode(edges).alias("e")).select("src", "e.*").where(F.col("dst").rlike(_KNOWN))
    # Dealt out first: a task then sorts its part of the edges, rather than all of its split of the objects before that too.
    n = int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(max(n, min(_PARTS[0] * n, _PARTS[1])), "src", "dst", "dependency")
    return rows.groupBy("src", "dst", "dependency").agg(F.min_by("field", "rank").alias("field")).select("src", "dst", "field", "dependency")


def duplicate_ids(objects: DataFrame) -> DataFrame:
    """G6."""
    return objects.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", "n")


def dangling(edges: DataFrame, objects: DataFrame) -> DataFrame:
    """edges to nothing; `dependency` tells dangling references from advisory ones."""
    return edges.join(objects.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst", "field", "dependency")


def dependency_graph(edges: DataFrame, objects: DataFrame) -> DataFrame:
    """dependencies whose target exists."""
    return edges.where("dependency").select("src", "dst").distinct().join(objects.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst")


def cycle_members(graph: DataFrame) -> DataFrame:
    """K3: (id) of every node that reaches itself, rather than paths that depend on the order of a search. No bound on length."""
    return cycle_components(graph).select("id")


def known_starts(starts: DataFrame, objects: DataFrame) -> DataFrame:
    """Distinct starts (id); one that is no object is an error, as a trace from it would just be empty."""
    unknown = lacking(starts.select("id"), "id", objects, "id").limit(5).collect()
    if unknown:
        raise LookupError(f"OBJECT_NOT_FOUND: {', '.join(str(r.id) for r in unknown)}")
    return starts.select("id").distinct()


def _on_typed_cycles(edges: DataFrame) -> DataFrame:
    """The edges whose types, by the prefixes of their ids, may lie on a cycle; ids of no known type are one more type.

    A cycle of nodes is a cycle of their types, so an edge is on none unless its target's type leads back to its own. At most
    a row for each two types is collected, and nothing is shuffled but those."""
    kind = lambda c: F.regexp_extract(c, _KNOWN, 0)
    pairs = {tuple(r) for r in edges.where("src IS NOT NULL AND dst IS NOT NULL").select(kind("src"), kind("dst")).distinct().collect()}
    leads, kinds = set(pairs), {k for pair in pairs for k in pair}
    for via in kinds:
        leads |= {(a, b) for a in kinds for b in kinds if (a, via) in leads and (via, b) in leads}
    return edges.where(F.concat_ws(">", kind("src"), kind("dst")).isin([f"{a}>{b}" for a, b in pairs if (b, a) in leads]))


def validate(objects: DataFrame, edges: DataFrame) -> DataFrame:
    """K2, K7: (finding, id, detail, blocking) of the whole graph, without a cap on objects. No blocking row: it is ok.

    Of the objects only ids are moved, once for both duplicates and references; of the edges, those that by their types may be on
    a cycle are searched for one."""
    edges = Scratch(edges.sparkSession).put(edges)  # read by every part
    row = lambda df, finding, detail, blocking: df.select(finding.alias("finding"), F.col("id"), detail.alias("detail"), blocking.alias("blocking"))
    yes = F.lit(True)
    # The join asks for ids that aren't null; asked for here, they are one exchange for the join and the duplicates.
    counted, nameless = (objects.where(f"id IS {which}").groupBy("id").agg(F.count("*").alias("n")) for which in ("NOT NULL", "NULL"))
    missing = edges.withColumnRenamed("src", "__src").join(counted.withColumnRenamed("id", "dst"), "dst", "left").where("n IS NULL AND dependency IS NOT NULL").withColumnRenamed("__src", "id")
    typed = _on_typed_cycles(edges.where("dependency")).select("src", "dst")
    there = typed.join(may_hold(objects.select(F.col("id").alias("dst")), "dst", typed, "dst"), "dst", "left_semi").select("src", "dst")
    parts = [
        *(row(ids.where("n > 1"), F.lit("DUPLICATE_ID"), F.col("n").cast("string"), yes) for ids in (counted, nameless)),
        row(missing, F.when(F.col("dependency"), "DANGLING_REFERENCE").otherwise("ADVISORY_REFERENCE"), F.concat_ws(":", "field", "dst"), F.col("dependency")),
        row(cycle_members(there), F.lit("DEPENDENCY_CYCLE"), F.lit(""), yes),
    ]
    if {"origin_type", "origin_object_ids", "derivation_links"} <= set(objects.columns):
        bare = objects.where("origin_type = 'derived' AND size(coalesce(origin_object_ids, array())) = 0 AND size(coalesce(derivation_links, array())) = 0")
        parts.append(row(bare, F.lit("DERIVED_WITHOUT_ORIGINS"), F.lit(""), yes))
    return reduce(lambda a, b: a.unionByName(b), parts)


def trace_paths(graph: DataFrame, starts: DataFrame, objects: DataFrame, max_depth: int = MAX_DEPTH, source_prefix: str = "src_") -> DataFrame:
    """(start, source, path, depth): every simple path of dependencies from each start (id) to a source.

    A path stops at its first source. A start that isn't among `objects` is an error, and so are more than `max_depth`
    nodes on a path, as such a graph can't be traced."""
    starts = known_starts(starts, objects)
    scratch = Scratch(graph.sparkSession)
    whole = scratch.put(graph.select("src", "dst"))
    # Read at every step, so without the edges of nodes that are no start and that none leads to.
    met = starts.select(F.col("id").alias("src")).unionByName(whole.select(F.col("dst").alias("src"))).distinct()
    graph = scratch.put(whole.distinct().join(met, "src", "left_semi"))
    frontier = starts.select(F.col("id").alias("start"), F.col("id").alias("node"), F.array("id").alias("path")).distinct()
    done = frontier.where(F.col("node").startswith(source_prefix))
    frontier, depth = frontier.where(~F.col("node").startswith(source_prefix)), 0
    while True:
        step = frontier.join(graph, frontier["node"] == graph["src"]).where(~F.array_contains("path", F.col("dst")))
        step = scratch.put(step.select("start", F.col("dst").alias("node"), F.concat("path", F.array("dst")).alias("path")))
        if step.isEmpty():
            break
        depth += 1
        if depth >= max_depth:
            raise RuntimeError(f"paths have more than {max_depth} nodes")
        done = done.unionByName(step.where(F.col("node").startswith(source_prefix)))
        frontier = step.where(~F.col("node").startswith(source_prefix))
    return done.select("start", F.col("node").alias("source"), "path", (F.size("path") - 1).alias("depth"))


def trace_dag(graph: DataFrame, starts: DataFrame, objects: DataFrame, max_depth: int = MAX_DEPTH, source_prefix: str = "src_") -> DataFrame:
    """K4 without enumerating: (start, src, dst, n): the dependencies on the paths from each start, and how many paths lead to src.

    A row for each start and dependency, whatever the number of paths: those of one node are counted together at each step.
    Paths of more than `max_depth` nodes, which a cycle always gives, are an error, and so are unknown starts."""
    graph = checkpoint(graph.where(~F.col("src").startswith(source_prefix)))  # read at every step; a path stops at its first source
    scratch = Scratch(graph.sparkSession)
    one = F.lit(1).cast("decimal(38,0)")
    level = scratch.put(known_starts(starts, objects).select(F.col("id").alias("start"), F.col("id").alias("node"), one.alias("n")))
    levels = [level]
    while True:
        step = level.join(graph, level["node"] == graph["src"]).groupBy("start", F.col("dst").alias("node")).agg(F.sum("n").cast("decimal(38,0)").alias("n"))
        level = scratch.put(step)
        if level.isEmpty():
            break
        levels.append(level)
        if len(levels) > max_depth:
            raise RuntimeError(f"paths have more than {max_depth} nodes")
    reached = reduce(DataFrame.unionByName, levels).groupBy("start", "node").agg(F.sum("n").cast("decimal(38,0)").alias("n"))
    return reached.join(graph, reached["node"] == graph["src"]).select("start", "src", "dst", "n")


def path_counts(dag: DataFrame, source_prefix: str = "src_") -> DataFrame:
    """(start, source, n_paths) from a `trace_dag`: how many paths `trace_paths` would list. A start that is a source has none here."""
    return dag.where(F.col("dst").startswith(source_prefix)).groupBy("start", F.col("dst").alias("source")).agg(F.sum("n").cast("decimal(38,0)").alias("n_paths"))


def trace_sources(graph: DataFrame, starts: DataFrame, objects: DataFrame, source_prefix: str = "src_") -> DataFrame:
    """The sources that each start reaches, however far away, without enumerating paths: what scales on dense graphs. A start
    that isn't among `objects` is an error.

    Walks back from the sources, a pair of node and source once however many starts meet there; the starts are joined last."""
    starts = known_starts(starts, objects)
    is_source = lambda c: F.col(c).startswith(source_prefix)
    scratch = Scratch(graph.sparkSession)
    open_ = scratch.put(graph.where(~is_source("src")).select("src", "dst"))  # a path stops at its first source
    # Only nodes that another leads to are passed on the way back; the edges of all others are joined once, at the end.
    inner = scratch.put(open_.join(open_.select(F.col("dst").alias("src")).distinct(), "src", "left_semi"))
    ends = open_.select(F.col("dst").alias("node")).unionByName(starts.select(F.col("id").alias("node"))).where(is_source("node")).distinct()
    frontier = reached = scratch.put(ends.select("node", F.col("node").alias("source")))
    while not frontier.isEmpty():
        step = inner.join(frontier, inner["dst"] == frontier["node"]).select(F.col("src").alias("node"), "source").distinct()
        frontier = scratch.put(step.join(reached, ["node", "source"], "left_anti"))
        reached = scratch.put(reached.unionByName(frontier), "reached")
    begun = starts.select(F.col("id").alias("start"))
    outer = begun.join(open_, begun["start"] == open_["src"]).join(reached, F.col("dst") == F.col("node")).select("start", "source")
    return begun.where(is_source("start")).select("start", F.col("start").alias("source")).unionByName(outer.distinct())


def unit_sources(units: DataFrame, documents: DataFrame) -> DataFrame:
    """F8: (unit_id, document_id, workspace_id, source_id, problem): a unit's document's source within its workspace, or why not."""
    docs = documents.select(F.col("id").alias("document_id"), F.col("workspace_id"), F.col("source_id"), F.lit(True).alias("there"))
    joined = units.select(F.col("id").alias("unit_id"), "workspace_id", "document_id").join(docs, ["document_id", "workspace_id"], "left")
    problem = F.when(F.coalesce("document_id", F.lit("")) == "", "UNIT_WITHOUT_DOCUMENT").when(F.col("there").isNull(), "DOCUMENT_NOT_FOUND").when(F.coalesce("source_id", F.lit("")) == "", "DOCUMENT_WITHOUT_SOURCE")
    return joined.select("unit_id", "document_id", "workspace_id", "source_id", problem.alias("problem"))


def root_sources(sources: DataFrame) -> DataFrame:
    """K6: (id, root, problem). `sources`: id, workspace_id, parent_source_id, derivation_links. A source's parent is its
    parent_source_id, else its first link to a source. Cycles, missing and foreign parents have no root.

    Pointers double in length each round, so a chain of n sources takes log2(n) rounds. A round
    that ends no pointer leaves cycles only: the longest chain left would have had one at half its length to end."""
    links = F.filter("derivation_links", lambda x: x["object_id"].startswith("src_"))
    parent = F.coalesce(F.when(F.col("parent_source_id") != "", F.col("parent_source_id")), F.get(links, F.lit(0))["object_id"])
    own = sources.select("id", "workspace_id", parent.alias("parent")).dropDuplicates(["id"])
    other = own.select(F.col("id").alias("parent"), F.col("workspace_id").alias("parent_workspace"))
    joined = own.join(other, "parent", "left")
    problem = F.when(F.col("parent").isNotNull() & F.col("parent_workspace").isNull(), "SOURCE_NOT_FOUND").when(F.col("parent_workspace") != F.col("workspace_id"), "CROSS_WORKSPACE")
    scratch = Scratch(sources.sparkSession)
    state = scratch.put(joined.select("id", F.coalesce(F.when(problem.isNull(), F.col("parent")), F.col("id")).alias("to"), problem.alias("problem"), (F.col("parent").isNull() | problem.isNotNull()).alias("ended")), "pointers")
    left, before = state.where("NOT ended").count(), None
    while left and left != before:
        ahead = state.select(F.col("id").alias("to"), F.col("to").alias("further"), F.col("problem").alias("their_problem"), F.col("ended").alias("their_end"))
        moved = state.where("NOT ended").join(ahead, "to", "left").select("id", F.coalesce("further", "to").alias("to"), F.col("their_problem").alias("problem"), F.coalesce("their_end", F.lit(True)).alias("ended"))
        state = scratch.put(state.where("ended").unionByName(moved), "pointers")
        left, before = state.where("NOT ended").count(), left
    final = F.when(~F.col("ended"), "CYCLE").otherwise(F.col("problem"))
    return state.select("id", F.when(final.isNull(), F.col("to")).alias("root"), final.alias("problem"))


def latest_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest row of each key, by `order`; ties by all columns."""
    window = Window.partitionBy(*keys).orderBy(F.desc(order), *sorted(c for c in rows.columns if c not in keys))
    return rows.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n")
