import random

import pytest

from tessera.operators import graph


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "src string, dst string")


def test_edges_keep_the_first_field_and_known_ids(spark):
    objects = spark.createDataFrame(
        [("evi_1", "evidence", ["cu_1", "other"], [("cu_1", "quoted_from"), ("cu_2", "derived_from")], ["cu_2"], "run_1", "clm_1", "cu_3")],
        "id string, object_type string, source_refs array<string>, derivation_links array<struct<object_id:string,relation_type:string>>, origin_object_ids array<string>, processing_run_id string, target_object_id string, source_ref string",
    )
    got = {tuple(r) for r in graph.extract_edges(objects).collect()}
    assert got == {
        ("evi_1", "cu_1", "source_refs", True), ("evi_1", "cu_2", "provenance.derivation_links.derived_from", True), ("evi_1", "run_1", "provenance.processing_run_id", False),
        ("evi_1", "clm_1", "target_object_id", False), ("evi_1", "cu_3", "source_ref", True),
    }


def test_edges_are_dealt_out_before_they_are_told_apart(spark):
    """No task sorts or groups its split of the objects, and edges are dealt into more parts than the session's; the first field wins across rows too."""
    objects = spark.createDataFrame([("clm_1", "claim", "cu_1", None), ("clm_1", "claim", None, ["cu_1", "cu_2"]), (None, "claim", "cu_1", None), (None, "claim", "cu_1", None)], "id string, object_type string, source_ref string, source_refs array<string>")
    found = graph.extract_edges(objects)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan[: plan.index("Exchange")] and "Aggregate" not in plan[plan.index("Exchange") :]
    assert found.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [("clm_1", "cu_1", "source_refs", True), ("clm_1", "cu_2", "source_refs", True), (None, "cu_1", "source_ref", True)]))


def test_validation(spark):
    objects = spark.createDataFrame([("clm_1", "claim", "cu_1"), ("clm_1", "claim", "cu_1"), ("cu_1", "content_unit", None), ("clm_2", "claim", "cu_9")], "id string, object_type string, source_ref string")
    found = {(r.finding, r.id, r.blocking) for r in graph.validate(objects, graph.extract_edges(objects)).collect()}
    assert found == {("DUPLICATE_ID", "clm_1", True), ("DANGLING_REFERENCE", "clm_2", True)}


def test_validation_searches_cycles_only_where_types_allow_one(spark, monkeypatch):
    """Units lead to documents and never back, so 500 of their edges aren't searched; entities and claims lead to each other."""
    searched, members = [], graph.cycle_members
    monkeypatch.setattr(graph, "cycle_members", lambda g: searched.extend(tuple(r) for r in g.collect()) or members(g))
    units = [(f"cu_{i}", "content_unit", f"doc_{i % 9}", None, None, None) for i in range(500)] + [(f"doc_{i}", "document", None, None, None, None) for i in range(8)]
    rings = [("ent_a", "entity", None, ["clm_a"], None, None), ("clm_a", "claim", None, None, ["ent_a"], None), ("ent_b", "entity", None, ["clm_gone"], None, None), ("odd", "claim", None, None, ["ent_a"], None)]
    others = [("evi_1", "evidence", None, None, None, "clm_none"), (None, "entity", None, None, None, None), (None, "entity", None, None, None, None)]
    objects = spark.createDataFrame([*units, *rings, *others, units[0]], "id string, object_type string, document_id string, possible_same_as array<string>, subject_entity_ids array<string>, target_object_id string")
    loose = spark.createDataFrame([("clm_gone", "ent_b", "subject_entity_ids", True), (None, "ent_a", "x", True)], "src string, dst string, field string, dependency boolean")
    found = graph.validate(objects, graph.extract_edges(objects).unionByName(loose)).collect()
    assert sorted(searched) == [("clm_a", "ent_a"), ("clm_gone", "ent_b"), ("ent_a", "clm_a")]
    want = [("DANGLING_REFERENCE", f"cu_{i}", "document_id:doc_8", True) for i in range(8, 500, 9)] + [("DANGLING_REFERENCE", "ent_b", "possible_same_as:clm_gone", True), ("ADVISORY_REFERENCE", "evi_1", "target_object_id:clm_none", False)]
    want += [("DUPLICATE_ID", "cu_0", "2", True), ("DUPLICATE_ID", None, "2", True), ("DEPENDENCY_CYCLE", "ent_a", "", True), ("DEPENDENCY_CYCLE", "clm_a", "", True)]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_cycles_are_members_only(spark):
    found = graph.cycle_members(edges(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("z", "a"), ("c", "d"), ("d", "e"), ("e", "d"), ("s", "s")))
    assert {r.id for r in found.collect()} == {"a", "b", "c", "d", "e", "s"}
    assert graph.cycle_members(edges(spark, ("a", "b"), ("b", "c"))).count() == 0


def test_cycles_of_any_length(spark):
    ring = lambda prefix, n: [(f"{prefix}{i}", f"{prefix}{(i + 1) % n}") for i in range(n)]
    between = [("a0", "p0"), ("p0", "p1"), ("p1", "b0"), ("b1", "tail")]
    found = [r.id for r in graph.cycle_members(edges(spark, *ring("a", 300), *ring("b", 66), *between)).collect()]
    assert sorted(found) == sorted(x for x, _ in ring("a", 300) + ring("b", 66))


def test_a_long_ring_is_not_valid(spark):
    objects = spark.createDataFrame([(f"ent_{i}", "entity", [f"ent_{(i + 1) % 100}"]) for i in range(100)], "id string, object_type string, possible_same_as array<string>")
    found = graph.validate(objects, graph.extract_edges(objects)).where("blocking").collect()
    assert {(r.finding, r.id) for r in found} == {("DEPENDENCY_CYCLE", f"ent_{i}") for i in range(100)}


def plain_components(pairs):
    reach = {}
    for a in {x for p in pairs for x in p}:
        reach[a], todo = set(), [a]
        while todo:
            for b in [d for c, d in pairs if c == todo[-1]] if todo else []:
                if b not in reach[a]:
                    reach[a].add(b)
                    todo.insert(0, b)
            todo.pop()
    return {frozenset(b for b in reach[a] if a in reach[b]) for a in reach if a in reach[a]}


def test_components_against_brute_force(spark):
    """Thirty random graphs at once, of all densities, some joined by one-way edges; loops, chains, ladders, repeated edges."""
    rng = random.Random(5)
    groups = []
    for g in range(30):
        n = rng.randint(2, 25)
        groups.append([(f"{g}.{rng.randrange(n)}", f"{g}.{rng.randrange(n)}") for _ in range(int(n * rng.choice((0.7, 1, 1.3, 2, 3))))])
    ladder = [(f"l{i}", f"l{i}{k}") for i in range(20) for k in "ab"] + [(f"l{i}{k}", f"l{i + 1}") for i in range(20) for k in "ab"]
    pairs = [p for g in groups for p in g] + [(groups[i][0][0], groups[i + 1][0][0]) for i in range(0, 28, 3)] + ladder + [("l20", "m"), ("m", "l3"), ("m", "m")]
    want = set().union(*(plain_components(g) for g in groups), plain_components([*ladder, ("l20", "m"), ("m", "l3"), ("m", "m")]))
    found = {}
    for r in graph.cycle_components(edges(spark, *pairs)).collect():
        found.setdefault(r.component, []).append(r.id)
    assert all(c in ids for c, ids in found.items()) and sum(map(len, found.values())) == len(set().union(*want))
    assert {frozenset(ids) for ids in found.values()} == want


def test_a_long_chain_into_a_ring_takes_few_rounds(spark, monkeypatch):
    from tessera.operators.components import Scratch

    rounds, put = [], Scratch.put
    monkeypatch.setattr(Scratch, "put", lambda self, df, name="": rounds.append(name) or put(self, df, name))
    n = 2000
    ring = spark.range(n).selectExpr("concat('r', id) AS src", f"concat('r', (id + 1) % {n}) AS dst")
    chain = spark.range(n).selectExpr("concat('c', id) AS src", f"CASE WHEN id = {n - 1} THEN 'r0' ELSE concat('c', id + 1) END AS dst")
    found = graph.cycle_components(ring.unionByName(chain))
    assert found.where("id LIKE 'r%'").count() == found.count() == n and found.select("component").distinct().count() == 1
    assert len(rounds) < 100


def chords(n):
    """A ring with chords, none of whose nodes has one way only."""
    return [(f"n{i:04}", f"n{(i + k) % n:04}") for i in range(n) for k in (1, 3)]


@pytest.mark.parametrize("near, most", [(True, 20), (False, 100)])
def test_a_ring_with_chords_takes_few_rounds(spark, monkeypatch, near, most):
    """By ranges of ids, and without them, as where ids are in no order."""
    from tessera.operators import components

    rounds, put = [], components.Scratch.put
    monkeypatch.setattr(components.Scratch, "put", lambda self, df, name="": rounds.append(name) or put(self, df, name))
    if not near:
        monkeypatch.setattr(components, "_merged_in_parts", lambda scratch, e, parts: (e, e.selectExpr("src AS node", "src AS into").limit(0)))
    found = components.cycle_components(edges(spark, *chords(300), ("n0007", "tail"), ("head", "n0009"))).collect()
    assert {r.id for r in found} == {a for a, _ in chords(300)} and len(found) == 300 and len({r.component for r in found}) == 1
    assert len(rounds) < most


@pytest.mark.parametrize("part", [1, None])
def test_components_without_whole_parts(spark, monkeypatch, part):
    """Ranges of about one edge, and none, against brute force."""
    from tessera.operators import components

    rng = random.Random(9)
    pairs = [(f"{g}.{rng.randrange(12)}", f"{g}.{rng.randrange(12)}") for g in range(12) for _ in range(rng.choice((10, 14, 20)))] + chords(24)
    want = plain_components(pairs)
    if part:
        monkeypatch.setattr(components, "_PART", part)
    else:
        monkeypatch.setattr(components, "_merged_in_parts", lambda scratch, e, parts: (e, e.selectExpr("src AS node", "src AS into").limit(0)))
    found = {}
    for r in components.cycle_components(edges(spark, *pairs)).collect():
        found.setdefault(r.component, []).append(r.id)
    assert all(c in ids for c, ids in found.items()) and sum(map(len, found.values())) == len(set().union(*want))
    assert {frozenset(ids) for ids in found.values()} == want


def test_a_part_of_too_many_edges_closes_nothing(monkeypatch):
    import pyarrow as pa

    from tessera.operators import components

    batches = [pa.RecordBatch.from_pylist([{"src": a, "dst": b}]) for a, b in (("a", "b"), ("b", "a"), ("c", "a"), ("c", "d"), ("d", None))]
    changed = lambda: [tuple(r.values()) for out in components._components_of_part(iter(batches)) for r in out.to_pylist()]
    assert sorted(changed()) == [("a", "a", True), ("b", "a", True), ("c", "c", True), ("d", "d", True)]
    monkeypatch.setattr(components, "_PART", 1)
    assert changed() == [("b", "a", False)]


def test_paths_and_sources(spark):
    g = edges(spark, ("clm_1", "cu_1"), ("clm_1", "cu_2"), ("cu_1", "doc_1"), ("cu_2", "doc_1"), ("doc_1", "src_1"), ("src_1", "src_0"), ("doc_1", "clm_1"))
    start = spark.createDataFrame([("clm_1",), ("src_1",)], "id string")
    there = g.selectExpr("explode(array(src, dst)) AS id").distinct()
    assert {(r.start, ">".join(r.path)) for r in graph.trace_paths(g, start, there).collect()} == {("clm_1", "clm_1>cu_1>doc_1>src_1"), ("clm_1", "clm_1>cu_2>doc_1>src_1"), ("src_1", "src_1")}
    assert {tuple(r) for r in graph.trace_sources(g, start, there).collect()} == {("clm_1", "src_1"), ("src_1", "src_1")}
    with pytest.raises(RuntimeError):
        graph.trace_paths(g, start, there, max_depth=3)
    assert graph.trace_paths(g, start, there, max_depth=4).count() == 3
    unknown = spark.createDataFrame([("clm_1",), ("clm_9",)], "id string")
    for trace in (graph.trace_paths, graph.trace_sources):
        with pytest.raises(LookupError, match="OBJECT_NOT_FOUND: clm_9"):
            trace(g, unknown, there)


def test_root_sources(spark):
    links = [("doc_1", "x"), ("src_b", "x")]
    rows = [("src_a", "w", None, links), ("src_b", "w", "src_c", []), ("src_c", "w", None, []), ("src_x", "w", "src_y", []), ("src_y", "w", "src_x", []), ("src_m", "w", "src_none", []), ("src_w", "w", "src_o", []), ("src_o", "other", None, [])]
    sources = spark.createDataFrame(rows, "id string, workspace_id string, parent_source_id string, derivation_links array<struct<object_id:string,relation_type:string>>")
    got = {r.id: (r.root, r.problem) for r in graph.root_sources(sources).collect()}
    assert got["src_a"] == got["src_b"] == got["src_c"] == ("src_c", None)
    assert got["src_x"] == (None, "CYCLE") and got["src_m"] == (None, "SOURCE_NOT_FOUND") and got["src_w"] == (None, "CROSS_WORKSPACE")


def test_roots_at_the_end_of_long_chains(spark):
    """Chains of 1 to 700 steps, and cycles of two and of 300 with a tail."""
    chain = [(f"src_{i}", f"src_{i - 1}" if i else None) for i in range(701)]
    ring = [(f"src_c{i}", f"src_c{(i + 1) % 300}") for i in range(300)] + [("src_d0", "src_d1"), ("src_d1", "src_d0")] + [(f"src_t{i}", f"src_t{i - 1}" if i else "src_c7") for i in range(80)]
    sources = spark.createDataFrame([(i, "w", p, []) for i, p in chain + ring], "id string, workspace_id string, parent_source_id string, derivation_links array<struct<object_id:string,relation_type:string>>")
    got = {r.id: (r.root, r.problem) for r in graph.root_sources(sources).collect()}
    assert got == {i: ("src_0", None) for i, _ in chain} | {i: (None, "CYCLE") for i, _ in ring}


def test_sources_far_away(spark):
    g = edges(spark, *((f"ent_{i}", f"ent_{i + 1}") for i in range(65)), ("ent_65", "src_1"), ("ent_3", "src_2"), ("ent_65", "ent_0"))
    start = spark.createDataFrame([("ent_0",)], "id string")
    assert {tuple(r) for r in graph.trace_sources(g, start, start).collect()} == {("ent_0", "src_1"), ("ent_0", "src_2")}


def test_paths_are_counted_without_being_listed(spark):
    ladder = [(f"l{i}", f"l{i}{k}") for i in range(40) for k in "ab"] + [(f"l{i}{k}", f"l{i + 1}" if i < 39 else "src_1") for i in range(40) for k in "ab"]
    short = [("x", "y"), ("x", "z"), ("y", "z"), ("z", "src_2"), ("y", "src_2"), ("src_2", "src_3")]
    g = edges(spark, *ladder, *short)
    there = g.selectExpr("explode(array(src, dst)) AS id").distinct()
    start = spark.createDataFrame([("l0",), ("l38",), ("x",), ("src_2",)], "id string")
    dag = graph.trace_dag(g, start, there, max_depth=90)
    assert {tuple(r) for r in graph.path_counts(dag).collect()} == {("l0", "src_1", 2**40), ("l38", "src_1", 4), ("x", "src_2", 3)}
    assert dag.where("start = 'l0'").count() == len(ladder)
    listed = graph.trace_paths(g, start.where("id <> 'l0' AND id <> 'src_2'"), there).groupBy("start", "source").count()
    assert {tuple(r) for r in listed.collect()} == {("l38", "src_1", 4), ("x", "src_2", 3)}
    with pytest.raises(RuntimeError):
        graph.trace_dag(edges(spark, ("a", "b"), ("b", "a")), spark.createDataFrame([("a",)], "id string"), spark.createDataFrame([("a",), ("b",)], "id string"), max_depth=5)


def test_ladders_are_whole_where_the_table_ends(spark, tmp_path):
    from tessera.plans import graphs

    spark.range(150).withColumnRenamed("id", "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.start, r.source, r.n_paths) for r in graphs.path_counts(spark, str(tmp_path)).collect()}
    assert got == {(f"doc_{d}", f"src_{d - d % 100 + 99}", 1 << (33 - d % 100 // 3)) for d in range(150) if d % 100 < 99 and d % 100 % 3 == 0}


def test_large_scratch_tables_are_not_broadcast(spark):
    from tessera.durable import Scratch

    scratch = Scratch(spark)
    plan = lambda n: scratch.put(spark.range(n)).join(scratch.put(spark.range(n)), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(100) and "BroadcastHashJoin" not in plan(200_000)


def test_traces_carry_no_nodes_that_nothing_leads_to(spark, monkeypatch):
    """500 leaves above one chain: the tables of each step hold the chain, and the leaves are joined once."""
    from tessera.durable import Scratch

    pairs = [(f"cu_{i}", "doc_0") for i in range(500)] + [(f"doc_{i}", f"doc_{i + 1}") for i in range(5)] + [("doc_5", "src_1")]
    rows, put = [], Scratch.put

    def counted(self, df, name=""):
        out = put(self, df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "put", counted)
    objects = spark.createDataFrame([(x,) for x in sorted({x for p in pairs for x in p})], "id string")
    found = graph.trace_sources(edges(spark, *pairs), objects, objects).collect()
    assert sorted(r.start for r in found) == sorted({x for p in pairs for x in p}) and {r.source for r in found} == {"src_1"}
    assert sum(n > 100 for n in rows) == 1  # the graph itself
    rows.clear()
    starts = spark.createDataFrame([("doc_3",)], "id string")
    assert [r.path for r in graph.trace_paths(edges(spark, *pairs), starts, objects).collect()] == [["doc_3", "doc_4", "doc_5", "src_1"]]
    assert sum(n > 100 for n in rows) == 1
