import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.durable import checkpoint
from tessera.llm import components, decontamination, jaccard_join, substrings, suffixes, words
from tessera.llm.suffixes import Run, front_code, merge_runs


def test_word_hashes_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = ["a bb  ccc", None, "", "x" * 5000 + " y", "é\x0bü", "a bb"]
    whole = words.Words(pa.array(texts))
    assert whole.counts().tolist() == [3, 0, 0, 2, 2, 2]
    alone = np.concatenate([words.Words(pa.array([t], pa.string())).hashes() for t in texts])
    assert (whole.hashes() == alone).all() and len(set(alone.tolist())) == 7
    assert list(words.slices(pa.array(texts), 10)) == [(0, 3), (3, 4), (4, 6)]
    assert (words.unpack(words.pack(alone), len(alone), np.uint64) == alone).all()


@pytest.fixture(scope="module")
def pool():
    """Texts from a few letters and shared passages, so that matches of every length and overlap occur."""
    rng = random.Random(4)
    base = "".join(rng.choice("abc é") for _ in range(3000))
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind, at = rng.random(), rng.randrange(2800)
            if kind < 0.5:
                parts.append(base[at : at + rng.randint(20, 300)])
            elif kind < 0.7:
                parts.append("ab " * rng.randint(1, 120))
            elif kind < 0.8:
                parts.append("\0" * rng.randint(1, 150))
            else:
                parts.append("".join(rng.choice("xyz ") for _ in range(rng.randint(1, 80))))
        rows.append((i, "".join(parts) if i % 17 else None))
    return rows


def brute_words(rows, n):
    seen, out = {}, {}
    for i, text in sorted(rows):
        own = (text or "").encode().split()
        gone = [False] * len(own)
        for j in range(len(own) - n + 1):
            if seen.setdefault(tuple(own[j : j + n]), i) < i:
                gone[j : j + n] = [True] * n
        out[i] = (len(own), sum(gone), b" ".join(w for w, g in zip(own, gone, strict=True) if not g).decode())
    return out


def brute_bytes(rows, n):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - n + 1):
            window = data[p : p + n]
            if window in seen:
                gone[p : p + n] = b"\1" * n
            seen.add(window)
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("window", [2, 5, 13])
def test_word_windows(documents, pool, window):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substrings.dedup_substrings(documents(*pool).repartition(5), window=window).collect()}
    assert got == brute_words(pool, window)


@pytest.mark.parametrize("length", [48, 64, 100])
def test_byte_strings(documents, pool, length):
    rows = suffixes.dedup_bytes(documents(*pool).repartition(5), length=length).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in rows}
    assert got == brute_bytes(pool, length)


def test_strings_too_short_for_anchors():
    with pytest.raises(ValueError):
        suffixes.zone(20)


def test_awkward_documents(documents, awkward):
    docs = documents(*awkward)
    by_words = substrings.dedup_substrings(docs).collect()
    by_bytes = suffixes.dedup_bytes(docs).collect()
    assert len(by_words) == len(by_bytes) == len(awkward)
    whole = {4: 0, 5: 30, None: 30}
    assert {(r.doc_id, r.n_removed) for r in by_words if r.doc_id in (4, 5, 8)} == {(4, 0), (5, 30), (8, 60)}
    assert sorted(r.n_removed for r in by_words if r.doc_id is None) == [0, whole[None]]
    # Repeated rows are one document: neither takes from the other, both lose what document 4 has.
    assert {(r.doc_id, r.n_removed == r.n_bytes) for r in by_bytes if r.doc_id in (4, 5)} == {(4, False), (5, True)}
    one = documents((1, "q " * 200), (1, "q " * 200))
    assert {r.n_removed for r in substrings.dedup_substrings(one).collect()} == {0}
    assert len({(r.n_removed, bytes(r.kept)) for r in suffixes.dedup_bytes(one).collect()}) == 1
    assert substrings.dedup_substrings(docs.limit(0)).count() == suffixes.dedup_bytes(docs.limit(0)).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(6)
    for n in (1, 2, 3, 7, 8):
        runs, everything = [], []
        for _ in range(n):
            strings = sorted({bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(rng.randint(0, 12))})
            everything += strings
            rows = np.frombuffer(b"".join(strings), dtype=np.uint8).reshape(-1, 6)
            lcps, tails = front_code(rows)
            runs.append(Run(lcps.tolist(), tails.tobytes(), 6))
        merged = list(merge_runs(runs, 6))
        assert [s for _, s, _ in merged] == sorted(everything)
        for (_, a, _), (_, b, lcp) in zip(merged, merged[1:], strict=False):
            assert lcp == next((i for i in range(6) if a[i] != b[i]), 6)


def shingles(text, n=5):
    own = tuple((text or "").encode().split())
    return frozenset(own[i : i + n] for i in range(len(own) - n + 1)) if len(own) >= n else frozenset([own] if own else [])


def brute_classes(rows, similarity=0.8):
    sets = {i: shingles(t) for i, t in rows}
    links = {i: {j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity} for i in sets}
    out = {}
    for i in sorted(sets):
        if i not in out:
            todo, seen = [i], {i}
            while todo:
                new = links[todo.pop()] - seen
                seen |= new
                todo += new
            out |= {j: i for j in seen}
    return {i: (out[i], len(links[i]), len(sets[i])) for i in sets}


def test_jaccard_classes(documents):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(60)] = f"x{rng.random()}"
        rows.append((i, " ".join(own)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a b"), (204, "a  b"), (205, "b a"), (206, "a b")]
    expect = brute_classes(rows)
    for block in (16, 1024):
        got = {r.doc_id: (r.class_id, r.n_links, r.n_shingles) for r in jaccard_join.jaccard_classes(documents(*rows), block=block).collect()}
        assert got == expect
    kept = {r.doc_id for r in jaccard_join.keep_one(documents(*rows)).collect()}
    assert kept == {c for c, _, _ in expect.values()}


def test_jaccard_of_awkward_documents(documents, awkward):
    rows = jaccard_join.jaccard_classes(documents(*awkward)).collect()
    assert len(rows) == len(awkward)
    assert {(r.class_id, r.n_links) for r in rows if r.n_shingles in (26, 30)} == {(4, 4)}  # document 8 holds the passage twice
    assert jaccard_join.jaccard_classes(documents(*awkward).limit(0)).count() == 0


def test_prefixes_shorten_until_the_recall_is_met():
    assert jaccard_join.forest_depth(24, 12, 0.8, 0.999) == 6
    assert jaccard_join.forest_depth(24, 12, 0.8, 0.99) == 7 and jaccard_join.forest_depth(2, 12, 0.8, 0.999) == 1
    assert jaccard_join.forest_depth(24, 9, 0.95, 0.999) == 9


def test_neighbours_in_sorted_tries_tie_each_node_together(spark):
    rng = random.Random(9)
    trees, depth, least = 3, 4, 2
    labels = {i: [[rng.randrange(2) for _ in range(depth)] for _ in range(trees)] for i in range(200)}
    rows = [(i, b"".join(bytes([t, *own[t]]) for t in range(trees))) for i, own in labels.items()]
    frame = spark.createDataFrame(rows, "sid long, labels binary").repartition(3)
    ties = [(r.u, r.v, r.depth) for r in jaccard_join.sorted_tries(frame, trees, depth, least).collect()]
    for level in range(least, depth + 1):
        parent = {i: i for i in labels}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for u, v, n in ties:
            if n >= level:
                parent[root(u)] = root(v)
        for t in range(trees):
            nodes = collections.defaultdict(set)
            for i, own in labels.items():
                nodes[tuple(own[t][:level])].add(root(i))
            assert all(len(roots) == 1 for roots in nodes.values())
    assert all(any(a[:n] == b[:n] for a, b in zip(labels[u], labels[v], strict=True)) for u, v, n in ties)
    assert jaccard_join.sorted_tries(frame.limit(0), trees, depth, least).count() == 0


def test_recall_of_pairs_just_over_the_threshold(documents):
    """Two thousand pairs of similarity 0.8 to 0.85, each of its own words."""
    rng = random.Random(12)
    rows, alike = [], 0
    for i in range(2000):
        one = [f"a{i}w{j}" for j in range(104)]
        two = list(one)
        two[rng.randrange(10, 50)] = two[rng.randrange(55, 95)] = f"b{i}"  # ten of a hundred shingles differ
        near = len(shingles(" ".join(one)) & shingles(" ".join(two))) / len(shingles(" ".join(one)) | shingles(" ".join(two)))
        alike += 0.8 <= near <= 0.85
        rows += [(2 * i, " ".join(one)), (2 * i + 1, " ".join(two))]
    found = jaccard_join.jaccard_classes(documents(*rows)).where("n_links = 1").count() / 2
    print("pairs found:", found, "of", alike)
    assert alike == 2000 and found >= 0.998 * alike


def test_one_document_of_each_class_whatever_its_id(documents):
    text = lambda n: " ".join(f"t{n}w{i}" for i in range(30))
    a, b, z = text(1), text(2), text(3)
    kept = lambda *rows: sorted(((r.doc_id, r.text) for r in jaccard_join.keep_one(documents(*rows)).collect()), key=repr)
    assert kept((5, a), (5, b), (3, b), (9, z)) == sorted([(5, a), (3, b), (9, z)], key=repr)
    assert kept((5, a), (5, a)) == [(5, a)]
    assert kept((None, a), (None, a), (None, b)) == sorted([(None, a), (None, b)], key=repr)
    assert kept((None, a), (7, a)) == [(7, a)]
    assert kept((1, None), (1, None), (2, ""), (2, " ")) == sorted([(1, None), (1, None), (2, ""), (2, " ")], key=repr)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 100), (7, 7)] + [(5000, 1000 + i) for i in range(3000)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100, **dict.fromkeys(range(1000, 4000), 1000), 5000: 1000}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_stop_at_stars(spark, monkeypatch):
    steps, with_least = [], components._with_least
    monkeypatch.setattr(components, "_with_least", lambda edges, n: steps.append(n) or with_least(edges, n))
    pairs = {"stars": [(3, 1), (4, 1), (1, 5), (9, 8), (8, 9)], "two above": [(3, 1), (3, 2)], "chain": [(3, 2), (2, 1)]}
    for name, edges in pairs.items():
        steps.clear()
        got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
        assert got == ({1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8} if name == "stars" else {1: 1, 2: 1, 3: 1})
        assert len(steps) == (0 if name == "stars" else 2)  # one round: two stars
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    least = {x: x for edge in edges for x in edge if edge[0] != edge[1]}
    for _ in least:
        for u, v in edges:
            if u != v:
                least[u] = least[v] = min(least[u], least[v])
    assert {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()} == least


@pytest.fixture(scope="module")
def benchmark(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([4, 5, 6, 9, 12, 20, 33, 64, 100, 200])] + [(50, None), (51, ""), (5, "again " * 7)]
    docs = []
    for i in range(120):
        own = [word() for _ in range(rng.choice([0, 3, 40, 900, 6000]))]
        if i % 2:
            leak = items[rng.randrange(1, 10)][1].split()
            for _ in range(rng.randint(0, max(1, len(leak) // 20))):
                leak[rng.randrange(len(leak))] = word()
            at = rng.randint(0, len(own))
            own[at:at] = leak
        docs.append((i, " ".join(own)))
    return spark.createDataFrame(items, "item_id long, text string"), items, docs


def test_leaks_against_brute_force(documents, benchmark):
    items, item_rows, docs = benchmark
    full = lambda t: shingles(t) if len((t or "").split()) >= 5 else frozenset()
    expect = sorted((d, i, len(full(t)), len(full(t) & full(text))) for d, text in docs for i, t in item_rows if full(t) and len(full(t) & full(text)) >= 0.8 * len(full(t)))
    assert len(expect) > 20
    for limit in (20_000, 0):  # the index on every worker, and both sides shuffled
        found = decontamination.find_leaks(documents(*docs), items, most_items=limit).collect()
        assert sorted((r.doc_id, x["item"], x.n_shingles, x.n_shared) for r in found for x in r.leaks) == expect
    clean = {r.doc_id for r in decontamination.drop_leaking(documents(*docs), items).collect()}
    assert clean == {d for d, _ in docs} - {d for d, *_ in expect}


def test_leaks_of_awkward_documents(documents, benchmark, awkward):
    items = benchmark[0]
    for limit in (20_000, 0):
        assert decontamination.find_leaks(documents(*awkward), items, most_items=limit).count() == len(awkward)
        assert decontamination.find_leaks(documents(*awkward), items.limit(0), most_items=limit).where(F.size("leaks") > 0).count() == 0
        assert decontamination.find_leaks(documents(*awkward).limit(0), items, most_items=limit).count() == 0


@pytest.mark.parametrize("module", [substrings, decontamination, jaccard_join])
def test_queries_match_sql(spark, duck, sf_dir, module):
    frame = module.query(spark, sf_dir)
    relation = duck.sql(module.ORACLE)
    columns = sorted(frame.columns)
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in frame.collect()) == sorted(repr(tuple(r[i] for i in places)) for r in relation.fetchall())


def test_suffix_query_matches_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expect = {i: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, (n, gone, spans, kept) in brute_bytes(rows, 100).items()}
    assert {r.doc_id: tuple(r)[1:] for r in suffixes.query(spark, sf_dir).collect()} == expect
    assert collections.Counter(v[1] > 0 for v in expect.values())[True] > 10


def test_short_items_are_not_missed(spark):
    """Items of five to eight words, and of one repeated word, at the edges and in the middle of long documents."""
    import pyarrow as pa

    texts = [(i, " ".join([f"q{i}x"] * 7 if n == 4 else [f"q{i}x{j}" for j in range(5 + n)])) for i in range(600) for n in (i % 5,)]
    filler = lambda i, n: [f"f{i}y{j}" for j in range(n)]
    docs = [(i, " ".join(filler(i, 200 * (i % 3 > 0)) + [text] + filler(-i - 1, 200 * (i % 3 < 2)))) for i, text in texts]
    index = decontamination.Index.build([i for i, _ in texts], pa.array([t for _, t in texts]), decontamination.CONTAINMENT)
    found = [[x["item"] for x in own] for own in index.search(pa.array([t for _, t in docs]), decontamination.CONTAINMENT)]
    missed = [sum(own != [i] for i, own in enumerate(found) if i % 5 == n) for n in range(5)]
    print("missed of 120 each, 5 to 8 words and one repeated:", missed)
    assert not any(missed)
    shuffled = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(texts, "item_id long, text string"), most_items=0)
    assert all([x["item"] for x in r.leaks] == [r.doc_id] for r in shuffled.collect())


def test_scattered_items_are_found(documents, spark):
    """Items whose shingles lie piece by piece all over long documents, at the least containment."""
    rng = random.Random(14)
    items, docs = [], []
    for i in range(120):
        n = rng.choice([30, 60, 150, 400, 900])
        own = [f"i{i}w{j}" for j in range(n)]
        items.append((i, " ".join(own)))
        cuts = sorted(rng.sample(range(5, n - 5), max(1, (n - 4) // 25)))  # each cut loses four shingles
        pieces = [own[a:b] for a, b in zip([0, *cuts], [*cuts, n], strict=True)]
        rng.shuffle(pieces)
        docs.append((i, " ".join(" ".join(p + [f"d{i}f{k}x{j}" for j in range(rng.randint(50, 400))]) for k, p in enumerate(pieces))))
    expect = [(d, i) for (d, text), (i, item) in zip(docs, items, strict=True) if len(shingles(text) & shingles(item)) >= 0.8 * len(shingles(item))]
    assert len(expect) > 100
    frame = spark.createDataFrame(items, "item_id long, text string")
    for limit in (20_000, 0):
        found = decontamination.find_leaks(documents(*docs), frame, most_items=limit).collect()
        assert sorted((r.doc_id, x["item"]) for r in found for x in r.leaks) == expect


def test_the_index_and_the_shuffle_find_the_same(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    one, other = (sorted((r.doc_id, tuple(r.leaks)) for r in decontamination.find_leaks(docs, items, most_items=limit).collect()) for limit in (20_000, 0))
    assert one == other and any(leaks for _, leaks in one)


def test_rows_of_a_large_group_stay_spread(spark):
    rows = spark.range(6400).select(F.col("id").alias("node"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("component"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sized = jaccard_join._sized(checkpoint(rows.repartition(64, "node")))
        counts = [r["count"] for r in checkpoint(sized).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(counts) == 6400 and max(counts) < 1000


def test_a_passage_in_most_documents_is_met_in_parts(spark):
    """The shuffle form on whole tables of sf0.01 gives the SQL's rows; a passage that every document holds is dealt over the salts."""
    import duckdb

    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    found = decontamination.find_leaks(docs.select("doc_id", "text"), items, most_items=0).selectExpr("doc_id", "explode(leaks) AS l").selectExpr("doc_id", "l.item AS item_id", "l.n_shingles", "l.n_shared")
    wide = duckdb.connect()
    for t in ("documents", "benchmark"):
        wide.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert {tuple(r) for r in found.collect()} == set(wide.sql(decontamination.ORACLE).fetchall())
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    many = spark.range(3000).selectExpr("id AS doc_id", f"concat('w', id, ' ', '{passage}', ' v', id) AS text")
    hot = decontamination.find_leaks(many, spark.createDataFrame([(1, passage), (2, passage)], "item_id long, text string"), most_items=0)
    assert hot.where("size(leaks) = 2").count() == 3000
