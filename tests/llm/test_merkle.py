import hashlib
import zlib

import pytest

from tessera.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_of(nodes):
    """All levels of a tree, leaves first."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H(*low[i : i + 3]) for i in range(0, len(low), 3)])
    return levels


def way(levels, at):
    """The siblings of a node, level by level: those before and those after it."""
    found = []
    for low in levels[:-1]:
        run = low[at // 3 * 3 : at // 3 * 3 + 3]
        found.append((run[: at % 3], run[at % 3 + 1 :]))
        at //= 3
    return found


def plain(rows):
    """rows (doc_id, source, lang, n_chars, text) -> the contract's rows."""
    framed = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r: H(*map(framed, r))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    first = lambda x: (x is not None, x if x is not None else 0)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(groups[s], key=lambda r: (first(r[0]), leaf(r))) for s in order}
    levels = {s: tree_of(map(leaf, trees[s])) for s in order}
    top = tree_of(levels[s][-1][0] for s in order)
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(trees[s]):
            path = way(levels[s], i) + way(top, k)
            forged = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                forged = (*r[:4], r[4].replace("\n", ""))
            h = leaf(forged)
            for before, after in path:
                h = H(*before, h, *after)
            root = top[-1][0]
            out.append((r[0], leaf(r), levels[s][-1][0], root, H(*(x for b, a in path for x in (*b, *a))), h, h == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.fixture
def proved(spark, tmp_path):
    def run(rows):
        docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
        docs = docs.selectExpr("*", "'x' AS tree", "'x' AS at", "'x' AS digest", "'x' AS path", "'x' AS n")
        docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        return sorted((tuple(r[c] for c in COLUMNS) for r in merkle.query(spark, str(tmp_path)).collect()), key=str)

    return run


def test_awkward_rows(proved):
    rows = [(i, f"s{i % 7}", "en", i, f"text {i}\nx") for i in range(60)]
    rows += [(None, "s1", None, None, None), (None, None, "en", 3, ""), (5, None, "é", 1, "\n\n"), (6, None, "é", 1, None), (70, "ß", "en", 5, "w" * 200_000 + "\n"), (71, "", "-", 0, "-")]
    rows += [(80, "s2", "en", 1, "same\n")] * 5 + [(81, "s2", "en", 1, "a\n"), (81, "s2", "en", 1, "b\n")]
    assert proved(rows) == plain(rows)


def test_one_leaf_and_none(proved):
    assert proved([(1, "s", "en", 1, "a")]) == plain([(1, "s", "en", 1, "a")])
    assert proved([]) == []


@pytest.mark.parametrize("levels", [1, 2])
def test_trees_of_many_packs(proved, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "PACK", 3**levels)
    rows = [(i, "hot" if i % 3 else f"s{i % 39}", "en", i, f"t{i}\n") for i in range(400)]
    assert proved(rows) == plain(rows)


def test_paths_excise_and_splice(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = merkle.manifest(merkle.document_leaves(docs), "source", ["doc_id"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        h = r.digest
        for step in r.path:
            assert step.preimage[64 * step.slot : 64 * step.slot + 64] == h
            h = H(step.preimage)
        assert h == r.root
