import collections
import random
import re

import numpy as np
import pytest

from tessera.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, share=100):
    """(lang, text) rows -> {(lang, phrase): (a, l, r, n, score)} by brute force."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    held = collections.Counter()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                held[lang, w[i : i + k]] = max(held[lang, w[i : i + k]], a)
    out = {}
    for (lang, w), a in candidates.items():
        if 100 * held[lang, w] >= share * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang, " ".join(w)] = (a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score)
    return out


def found(docs, **options):
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(docs, **options).collect()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    words = [f"W{i}" for i in range(8)] + ["é", "ß\x00x", "日本", "a-b"]
    rows = [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", "\t ", ", ", "\n", "!", "\x0b"]) for _ in range(rng.randint(0, 80)))) for _ in range(150)]
    rows += [("en", None), ("en", ""), ("fr", " \t\n.,"), (None, None), ("en", "again and Again " * 2000), ("es", "x" * 60_000)]
    return rows + [("de", "hot word pair goes here")] * 60 + [("en", "Wide wide WIDE wide wide wide")] * 7


@pytest.mark.parametrize("options", [{}, {"share": 80}, {"most_words": 3}])
def test_brute_force(spark, corpus, options):
    docs = spark.createDataFrame(corpus, "lang string, text string").selectExpr("*", "'x' AS n", "'x' AS key", "'x' AS phrase", "1 AS bucket").repartition(5)
    want = plain(corpus, 6, options.get("share", 100))
    assert len(want) > 50 and found(docs, least=6, **options) == want


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "lang string, text string")) == {}
    assert found(spark.createDataFrame([("en", "a b"), (None, None)], "lang string, text string"), least=2) == {}


def test_ranks_and_ties(spark, tmp_path):
    rows = [(f"l{k}", "b a. c a. é a. a a") for k in range(2) for _ in range(100)]
    spark.createDataFrame(rows, "lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.lang, r["rank"], r.phrase) for r in collocations.query(spark, str(tmp_path)).orderBy("lang", "rank").collect()]
    assert got == [(f"l{k}", i + 1, p) for k in range(2) for i, p in enumerate(["b a", "c a", "é a", "a a"])]


def test_ids_of_every_width_sort_as_their_keys():
    rng = np.random.default_rng(2)
    for n in (50, 70_000, None):
        hashes = np.unique(rng.integers(0, 1 << 63, 70_001 if n is None else n, dtype=np.uint64))
        book = collocations.Dictionary(None if n is None else hashes)
        assert book.digits == {50: 1, 70_000: 2, None: 4}[n]
        ids = book.ids(hashes)
        assert len(set(ids.tolist())) == len(hashes) and 0 not in ids
        if n:
            assert not book.ids(np.array([1 << 63], dtype=np.uint64)).any()
        rows = book.matrix(ids[rng.integers(0, len(ids), (2000, 5))])
        order = collocations.radix_order(rows)
        assert [rows[i].tolist() for i in order] == sorted(rows.tolist())
        keys = collocations.as_bytes(rows)
        assert (np.argsort(keys, kind="stable") == order).all()


def test_large_counts_stay_exact(spark):
    words = spark.createDataFrame([(b"\0\1", "en", "a", 10**13, 3 * 10**14), (b"\0\2", "en", "b", 10**13 - 7, 3 * 10**14)], "key binary, lang string, word string, f long, n long")
    phrases = spark.createDataFrame([(b"\0\1\0\2", 10**12 + 1)], "phrase binary, a long")
    row = collocations.score_phrases(words, phrases, 2).first()
    assert row.score == 1000 * (10**12 + 1) * (3 * 10**14) // (10**13 * (10**13 - 7))
