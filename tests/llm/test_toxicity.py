import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity
from tessera.llm.levenshtein import Automaton, Term, code_points, word_bounds


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def plain_match(terms, word):
    """The fewest edits to a term, or to any beginning of the word for a stem; then the longest term."""
    found = []
    for i, t in enumerate(terms):
        d = min(edits(t.text, word[:k]) for k in range(1, len(word) + 1)) if t.stem else edits(t.text, word)
        if d <= t.edits:
            found.append((d, -len(t.text), i))
    return min(found)[::2] if found else None


def test_automaton_against_edit_distance():
    rng = random.Random(4)
    terms = [Term("abcab", 1, edits=1), Term("abc", 1), Term("bacabba", 1, edits=2), Term("cab", 1, stem=True), Term("accba", 1, stem=True, edits=1), Term("éb", 1), Term("ccccc", 1, edits=1)]
    automaton = Automaton(terms)
    words = ["".join(rng.choice("abcabcabcéd") for _ in range(rng.randint(1, 9))) for _ in range(6000)] + [t.text for t in terms]
    points, bounds = code_points([" ".join(words)])
    starts, ends, first = word_bounds(points, bounds)
    assert first.tolist() == [0, len(words)]
    hits, term, distance = automaton.walk(points, starts, ends)
    got = {int(h): (int(e), int(t)) for h, t, e in zip(hits, term, distance, strict=True)}
    want = {i: m for i, w in enumerate(words) if (m := plain_match(terms, w))}
    assert len(want) > 200 and got == want


def test_words_and_quotations():
    texts = ['He said "you mug" and left. mug', "a «mug» b", "x\n\"\nmug", "", "MUG mug7 😀mug", "„mug“ mug\n “mug” mug"]
    found = toxicity.find_matches(Automaton([Term("mug", 1)]), texts)
    assert list(zip(found.text.tolist(), found.quoted.tolist(), strict=True)) == [(0, True), (0, False), (1, True), (2, False), (4, False), (4, False), (5, True), (5, False), (5, True), (5, False)]
    assert found.n_words.tolist() == [7, 3, 2, 0, 3, 4]


CLEAN = ["".join(random.Random(i).choice("aeioutnrs") for _ in range(5)) for i in range(80)]
VILE, STEM = ("zwackel", "dumpfex", "quilbat"), "grxl"


@pytest.fixture(scope="module")
def labelled(spark, documents):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(CLEAN) for _ in range(60)]
        toxic, quoting = i % 3 == 0, i % 3 == 1
        for k in rng.sample(range(60), 4):
            vile = rng.choice([*VILE, STEM + "".join(rng.choice("bdfg") for _ in range(3))])
            if toxic:
                words[k] = vile
            elif quoting and k % 2:
                words[k] = f'"{vile}"'
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # copies of one toxic text teach no words of their own
    labels += [(1000 + i, 1, 1) for i in range(40)] + [(None, 1, 1), (4, None, None)]
    return documents(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(labelled):
    return toxicity.fit(*labelled)


def test_learns_terms_stems_and_contexts(model):
    terms = {(t.text, t.stem) for t in model.automaton.terms}
    assert terms == {*((v, False) for v in VILE), (STEM, True)}
    assert model.context.quoted < -1


def test_misspelled_terms_and_quotations(model):
    fill = " ".join(CLEAN[:40])
    vile = f"{fill} zwakel {CLEAN[1]} dumpvex {CLEAN[2]} quilbaat {CLEAN[3]} {STEM}bbb"
    mention = f'{fill} "zwackel" {CLEAN[1]} "dumpfex" {CLEAN[2]} "quilbat"'
    scores = model.score([vile, mention, fill, "", "zwackel dumpfex"])
    assert scores[0] > 0.5 > scores[1] and scores[2] < 0.05 and scores[3] < 0.5 < scores[4]


def test_fitted_rows_are_told_apart(labelled, model):
    docs, labels = labelled
    rows = docs.withColumn("s", toxicity.scorer(model)("text")).join(labels, "doc_id").select("s", "toxic", toxicity.held_out(F.col("doc_id")).alias("h")).where("h AND toxic IS NOT NULL").collect()
    assert len(rows) > 100 and np.mean([(r.s >= 0.5) == (r.toxic == 1) for r in rows]) > 0.97


def test_held_out_labels_are_never_seen(labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = lambda l: sorted((r.doc_id, r.s) for r in toxicity.score_toxicity(docs, l, into="s").collect())  # noqa: E731, E741
    assert scores(labels) == scores(turned)


def test_awkward_texts_and_missing_labels(documents, awkward, labelled):
    docs, labels = documents(*awkward), labelled[1]
    assert {r.s for r in toxicity.score_toxicity(docs, labels.limit(0), into="s").collect()} == {0.5}
    only = toxicity.score_toxicity(labelled[0], labels.where("toxic = 1"), into="s").select("s").distinct().collect()
    assert len(only) == 1 and only[0].s > 0.9
    rows = docs.withColumn("s", toxicity.scorer(toxicity.fit(*labelled))("text")).collect()
    assert len(rows) == len(awkward) and all(0 <= r.s < 0.5 for r in rows)
    assert toxicity.score_toxicity(docs.limit(0), labels, into="s").count() == 0


def test_accuracy_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r.predicted, labels[r.doc_id]) for r in toxicity.query(spark, sf).where("held_out").collect() if r.doc_id in labels]
    toxic, clean = [p for p, t in rows if t], [p for p, t in rows if not t]
    assert len(toxic) > 50 and np.mean(toxic) > 0.9 and np.mean(clean) < 0.01
