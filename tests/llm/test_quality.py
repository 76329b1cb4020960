import collections
import random
import re

import numpy as np
import pytest

from tessera.llm import boosting, quality_classifier, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def labelled(spark, documents):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        words = ["".join(rng.choice("aeioutnrs") for _ in range(rng.randint(2, 9))) for _ in range(80)]
        rows.append((i, " ".join(w + "%%%" if i % 4 == 0 else w for w in words)))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    return documents(*rows), labels


def test_statistics_of_awkward_texts(documents, awkward, labelled):
    docs = documents(*awkward, (20, "a b c d e " * 3 + "\nx\nx\n \n \n" + "#1|<>"))
    judged = quality_rules.judge_quality(docs, labelled[1], into="verdict_struct").collect()
    assert len(judged) == len(awkward) + 1
    for row in judged:
        v = row.verdict_struct
        counts = brute(row.text)
        assert tuple(v)[:5] == counts
        assert v.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0]) and not (v.base_failed and v.kept)


def test_junk_goes_and_clean_text_stays(labelled):
    docs, labels = labelled
    kept = {r.doc_id for r in quality_rules.keep_good(docs, labels).collect()}
    assert kept == {i for i in range(400) if i % 4}
    assert quality_rules.keep_good(docs, labels).columns == docs.columns


def test_without_labels_only_the_limits_count(labelled):
    docs, labels = labelled
    assert quality_rules.keep_good(docs, labels.limit(0)).count() == 400
    assert quality_rules.keep_good(docs.limit(0), labels).count() == 0


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * rng.standard_normal(3000) < 0.5) & (x[:, 1] > 0.2)).astype(float)
    trees = boosting.fit(x, y, {0: -1})
    assert ((trees.probability(x) > 0.5) == (y > 0)).mean() > 0.8
    grid = np.repeat(rng.random((50, 3)), 100, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 100), 50)
    assert (np.diff(trees.margin(grid).reshape(50, 100), axis=1) <= 1e-12).all()
    assert (boosting.fit(x, np.ones(3000)).margin(x[:5]) > 0).all() and len(boosting.fit(np.zeros((0, 3)), np.zeros(0)).roots) == 0


def test_classifier_on_held_out_rows(spark, sf_dir):
    rows = quality_classifier.query(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.93
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_never_seen(spark, labelled):
    docs, labels = labelled
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda l: sorted((r.doc_id, r.s) for r in quality_classifier.score_quality(docs, l, into="s").collect())  # noqa: E731, E741
    assert scores(labels) == scores(turned)


def test_classifier_on_awkward_texts(documents, awkward, labelled):
    docs = documents(*awkward)
    rows = quality_classifier.score_quality(docs, labelled[1].limit(0), into="s").collect()
    assert len(rows) == len(awkward) and {r.s for r in rows} == {0.5}
    assert quality_classifier.score_quality(docs.limit(0), labelled[1], into="s").count() == 0


def test_dual_coordinate_descent_separates():
    rows = [np.array([i % 2, 5]) for i in range(40)]
    model = quality_classifier.fit_rows(rows, np.array([i % 2 for i in range(40)]))
    assert model.score(np.array([1, 5])) > 0.8 > 0.2 > model.score(np.array([0, 5]))


def test_descent_matches_a_plain_solver():
    """The dual is a concave program in a box: projected gradient steps to the same weights."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 12, 6)) for _ in range(60)]
    y = np.where([(r < 6).mean() + 0.2 * rng.standard_normal() > 0.5 for r in rows], 1.0, -1.0)
    ratio = np.zeros(quality_classifier.SIZE)
    ratio[:12] = rng.uniform(-2, 2, 12)
    cost = np.where(y > 0, 0.7, 1.1)
    weights, intercept = quality_classifier._descend(rows, y, ratio, cost, 2000)
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r], x[i, 12] = ratio[r] / np.sqrt(len(r)), 1.0
    gram = (x * y[:, None]) @ (x * y[:, None]).T
    alpha, step = np.zeros(60), 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(200_000):
        alpha = np.clip(alpha - step * (gram @ alpha - 1), 0, cost)
    w = (x * y[:, None]).T @ alpha
    loss = lambda v: 0.5 * v @ v + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    mine = np.append(weights[:12] / np.where(ratio[:12] == 0, 1, ratio[:12]), intercept)
    assert abs(loss(mine) - loss(w)) < 0.01 * loss(w) and np.abs(mine - w).max() < 0.05


def test_indicators_match_sets(awkward):
    import pyarrow as pa

    def plain(text):
        data = (text or "").encode()
        if not data:
            return set()
        hashed = lambda v, bits: ((v * 2654435761) % (1 << 32)) >> (32 - bits)
        kind = lambda b: 6 if b >= 128 else 1 if 97 <= b < 123 else 2 if 65 <= b < 91 else 3 if 48 <= b < 58 else 4 if b in b".,;:!?" else 5 if b in b"#*$%&|<>=_@~^" else 0
        grams = {hashed(data[i] | data[i + 1] << 8 | data[i + 2] << 16, 17) for i in range(len(data) - 2)}
        words = re.findall(rb"[^\x20\x09-\x0D]+", data)
        shape = [((kind(w[0]) * 7 + kind(w[-1])) * 8 + min(len(w), 7)) * 2 + (i > 0 and w == words[i - 1]) for i, w in enumerate(words)]
        shapes = {(1 << 17) + hashed(a * 1024 + b, 15) for a, b in zip(shape[:-1], shape[1:], strict=True)}
        share = brute(text)[4] / max(len(words), 1)
        return grams | shapes | {quality_classifier.SIZE - 16 + k for k in range(int(10 * share) + 1)}

    texts = [t for _, t in awkward] + ["a b. C d9 $x x x", "one two " * 9]
    got = [set(next(quality_classifier.indicators(pa.array([t], pa.string()))).tolist()) for t in texts]
    assert got == [plain(t) for t in texts]
