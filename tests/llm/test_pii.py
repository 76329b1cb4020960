import hashlib
import random
import re

import numpy as np
import pytest

from tessera.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and max(map(int, m[0].split("."))) <= 255, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def spans(rows, field):
    return [[(s.kind, s.start, s.end) for s in r.pii[field]] for r in rows]


def test_base_spans_of_random_texts(spark):
    rng = random.Random(3)
    parts = ["a", "@", ".", "1", "2", "9", "+", " ", "-", "(", ")", "é", "_", "%", "255", "256", "0", "4111111111111111", 'token = "', "😀", "\n", "b@c.d"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [None, "", "a.b@c.d_e@f.g", "1.2.3.4.5", "0255.1.1.1"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find_pii(frame, model={}).orderBy("doc_id").collect()
    assert spans(rows, "base") == [brute(t) for t in texts] == spans(rows, "spans")


@pytest.mark.parametrize("text", ["1 " * 20_000, "1" * 50_000, "a@" * 20_000, "1." * 20_000, "+" + "1(" * 20_000, "a" * 200_000, "x@" + "a." * 20_000, "a" * 100_000 + "@b.c"])
def test_long_runs_neither_overflow_nor_crawl(spark, text):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.find_pii(frame, model={}).count() == 1
    assert len(spans(pii.find_pii(frame, model={}).collect(), "base")) == 1


def test_query_keeps_base_spans_and_adds_secrets(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = pii.query(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    added = set()
    for r in rows:
        base = brute(texts[r.doc_id])
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in PLAIN)
        assert set(filter(None, digest.split(","))) <= set(r.spans.split(","))
        added |= {x.split(":")[0] for x in set(r.spans.split(",")) - set(digest.split(",")) - {""}}
    assert added <= {"secret", "email", "phone"}


def test_native_plans(spark, sf_dir):
    plan = pii.query(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_expectation_maximisation_finds_the_good_labelers():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.9, 0.85, 0.5])
    votes = np.where(rng.random((4000, 5)) < right, truth[:, None] * 2 - 1, 1 - truth[:, None] * 2)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    belief = pii._believe(patterns, counts.astype(float))
    assert ((belief[inverse.ravel()] > 0.5) == truth).mean() > 0.97
    weights = pii._classify(patterns, counts.astype(float), belief)
    assert weights[1] - weights[6] > 4 * abs(weights[5] - weights[10])


def test_votes_add_a_local_phone_with_context(spark):
    rows = [(i, f"call me: phone {200 + i}-555-{1000 + i} now") for i in range(60)] + [(100 + i, f"order {200 + i}-555-{1000 + i}x9") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(frame)
    found = {r.doc_id: len(r.pii.spans) for r in pii.find_pii(frame, model).collect()}
    assert all(found[i] == 1 for i in range(60)) and set(model) == {"phone"}


def test_redaction(documents, awkward):
    rows = [*awkward, (50, 'é a@b.com, 4111111111111111! token = "0123456789abcdef0123456789abcdef" x')]
    out = pii.redact(documents(*rows))
    assert out.columns == documents(*rows).columns and out.count() == len(rows)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[50].startswith("é <email>, <card>! ") and texts[50].endswith(" x") and texts[1] is None and texts[6] == dict((r[0], r[1]) for r in awkward)[6]
    assert pii.redact(documents(*awkward).limit(0)).count() == 0


def test_long_secrets_and_addresses_are_redacted_whole(spark):
    values = [("token=" + "a1" * 450, "<secret>"), ("token=" + "b2" * 50_000, "<secret>"), ("n" * 80 + " [at] example.com", "<email>"), ("me [at] " + "h" * 80 + ".com", "<email>")]
    rows = [(i, f"login mail {value} end") for i, (value, _) in enumerate(values)]
    model = {k: np.array([1.0] + [0.0] * 10) for k in pii.KINDS}
    out = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert out == {i: f"login mail {kind} end" for i, (_, kind) in enumerate(values)}


N_MATCHES = 100_000


def test_a_text_with_a_hundred_thousand_matches(spark):
    words = [("555-123-%04d x" if i % 2 else "u%d@mail.org y") % (i % 10_000) for i in range(N_MATCHES)]
    frame = spark.createDataFrame([(1, "call " + " ".join(words))], "doc_id long, text string")
    row = pii.redact(frame).collect()[0]
    assert row.text == "call " + " ".join(("<phone> x" if i % 2 else "<email> y") for i in range(N_MATCHES))


def test_pieces_are_cut_where_asked(spark):
    from pyspark.sql import functions as F

    rng = random.Random(7)
    text = "".join(rng.choice("ab\né😀") for _ in range(5000))
    cuts = [tuple(sorted((rng.randrange(5001), rng.randrange(5001)))) for _ in range(200)] + [(0, 0), (0, 5000), (1024, 2048), (1023, 1024), (5000, 5000)]
    frame = spark.createDataFrame([(text, a, b) for a, b in cuts], "text string, a int, b int").withColumn("pieces", pii.pieces_of(F.col("text")))
    assert [r.part for r in frame.select(pii.cut(F.col("pieces"), F.col("a"), F.col("b")).alias("part")).collect()] == [text[a:b] for a, b in cuts]


def test_additions_overlap_nothing(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    some = lambda: [("k", a, a + rng.randint(1, 9)) for a in (rng.randrange(80) for _ in range(rng.randint(0, 12)))]
    rows = [(some(), some()) for _ in range(300)]
    spans_type = f"array<{pii._FOUND}>"
    frame = spark.createDataFrame(rows, f"base {spans_type}, good {spans_type}")
    got = frame.select("base", "good", pii._additions(F.col("base"), F.col("good")).alias("added")).collect()
    for r in got:
        kept = []
        for _, a, b in sorted(map(tuple, r.good), key=lambda s: (s[1], -s[2])):
            if all(b <= s[1] or s[2] <= a for s in r.base):
                if kept and a < kept[-1][2]:
                    kept[-1][2] = max(kept[-1][2], b)
                else:
                    kept.append(["k", a, b])
        assert [list(x) for x in r.added] == kept


def test_running_sums(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    rows = [([rng.randrange(100) for _ in range(n)],) for n in (0, 1, 63, 64, 65, 1000)]
    got = spark.createDataFrame(rows, "v array<int>").select("v", pii.scan(F.col("v"), 0, lambda a, b: a + b).alias("sums"), pii.scan(F.col("v"), 0, F.greatest).alias("most")).collect()
    for r in got:
        assert list(r.sums) == [sum(r.v[:i]) for i in range(len(r.v))] and list(r.most) == [max(r.v[:i], default=0) for i in range(len(r.v))]
