import collections
import heapq
import random

import numpy as np
import pytest

from tessera.llm import chat, mixing


def plain_targets(sizes):
    """Targets by name, null last, shared out again until none is above."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, full = {}, set()
    while True:
        left, total = sum(sizes.values()) - sum(3 * sizes[s] for s in full), sum(weight[s] for s in order if s not in full)
        goal = {s: 3 * sizes[s] if s in full else left * weight[s] / total for s in order}
        above = {s for s in order if s not in full and goal[s] > 3 * sizes[s]}
        if not above:
            return goal
        full |= above


def test_targets():
    sizes = {"a": 100, "b": 10, "c": 40, None: 50}
    got = mixing.targets(np.array(list(sizes.values())))
    assert got.tolist() == pytest.approx(list(plain_targets(sizes).values())) and sum(got) == pytest.approx(200) and got[1] == 30
    assert not len(mixing.targets(np.array([]))) and mixing.targets(np.array([0])).tolist() == [0]


def test_quotas_are_split_exactly(spark):
    quotas = {"a": 100, "b": 7, "c": 0, "d": 33}
    frame = spark.createDataFrame(list(quotas.items()), "at string, n long")
    for shards in (1, 8, 100):
        rows = mixing.shard_ranges(frame, shards, 1).collect()
        drawn = collections.defaultdict(list)
        for r in rows:
            drawn[r["at"]] += [(i, r.shard) for i in range(r["first"], r["first"] + r.n)]
        assert {k: sorted(i for i, _ in v) for k, v in drawn.items()} == {k: list(range(n)) for k, n in quotas.items() if n}
        sizes = collections.Counter(s for v in drawn.values() for _, s in v)
        assert set(sizes) <= set(range(shards)) and max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 7
        assert sorted(rows) == sorted(mixing.shard_ranges(frame.repartition(3), shards, 1).collect())
    nodes = mixing.split_counts(np.array([50, 50]), 0, 8, 1, 8)
    assert not all((a == b).all() for (*_, a), (*_, b) in zip(nodes, mixing.split_counts(np.array([50, 50]), 0, 8, 2, 8), strict=True))


def test_many_large_sources_stay_below_the_generators_limit():
    import pandas as pd

    n = 6000
    rows = mixing._planner(mixing.WEIGHTS, 3, 1)(pd.DataFrame({"at": [f"s{i}" for i in range(n)], "size": 10**9, "docs": 10**8}))
    quotas = (rows["blocks"] * 3).to_numpy()
    assert quotas.sum() < 10**9
    assert sum(int(c.sum()) for *_, c in mixing.split_counts(quotas, 0, 4, 1, 4)) == quotas.sum()


def test_query_against_a_plain_version(spark, sf_dir):
    rows = mixing.query(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes, taken, shard_words = collections.Counter(), collections.Counter(), collections.Counter()
    for r in docs.values():
        sizes[r.source] += len((r.text or "").encode().split())
    goal, largest = plain_targets(sizes), max(len((r.text or "").encode().split()) for r in docs.values())
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        drawn = [x.split(":") for x in r.drawn.split(",") if x]
        assert r["size"] == len((docs[r.doc_id].text or "").encode().split()) and r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert r.taken == len(drawn) * r["size"] <= 3 * r["size"]
        taken[r.source] += r.taken
        for shard, _ in drawn:
            shard_words[int(shard)] += r["size"]
    assert all(abs(taken[s] - g) <= largest / 2 for s, g in goal.items())
    assert sum(shard_words.values()) == sum(taken.values()) and set(shard_words) <= set(range(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    assert sorted(rows) == sorted(mixing.query(spark, sf_dir).collect())


@pytest.fixture(scope="module")
def corpus(documents):
    rng = random.Random(2)
    return documents(*((i, "w " * rng.randint(1, 60), f"s{i % 3 if i % 2 else 0}") for i in range(1500)))


def test_mix_comes_near_its_targets(corpus):
    planned, draws = mixing.plan_mix(corpus)
    copies = collections.Counter((r["at"], r.lot) for r in draws.collect())
    taken, goal = collections.Counter(), {}
    for r in planned.collect():
        taken[r.source] += copies[r["at"], r.lot] * r["size"]
        goal[r.source] = r.target
        assert copies[r["at"], r.lot] <= 3
    assert all(abs(taken[s] - g) <= 30 for s, g in goal.items())  # half of the largest document


def test_shards_hold_whole_draws_in_order(spark, corpus):
    mixed = mixing.mix(corpus, shards=4)
    assert mixed.columns == [*corpus.columns, "mix_copy", "mix_shard", "mix_place"]
    rows = mixed.collect()
    assert {r.mix_shard for r in rows} == {0, 1, 2, 3} and len({(r.doc_id, r.mix_copy) for r in rows}) == len(rows)
    for shard in range(4):
        places = [r.mix_place for r in rows if r.mix_shard == shard]
        assert places == sorted(places)
    assert mixing.mix(mixed, shards=2).columns == mixed.columns
    again = mixing.mix(corpus.repartition(7), shards=4, few_sources=0).collect()
    key = lambda r: (r.doc_id, r.mix_copy, r.mix_shard, r.mix_place)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_awkward_documents(documents, awkward):
    docs = documents(*((*r, None if i % 2 else "s") for i, r in enumerate(awkward)))
    planned, draws = mixing.plan_mix(docs)
    assert planned.count() == len(awkward) and planned.where("source IS NULL").count() == 6
    assert draws.count() >= 0 and mixing.mix(docs).count() > 0
    assert mixing.plan_mix(docs.limit(0))[1].count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def cheapest(roles):
    best, queue = {(0, 0): 0}, [(0, 0, 0)]
    after = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}

    def push(cost, i, s):
        if cost < best.get((i, s), 1e9):
            best[i, s] = cost
            heapq.heappush(queue, (cost, i, s))

    while queue:
        cost, i, s = heapq.heappop(queue)
        if i == len(roles) and s == 3:
            return cost
        for t in after[s]:
            push(cost + chat.INSERT, i, t)
        if i < len(roles):
            for t in (1, 2, 3):
                change = 0 if roles[i] == chat.ROLES[t - 1] else chat.RELABEL if roles[i] in chat.ROLES else chat.RENAME
                if t in after[s]:
                    push(cost + change, i + 1, t)
                if t == s:
                    push(cost + change + chat.MERGE, i + 1, t)


def test_repair_is_legal_cheapest_and_whole(spark):
    rng = random.Random(2)
    roles = {c: [rng.choice(["system", "user", "assistant", "tool", None, "user", "assistant"]) for _ in range(rng.randint(1, 7) if c else 500)] for c in range(150)}
    data = [(c, i, r, f"t{c}.{i}", "x") for c, rs in roles.items() for i, r in enumerate(rs)]
    rng.shuffle(data)
    out = collections.defaultdict(list)
    for r in chat.repair(spark.createDataFrame(data, "conv_id long, turn int, role string, text string, place string")).collect():
        out[r.conv_id].append(r)
    for c, rs in roles.items():
        fragments = sorted(out[c], key=lambda r: r.place)
        assert [f.place for f in fragments] == list(range(len(fragments)))
        assert [f.turn for f in fragments if f.turn is not None] == list(range(len(rs)))
        cost = sum((f.action == "insert") * chat.INSERT + ("merge" in f.action) * chat.MERGE + ("relabel" in f.action) * (chat.RELABEL if f.turn is not None and rs[f.turn] in chat.ROLES else chat.RENAME) for f in fragments)
        messages = []
        for f in fragments:
            if "merge" in f.action:
                assert messages[-1][0] == f.role
                messages[-1][1].append(f.text)
            else:
                messages.append((f.role, [f.text]))
            assert f.message_no == len(messages) - 1
        sequence = [m[0] for m in messages]
        turns = sequence[1:] if sequence[0] == "system" else sequence
        assert len(turns) % 2 == 0 and turns == ["user", "assistant"] * (len(turns) // 2)
        assert cost == cheapest(rs)
        assert "".join(f.rendered for f in fragments) == "".join(f"<|{role}|>\n" + "\n".join(texts) + "<|end|>\n" for role, texts in messages)


def test_awkward_turns(spark):
    schema = "conv_id long, turn int, role string, text string"
    rows = [(None, None, None, None), (1, None, "user", None), (1, 2, "user", "a"), (1, 2, "user", "a"), (2, 1, " USER ", "x" * 100_000)]
    got = chat.repair(spark.createDataFrame(rows, schema)).collect()
    assert sum(r.action != "insert" for r in got) == len(rows)
    assert chat.repair(spark.createDataFrame([], schema)).count() == 0
