import random

from tessera.llm import url_filters as op


def brute(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].translate(str.maketrans(op.UPPER, op.LOWER)), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_against_brute_force(spark):
    rng = random.Random(1)
    hosts, paths = ["a", "b.a", "c.b.a", "a.b", "", "x.c.b.a"], ["", "/", "/a", "/aa", "/aab", "/b", "/ab/c", "/é"]
    rules = {(h, p): v for h, p, v in ((rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(40))}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [None, "", "none", "http://", "http://A.B/aab?x", "http://c.b.a/ab/c/d#f", "x://y.x.c.b.a/é/z", "s://a./a", "s://a/\n/a"]
    urls += ["s://" + rng.choice([*hosts, "q.a", "z.b", "com"]) + rng.choice(paths) + rng.choice(["", "?q", "#z", "/aab"]) for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: tuple(r)[1:] for r in op.judge_urls(pages, op.rules_frame(spark, tuple(rules))).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_sweep_across_partitions(spark):
    """Rules that open in one partition and hold in all that follow."""
    rules = (("a", "", "block"), ("a", "/m", "allow"), ("a", "/m/5", "block"))
    urls = [f"http://a/{c}/{i}" for c in "kmz" for i in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in op.judge_urls(pages, op.rules_frame(spark, rules)).collect()}
    assert got == {i: brute(u, rules)[2:] for i, u in enumerate(urls)}


def test_empty_tables_and_doubled_rules(spark):
    pages = spark.createDataFrame([(1, "http://a/b"), (1, "http://a/b"), (None, None)], "page_id long, url string")
    assert op.judge_urls(pages.limit(0), op.rules_frame(spark, op.RULES)).count() == 0
    assert {r.verdict for r in op.judge_urls(pages, op.rules_frame(spark, ())).collect()} == {"allow"}
    both = op.rules_frame(spark, (("a", "", "allow"), ("a", "", "block")))
    rows = op.judge_urls(pages, both).collect()
    assert len(rows) == 3 and sorted(r.verdict for r in rows) == ["allow", "block", "block"]


def test_matches_sql_and_stays_in_the_jvm(spark, duck, sf_dir):
    frame = op.query(spark, sf_dir)
    assert sorted(map(repr, map(tuple, frame.collect()))) == sorted(map(repr, duck.sql(op.ORACLE).fetchall()))
    assert not any(x in frame._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
