"""The pipeline against a plain Python version of what each stage must do to its own input."""

import collections

import corpus_pipeline
from tessera.llm import pii, quality_rules
from test_dedup import brute_classes, shingles
from test_quality import brute


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "pii", "source_mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = docs.collect()
        kept = {r.doc_id for r in after}
        if name != "source_mixing":
            assert docs.columns == columns and len(after) == len(kept)
        if name == "quality_rules":
            for i, r in before.items():
                n, *_, repeated = brute(r.text)
                if n < quality_rules.LEAST_WORDS or 100 * repeated > quality_rules.MOST_REPEATED_PERCENT * n or labels.get(i) == 0:
                    assert i not in kept
                elif labels.get(i) == 1:
                    assert i in kept
        elif name == "jaccard_join":
            assert kept == {c for c, _, _ in brute_classes([(i, r.text) for i, r in before.items()]).values()}
        elif name == "decontamination":
            assert kept == {i for i, r in before.items() if not any(x and len(x & shingles(r.text)) >= 0.8 * len(x) for x in items)}
        elif name == "pii":
            assert kept == set(before) and all(r.n_chars == len(r.text) for r in after)
            left = pii.find_pii(docs, model={}).where("size(pii.base) > 0").count()
            assert left == 0
        else:
            assert len({(r.doc_id, r.mix_copy) for r in after}) == len(after) and max(collections.Counter(r.doc_id for r in after).values()) <= 3


def test_run_returns_the_mix(spark, sf_dir):
    mixed = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "text", "mix_copy", "mix_shard", "mix_place"} <= set(mixed.columns) and mixed.count() > 50


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
