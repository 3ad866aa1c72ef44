"""Stages of the pipeline, each against brute force on its own input."""

import corpus_pipeline as pipeline
from test_decontaminate import tokens
from test_minhash import brute

from headroom.llm import decontaminate, raking, toxicity


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {name: None for name, _ in pipeline.STAGES}
    before = docs
    for name, stage in pipeline.STAGES:
        after = pipeline.stored(stage(spark, before, sf), name)
        assert after.columns == docs.columns if name != "sharding" else after.columns == [*docs.columns, "shard", "slot"]
        kept[name] = ({r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in after.collect()})
        before = after
    all_docs, calm = kept["toxicity"]
    assert calm.items() <= all_docs.items() and len(calm) > 0.8 * len(all_docs)
    one, two = kept["near_duplicates"]
    assert set(two) == {i for i, _, _, first in brute(sorted(one.items()), 80) if first}
    one, two = kept["decontamination"]
    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    for i in set(one) - set(two):  # a removed document shares at least seven tokens on one diagonal with some item
        words = tokens(one[i])
        assert any(sum(a == b for a, b in zip(words[k:], item)) >= 7 for item in items.values() for k in range(len(words)))
    for i, text in two.items():
        joined = f" {' '.join(tokens(text))} "
        assert not any(f" {' '.join(item)} " in joined for item in items.values() if len(item) >= 5)
    one, two = kept["mixing"]
    assert two.items() <= one.items() and 0.5 * len(one) < len(two) <= len(one)
    rows = before.collect()
    assert {r.doc_id for r in rows} == set(two) == set(kept["sharding"][1])
    for k in range(pipeline.SHARDS):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))


def test_run_gives_the_last_stage(spark, sf):
    assert pipeline.run(spark, sf).count() > 50
    assert [f.__module__ for _, f in pipeline.STAGES] == ["corpus_pipeline"] * 5 and toxicity and raking and decontaminate


def test_rows_with_null_or_repeated_ids_pass_no_stage_unfiltered(spark, table, tmp_path):
    text = "one two three four five six seven"
    rows = [(None, text), (None, text), (4, text), (4, text), (9, text), (None, "a b c d e f g"), (None, "a b c d e f g"), (8, None), (8, "")]
    left = pipeline.drop_near_duplicates(spark, table(rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted([(4, text), (None, "a b c d e f g"), (8, None), (8, "")], key=repr)
    spark.createDataFrame([(1, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = pipeline.drop_contaminated(spark, table(rows), str(tmp_path))
    assert clean.columns == table(rows).columns and {r.text for r in clean.collect()} == {"a b c d e f g", None, ""} and clean.count() == 4


def test_mixing_meets_the_targets_without_weights(spark, table):
    from collections import Counter

    rows = [(i if i % 3 else None, f"text {i} " + "word " * 18, "en" if i % 20 else "es", "hot" if i % 10 else "rare") for i in range(12_000)]
    tokens, kept = ([Counter(), Counter()] for _ in range(2))
    out = pipeline.mix_sources(spark, table(rows), "").collect()
    for (_, text, lang, source), sums in [(r, tokens) for r in rows] + [((r.doc_id, r.text, r.lang, r.source), kept) for r in out]:
        sums[0][source] += len(text.split())
        sums[1][lang] += len(text.split())
    for had, got in zip(tokens, kept):
        mass = {k: v**0.7 for k, v in had.items()}
        for k in had:
            assert abs(got[k] / sum(got.values()) - mass[k] / sum(mass.values())) < 0.01, (k, had, got)
