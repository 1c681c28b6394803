"""The pipeline's stages against brute force, one after the other."""

from collections import Counter

import duckdb

import corpus_pipeline
from salesmart.llm import decontaminate as dc, mixing, sharding
from test_near_copies import plain_kept


def test_stage_by_stage(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [stage(spark, docs, sf_dir) for _, stage in corpus_pipeline.STAGES[:1]][0].cache()
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in texts if t and any(c.isalpha() for c in t)}

    deduped = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, kept, sf_dir).cache()
    want, _ = plain_kept([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert sorted(r["doc_id"] for r in deduped.collect()) == want

    clean = corpus_pipeline.drop_benchmark_leaks(spark, deduped, sf_dir).cache()
    items = [dc.normalised(t) for (t,) in duckdb.sql(f"select text from '{sf_dir}/benchmark.parquet'").fetchall()]
    dropped = {r["doc_id"]: r["text"] for r in deduped.collect()}
    for row in clean.collect():
        del dropped[row["doc_id"]]
        assert not any(item in dc.normalised(row["text"]) for item in items)
    assert all(any(item in dc.normalised(t) for item in items) for t in dropped.values())

    mixed = corpus_pipeline.mix_sources(spark, clean, sf_dir).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan(clean).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == copies

    sharded = corpus_pipeline.shard_documents(spark, mixed, sf_dir)
    assert sharded.columns == [*docs.columns, "shard"] and sharded.count() == mixed.count()
    assert sharded.groupBy("text").agg({"shard": "min"}).count() == sharded.select("text", "shard").distinct().count()
    assert sharded.where(f"shard not between 0 and {sharding.SHARDS - 1}").count() == 0
    for frame in (kept, deduped, clean, mixed):
        assert frame.columns == docs.columns
        frame.unpersist()


def test_run_gives_what_the_stages_give(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    want = Counter((r["doc_id"], r["shard"]) for r in docs.collect())
    assert Counter((r["doc_id"], r["shard"]) for r in corpus_pipeline.run(spark, sf_dir).collect()) == want


def test_stages_take_edge_rows_and_empty_tables(spark, sf_dir, edge_docs):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    edge = edge_docs.selectExpr("doc_id", "text", "lang", "source", "cast(_key as long) as n_chars")
    for start in (base.unionByName(edge), base.limit(0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert docs.columns == [*base.columns, "shard"]
        docs.count()
