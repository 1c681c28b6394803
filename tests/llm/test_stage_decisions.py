"""What the model decides in the language stage, and that shards can be put back into training order."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import langid, mixing, sharding
from salesmart.llm.common import Scratch
from test_near_copies import plain_kept

STAGES = dict(corpus_pipeline.STAGES)


def test_language_stage_rejects_what_is_like_no_language(spark, sf_dir, texts):
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("qxzjvkw") for _ in range(n))
    real = {i: t for i, t in texts if t and any(c.isalpha() for c in t)}
    words = next(iter(real.values()))
    extra = [(10**6, " ".join(letters(7) for _ in range(400))), (10**6 + 1, "x" * 5000), (10**6 + 2, words + " " + letters(9)),
             (10**6 + 3, ""), (10**6 + 4, None), (10**6 + 5, "!?")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame(extra, "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    kept = {r["doc_id"] for r in STAGES["language_id"](spark, docs, sf_dir).collect()}
    assert kept == set(real) | {10**6 + 2}
    # the model decides: one that knows other letters keeps others
    languages, table = langid.train(spark.createDataFrame(
        [(i, "zz", " ".join(letters(7) for _ in range(400))) for i in range(200)], "doc_id long, lang string, text string"))
    kept = {r["doc_id"] for r in langid.keep_identified(docs, (languages, table), likely=True).collect()}
    assert 10**6 in kept and not kept & set(real)


def test_near_copy_stage_after_the_language_stage(spark, sf_dir):
    docs = STAGES["language_id"](spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    want, _ = plain_kept([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r["doc_id"] for r in STAGES["simhash_near_dedup"](spark, docs, sf_dir).collect()) == want


def test_shuffled_shards_restore_the_curriculum(spark, sf_dir):
    planned = mixing.scheduled_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    docs = Scratch(spark, "order-test").keep(planned, "mixed", maxRecordsPerFile=7)
    sharded = sharding.shard_rows(docs, shards=4, place=sharding.row_place())
    assert sharded.columns == [*docs.columns, "shard", "position"]
    rows = sharded.collect()
    random.Random(1).shuffle(rows)
    rows.sort(key=lambda r: r["position"])
    assert len({r["position"] for r in rows}) == len(rows)
    want = [r["doc_id"] for r in planned.collect()]
    assert [r["doc_id"] for r in rows] == want
    for shard in range(4):
        mine = [r["doc_id"] for r in rows if r["shard"] == shard]
        assert mine == [i for i in want if i in set(mine)]


def test_places_of_edge_rows(edge_docs):
    rows = sharding.shard_rows(edge_docs.withColumn("position", F.lit(0)), shards=3, place=F.monotonically_increasing_id())
    assert rows.columns[-2:] == ["_shard", "_position"] and rows.count() == edge_docs.count()
    assert sharding.shard_rows(edge_docs.limit(0), place=F.lit(1)).count() == 0
