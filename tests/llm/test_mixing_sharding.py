"""Mixing against its SQL twin and a plain water level; shards against the laws of the scheduler."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, oracle_connection
from salesmart.llm import mixing, queries, sharding
from salesmart.llm.common import Scratch, word_count
from salesmart.llm.running import with_running


def test_mixing_matches_its_twin(spark, sf_dir):
    ok, message = compare(spark, oracle_connection(sf_dir), "op8_mixing", queries.QUERIES["op8_mixing"],
                          queries.ORACLE["op8_mixing"], sf_dir)
    assert ok, message


@pytest.mark.parametrize("seed", range(3))
def test_targets_reach_the_water_level(spark, seed):
    random.seed(seed)
    sizes = {None if s == 0 else f"s{s:02d}": random.choice([0, 1, 5, 50, 1000, 100_000]) for s in range(9)}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    open_, left, want = set(sizes), float(sum(sizes.values())), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not full:
            want |= {s: share * weight[s] for s in open_}
            break
        want |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3.0 * sizes[s] for s in full)
        open_ -= full
    assert got == pytest.approx(want)


def test_schedule_and_its_inverse(spark):
    row = spark.range(101).select((F.col("id") / 100).alias("u"))
    for slope in (-0.4, 0.0, 0.4):
        got = row.select("u", mixing.due_time(F.col("u"), F.lit(slope)).alias("t")).collect()
        assert all(abs(r["t"] + slope * (r["t"] ** 2 - r["t"]) - r["u"]) < 1e-9 for r in got)


def test_scheduled_copies_repeat_and_sort(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planned = {r["doc_id"]: r for r in mixing.plan(docs).collect()}
    rows = [r["doc_id"] for r in mixing.scheduled_copies(docs).collect()]
    assert Counter(rows) == {i: r["copies"] for i, r in planned.items() if r["copies"]}
    assert rows == [i for _, i in sorted((t, i) for i, r in planned.items() for t in r["places"])]


def test_a_row_repeated_for_a_third_of_the_table(spark):
    """Equal rows with unlike further columns: each entry of the plan is dealt to one row, in its own source."""
    rows = [(i, f"text {i} " * 5, "b" if i % 2 else None, i) for i in range(400)]
    rows += [(7, "the same words", "a", 1000 + i) for i in range(200)] + [(7, "the same words", None, 2000 + i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _h int").repartition(5)
    planned = mixing.plan(docs).collect()
    assert len(planned) == len(rows)
    got = mixing.scheduled_copies(docs)
    assert got.columns == docs.columns
    want = Counter()
    for r in planned:
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = got.collect()
    assert Counter((r["doc_id"], r["source"], len(r["text"].split())) for r in got) == +want
    hot = [r for r in planned if (r["doc_id"], r["source"], r["size"]) == (7, "a", 3)]
    assert sorted(r["number"] for r in hot) == list(range(200)) and {r["repeats"] for r in hot} == {200}
    assert len({r["position"] for r in hot if r["copies"]}) == sum(1 for r in hot if r["copies"])
    # copies of a row are as many as an entry gives: no row gets two entries
    assert (Counter(Counter(r["_h"] for r in got if 1000 <= r["_h"] < 2000).values())
            == Counter(r["copies"] for r in hot if r["copies"]))


def test_mixing_edge_rows(edge_docs):
    rows = mixing.plan(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.plan(edge_docs.limit(0)).count() == 0
    got = mixing.scheduled_copies(edge_docs)
    assert got.columns == edge_docs.columns
    copies = Counter()
    for r in rows:
        copies[r["doc_id"], r["source"], r["size"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"], len(r["text"].split())) for r in got.collect()) == +copies
    assert mixing.scheduled_copies(edge_docs.limit(0)).count() == 0


def test_word_count(spark, texts):
    docs = spark.createDataFrame([*texts, (-1, None), (-2, " \t a\x0bb c ")], "doc_id long, text string")
    want = {i: len(t.encode().split()) if t else 0 for i, t in [*texts, (-1, None), (-2, " \t a\x0bb c ")]}
    assert {r[0]: r[1] for r in docs.select("doc_id", word_count()).collect()} == want


def test_running_sums_over_several_levels(spark, monkeypatch):
    import salesmart.llm.running as running
    monkeypatch.setattr(running, "BUCKET_ROWS", 2)
    monkeypatch.setattr(running, "LEVEL_BITS", 3)
    rows = spark.range(3000).select((F.col("id") % 3 % 2).alias("k"), F.xxhash64("id").alias("h"), "id", (F.col("id") % 7).alias("v"))
    got = with_running(rows, "k", "h", ["id"], {"before": F.col("v"), "place": F.lit(1)}, 3000, Scratch(spark, "t")).collect()
    sums, places = defaultdict(int), defaultdict(int)
    for r in sorted(got, key=lambda r: (r["h"], r["id"])):
        assert (r["before"], r["place"]) == (sums[r["k"]], places[r["k"]])
        sums[r["k"]] += r["v"]
        places[r["k"]] += 1
    assert len(got) == 3000


def test_least_loaded_is_longest_first():
    sizes = [7, 7, 6, 6, 5, 4, 4, 4, 1]
    given = sharding.least_loaded(sizes, 3)
    loads = [0] * 3
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        least = min(range(3), key=lambda s: (loads[s], s))
        assert given[at] == least
        loads[least] += sizes[at]


def test_registered_sharding(spark, sf_dir, texts):
    import zlib
    rows = queries.QUERIES["op7_sharding"](spark, sf_dir).collect()
    of = dict(texts)
    assert len(rows) == len(texts)
    assert all(r["size"] == len(of[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(of[r["doc_id"]].encode()) for r in rows)
    slots, loads, groups = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        groups[of[r["doc_id"]]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    # a shard tops the mean by less than the largest group, as the scheduler promises
    largest = max(sum(r["size"] for r in rows if of[r["doc_id"]] == t) for t in groups)
    assert max(loads.values()) - sum(loads.values()) / 40 <= largest


def test_bundles_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SHARE", 5)
    monkeypatch.setattr(sharding, "BUNDLES", 50)
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'the same' else concat('text ', id) end as text")
    rows = sharding.assign(docs, 4).collect()
    hot = {r["shard"] for r in rows if r["doc_id"] % 3 == 0}
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert len(hot) == 1 and len(rows) == 3000
    rest = [v for s, v in loads.items() if s not in hot]  # the hot group alone is more than an even share
    assert loads[hot.pop()] == 1000 * (len("the same") + 16)
    assert max(rest) - min(rest) < 0.02 * sum(rest)


def test_spread_of_more_groups_than_are_scheduled_one_by_one(spark):
    """30,000 texts and 20,000 places in the list: most are bundled, shards differ by less than an average bundle or so."""
    docs = spark.range(30_000).selectExpr("id as doc_id", "repeat(concat(id, ' '), 1 + cast(pow(id % 100, 2) / 100 as int)) as text")
    rows = sharding.assign(docs, sharding.SHARDS).collect()
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    mean = sum(loads.values()) / sharding.SHARDS
    assert sum(r["size"] * sharding.SHARE * sharding.SHARDS > sum(loads.values()) for r in rows) < 20_000 < len(rows)
    assert len(loads) == sharding.SHARDS and max(loads.values()) - min(loads.values()) < 0.015 * mean


def test_sharding_edge_rows(edge_docs):
    rows = sharding.assign(edge_docs, 3).collect()
    assert len(rows) == edge_docs.count() and all(r["shard"] is not None for r in rows)
    assert sharding.assign(edge_docs.limit(0)).count() == 0
    sharded = sharding.shard_rows(edge_docs, 3)
    assert sharded.columns == [*edge_docs.columns, "_shard"]
    assert sharded.where("_shard is null").count() == 0 and sharded.count() == edge_docs.count()
    assert sharding.shard_rows(edge_docs.limit(0)).count() == 0
