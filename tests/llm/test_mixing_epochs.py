"""Every copy of a repeated document has the training time of its own epoch."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from salesmart.llm import mixing

STAGE = dict(corpus_pipeline.STAGES)["mix_sources"]


def plain_due(share, slope):
    """Inverse of t + slope * (t * t - t) by halving."""
    low, high = 0.0, 1.0
    for _ in range(60):
        t = (low + high) / 2
        low, high = (t, high) if t + slope * (t * t - t) < share else (low, t)
    return low


@pytest.fixture(scope="module")
def hot_source(spark):
    """A source of half of all words; the small ones, c the heaviest, are raised to three times their size."""
    rows = [(i, f"{'word ' * 20}{i}", "a" if i < 300 else "b" if i < 330 else "c") for i in range(360)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_places_follow_the_schedule_in_every_epoch(hot_source):
    source = {r["doc_id"]: r["source"] for r in hot_source.collect()}
    streams = defaultdict(list)
    for r in mixing.plan(hot_source).collect():
        streams[source[r["doc_id"]]].append(r)
    assert {len(r["places"]) for r in streams["c"]} == {3}
    for name, slope in (("a", -0.4), ("b", 0.0), ("c", 0.4)):
        start = 0
        for r in sorted(streams[name], key=lambda r: (r["h"], r["doc_id"])):
            starts = [r["source_size"] * e + start for e in range(r["copies"])]
            assert r["places"] == pytest.approx([plain_due(s / r["target"], slope) for s in starts], abs=1e-9)
            start += r["size"]


def test_stage_spreads_repeats_over_training(hot_source):
    rows = [(r["doc_id"], r["source"]) for r in STAGE(hot_source.sparkSession, hot_source, "").collect()]
    planned = {r["doc_id"]: r["places"] for r in mixing.plan(hot_source).collect()}
    due = sorted((t, i) for i, places in planned.items() for t in places)
    assert [i for i, _ in rows] == [i for _, i in due]
    at = [place for place, (_, s) in enumerate(rows) if s == "c"]
    assert Counter(i for i, s in rows if s == "c") == {i: 3 for i in range(330, 360)}
    assert max(at) > 0.9 * len(rows)  # the source is there until the end
    assert all(a[0] != b[0] for a, b in zip(rows, rows[1:]))  # no document twice in a row
