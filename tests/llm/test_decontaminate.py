"""Pigeonhole matches against a full edit-distance table."""

import random

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from salesmart.llm import decontaminate as dc, queries


def least_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=70), st.text("abc ", max_size=120))
def test_bit_vectors_match_the_table(pattern, text):
    distance, end = dc.best_end(dc.masks_of(pattern), len(pattern), text)
    assert distance == least_distance(pattern, text)
    assert distance == len(pattern) or least_distance(pattern[::-1], text[:end][::-1]) == distance


def test_pieces_cover_the_item_and_are_one_more_than_the_budget():
    text = "abcdefghij" * 20
    for budget in range(0, 30):
        pieces = dc.pieces_of(text, budget)
        assert len(pieces) == budget + 1
        assert "".join(text[a:b] for a, b, _ in pieces) == text


@pytest.fixture(scope="module")
def items(sf_dir):
    return duckdb.sql(f"select item_id, text from '{sf_dir}/benchmark.parquet' order by 1 limit 8").fetchall()


def edited(text, edits):
    chars = list(text)
    for _ in range(edits):
        at, what = random.randrange(len(chars)), random.random()
        if what < 0.4:
            chars[at] = random.choice("abcxyz")
        elif what < 0.7:
            del chars[at]
        else:
            chars.insert(at, random.choice("abcxyz"))
    return "".join(chars)


def test_finds_what_the_table_finds(items, texts):
    random.seed(3)
    ready = dc.prepare(items)
    pieces = dc.piece_automaton(ready)
    hits = 0
    for _, text in [t for t in texts if len(t[1]) < 1500][:20]:
        item = random.choice(ready)
        text = f"{text[:300]} {edited(item.text, random.randint(0, int(item.budget * 1.3)))} {text[300:600]}"
        want = {i.item_id: d for i in ready if (d := least_distance(i.text, dc.normalised(text))) <= i.budget}
        assert {i.item_id: d for i, d, _, _ in dc.find_items(text, ready, pieces)} == want
        hits += len(want)
    assert hits > 5


def test_registered_query_finds_exact_passages(spark, sf_dir, texts):
    items = duckdb.sql(f"select item_id, text from '{sf_dir}/benchmark.parquet'").fetchall()
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op1_decontaminate"](spark, sf_dir).collect()}
    assert got >= {(d, i) for d, t in texts for i, x in items if dc.normalised(x) in dc.normalised(t)}


def test_case_marks_and_blanks_do_not_hide_a_passage(spark, items):
    text = "Before. " + items[0][1].upper().replace(" ", "  \n") + "!! after"
    docs = spark.createDataFrame([(1, text, 5), (2, "nothing here", 6), (None, None, 7)], "doc_id long, text string, _clean int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in dc.contaminated(docs, bench).collect()] == [(1, items[0][0], 0)]
    assert sorted(dc.clean(docs, bench).collect(), key=str) == sorted(docs.where("doc_id = 2 or doc_id is null").collect(), key=str)


def test_short_items_need_whole_words(spark):
    docs = spark.createDataFrame([(1, "scattered"), (2, "a cat sat")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "cat"), (2, None), (3, "?!")], "item_id long, text string")
    assert [r["doc_id"] for r in dc.contaminated(docs, bench).collect()] == [2]


@settings(max_examples=300, deadline=None)
@given(st.text("ab ", min_size=8, max_size=34), st.text("ab ", max_size=80))
def test_short_items_have_the_same_budget_as_long_ones(item, text):
    ready = dc.prepare([(1, item)])
    got = {i.item_id: d for i, d, _, _ in dc.find_items(text, ready, dc.piece_automaton(ready))}
    item, text = dc.normalised(item), dc.normalised(text)
    if len(item) < 10:
        assert got == ({1: 0} if item and f" {item} " in f" {text} " else {})
    else:
        distance = least_distance(item, text)
        assert got == ({1: distance} if text and distance <= len(item) // 10 else {})


@pytest.mark.parametrize("size", [9, 10, 31, 32])
def test_one_wrong_letter_at_the_borders_of_the_budget(spark, size):
    item = "which river runs by the old mill"[:size]
    docs = spark.createDataFrame([(1, f"so {item[:4]}q{item[5:]} it said"), (2, f"so {item} it said")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in dc.contaminated(docs, bench).collect()) == ([2] if size < 10 else [1, 2])
    assert [r["doc_id"] for r in dc.contaminated(docs, bench, error_rate=0).collect()] == [2]
    assert [r["doc_id"] for r in dc.clean(docs, bench, error_rate=0).collect()] == [1]


def test_repeated_items_and_item_ids(spark):
    docs = spark.createDataFrame([(1, "a cat sat")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "cat"), (1, "cat"), (1, "sat"), (2, "cat")], "item_id long, text string")
    assert sorted(r["item_id"] for r in dc.contaminated(docs, bench).collect()) == [1, 1, 1, 2]


def test_blocks_of_items_give_the_same(spark, sf_dir, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, dc.contaminated(docs, bench).collect()))
    monkeypatch.setattr(dc, "BLOCK_CHARS", 3000)
    assert len(dc.benchmark_blocks(bench)) > 1
    assert sorted(map(tuple, dc.contaminated(docs, bench).collect())) == want


def test_edge_rows(spark, edge_docs, items):
    bench = spark.createDataFrame([*items, (None, "word"), (99, "")], "item_id long, text string")
    assert {r["doc_id"] for r in dc.contaminated(edge_docs, bench).collect()} == {4}
    assert dc.clean(edge_docs, bench.limit(0)).count() == edge_docs.count()
    assert dc.clean(edge_docs, bench).columns == edge_docs.columns
    assert dc.contaminated(edge_docs.limit(0), bench).count() == 0
