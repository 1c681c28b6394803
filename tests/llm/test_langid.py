"""Language mixtures: held-out accuracy, recovered shares, edge rows."""

import zlib

import duckdb
import numpy as np
import pytest

from salesmart.llm import langid, queries


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return langid.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_registered_query_on_held_out_rows(spark, sf_dir):
    lang = dict(duckdb.sql(f"select doc_id, lang from '{sf_dir}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op9_langid"](spark, sf_dir).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_shares_of_a_mixture(spark, sf_dir, model):
    languages, table = model
    of = {lang: " ".join(r[0] for r in duckdb.sql(
        f"select text from '{sf_dir}/documents.parquet' where lang = '{lang}' order by doc_id limit 5").fetchall())
        for lang in ("de", "en", "fr")}
    text = of["de"][:3000] + " " + of["fr"][:1000]
    share = langid.fit_mixtures(*langid.unit_likelihoods([text, of["en"]], table), 2)
    assert share[0, languages.index("de")] == pytest.approx(0.75, abs=0.1)
    assert share[0, languages.index("fr")] == pytest.approx(0.25, abs=0.1)
    assert share[1].argmax() == languages.index("en")
    assert np.allclose(share.sum(axis=1), 1)


def test_em_matches_a_plain_loop():
    random = np.random.default_rng(0)
    scores = random.normal(size=(30, 3)) * 3
    sizes = random.integers(1, 20, 30).astype(float)
    pi = np.full(3, 1 / 3)
    for _ in range(200):
        new = np.zeros(3)
        for s, w in zip(scores, sizes):
            r = pi * np.exp(s)
            new += w * r / r.sum()
        pi = new / new.sum()
    got = langid.fit_mixtures(np.zeros(30, int), sizes, scores, 1)[0]
    kept = got > 0
    assert got[kept] == pytest.approx(pi[kept] / pi[kept].sum(), abs=0.15)


def test_long_texts_go_in_several_blocks(model, monkeypatch):
    text = "the thing and that other " * 4000
    want = langid.fit_mixtures(*langid.unit_likelihoods([text], model[1]), 1)
    monkeypatch.setattr(langid, "BLOCK_CHARS", 5000)
    assert langid.fit_mixtures(*langid.unit_likelihoods([text], model[1]), 1) == pytest.approx(want, abs=0.01)


def test_edge_rows(edge_docs, model):
    rows = langid.identify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (0, 1, 2, 3)} == dict.fromkeys(range(4), "und")
    assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (4, 5, 6, 7, 8, None))
    kept = langid.keep_identified(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 5
    assert langid.identify(edge_docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark, edge_docs):
    empty = langid.train(edge_docs.limit(0))
    assert empty[0] == []
    assert {r["lang_pred"] for r in langid.identify(edge_docs, empty).collect()} == {"und"}
    assert langid.keep_identified(edge_docs, empty).count() == 0
