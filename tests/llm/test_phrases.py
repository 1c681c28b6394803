"""op11 against plain counting, against its SQL twin, and with fingerprints cut so short that most collide."""

import re
from collections import Counter

import pytest

from checks.compare import compare, oracle_connection
from salesmart.llm import phrases
from salesmart.llm.queries import ORACLE, QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(docs, max_words=3, least=10, drop=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + m])) for m in range(1, max_words + 1) for i in range(len(words) - m + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    around = Counter()
    for (lang, words), a in found.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                around[lang, words[i:i + m]] = max(a, around[lang, words[i:i + m]])
    rows = []
    for (lang, words), a in found.items():
        if around[lang, words] and 100 * around[lang, words] >= drop * a:
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        rows.append((lang, -score, -a, " ".join(words).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


DOCS = [("en", "New York city, new york CITY. new\tyork  city!" * 4), ("en", "a a a a a a a a a a a a"), (None, "a b. " * 12),
        ("und", "A B a b"), ("en", None), ("en", ""), ("en", " \n\t"), ("fr", "né é né é " * 20), ("en", "\x00 \x1f x\xa0y " * 11),
        ("en", "w" * 50_000 + " tail " + "w" * 50_000 + " tail"), ("de", "x y z x y z " * 15)]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(lang, text, 1, "fp") for lang, text in DOCS], "lang string, text string, block int, phrase string")


def test_equals_plain_counting(small):
    assert got(phrases.collocations(small)) == plain(DOCS)


@pytest.mark.parametrize("bits", [1, 5])
def test_colliding_fingerprints_are_counted_by_their_text(small, bits):
    assert got(phrases.collocations(small, bits=bits)) == plain(DOCS)


def test_more_words_lower_limits_and_few_rows(small):
    assert got(phrases.collocations(small, max_words=5, least=3, drop_percent=80, top=4)) == plain(DOCS, 5, 3, 80, 4)


def test_blocks_and_chunks_of_few_bytes(small, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 16)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 64)
    assert got(phrases.collocations(small)) == plain(DOCS)


def test_a_full_bitmap_costs_rows_only(small, monkeypatch):
    monkeypatch.setattr(phrases, "BITS_PER_ITEM", 0)
    monkeypatch.setattr(phrases, "in_bitmap", lambda bitmap, values: values == values)
    assert got(phrases.collocations(small)) == plain(DOCS)


def test_empty_table_and_texts_without_phrases(spark, small):
    assert got(phrases.collocations(small.limit(0))) == []
    assert got(phrases.collocations(small.where("lang is null and text is null"))) == []
    assert got(phrases.collocations(spark.createDataFrame([(None, None), (None, "one")], "lang string, text string"))) == []


def test_edge_rows(edge_docs):
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert got(phrases.collocations(edge_docs, least=2)) == plain(rows, least=2)


def test_a_hot_phrase_and_repeated_rows(spark):
    docs = [("en", f"the same line\nword{i % 7} the same")for i in range(400)] + [("en", "repeated row here")] * 200
    assert got(phrases.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(8))) == plain(docs)


def test_matches_its_twin(spark, sf_dir):
    ok, message = compare(spark, oracle_connection(sf_dir), "op11_phrases", QUERIES["op11_phrases"], ORACLE["op11_phrases"], sf_dir)
    assert ok, message
