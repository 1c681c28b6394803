import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def texts(sf_dir):
    """doc_id and text of the smallest documents table."""
    return duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet' order by doc_id").fetchall()


EDGE_TEXTS = [None, "", "   \n", "!!! ???", "word", "two words", "one two three", "x" * 50_000, "ab " * 20_000]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src", i) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "null id", "en", "src", 0), (3, "!!! ???", "fr", "src", 3), (4, "word", "en", None, 4), (4, "word", "en", None, 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _key int").selectExpr(
        "*", "_key as _place", "_key as _clean", "text as shard", "source as grp", "_key as h")
