"""Languages of a document as a mixture: expectation-maximisation over n-gram likelihoods.

Each language has a distribution over hashed letter trigrams. A document is a
run of short units (a few words); a unit's likelihood under a language is the
product over its trigrams. EM estimates the language proportions, and the set
of languages shrinks for as long as the penalised likelihood gains by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from salesmart.llm.common import ARROW_ROWS, Scratch, fresh, scan

UNDETERMINED = "und"
# The sample that a language's model is fitted on: so many documents of each language are expected.
SAMPLE_PER_LANGUAGE = 3000
BUCKETS = 1 << 16
SMOOTHING = 0.1
WORDS_PER_UNIT = 4
BLOCK_CHARS = 1 << 20
EM_STEPS, REFIT_STEPS = 8, 4


@cache
def letter_table() -> np.ndarray:
    """Lower-case code point of each letter of the basic plane, a blank for all else."""
    return np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


def normalised(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = letter_table()[np.minimum(codes, 0xFFFF)]
    beyond = np.nonzero(codes > 0xFFFF)[0]
    for at in beyond:
        out[at] = int(codes[at]) if chr(int(codes[at])).isalpha() else 32
    return out


def trigram_buckets(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the letters and the bucket of the trigram around each."""
    padded = np.concatenate([[32], letters, [32]]).astype(np.uint32)
    mixed = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA77) + padded[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    at = np.nonzero(letters != 32)[0]
    return at, ((mixed[at] * np.uint32(0x27D4EB2F)) >> np.uint32(16)).astype(np.int64)


def blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Normalised letters of many texts and the text that each letter is of; long texts go in several blocks."""
    pieces, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, len(text or ""), BLOCK_CHARS):
            piece = text[start:start + BLOCK_CHARS]
            pieces.append((row, piece))
            size += len(piece)
            if size >= BLOCK_CHARS:
                yield _block(pieces)
                pieces, size = [], 0
    if pieces:
        yield _block(pieces)


def _block(pieces: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    letters = normalised(" ".join(piece for _, piece in pieces))
    rows = np.repeat([row for row, _ in pieces], [len(piece) + 1 for _, piece in pieces])[:-1]
    return letters, rows


def unit_likelihoods(texts: list[str | None], model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number of letters and log-likelihood under each language of every unit of the texts."""
    rows, sizes, scores = [], [], []
    for letters, of in blocks(texts):
        at, bucket = trigram_buckets(letters)
        if not len(at):
            continue
        new_word = np.ones(len(at), bool)
        new_word[1:] = np.diff(at) > 1
        new_row = np.ones(len(at), bool)
        new_row[1:] = of[at][1:] != of[at][:-1]
        word = np.cumsum(new_word | new_row) - 1
        first_word = np.maximum.accumulate(np.where(new_row, word, 0))
        group = (word - first_word) // WORDS_PER_UNIT
        starts = np.nonzero(new_row | np.concatenate([[True], group[1:] != group[:-1]]))[0]
        rows.append(of[at[starts]])
        sizes.append(np.diff(np.append(starts, len(at))))
        scores.append(np.add.reduceat(model[bucket], starts, axis=0, dtype=np.float64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros((0, model.shape[1]))
    return np.concatenate(rows), np.concatenate(sizes).astype(float), np.concatenate(scores)


def fit_mixtures(rows: np.ndarray, sizes: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Language proportions of each of ``n`` documents; a document without units has none."""
    many = scores.shape[1]
    shares = np.zeros((n, many))
    if not len(rows):
        return shares
    there, starts = np.unique(rows, return_index=True)
    of = np.searchsorted(there, rows)
    units = np.diff(np.append(starts, len(rows)))
    top = scores.max(axis=1, keepdims=True)
    likely = np.exp(np.maximum(scores - top, -700))
    weight = sizes[:, None]

    def run(start: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(steps):
            joint = start[of] * likely
            joint *= weight / np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
            start = np.add.reduceat(joint, starts, axis=0)
            start /= start.sum(axis=1, keepdims=True)
        mixed = np.log(np.maximum((start[of] * likely).sum(axis=1), 1e-300))
        fit = np.add.reduceat(mixed, starts)
        return start, fit - 0.5 * (start > 0).sum(axis=1) * np.log(units + 1)

    share, value = run(np.full((len(there), many), 1.0 / many), EM_STEPS)
    for _ in range(many - 1):
        tried = share.copy()
        least = np.where(tried > 0, tried, 2.0).argmin(axis=1)
        several = (tried > 0).sum(axis=1) > 1
        tried[np.arange(len(there))[several], least[several]] = 0.0
        tried /= tried.sum(axis=1, keepdims=True)
        tried, gained = run(tried, REFIT_STEPS)
        better = several & (gained >= value)
        if not better.any():
            break
        share[better], value[better] = tried[better], gained[better]
    shares[there] = share
    return shares


def explained(rows: np.ndarray, sizes: np.ndarray, scores: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """True for each document whose mixture makes its trigrams likelier than if all buckets were equally likely.

    Text in a learned language, or in several, is far above that, random letters far below; a document
    without units is not explained.
    """
    fit, letters = np.zeros(len(shares)), np.zeros(len(shares))
    if len(rows):
        top = scores.max(axis=1)
        mixed = (shares[rows] * np.exp(np.maximum(scores - top[:, None], -700))).sum(axis=1)
        np.add.at(fit, rows, top + np.log(np.maximum(mixed, 1e-300)))
        np.add.at(letters, rows, sizes)
    return (letters > 0) & (fit > -np.log(BUCKETS) * letters)


def in_test(every: int = 5):
    """True for the rows that are held out: crc32 of doc_id as text leaves no remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their log-probabilities by trigram bucket.

    Fitted on rows with text and lang that are not held out: about ``sample``
    documents of each language, chosen by a hash of doc_id against the
    language's share. The model has ``BUCKETS`` numbers for each language.
    """
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                          & ~in_test()).select("doc_id", "lang", "text")
    shares = labelled.groupBy(F.col("lang").alias("of")).agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    shares = Scratch(docs.sparkSession, "langid").keep(shares, "shares")  # its size known, texts are not shuffled for it
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.join(shares, F.col("lang") == F.col("of")).where(place < F.col("share")).select("lang", "text")

    def count(columns: dict[str, list]) -> dict[str, list]:
        out = {"lang": [], "bucket": [], "n": []}
        for lang in sorted(set(columns["lang"])):
            total = np.zeros(BUCKETS, np.int64)
            for letters, _ in blocks([t for of, t in zip(columns["lang"], columns["text"], strict=True) if of == lang]):
                total += np.bincount(trigram_buckets(letters)[1], minlength=BUCKETS)
            seen = np.nonzero(total)[0]
            out["lang"] += [lang] * len(seen)
            out["bucket"] += seen.tolist()
            out["n"] += total[seen].tolist()
        return out

    counts = scan(chosen, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = sorted(found["lang"].unique().tolist())
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    column = {lang: i for i, lang in enumerate(languages)}
    table[found["bucket"], found["lang"].map(column)] += found["n"]
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages of every row, from its text alone.

    score is the share of the document in its main language, languages lists
    all shares. Null texts, texts without a letter and any text under an empty
    model are ``und`` with score 0. One row in, one row out; ties go to the
    language first in code-point order; an empty table gives none.
    """
    languages, table = model

    def work(columns: dict[str, list]) -> dict[str, list]:
        texts = columns["text"]
        shares = fit_mixtures(*unit_likelihoods(texts, table), len(texts)) if languages else np.zeros((len(texts), 1))
        best = shares.argmax(axis=1)
        score = np.minimum(shares.max(axis=1), 1.0)
        known = score > 0
        listed = [",".join(f"{languages[j]}:{share[j]:.4f}" for j in np.argsort(-share, kind="stable") if share[j] > 0)
                  if ok else "" for share, ok in zip(shares, known, strict=True)]
        return {"doc_id": columns["doc_id"], "held_out": columns["held_out"],
                "lang_pred": [languages[b] if ok else UNDETERMINED for b, ok in zip(best, known, strict=True)],
                "score": score.tolist(), "languages": listed}

    return scan(docs.select("doc_id", in_test().alias("held_out"), "text"), work,
                "doc_id long, held_out boolean, lang_pred string, score double, languages string")


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray], likely: bool = False) -> DataFrame:
    """The rows of ``docs`` that have a language; the text is judged where it is, so rows need no key and no join.

    Rejected are null texts, texts without a letter, and all rows under an empty model; with ``likely`` also texts that
    their own mixture of languages explains no better than chance (see ``explained``). Mixed languages are kept.
    """
    languages, table = model
    (flag,) = fresh(docs, "_identified")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    @F.pandas_udf("boolean")
    def identified(texts: pd.Series) -> pd.Series:
        own = texts.tolist()
        if not languages:
            return pd.Series([False] * len(own), dtype=bool)
        units = unit_likelihoods(own, table)
        shares = fit_mixtures(*units, len(own))
        return pd.Series(explained(*units, shares) if likely else shares.max(axis=1) > 0, dtype=bool)

    return docs.withColumn(flag, identified("text")).where(F.col(flag)).select(*docs.columns)
