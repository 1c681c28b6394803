"""Katz backoff over word pairs: Good-Turing discounts, exactly normalised backoff weights, scores of all documents.

Words are known by 64-bit hashes. The corpus is read twice: once for word
counts, once to send each occurrence (context, word, document) to the bucket
of its word, where pairs are counted and looked up in one place. Frequent
words are spread over all buckets by pair. What a bucket can't know (the
backoff weight of a context) is needed only for pairs that training has not
seen; those few meet the table of contexts in a join.

A text's score is, with c the counts and d the discounts,

    sum over pairs seen in training of   log d(c(u, w)) + log c(u, w) - log c(u)
    sum over all others of               log backoff(u) + log p(w)

where the first term's ``- log c(u)`` is taken once for each token as a
context, and given back for the pairs that turn out unseen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import Scratch, arrow_schema, give_back

# Counts up to DISCOUNTED are discounted by Good-Turing; greater ones give up LARGE_GIVES of one occurrence.
DISCOUNTED, LARGE_GIVES = 5, 0.01
# Tokens and documents that a task packs together, tokens that a bucket aims at, frequent words at most.
CHUNK_TOKENS, CHUNK_DOCS, BUCKET_TOKENS, MOST_FREQUENT = 3_000_000, 16_384, 2_000_000, 100_000
# A bucket is counted in so many passes over its words, one after the other, to keep its task small.
PASSES = 4
PIECE = 1 << 14
# Rows handed to a task at once: those of a bucket are large.
ROWS_AT_ONCE = 64
HELD_OUT_EVERY, HELD_OUT_IS = 7, 2
# What stands for the start and the end of a text; no word holds a blank.
START = int(np.uint64(xxhash.xxh64_intdigest(b" start")).astype(np.int64))
END = int(np.uint64(xxhash.xxh64_intdigest(b" end")).astype(np.int64))

OCCURRENCES = ("bucket int, chunk long, words array<long>, runs array<int>, contexts array<long>, packed binary, "
               "doc_ids array<long>, held array<boolean>, tokens array<long>")
COUNTED = ("kind string, bucket int, chunk long, longs array<long>, more_longs array<long>, counts array<long>, "
           "base array<double>, part array<double>")


class Vocabulary(dict):
    """Local numbers of words, given as they are first seen; 0 and 1 are the start and the end."""

    def __init__(self):
        super().__init__()
        self.hashes = [START, END]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        value = xxhash.xxh64_intdigest(word)
        self.hashes.append(value - (1 << 64) if value >> 63 else value)
        return number


class Model(NamedTuple):
    """What a bucket needs besides its own occurrences."""
    tokens: int
    words: int
    texts: int
    discounts: list[float]
    unknown: float
    frequent: np.ndarray
    frequent_counts: np.ndarray
    buckets: int


def held_out(doc_id: str = "doc_id") -> Column:
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_EVERY
    return F.coalesce(rest == HELD_OUT_IS, F.lit(False))


def good_turing(of_count: list[int]) -> list[float]:
    """Katz' discount for counts 1 to DISCOUNTED from the numbers of items with counts 1 to DISCOUNTED + 1.

    A discount outside (0, 1), as small or odd data give, is replaced by giving up half an occurrence.
    """
    n = [0, *of_count]
    last = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, DISCOUNTED + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last) if n[r] and last != 1 else 0.0
        out.append(value if 0 < value < 1 else (r - 0.5) / r)
    return out


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, trained, all) of a chunk of texts, again and again."""
    vocabulary, held, free, size = Vocabulary(), [], [], 0

    def flush() -> pa.RecordBatch:
        counts = [np.bincount(np.concatenate(part) if part else np.zeros(0, np.int64), minlength=len(vocabulary.hashes))
                  for part in (free, held)]
        return pa.RecordBatch.from_pydict({"word": np.array(vocabulary.hashes[1:], np.int64),
                                           "trained": counts[0][1:], "all": (counts[0] + counts[1])[1:]})

    for batch in batches:
        for is_held, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            numbers = np.fromiter(map(vocabulary.__getitem__, _words(text)), np.int32)
            (held if is_held else free).append(np.append(numbers, np.int32(1)))
            size += len(numbers) + 1
        if size >= CHUNK_TOKENS:
            yield flush()
            vocabulary, held, free, size = Vocabulary(), [], [], 0
    if size:
        yield flush()
    del vocabulary, held, free
    give_back()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def bucket_of(names: np.ndarray, word: np.ndarray, context: np.ndarray, model: Model) -> np.ndarray:
    """Bucket of each occurrence of local words: by word, and by pair where the word is frequent."""
    keys, many = _mixed(names), np.uint64(model.buckets)
    out = (keys % many).astype(np.int32)[word]
    often = np.flatnonzero(np.isin(names, model.frequent)[word])
    out[often] = ((keys[word[often]] ^ _mixed(keys.view(np.int64))[context[often]]) % many).astype(np.int32)
    return out


def _packed(values: np.ndarray) -> bytes:
    """Bytes of equal significance together, which compress better."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(dtype)


def _send(model: Model):
    schema = arrow_schema(OCCURRENCES)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, flushed = TaskContext.get().partitionId(), 0

        def flush(vocabulary: Vocabulary, texts: list[np.ndarray], ids: list, held: list) -> Iterator[pa.RecordBatch]:
            chunk = (partition << 40) | (flushed << 20)
            names = np.array(vocabulary.hashes, np.int64)
            sizes = np.array([len(t) + 1 for t in texts])
            many = len(texts)
            flat = np.concatenate([part for t in texts for part in (t, np.ones(1, np.int32))])
            before = np.concatenate([part for t in texts for part in (np.zeros(1, np.int32), t)])
            doc = np.repeat((np.arange(many) * 2 + np.array(held)).astype(np.uint16), sizes)
            texts.clear()
            bucket = bucket_of(names, flat, before, model)
            order = (bucket.astype(np.int64) * len(names) + flat) * len(names) + before
            order = np.argsort(order)
            flat, before, doc, bucket = flat[order], before[order], doc[order], bucket[order]
            del order
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for start, end in zip(np.append(0, cuts), np.append(cuts, len(flat))):
                words, runs = np.unique(flat[start:end], return_counts=True)
                contexts, at = np.unique(before[start:end], return_inverse=True)
                packed = zstandard.compress(_packed(at.astype("<u4")) + _packed(doc[start:end]), 3)
                yield pa.RecordBatch.from_pylist([{
                    "bucket": int(bucket[start]), "chunk": chunk, "words": names[words], "runs": runs,
                    "contexts": names[contexts], "packed": packed}], schema=schema)
            yield pa.RecordBatch.from_pylist([{
                "bucket": int(chunk % 1_000_003 % model.buckets), "chunk": chunk, "doc_ids": ids, "held": held,
                "tokens": sizes.tolist()}], schema=schema)

        vocabulary, texts, ids, held, size = Vocabulary(), [], [], [], 0
        for batch in batches:
            for doc_id, is_held, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                texts.append(np.fromiter(map(vocabulary.__getitem__, _words(text)), np.int32))
                ids.append(doc_id)
                held.append(is_held)
                size += len(texts[-1]) + 1
                if size >= CHUNK_TOKENS or len(texts) >= CHUNK_DOCS:
                    yield from flush(vocabulary, texts, ids, held)
                    flushed += 1
                    vocabulary, texts, ids, held, size = Vocabulary(), [], [], [], 0
        if texts:
            yield from flush(vocabulary, texts, ids, held)
        del vocabulary, texts
        give_back()
    return send


def _count_bucket(model: Model):
    """Counts the pairs of a bucket, and looks each occurrence of it up."""
    schema = arrow_schema(COUNTED)

    def count(rows: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        put = lambda row: out.append(pa.RecordBatch.from_pylist([row], schema=schema))  # noqa: E731  small batches
        bucket = rows.column("bucket")[0].as_py()
        chunks, parts = [], []
        for at in range(rows.num_rows):
            row = {name: rows.column(name)[at] for name in rows.column_names}
            chunk = row["chunk"].as_py()
            if row["doc_ids"].is_valid:
                put({"kind": "text", "bucket": bucket, "chunk": chunk, "longs": row["doc_ids"].as_py(),
                     "more_longs": row["tokens"].values.to_numpy(), "counts": [int(h) for h in row["held"].as_py()]})
            else:
                parts.append([row[name].values.to_numpy() for name in ("words", "runs", "contexts")] + [row["packed"].as_py()])
                chunks.append(chunk)
        if chunks:
            for found in _looked_up(model, chunks, parts):
                put(found | {"bucket": bucket})
        del chunks, parts
        give_back()
        return pa.Table.from_batches(out, schema=schema)
    return count


def _unpack(parts: list[list]) -> tuple[np.ndarray, ...]:
    """Words and contexts of a bucket, and for each occurrence its place in both and its document.

    A document is the number of its part, then its number in the chunk, then
    whether it is held out. Occurrences are 32-bit numbers, as they are many.
    """
    names, before = (np.unique(np.concatenate([part[i] for part in parts])) for i in (0, 2))
    word_at, context_at, docs = [], [], []
    kind = np.int32 if len(parts) < 1 << 15 else np.int64
    for number, (words, runs, contexts, packed) in enumerate(parts):
        data = zstandard.decompress(packed)
        many = len(data) // 6
        word_at.append(np.repeat(np.searchsorted(names, words).astype(np.int32), runs))
        context_at.append(np.searchsorted(before, contexts).astype(np.int32)[_unpacked(data[:4 * many], "<u4")])
        docs.append(_unpacked(data[4 * many:], "<u2").astype(kind) + kind(number << 16))
    return names, before, np.concatenate(word_at), np.concatenate(context_at), np.concatenate(docs)


def _looked_up(model: Model, chunks: list[int], parts: list[list]) -> Iterator[dict]:
    """The rows of a bucket: what it adds to each document, unseen pairs, pairs with counts, counts of counts."""
    names, before, word_at, context_at, doc = _unpack(parts)
    docs = np.unique(doc)
    base, part = np.zeros(len(docs)), np.zeros(len(docs))
    counts = np.zeros((DISCOUNTED + 1, len(docs)), np.int64)
    of_count = np.zeros(DISCOUNTED + 1, np.int64)
    turn = ((_mixed(names) >> np.uint64(40)) % np.uint64(PASSES)).astype(np.int8)
    for number in range(PASSES):
        at = np.flatnonzero((turn == number)[word_at])
        if not len(at):
            continue
        word, context, own = word_at[at], context_at[at], doc[at]
        trained = (own & 1) == 0
        pair_at = word.astype(np.int64) * len(before) + context
        pairs = np.unique(pair_at)
        pair_at = np.searchsorted(pairs, pair_at).astype(np.int32)
        pair_count = np.bincount(pair_at[trained], minlength=len(pairs))
        count = np.bincount(word[trained], minlength=len(names))
        if len(model.frequent):
            place = np.minimum(np.searchsorted(model.frequent, names), len(model.frequent) - 1)
            count = np.where(model.frequent[place] == names, model.frequent_counts[place], count)
        to = np.searchsorted(docs, own).astype(np.int32)
        base += np.bincount(to, np.log10(count + 1.0)[word], len(docs))
        log_p = np.log10(np.maximum(unigram(count, model), 1e-300))
        log_pair = np.log10(np.where(pair_count > DISCOUNTED, pair_count - LARGE_GIVES, np.maximum(pair_count, 1)))
        as_context = np.where(names == END, 0.0, np.log10(np.maximum(count, 1)))
        seen = (pair_count > 0)[pair_at]
        part += np.bincount(to, np.where(seen, log_pair[pair_at], log_p[word]) - as_context[word], len(docs))
        small = np.minimum(pair_count, DISCOUNTED + 1).astype(np.int8)[pair_at]
        counts[0] += np.bincount(to[(count > 0)[word]], minlength=len(docs))
        for r in range(1, DISCOUNTED + 1):
            counts[r] += np.bincount(to[small == r], minlength=len(docs))
        unseen = np.flatnonzero(~seen)
        text = np.array(chunks, np.int64)[own[unseen] >> 16] + ((own[unseen] & 0xFFFF) >> 1)
        for start in range(0, len(unseen), PIECE):
            some = slice(start, start + PIECE)
            yield {"kind": "unseen", "longs": before[context[unseen[some]]], "more_longs": text[some]}
        stored = np.flatnonzero(pair_count)
        for start in range(0, len(stored), PIECE):
            some = stored[start:start + PIECE]
            of_word = pairs[some] // len(before)
            yield {"kind": "pair", "longs": before[pairs[some] % len(before)], "more_longs": names[of_word],
                   "counts": np.stack([pair_count[some], count[of_word]], 1).reshape(-1)}
        of_count += np.bincount(np.minimum(pair_count[stored], DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1:DISCOUNTED + 2]
    yield {"kind": "of_count", "counts": of_count}
    for number in np.unique(docs >> 16):
        mine = (docs >> 16) == number
        yield {"kind": "part", "chunk": chunks[number], "longs": (docs[mine] & 0xFFFF) >> 1,
               "counts": counts[:, mine].T.reshape(-1), "base": base[mine], "part": part[mine]}


def unigram(count: np.ndarray, model: Model) -> np.ndarray:
    """Discounted probability of words with these counts; a word never seen has all of the mass given up."""
    rate = np.append(np.append(0.0, model.discounts), 1.0)[np.minimum(count, DISCOUNTED + 1)]
    given = np.where(count > DISCOUNTED, count - LARGE_GIVES, count * rate)
    return np.where(count > 0, given / max(1, model.tokens), model.unknown)


def _unigram_column(count: Column, model: Model) -> Column:
    given = count - LARGE_GIVES
    for r, rate in enumerate(model.discounts, 1):
        given = F.when(count == r, r * rate).otherwise(given)
    return given / float(max(1, model.tokens))


def fit_words(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, Model]:
    """The table of words (word hash, trained, all) and the numbers that the second reading needs."""
    counted = docs.mapInArrow(_count_words, "word long, trained long, all long")
    words = scratch.keep(counted.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("all").alias("all")), "words")
    of = [F.count(F.when(F.col("trained") == r, 1)) for r in range(1, DISCOUNTED + 2)]
    total, everything, known, large, texts, *of_count = words.agg(
        F.sum("trained"), F.sum("all"), F.count(F.when(F.col("trained") > 0, 1)),
        F.count(F.when(F.col("trained") > DISCOUNTED, 1)), F.sum(F.when(F.col("word") == END, F.col("trained"))), *of).first()
    total, everything = total or 0, everything or 0
    discounts = good_turing(of_count)
    given_up = sum((1 - d) * r * n for r, (d, n) in enumerate(zip(discounts, of_count), 1)) + LARGE_GIVES * large
    buckets = max(1, math.ceil(everything / BUCKET_TOKENS))
    least = max(everything / (4 * buckets), everything / MOST_FREQUENT)
    often = words.where((F.col("all") > least) | (F.col("word") == END)).select("word", "trained").collect()
    often = sorted(tuple(r) for r in often)  # fewer than MOST_FREQUENT + 1 by their share
    return words, Model(total, known, texts or 0, discounts, given_up / total if total else 1.0,
                        np.array([w for w, _ in often], np.int64), np.array([n for _, n in often], np.int64), buckets)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Learns from the rows that are not held out. score is the base-10 log of
    the model's probability of the text with its end; base_score is that of
    add-one smoothed words. Null, empty and wordless texts are an end alone;
    a null doc_id is trained on; repeated rows count and are scored each; an
    empty table gives none. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "katz")
    narrow = docs.select("doc_id", held_out().alias("held"), F.col("text").cast("binary").alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    words, model = fit_words(narrow, scratch)
    sent = narrow.mapInArrow(_send(model), OCCURRENCES)
    counted = scratch.keep(sent.groupBy("bucket").applyInArrow(_count_bucket(model), COUNTED), "counted", by="kind",
                           **{"parquet.block.size": 16 << 20})  # rows are large arrays: small row groups, small buffers
    of_kind = lambda kind: counted.where(F.col("kind") == kind)
    totals = of_kind("of_count").agg(*[F.sum(F.element_at("counts", r)) for r in range(1, DISCOUNTED + 2)]).first()
    discounts = good_turing([n or 0 for n in totals])

    pair = F.explode(F.transform("longs", lambda x, i: F.struct(
        x.alias("context"), F.get("counts", 2 * i).alias("n"), F.get("counts", 2 * i + 1).alias("of_word"))))
    n = F.col("pair.n")
    left = F.lit(LARGE_GIVES)
    for r, rate in enumerate(discounts, 1):
        left = F.when(n == r, r * (1 - rate)).otherwise(left)
    contexts = (of_kind("pair").select(pair.alias("pair"))
                .groupBy("pair.context").agg(F.sum(n).alias("total"), F.sum(left).alias("left"),
                                             F.sum(_unigram_column(F.col("pair.of_word"), model)).alias("below")))
    weight = F.col("left") / F.col("total") / (1.0 - F.col("below"))
    contexts = scratch.keep(contexts.select("context", "total", F.log10(weight).alias("log_backoff")), "contexts")

    event = F.explode(F.arrays_zip("longs", "more_longs")).alias("e")
    events = of_kind("unseen").select(event).select(F.col("e.longs").alias("context"), F.col("e.more_longs").alias("at"))
    backed = (events.join(contexts, "context").groupBy("at")
              .agg(F.sum(F.col("log_backoff") + F.log10("total")).alias("backed")))
    parts = counted.where(F.col("kind").isin("part", "text")).groupBy("chunk").applyInArrow(_gather, GATHERED)
    rows = parts.join(backed, "at", "left")
    discounted = sum((F.col(f"r{r}") * math.log10(rate) for r, rate in enumerate(discounts, 1)), F.lit(0.0))
    start = math.log10(model.texts) if model.texts else 0.0
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(model.tokens + model.words + 1)).alias("base_score"),
        (F.col("part") + discounted + F.coalesce("backed", F.lit(0.0)) - start).alias("score"))


GATHERED = ("at long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, part double, "
            + ", ".join(f"r{r} long" for r in range(1, DISCOUNTED + 1)))


def _gather(rows: pa.Table) -> pa.Table:
    """Sums what the buckets found for each document of a chunk."""
    chunk, texts, at, base, part, counts = rows.column("chunk")[0].as_py(), None, [], [], [], []
    for row in rows.to_pylist():
        if row["kind"] == "text":
            texts = row
        else:
            for kept, name in ((at, "longs"), (base, "base"), (part, "part"), (counts, "counts")):
                kept.append(np.array(row[name]))
    many = len(texts["longs"])
    at = np.concatenate(at)
    counts = np.concatenate(counts).reshape(len(at), -1)
    summed = [np.bincount(at, counts[:, i], many).astype(np.int64) for i in range(counts.shape[1])]
    return pa.table({
        "at": np.arange(many) + chunk, "doc_id": pa.array(texts["longs"], pa.int64()),
        "held_out": pa.array([h == 1 for h in texts["counts"]]), "n_tokens": pa.array(texts["more_longs"], pa.int64()),
        "n_known": summed[0], "base": np.bincount(at, np.concatenate(base), many),
        "part": np.bincount(at, np.concatenate(part), many), **{f"r{r}": summed[r] for r in range(1, DISCOUNTED + 1)}})
