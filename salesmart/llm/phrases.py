"""Phrase collocations: Rabin-Karp fingerprints of every n-gram, counted by shuffle, verified against the text.

Texts are first written as blocks of canonical bytes (words behind one blank,
pieces behind one line feed), so that an occurrence has a lasting pointer:
block and word. Each level n then scans the blocks: prefix polynomials give
the fingerprints of all n-grams whose two (n-1)-grams are frequent, a task
adds up what it has seen, and a shuffle adds up fingerprints and keeps the
least pointer. Which (n-1)-grams are frequent is told by a bitmap of bounded
size; a false hit costs a row, never a wrong count.

A fingerprint is checked by a second, independent one. Where occurrences of
one fingerprint disagree in it, they are counted again by their text. Only
phrases that are frequent are ever made into strings, from their pointers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from salesmart.llm.common import Scratch, arrow_schema, arrow_rows, give_back

MAX_WORDS, LEAST_COUNT, DROP_PERCENT, TOP = 3, 10, 50, 2000
SCALE = 1_000_000
# Bytes of a block of text and of what a task counts together.
BLOCK_BYTES, CHUNK_BYTES = 1 << 18, 8 << 20
# Documents and blocks that a task is handed at once.
DOCS_AT_ONCE, BLOCKS_AT_ONCE = 256, 16
# Bits of a pointer for a block's number within its task and for a word within its block; the task has the rest.
ORDINAL_BITS, WORD_BITS = 15, 28
# Bits of a bitmap for each frequent n-gram, and the most in all (16 MiB): beyond it more n-grams are counted in vain.
BITS_PER_ITEM, MOST_BITS = 16, 1 << 27
# Parts of a language that are cut to their first rows before the language as a whole is.
TOP_PARTS = 64
# Separators of pieces (.,;:!? and line ends) become line feeds, tabs blanks, A-Z a-z.
CANONICAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
# Primes below 2 ** 31 and bases of the byte polynomials, odd multipliers of the word polynomials; two of each per fingerprint.
PRIMES = ((2147483647, 2147483629), (2147483587, 2147483579))
BASES = ((1000003, 998244353), (1664525, 22695477))
STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

BLOCKS = "block long, lang string, words long, data binary"
COUNTED = "fp long, sign long, at long, n long"


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Canonical blocks of (lang, text) rows; a block holds whole pieces of one language."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    ordinal = TaskContext.get().partitionId() << ORDINAL_BITS
    first = ordinal

    def close(lang: str) -> pa.RecordBatch | None:
        nonlocal ordinal
        data = np.frombuffer(b"\n" + b"\n".join(held.pop(lang)).translate(CANONICAL), np.uint8).copy()
        del sizes[lang]
        lines = data == 10
        word = ~(lines | (data == 32))
        starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        if not len(starts):
            return None
        piece = np.cumsum(lines, dtype=np.int32)[starts]
        data[starts - 1] = np.where(np.diff(piece, prepend=-1) != 0, 10, 32)
        word[starts - 1] = True
        row = {"block": [ordinal], "lang": [lang], "words": [len(starts)], "data": [data[word].tobytes()]}
        ordinal += 1
        if ordinal - first >> ORDINAL_BITS or len(starts) >> WORD_BITS:
            raise ValueError("too many blocks in a task or words in a block: use more partitions")
        return pa.RecordBatch.from_pydict(row, schema)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= BLOCK_BYTES and (made := close(lang)):
                yield made
        if sum(sizes.values()) >= CHUNK_BYTES:  # many languages, none of them large
            yield from filter(None, map(close, list(held)))
    yield from filter(None, map(close, list(held)))
    give_back()


def to_blocks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    schema = arrow_schema(BLOCKS)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    with arrow_rows(docs.sparkSession, DOCS_AT_ONCE):
        return scratch.keep(rows.mapInArrow(lambda batches: _blocks(batches, schema), BLOCKS), "blocks",
                            **{"parquet.block.size": 16 << 20})


class Powers:
    """Powers of the bases and of their inverses, as far as a text so far has needed them."""

    def __init__(self):
        self.size, self.up, self.down = 0, {}, {}

    def reach(self, size: int) -> None:
        if size <= self.size:
            return
        self.size = max(size, 2 * self.size, 1 << 16)
        for p, b in zip(sum(PRIMES, ()), sum(BASES, ()), strict=True):
            for table, base in ((self.up, b), (self.down, pow(b, -1, p))):
                out = np.ones(self.size, np.uint64)
                done = 1
                while done < self.size:
                    more = min(done, self.size - done)
                    out[done:done + more] = out[:more] * np.uint64(pow(base, done, p)) % np.uint64(p)
                    done += more
                table[p] = out


def byte_fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers, which: int) -> np.ndarray:
    """62-bit fingerprints of the byte ranges, from one prefix polynomial for each of two primes."""
    powers.reach(len(data) + 1)
    value = np.zeros(len(starts), np.uint64)
    for p in PRIMES[which]:
        prime = np.uint64(p)
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[p][:len(data)] % prime, out=prefix[1:])
        part = (prefix[ends] - prefix[starts]) % prime * powers.down[p][starts] % prime
        value = (value << np.uint64(31)) | part
    return value


def mixed(values: np.ndarray) -> np.ndarray:
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def gram_fingerprints(symbols: np.ndarray, lang: int, n: int, which: int) -> np.ndarray:
    """Fingerprint of every run of ``n`` symbols behind the language's own symbol, from one prefix polynomial mod 2 ** 64."""
    step = STEPS[which]
    back = pow(step, -1, 1 << 64)
    many = len(symbols)
    powers, inverse = np.ones(many + 1, np.uint64), np.ones(many + 1, np.uint64)
    np.multiply.accumulate(np.full(many, step, np.uint64), out=powers[1:])
    np.multiply.accumulate(np.full(many, back, np.uint64), out=inverse[1:])
    prefix = np.zeros(many + 1, np.uint64)
    np.cumsum(symbols * powers[:many], out=prefix[1:])
    runs = (prefix[n:] - prefix[:many + 1 - n]) * inverse[:many + 1 - n]
    return mixed(runs * np.uint64(step) + np.uint64(lang))


class Chunk:
    """The words of several blocks of one language, with exact numbers for words and n-grams."""

    def __init__(self, lang: str, blocks: list[tuple[int, bytes]], powers: Powers):
        self.data = np.frombuffer(b"".join(data for _, data in blocks) + b"\n", np.uint8)
        self.gaps = np.flatnonzero((self.data == 32) | (self.data == 10)).astype(np.int32)
        many = np.array([data.count(b" ") + data.count(b"\n") for _, data in blocks])
        first = np.cumsum(many) - many
        self.at = (np.repeat(np.array([b for b, _ in blocks], np.int64) << WORD_BITS, many)
                   + np.arange(len(self.gaps) - 1) - np.repeat(first, many))
        self.joined = self.data[self.gaps[:-1]] == 32  # in one piece with the word before
        flat = self.data.copy()
        flat[self.gaps] = 32
        words = pa.BinaryArray.from_buffers(pa.binary(), len(self.gaps) - 1, [None, pa.py_buffer(self.gaps), pa.py_buffer(flat)])
        coded = words.dictionary_encode()
        self.word = coded.indices.to_numpy().astype(np.int64)
        self.distinct = len(coded.dictionary)
        _, offsets, buffer = coded.dictionary.buffers()
        ends = np.frombuffer(offsets, np.int32)[:self.distinct + 1].astype(np.int64)
        known = np.frombuffer(buffer, np.uint8)[:ends[-1]]
        self.symbols = [mixed(byte_fingerprints(known, ends[:-1], ends[1:], powers, which)) for which in (0, 1)]
        name = np.frombuffer(lang.encode() + b"\n", np.uint8)
        self.lang = [int(byte_fingerprints(name, np.zeros(1, np.int64), np.array([len(name)]), powers, which)[0]) for which in (0, 1)]

    def fingerprints(self, n: int, which: int) -> np.ndarray:
        return gram_fingerprints(self.symbols[which][self.word], self.lang[which], n, which)

    def starts(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each place lie in one piece."""
        ok = np.ones(max(0, len(self.word) - n + 1), bool)
        for k in range(1, n):
            ok &= self.joined[k:len(self.word) - n + 1 + k]
        return ok

    def distinct_grams(self, n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and count of each different n-gram among the places ``at``; exact, by word numbers."""
        code = self.word[at]
        for k in range(1, n):
            code = code * self.distinct + self.word[at + k]
            if k < n - 1:
                code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        _, first, count = np.unique(code, return_index=True, return_counts=True)
        return at[first], count

    def texts(self, n: int, at: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip((self.gaps[at] + 1).tolist(), self.gaps[at + n].tolist(), strict=True)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, bytes]]]]:
    """Blocks, several of a language together as far as a chunk's bytes go."""
    held: dict[str, list[tuple[int, bytes]]] = {}
    size = 0
    for batch in batches:
        for block, lang, data in zip(*(batch.column(c).to_pylist() for c in ("block", "lang", "data")), strict=True):
            held.setdefault(lang, []).append((block, data))
            size += len(data)
            if size >= CHUNK_BYTES:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _kept(values: np.ndarray, bits: int) -> np.ndarray:
    return values if bits >= 64 else values & np.uint64((1 << bits) - 1)


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values % np.uint64(len(bitmap) * 8)
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _scan(n: int, below: np.ndarray | None, bits: int, wanted: np.ndarray | None, schema: pa.Schema) -> Callable:
    """Counts of the n-grams of a chunk, by fingerprint, or by text as well for those in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for lang, blocks in _chunks(batches):
            chunk = Chunk(lang, blocks, powers)
            ok = chunk.starts(n)
            if below is not None and len(ok):
                often = in_bitmap(below, _kept(chunk.fingerprints(n - 1, 0), bits))
                ok &= often[:-1] & often[1:]
            at, count = chunk.distinct_grams(n, np.flatnonzero(ok))
            fp = _kept(chunk.fingerprints(n, 0)[at], bits) if len(at) else np.zeros(0, np.uint64)
            if wanted is None:
                sign = chunk.fingerprints(n, 1)[at] if len(at) else fp
                yield pa.RecordBatch.from_arrays([fp.view(np.int64), sign.view(np.int64), chunk.at[at], count.astype(np.int64)],
                                                 schema=schema)
            else:
                hit = in_bitmap(wanted, fp)
                yield pa.RecordBatch.from_pydict({"fp": fp[hit].view(np.int64), "lang": [lang] * int(hit.sum()),
                                                  "phrase": chunk.texts(n, at[hit]), "n": count[hit].astype(np.int64)}, schema)
        del powers
        give_back()

    return run


def bitmap_of(frequent: DataFrame, rows: int) -> np.ndarray:
    """A bitmap of the column ``fp``, made by Spark in buckets; its size follows ``rows`` up to ``MOST_BITS``."""
    bits = 1 << 18
    while bits < min(rows * BITS_PER_ITEM, MOST_BITS):
        bits <<= 1
    place = F.col("fp").bitwiseAND(bits - 1) + 1
    parts = (frequent.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("part")).collect())
    whole = np.zeros(bits >> 3, np.uint8)
    for row in parts:
        part = np.frombuffer(row["part"], np.uint8)
        start = (row["bucket"] - 1) * len(part)
        whole[start:start + len(part)] = part[:len(whole) - start]
    return whole


def _frequent(counted: DataFrame, least: int) -> DataFrame:
    return (counted.groupBy("fp").agg(F.sum("n").alias("n"), F.min("at").alias("at"), F.min("sign").alias("low"),
                                      F.max("sign").alias("high")).where(F.col("n") >= least))


def _texts_at(schema: pa.Schema) -> Callable:
    """Phrases at the pointers of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                gaps = np.frombuffer(row["data"] + b"\n", np.uint8)
                gaps = np.flatnonzero((gaps == 32) | (gaps == 10))
                out = {"lang": [], "words": [], "phrase": [], "a": []}
                for mark in row["marks"]:
                    word, n = mark["word"], mark["words"]
                    out["phrase"].append(row["data"][gaps[word] + 1:gaps[word + n]])
                    out["words"].append(n)
                    out["a"].append(mark["n"])
                out["lang"] = [row["lang"]] * len(out["a"])
                yield pa.RecordBatch.from_pydict(out, schema)

    return run


def frequent_phrases(docs: DataFrame, scratch: Scratch, max_words: int = MAX_WORDS, least: int = LEAST_COUNT,
                     bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, a) of every phrase of up to ``max_words`` words that occurs ``least`` times, and (lang, n) of all words.

    ``bits`` cuts the fingerprints (not their check): collisions then abound and are resolved, with the same result.
    """
    spark = docs.sparkSession
    blocks = to_blocks(docs, scratch)
    totals = blocks.groupBy("lang").agg(F.sum("words").alias("n"))
    by_text_ddl, found_ddl = "fp long, lang string, phrase binary, n long", "lang string, words int, phrase binary, a long"
    marks, resolved, below = None, None, None
    with arrow_rows(spark, BLOCKS_AT_ONCE):
        for n in range(1, max_words + 1):
            counted = blocks.select("block", "lang", "data").mapInArrow(_scan(n, below, bits, None, arrow_schema(COUNTED)), COUNTED)
            level = scratch.keep(_frequent(counted, least), f"frequent-{n}")
            sizes = level.agg(F.count(F.lit(1)), F.count_if(F.expr("low <> high"))).first()
            if not sizes[0]:
                break
            below = bitmap_of(level, sizes[0])
            alike = level.where("low = high").select("at", "n", F.lit(n).alias("words"))
            marks = alike if marks is None else marks.union(alike)
            if sizes[1]:  # occurrences of one fingerprint differ: count them by their text
                differ = level.where("low <> high").select("fp")
                scan = _scan(n, None, bits, bitmap_of(differ, sizes[1]), arrow_schema(by_text_ddl))
                by_text = (blocks.select("block", "lang", "data").mapInArrow(scan, by_text_ddl).join(differ, "fp", "left_semi")
                           .groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least))
                by_text = scratch.keep(by_text.select("lang", F.lit(n).alias("words"), "phrase", "a"), f"by-text-{n}")
                resolved = by_text if resolved is None else resolved.union(by_text)
        if marks is None:
            marks = spark.createDataFrame([], "at long, n long, words int")
        per_block = (marks.groupBy(F.shiftright("at", WORD_BITS).alias("block"))
                     .agg(F.collect_list(F.struct(F.col("at").bitwiseAND((1 << WORD_BITS) - 1).alias("word"), "words", "n")).alias("marks")))
        found = (blocks.select("block", "lang", "data").join(per_block, "block").select("lang", "data", "marks")
                 .mapInArrow(_texts_at(arrow_schema(found_ddl)), found_ddl))
        found = scratch.keep(found if resolved is None else found.union(resolved), "phrases")
    totals = scratch.keep(totals, "totals")
    scratch.drop(blocks)
    return found.withColumn("phrase", F.col("phrase").cast("string")), totals


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST_COUNT, drop_percent: int = DROP_PERCENT,
                 top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of 2 to ``max_words`` words.

    A phrase is a run of words within a piece; pieces end at ``.,;:!?`` and
    line ends. It is a candidate if it occurs ``least`` times; its score is
    that of its worst cut into two parts, floor(1000000 a a / (l r)). A
    candidate goes if a longer one that holds it has at least
    ``drop_percent`` % of its occurrences. Ranks go by score, count and
    phrase. All counts are exact whatever fingerprints collide: see the
    module. Null languages count as ``und``, null texts as empty; empty texts
    have no phrases; repeated rows count each; an empty table gives no rows;
    only ``lang`` and ``text`` are read. A phrase's cells in memory are
    bounded by a block, a block by ``BLOCK_BYTES`` or the longest text.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    found, totals = frequent_phrases(docs, scratch, max_words, least, bits)
    split = F.split("phrase", " ")
    part = lambda start, many: F.array_join(F.slice("parts", start, many), " ")
    candidates = found.where("words > 1").withColumn("parts", split)
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"), part(F.lit(1), k).alias("head"), part(k + 1, F.col("words") - k).alias("tail")))).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut.*")
    count_of = lambda name, count: found.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    cuts = cuts.join(count_of("head", "l"), ["lang", "head"]).join(count_of("tail", "r"), ["lang", "tail"])
    wide = lambda name: F.col(name).cast("decimal(18,0)")
    cuts = cuts.withColumn("upper", wide("a") * wide("a") * F.lit(SCALE).cast("decimal(7,0)")).withColumn("lower", wide("l") * wide("r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("upper div lower").alias("score"), "k", "l", "r")).alias("best"))
    inner = candidates.where("words > 2").select("lang", "a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda many: F.transform(F.sequence(F.lit(1), F.col("words") - many + 1), lambda start: part(start, many))))).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    rows = (scored.join(around, ["lang", "phrase"], "left")
            .where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * drop_percent))
            .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    best = [F.desc("score"), F.desc("a"), "phrase"]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return (ranked.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
