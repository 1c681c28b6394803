"""Packing token pieces into sequences: Martello-Toth dominance on the lengths, best fit for the rest.

Pieces of one length are interchangeable, so the instance is the number of
pieces of each length: at most ``capacity`` numbers, however many documents
there are. Spark counts them, the driver works out a plan on the counts, a
table of "pieces of this length with these ranks go to these sequences at
this offset" whose size depends on the capacity alone, and Spark ranks the
pieces within their length and looks each one up.

The reduction fixes sequences that some best packing must hold or may hold
without loss (Martello and Toth, 1990): a set that contains the largest piece
dominates every other such set if each of those splits into groups that fit
under different members of it. What is left is packed by best fit, largest
first.
"""

from __future__ import annotations

import itertools
import json
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from salesmart.llm.common import Scratch, arrow_rows, arrow_schema, give_back
from salesmart.llm.running import with_running

CAPACITY = 2048
# Rows that a task is handed at once, tokens that it gives back at once.
DOCS_AT_ONCE, TOKENS_AT_ONCE = 256, 1 << 20
# The id behind each document; what plain byte-level definitions say of words, and how they cut them.
END_ID = 0
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

PIECES = "doc_id long, piece int, start long, length long, ids binary, uid long"


def byte_ranks(definition: dict) -> dict[bytes, int] | None:
    """Byte strings and ids of a plain byte-level BPE definition whose merges are in the order of their ids, else None."""
    model, split = definition["model"], definition.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and definition.get("normalizer") is None and not model.get("dropout")
             and {k: split.get(k) for k in BYTE_LEVEL} == BYTE_LEVEL)
    if not plain:
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    singles = [t for t in vocabulary if len(t) == 1]
    if merged != sorted(merged) or len(merged) + len(singles) != len(vocabulary) or max(map(vocabulary.get, singles)) > min(merged):
        return None
    return {bytes(byte_of[c] for c in token): number for token, number in vocabulary.items()}


class Ids:
    """Ids of texts as the tokenizer of a definition gives them, with ``END_ID`` behind.

    A plain byte-level definition is run by the quicker of two libraries that
    give the same ids; any other, and texts that hold a special token's
    string, by ``tokenizers`` itself.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        parsed = json.loads(definition)
        self.special = [t["content"] for t in parsed.get("added_tokens", [])]
        self.quick, ranks = None, byte_ranks(parsed)
        if ranks:
            import tiktoken
            self.quick = tiktoken.Encoding("plain", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> array:
        if self.quick and not any(s in text for s in self.special):
            ids = self.quick(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        ids.append(END_ID)
        ids = array("I", ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids


def _pieces(definition: str, capacity: int, schema: pa.Schema):
    """Pieces of (doc_id, text) rows; of a longer document all but the first have ``capacity`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, uid = Ids(definition), TaskContext.get().partitionId() << 40
        columns, held = ([], [], [], [], [], []), 0

        def flush() -> pa.RecordBatch:
            nonlocal columns, held
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            columns, held = ([], [], [], [], [], []), 0
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = ids_of(text or "")
                ends = range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)
                start = 0
                for piece, end in enumerate(ends):
                    for column, value in zip(columns, (doc_id, piece, start, end - start, ids[start:end].tobytes(), uid), strict=True):
                        column.append(value)
                    held, uid, start = held + end - start, uid + 1, end
                    if held >= TOKENS_AT_ONCE:
                        yield flush()
        if columns[0]:
            yield flush()
        del ids_of
        give_back()

    return run


def tokenise(docs: DataFrame, tokenizer: str, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32-bit) and a uid of every piece, written to the shared folder.

    ``tokenizer`` is the path of a tokenizer definition; its content travels with the job.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    with arrow_rows(docs.sparkSession, DOCS_AT_ONCE):
        made = docs.select("doc_id", "text").mapInArrow(_pieces(definition, capacity, arrow_schema(PIECES)), PIECES)
        return scratch.keep(made, "pieces", compression="zstd", **{"parquet.block.size": 16 << 20})


class Plan:
    """Which ranks of each length go to which sequences, as it is worked out."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {size: n for size, n in counts.items() if n}
        self.capacity, self.sequences = capacity, 0
        self.given = dict.fromkeys(counts, 0)
        self.rows: list[tuple[int, int, int, int, int, int]] = []

    def put(self, size: int, first: int, many: int, each: int, offset: int) -> None:
        """``each`` pieces of ``size`` into each of ``many`` sequences from ``first`` on, behind ``offset`` ids."""
        self.rows.append((size, self.given[size], many * each, each, first, offset))
        self.given[size] += many * each
        self.left[size] -= many * each
        if not self.left[size]:
            del self.left[size]

    def fix(self, sizes: list[int]) -> None:
        """As many sequences of exactly these pieces as there are pieces for."""
        each = {s: sizes.count(s) for s in sizes}
        many, offset = min(self.left[s] // n for s, n in each.items()), 0
        for size, n in each.items():
            self.put(size, self.sequences, many, n, offset)
            offset += size * n
        self.sequences += many


def dominating(plan: Plan, size: int) -> list[int] | None:
    """A set with a piece of ``size`` that dominates all other sets with it, of at most three pieces, or None."""
    room = plan.capacity - size
    rest = dict(plan.left)
    rest[size] -= 1
    sizes = sorted(s for s, n in rest.items() if n and s <= room)
    if not sizes:
        return [size]
    best = sizes[-1]
    least = list(itertools.islice((s for s in sizes for _ in range(min(rest[s], 3))), 3))
    if best == room or len(least) < 2 or least[0] + least[1] > room:
        return [size, best]  # nothing else fits beside, or no more than one piece does
    if len(least) == 3 and sum(least) <= room:
        return None  # sets of four and more are not compared
    rest[best] -= 1
    second = max((s for s in sizes if rest[s] and s <= room - best), default=0)
    if any(_pairs_beyond(sizes, rest, room, best, second)):
        return None
    return [size, best, second] if second else [size, best]


def _pairs_beyond(sizes: list[int], rest: dict[int, int], room: int, best: int, second: int) -> Iterator[bool]:
    """Pairs that fit beside, but neither together under ``best`` nor one under each of ``best`` and ``second``."""
    ordered = np.array(sizes)
    for low in sizes:
        if low <= second or 2 * low > room:
            continue
        high = int(ordered[np.searchsorted(ordered, room - low, "right") - 1])
        several = rest[low] + (low == best) > 1
        if high >= low and low + high > best and (high > low or several):
            yield True


def reduce(plan: Plan) -> None:
    """Fix dominating sets, from the largest pieces to the smallest, until none is found."""
    before = None
    while before != plan.sequences:
        before = plan.sequences
        for size in sorted(plan.left, reverse=True):
            while size in plan.left and (found := dominating(plan, size)):
                plan.fix(found)


def best_fit(plan: Plan) -> None:
    """The rest, largest first, each piece into the fullest sequence that has room; alike sequences go together."""
    open_: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of (first sequence, how many)
    for size in sorted(plan.left, reverse=True):
        while size in plan.left:
            room = min((r for r in open_ if r >= size), default=None)
            if room is None:  # new sequences, filled with pieces of this size
                each = plan.capacity // size
                many = -(-plan.left[size] // each)
                open_.setdefault(plan.capacity, []).append((plan.sequences, many))
                plan.sequences += many
                room = plan.capacity
            first, many = open_[room].pop()
            each = room // size
            filled = min(many, plan.left[size] // each)
            offset = plan.capacity - room
            if filled:
                plan.put(size, first, filled, each, offset)
                open_.setdefault(room - each * size, []).append((first, filled))
                first, many = first + filled, many - filled
            if many and (last := plan.left.get(size, 0)):
                plan.put(size, first, 1, last, offset)
                open_.setdefault(room - last * size, []).append((first, 1))
                first, many = first + 1, many - 1
            if many:
                open_.setdefault(room, []).append((first, many))
            if not open_.get(room, True):
                del open_[room]


def plan_of(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan = Plan(counts, capacity)
    reduce(plan)
    best_fit(plan)
    return plan


def _look_up(plan: Plan, names: list[str], schema: pa.Schema):
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 6)
    by_size = {int(s): rows[rows[:, 0] == s] for s in np.unique(rows[:, 0])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(names.index(c)).to_numpy() for c in ("_size", "_rank"))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                mine, table = np.flatnonzero(size == s), by_size[int(s)]
                row = table[np.searchsorted(table[:, 1], rank[mine], "right") - 1]
                nth = rank[mine] - row[:, 1]
                sequence[mine] = row[:, 4] + nth // row[:, 3]
                offset[mine] = row[:, 5] + nth % row[:, 3] * s
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], schema=schema)

    return run


def place(pieces: DataFrame, size: str, uid: str, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset: all pieces in few sequences of at most ``capacity``.

    ``size`` is a column of 1 to ``capacity``; ``uid`` tells rows apart. The
    frame is read several times, so it should be a written table.
    """
    counts = {r["_s"]: r["_n"] for r in pieces.groupBy(F.col(size).cast("long").alias("_s")).agg(F.count(F.lit(1)).alias("_n")).collect()}
    plan = plan_of(counts, capacity)
    keyed = pieces.withColumn("_size", F.col(size).cast("long")).withColumn("_h", F.xxhash64(uid))
    ranked = with_running(keyed, "_size", "_h", [uid], {"_rank": F.lit(1)}, max(1, sum(counts.values())), scratch)
    ddl = _placed_ddl(ranked)
    return ranked.mapInArrow(_look_up(plan, ranked.columns, arrow_schema(ddl)), ddl).drop("_size", "_rank", "_h")


def _placed_ddl(ranked: DataFrame) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields] + ["sequence_id long", "offset long"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id and offset of every piece of every document.

    A document is the ids of its whole text and a last id 0; one of more than
    ``capacity`` ids is cut so that all pieces but the first have ``capacity``.
    Null and empty texts are a document of one id; null doc_ids and repeated
    rows are packed like any other; an empty table gives no rows; only doc_id
    and text are read. Which of several pieces of one length goes where is
    free; sequences have no gaps.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = tokenise(docs, tokenizer, scratch, capacity)
    placed = place(pieces.select("uid", "length"), "length", "uid", scratch, capacity)
    return pieces.join(placed.drop("length"), "uid").drop("uid")


def pack_digests(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``pack`` with ids_crc32 in place of the ids, which then aren't shuffled."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = tokenise(docs, tokenizer, scratch, capacity)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "uid")
    return place(narrow, "length", "uid", scratch, capacity).drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids of every sequence, from the rows of ``pack``; a sequence is bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", joined.alias("ids"), F.transform("parts", lambda part: part["doc_id"]).alias("doc_ids")))
