"""Benchmark passages in documents: pigeonhole pieces find candidates, Myers' bit vectors verify them.

An item within ``budget`` edits of a stretch of text keeps at least one of
``budget + 1`` disjoint pieces unharmed, so exact hits of pieces miss
nothing. Both sides are compared as lower-case letters and digits, other
characters as one blank between words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.llm.common import ARROW_ROWS, fresh, scan

# Edits allowed for each character of an item, rounded down; an item too short for one must match exactly, as whole words.
ERROR_RATE = 0.1
# Items are matched in blocks of about so many characters, each block in a pass of its own.
BLOCK_CHARS = 8_000_000
GRAM = 3
WORD = re.compile(r"[^\W_]+")
HIT_SCHEMA = "doc_id long, item_id long, distance int, budget int, start int, end int"


class Item(NamedTuple):
    item_id: int | None
    text: str
    budget: int
    masks: dict[str, int]
    back_masks: dict[str, int]
    grams: list[str]


class Part(NamedTuple):
    """A stretch of an item that must match within ``budget`` for a hit of a piece inside it to count."""
    start: int
    end: int
    budget: int
    masks: dict[str, int]


def normalised(text: str | None) -> str:
    return " ".join(WORD.findall((text or "").lower()))


def masks_of(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for at, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << at
    return masks


def best_end(masks: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of ``text``, and the first end of such a stretch."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best, end = full, 0, size, size, 0
    for at, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        across = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(across | plus), plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, at
        up, down, vertical = (up << 1) & full, (down << 1) & full, equal | minus
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
    return best, end


def prepare(items: list[tuple[int | None, str | None]], error_rate: float = ERROR_RATE) -> list[Item]:
    out = []
    for item_id, raw in items:
        text = normalised(raw)
        if text:
            out.append(Item(item_id, text, int(len(text) * error_rate), masks_of(text), masks_of(text[::-1]),
                            [text[i:i + GRAM] for i in range(len(text) - GRAM + 1)]))
    return out


def pieces_of(text: str, budget: int) -> list[tuple[int, int, list[Part]]]:
    """``budget + 1`` disjoint pieces as (start, end, enclosing parts from the inside out).

    A stretch with at most ``b`` edits has a first half with at most
    ``(b - 1) // 2`` or a second half with at most the rest of ``b - 1``;
    halving down to no edits gives the pieces, and a hit must hold in each
    part around it.
    """
    out: list[tuple[int, int, list[Part]]] = []

    def split(start: int, end: int, edits: int, around: list[Part]) -> None:
        if not edits:
            out.append((start, end, around[::-1]))
            return
        left = (edits - 1) // 2
        middle = start + (end - start) * (left + 1) // (edits + 1)
        own = [*around, Part(start, end, edits, masks_of(text[start:end]))] if edits < budget else around
        split(start, middle, left, own)
        split(middle, end, edits - 1 - left, own)

    split(0, len(text), budget, [])
    return out


def piece_automaton(items: list[Item]) -> ahocorasick.Automaton:
    """Each piece with its size and the items it belongs to: number, offset, enclosing parts."""
    pieces: dict[str, list[tuple[int, int, list[Part]]]] = {}
    for number, item in enumerate(items):
        for start, end, parts in pieces_of(item.text, item.budget):
            pieces.setdefault(item.text[start:end], []).append((number, start, parts))
    found = ahocorasick.Automaton()
    for piece, places in pieces.items():
        found.add_word(piece, (len(piece), places))
    found.make_automaton()
    return found


def holds(parts: list[Part], text: str, start: int) -> bool:
    """True when each part matches near where it would be in an item that starts at ``start``."""
    for part in parts:
        low = max(0, start + part.start - part.budget)
        window = text[low:max(0, start + part.end + part.budget)]
        if best_end(part.masks, part.end - part.start, window)[0] > part.budget:
            return False
    return True


def verify(item: Item, text: str, first: int, last: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best match whose start lies about ``first`` to ``last``, if within budget."""
    size, budget = len(item.text), item.budget
    low, high = max(0, first - budget), last + size + budget
    window = text[low:high]
    if budget:
        there = {window[i:i + GRAM] for i in range(len(window) - GRAM + 1)}
        kept = sum(gram in there for gram in item.grams)
        if kept < len(item.grams) - GRAM * budget:  # an edit harms at most GRAM of them
            return None
        distance, end = best_end(item.masks, size, window)
        if distance > budget:
            return None
        _, back = best_end(item.back_masks, size, window[:end][::-1])
        return distance, low + end - back, low + end
    for m in re.finditer(rf"(?<!\S){re.escape(item.text)}(?!\S)", window):
        return 0, low + m.start(), low + m.end()
    return None


def find_items(text: str | None, items: list[Item], pieces: ahocorasick.Automaton) -> list[tuple[Item, int, int, int]]:
    """The best match of each item found in a text: (item, distance, start, end) in the normalised text."""
    text = normalised(text)
    if not text:
        return []
    starts: dict[int, set[int]] = {}
    for end, (size, places) in pieces.iter(text):
        for number, offset, parts in places:
            start = end + 1 - size - offset
            if start not in (known := starts.setdefault(number, set())) and holds(parts, text, start):
                known.add(start)
    found = []
    for number, wanted in sorted((n, w) for n, w in starts.items() if w):
        item, best, run = items[number], None, []
        if not item.budget:  # look at all of the text around each exact hit: these need whole words
            runs = [(s - 1, s + 1) for s in sorted(wanted)]
        else:
            runs = []
            for s in sorted(wanted):
                if run and s - run[-1] <= item.budget:
                    run.append(s)
                else:
                    if run:
                        runs.append((run[0], run[-1]))
                    run = [s]
            runs.append((run[0], run[-1]))
        for first, last in runs:
            got = verify(item, text, first, last)
            if got and (best is None or got < best):
                best = got
        if best:
            found.append((item, *best))
    return found


def benchmark_blocks(benchmark: DataFrame) -> list[list[tuple[int | None, str]]]:
    """The items on the driver, in blocks bounded by ``BLOCK_CHARS`` on average."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    return [[tuple(r) for r in items.where(of == i).orderBy("item_id", "text").collect()] for i in range(blocks)]


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """One row for each row of ``docs`` and item that it holds within the item's budget.

    The budget is ``error_rate`` times the item's normalised characters,
    rounded down; an item with a budget of none must stand there as whole words.

    doc_id, item_id, distance (edits), budget, start and end of the best match
    in the normalised text. Null, empty and wordless texts and items match
    nothing; repeated rows and items repeat; null ids stay null; an empty
    table on either side gives none. Only doc_id, item_id and text are read.
    """
    spark: SparkSession = docs.sparkSession
    narrow, out = docs.select("doc_id", "text"), None
    for block in benchmark_blocks(benchmark):
        hits = scan(narrow, _matcher(block, error_rate), HIT_SCHEMA)
        out = hits if out is None else out.union(hits)
    return spark.createDataFrame([], HIT_SCHEMA) if out is None else out


def _matcher(block: list[tuple[int | None, str]], error_rate: float):
    ready: list = []

    def work(columns: dict[str, list]) -> dict[str, list]:
        if not ready:
            items = prepare(block, error_rate)
            ready.extend((items, piece_automaton(items)))
        out: dict[str, list] = {k: [] for k in ("doc_id", "item_id", "distance", "budget", "start", "end")}
        if not ready[0]:
            return out
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            for item, distance, start, end in find_items(text, *ready):
                for name, value in zip(out, (doc_id, item.item_id, distance, item.budget, start, end), strict=True):
                    out[name].append(value)
        return out

    return work


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item by the rule of ``contaminated``, all their columns as they were.

    Null, empty and wordless texts stay; repeated rows are judged alike; an
    empty benchmark keeps all rows; an empty table gives none.
    """
    (flag,) = fresh(docs, "_clean")
    kept = docs
    for block in benchmark_blocks(benchmark):
        kept = _flagged(kept, flag, block, error_rate).where(F.col(flag)).select(*docs.columns)
    return kept


def _flagged(docs: DataFrame, flag: str, block: list[tuple[int | None, str]], error_rate: float) -> DataFrame:
    """``docs`` with a boolean column; the text is judged where it is, so rows need no key and no join."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    @F.pandas_udf("boolean")
    def is_clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = prepare(block, error_rate)
        pieces = piece_automaton(items)
        for texts in batches:
            yield pd.Series([not (items and find_items(t, items, pieces)) for t in texts], dtype=bool)

    return docs.withColumn(flag, is_clean("text"))
