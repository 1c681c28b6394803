"""op13: ids against the tokenizer, plans against exhaustive packing, and whole sequences against the texts."""

import itertools
import random
import zlib
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from salesmart.llm import packing
from salesmart.llm.queries import QUERIES, TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not Path(PATH).exists(), reason="no tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ids_of(tokenizer):
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_the_tokenizers(texts, ids_of):
    own, rng = packing.Ids(Path(PATH).read_text()), random.Random(5)
    assert own.quick
    bits = [" ", "  ", "\n", "\t", "a", "B", "'s", "'re", "é", "12", "!", "\xa0", "\x85", "\x1c", "日", "<|endoftext|>", "​", "😀", "\r", "\x0b"]
    made = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(5000)]
    for text in [*(t for _, t in texts), *made, "", "x" * 50_000]:
        assert own(text).tolist() == ids_of(text)


def test_other_definitions_are_left_to_the_library():
    other = f"{TOKENIZERS}/word_bpe_49k.json"
    own = packing.Ids(Path(other).read_text())
    assert own.quick is None
    assert own("Two Words").tolist() == [*Tokenizer.from_file(other).encode("Two Words", add_special_tokens=False).ids, 0]


def fewest(sizes, capacity):
    """Exhaustive packing, for few pieces."""
    @cache
    def best(left):
        if not left:
            return 0
        first, rest, found = left[0], left[1:], len(left)
        for many in range(len(rest) + 1):
            for others in set(itertools.combinations(range(len(rest)), many)):
                if first + sum(rest[i] for i in others) <= capacity:
                    found = min(found, 1 + best(tuple(s for i, s in enumerate(rest) if i not in others)))
        return found
    return best(tuple(sorted(sizes, reverse=True)))


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_best_packing_within_reach(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    sizes = [rng.randint(max(1, capacity // rng.choice([3, 5, 9])), capacity) for _ in range(rng.randint(1, 8))]
    plan = packing.Plan(dict(Counter(sizes)), capacity)
    packing.reduce(plan)
    rest = [s for s, n in plan.left.items() for _ in range(n)]
    assert plan.sequences + fewest(rest, capacity) == fewest(sizes, capacity)


def test_known_dominances():
    plan = packing.Plan({9: 1, 8: 1, 7: 1, 3: 1, 2: 1}, 10)
    packing.reduce(plan)
    assert not plan.left and plan.sequences == 3  # 9; 8 + 2; 7 + 3
    plan = packing.Plan({6: 3, 2: 6}, 10)
    packing.reduce(plan)
    assert not plan.left and plan.sequences == 3  # 6 + 2 + 2


@pytest.mark.parametrize("seed", range(30))
def test_plans_use_each_rank_once_and_leave_no_gap(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 400)))
    plan, cells, ranks = packing.plan_of(dict(counts), capacity), defaultdict(list), defaultdict(list)
    for size, first_rank, many, each, first, offset in plan.rows:
        ranks[size] += range(first_rank, first_rank + many)
        for nth in range(many):
            cells[first + nth // each].append((offset + nth % each * size, size))
    assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in counts.items()}
    assert sorted(cells) == list(range(plan.sequences))
    for cell in cells.values():
        end = 0
        for offset, size in sorted(cell):
            assert offset == end
            end += size
        assert end <= capacity
    total = sum(s * n for s, n in counts.items())
    assert plan.sequences <= -(-total // capacity) * 11 // 9 + 1


def check(rows, docs, ids_of, capacity):
    expected = Counter()
    for doc_id, text in docs:
        ids = ids_of(text)
        ends = list(range(len(ids), 0, -capacity))[::-1]
        for piece, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            expected[doc_id, piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    cells = defaultdict(list)
    for r in rows:
        cells[r["sequence_id"]].append((r["offset"], r["length"]))
    for cell in cells.values():
        end = 0
        for offset, length in sorted(cell):
            assert offset == end
            end += length
        assert end <= capacity
    return len(cells)


def test_registered_query(spark, sf_dir, texts, ids_of):
    rows = QUERIES["op13_packing"](spark, sf_dir).collect()
    many = check(rows, texts, ids_of, 2048)
    assert many <= -(-sum(len(ids_of(t)) for _, t in texts) // 2048) + 1


def test_edge_rows_and_sequences_hold_the_texts(edge_docs, ids_of, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check(packing.pack_digests(edge_docs, PATH, 100).collect(), docs, ids_of, 100)
    packed = packing.pack(edge_docs, PATH, 4096)
    whole = b"".join(bytes(r["ids"]) for r in packing.sequences(packed).collect())
    assert len(whole) == 4 * sum(len(ids_of(t)) for _, t in docs)
    by_place = {(r["sequence_id"], r["offset"]): r for r in packed.collect()}
    for sequence in packing.sequences(packed).collect():
        ids, at = np.frombuffer(sequence["ids"], "<u4"), 0
        for doc_id in sequence["doc_ids"]:
            row = by_place[sequence["sequence_id"], at]
            assert row["doc_id"] == doc_id and ids[at:at + row["length"]].tobytes() == bytes(row["ids"])
            at += row["length"]
        assert at == len(ids)


def test_empty_table_and_one_row_repeated(spark, edge_docs, ids_of):
    assert packing.pack_digests(edge_docs.limit(0), PATH).collect() == []
    docs = [(1, "the same row")] * 3000
    rows = packing.pack_digests(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect()
    assert check(rows, docs, ids_of, 2048) == -(-3000 // (2048 // len(ids_of("the same row"))))
