"""Packing: ids against the other tokenizer library, plans on counts against the pieces themselves, whole tables."""

from __future__ import annotations

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from freshet.llm import packing
from tests.llm.test_operators import DOCS, odd_rows, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
PIECES = packing.PIECES


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_ids_are_those_of_the_json_vocabulary(tokenizer):
    rng = random.Random(5)
    with open(packing.vocabulary(), "rb") as lines:
        tokens = [base64.b64decode(line.split()[0]) for line in lines]
    texts = [t.decode() for t in tokens if t.decode(errors="ignore").encode() == t]
    # Every kind of character, next to letters, digits, blanks and marks.
    pool = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list("  \n\t.,'s<|endoftext|>漢字😀")
    texts += ["".join(rng.choices(pool, k=30)) for _ in range(3000)] + ["a" * 20000, " " * 20000, "1." * 9000, "", "<|endoftext|>"]
    want = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for path in (packing.vocabulary(), public_tokenizers.path("byte_bpe_50k.json")):
        assert [np.frombuffer(b, "<u4").tolist() for b in packing.ids_of(texts, path)] == want


def by_rank(lengths):
    return np.repeat(np.array(sorted(lengths, reverse=True), int), [lengths[n] for n in sorted(lengths, reverse=True)])


def sequences_of(plan, lengths, capacity):
    large = {n: c for n, c in lengths.items() if n > plan.limit}
    pieces = by_rank(large)
    used = np.bincount(plan.large(np.arange(len(pieces))), pieces, minlength=plan.sequences).astype(int) if len(pieces) else np.zeros(0, int)
    assert len(used) == plan.sequences and (used <= capacity).all()
    rooms = Counter((capacity - used).tolist())
    assert rooms == Counter(packing.rooms_left(large, plan.large, plan.sequences, capacity))
    room = np.concatenate([np.sort(capacity - used), np.full(plan.new, capacity)])
    small = by_rank({n: c for n, c in lengths.items() if n <= plan.limit})
    if len(small):
        held = np.bincount(plan.small(np.arange(len(small))), small, minlength=len(room))
        assert len(held) == len(room) and (held <= room).all()
    return plan.sequences + plan.new


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in by_rank(lengths).tolist():
        j = min((j for j in range(len(rooms)) if rooms[j] >= n), key=lambda j: rooms[j], default=None)
        if j is None:
            rooms.append(capacity)
            j = len(rooms) - 1
        rooms[j] -= n
    return len(rooms)


def test_plans_hold_all_pieces_in_few_sequences():
    rng = random.Random(1)
    for _ in range(60):
        capacity, n = rng.choice([8, 16, 50, 100]), rng.choice([0, 1, 5, 50, 300])
        lengths = Counter(min(capacity - 1, rng.choice([rng.randint(1, capacity - 1), 3, capacity // 2 + 1, capacity // 3 + 1])) for _ in range(n))
        plan = packing.plan_of(dict(lengths), capacity, rng.choice([2, 4, 8]))
        assert sequences_of(plan, lengths, capacity) <= best_fit_decreasing(lengths, capacity)


def test_small_lengths_are_placed_as_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(40):
        lengths = Counter(rng.randint(1, 30) for _ in range(rng.choice([1, 20, 200])))
        places, new = packing.best_fit_places(lengths, {}, 60)
        assert new == best_fit_decreasing(lengths, 60)


def test_configurations_beat_best_fit_where_it_is_blind():
    # Best fit decreasing pairs the longest ones and needs a seventh more sequences.
    lengths = {400: 700, 312: 1400}
    plan = packing.plan_of(dict(lengths), 1024, 21)
    assert sequences_of(plan, lengths, 1024) == 700 and plan.limit < 312


def check(rows, capacity):
    places, spans = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= capacity
        places[r.sequence_id].append((r.offset, r.length))
        spans[r.doc_id].append((r.piece, r.start, r.length))
    for of in places.values():
        end = 0
        for offset, length in sorted(of):
            assert offset == end
            end += length
        assert end <= capacity
    for of in spans.values():
        of.sort()
        assert [p for p, _, _ in of] == list(range(len(of)))
        assert all(n == capacity for _, _, n in of[1:]) and all(a + n == b for (_, a, n), (_, b, _) in zip(of, of[1:])) and of[0][1] == 0
    return len(places)


def test_query_on_the_table(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = packing.op12_linear_grouping_packing(spark, SF).collect()
    sequences = check(rows, 1024)
    assert {r.doc_id for r in rows} == set(texts)
    total = 0
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
        total += r.length
    assert sequences <= 1.02 * total / 1024 + 1


@pytest.mark.parametrize("capacity", [5, 40, 1024])
def test_odd_documents(spark, capacity):
    table = [(*r, "x") for r in odd_rows() + [(100 + i, prose(i % 25, i), "en", "hot", 1) for i in range(300)] + [(9, "<|endoftext|>", "en", "a", 1)]]
    cut = packing.pieces(spark.createDataFrame(table, DOCS + ", length string"), packing.vocabulary(), capacity)
    rows = packing.packed(cut, capacity, 8).collect()
    ids = dict(Counter(r[0] for r in table))
    # Rows of one id are apart in the check below, by their number.
    seen, renamed = Counter(), []
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.ids_crc32, r.piece)):
        seen[r.doc_id, r.piece, r.start] += 1
        renamed.append(r)
    assert sum(c for (d, p, _), c in seen.items() if p == 0) == len(table) and ids
    places = defaultdict(list)
    for r in renamed:
        places[r.sequence_id].append((r.offset, r.length))
    for of in places.values():
        end = 0
        for offset, length in sorted(of):
            assert offset == end
            end += length
        assert end <= capacity
    for r in rows:
        if r.doc_id in (1, 2):
            assert (r.length, r.ids_crc32) == (1, zlib.crc32(np.array([2], "<u4").tobytes()))


def test_nothing(spark):
    assert packing.packed(spark.createDataFrame([], PIECES)).count() == 0
