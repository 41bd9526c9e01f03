"""Best-fit packing of tokenized documents into sequences, by linear grouping.

Every document is tokenized whole and closed by one more id; one longer than a sequence is cut into full sequences and a
first piece with what is left. Then the pieces are packed:

1. Large pieces are ranked by length, cut into groups of equal cardinality, and rounded up to the longest of their group.
2. For these few sizes the best mix of configurations (which sizes share a sequence) is a linear program over counts,
   solved by column generation; what its rounding down leaves over is packed best fit decreasing.
3. Actual pieces take the places of their sizes, by arithmetic on their ranks. None is longer than its place.
4. Small pieces, longest first, go into the tightest room left. Sequences with equal room are alike, so this is done on
   counts per room and length, and again turned into places by arithmetic on ranks.

The driver sees counts per length and per room, never more numbers than a sequence has tokens. Rows are ranked by ranges,
so no task holds a whole length. The plan tables that tasks look into are bounded by the capacity too.

Defined results: a null text is an empty one, which is the closing id alone. Very long texts are tokenized and cut whole.
Repeated rows and rows with equal or null doc_id are pieces of their own. Ties in length go by doc_id, piece, checksum.
An empty table gives an empty table. Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import in_order, ranked, read, written
from freshet.llm.textbytes import SLICE

CAPACITY = 1024
END = 2
# Pieces longer than a sequence divided by this are large; which divisor needs the fewest sequences is found on counts.
LARGE_PARTS = (2, 3, 4, 6)
GROUPS = 64
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# ---- tokens ----------------------------------------------------------------------------------------------------------


def vocabulary() -> str:
    """The ranks of byte_bpe_50k.json for the faster of the two libraries; both give the same ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """A tokenizer by its file: a list of ranks, or the JSON form that the `tokenizers` library reads."""
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [encoding.encode_ordinary(t) for t in texts]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def ids_of(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit numbers."""
    return [np.array(ids, "<u4").tobytes() for ids in _encoder(path)(texts)]


def pieces_of(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int) -> Iterator[pa.RecordBatch]:
    closing = np.array([end], "<u4").tobytes()
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        row = 0
        while row < len(ids):
            # A slice of a few texts at a time.
            slice_texts, size = [], 0
            first = row
            while row < len(ids) and (row == first or size < SLICE):
                text = texts[row].as_py() or ""
                slice_texts.append(text)
                size += len(text)
                row += 1
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, data in zip(ids[first:row], ids_of(slice_texts, path)):
                data += closing
                n = len(data) // 4
                start, stop, piece = 0, n % capacity or capacity, 0
                while start < n:
                    for column, value in zip(out, (doc_id, piece, start, stop - start, zlib.crc32(data[4 * start : 4 * stop]))):
                        column.append(value)
                    start, stop, piece = stop, stop + capacity, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every document's ids."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        partial(pieces_of, path=path, capacity=capacity, end=end), PIECES
    )


# ---- configurations --------------------------------------------------------------------------------------------------


def best_fill(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration: counts per size whose sizes fit into the capacity (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    useful = np.flatnonzero(values > 1e-12)
    useful = useful[np.argsort(sizes[useful])]
    fit = np.searchsorted(sizes[useful], np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fit[c]:
            gains = best[c - sizes[useful[: fit[c]]]] + values[useful[: fit[c]]]
            i = int(gains.argmax())
            if gains[i] > best[c] + 1e-12:
                best[c], choice[c] = gains[i], useful[i]
    counts, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(counts per size, how many sequences) that hold `demand` pieces of each size, in about as few as possible."""
    k = len(sizes)
    if not k:
        return []
    basis = np.diag((capacity // sizes).astype(float))
    # Demands a hair apart keep the simplex method from standing still on ties.
    wanted = demand + np.arange(1, k + 1) * 1e-7
    for _ in range(60 * k):
        inverse = np.linalg.inv(basis)
        amounts, prices = inverse @ wanted, inverse.sum(axis=0)
        value, column = best_fill(prices, sizes, capacity)
        if value <= 1 + 1e-6:
            break
        share = inverse @ column
        rows = np.flatnonzero(share > 1e-9)
        leaving = rows[np.argmin(amounts[rows] / share[rows])]
        basis[:, leaving] = column
    amounts = np.floor(np.linalg.solve(basis, wanted) + 1e-6).clip(0).astype(np.int64)
    chosen = [(basis[:, i].round().astype(np.int64), int(n)) for i, n in enumerate(amounts) if n > 0]
    left = demand.astype(np.int64) - sum((c * n for c, n in chosen), np.zeros(k, np.int64))
    rooms: list[int] = []
    fills: list[np.ndarray] = []
    for i in np.argsort(-sizes, kind="stable"):
        for _ in range(max(0, int(left[i]))):
            fitting = [(room, j) for j, room in enumerate(rooms) if room >= sizes[i]]
            if not fitting:
                rooms.append(capacity)
                fills.append(np.zeros(k, np.int64))
                fitting = [(capacity, len(rooms) - 1)]
            j = min(fitting)[1]
            rooms[j] -= int(sizes[i])
            fills[j][i] += 1
    return chosen + [(f, 1) for f in fills]


@dataclass(frozen=True)
class Places:
    """Pieces of one kind, by rank: those from `first[i]` to before `end[i]` go to the sequences from `base[i]` on, as
    many as `each[i]` to every sequence."""

    first: np.ndarray
    end: np.ndarray
    base: np.ndarray
    each: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, int, int, int]]) -> Places:
        table = np.array(rows or [(0, 0, 0, 1)], np.int64)
        return Places(*table[np.argsort(table[:, 0], kind="stable")].T)

    def __call__(self, rank: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.first, rank, "right") - 1
        return self.base[i] + (rank - self.first[i]) // self.each[i]


def grouped_places(lengths: dict[int, int], capacity: int, groups: int) -> tuple[Places, int]:
    """Places of the large pieces, ranked from the longest, and the number of sequences. `lengths`: pieces per length."""
    total = sum(lengths.values())
    if not total:
        return Places.of([]), 0
    each = -(-total // groups)
    by_length = sorted(lengths, reverse=True)
    ends = np.cumsum([lengths[n] for n in by_length])
    starts = np.arange(0, total, each)
    sizes = np.array(by_length)[np.searchsorted(ends, starts, "right")]
    counts = np.minimum(each, total - starts)
    # Groups that are rounded to one size are one size. Its pieces follow each other in rank.
    distinct, group_of = np.unique(sizes, return_inverse=True)
    demand = np.bincount(group_of, counts).astype(np.int64)
    rank = [int(starts[np.flatnonzero(sizes == s)[0]]) for s in distinct]
    last = [r + int(d) for r, d in zip(rank, demand)]
    rows, sequence = [], 0
    for held, times in configurations(distinct, demand, capacity):
        for i in np.flatnonzero(held):
            end = min(last[i], rank[i] + int(held[i]) * times)
            if rank[i] < end:
                rows.append((rank[i], end, sequence, int(held[i])))
                rank[i] = end
        sequence += times
    return Places.of(rows), sequence


def rooms_left(lengths: dict[int, int], places: Places, sequences: int, capacity: int) -> dict[int, int]:
    """How many of the sequences have how much room once the actual pieces are in their places.

    The length at a rank changes at few ranks only, and so the room changes at few sequences only.
    """
    if not sequences:
        return {}
    by_length = np.array(sorted(lengths, reverse=True))
    ends = np.cumsum([lengths[n] for n in by_length])
    cuts = [np.array([0, sequences])]
    for first, end, base, each in zip(places.first, places.end, places.base, places.each):
        edges = np.concatenate([ends[(ends > first) & (ends < end)], [first, end]])
        near = base + (edges - first) // each
        cuts += [near, near + 1]
    cuts = np.unique(np.concatenate(cuts))
    cuts = cuts[cuts <= sequences]
    used = np.zeros(len(cuts) - 1, np.int64)
    for first, end, base, each in zip(places.first, places.end, places.base, places.each):
        lo, hi = np.searchsorted(cuts[:-1], [base, base + -(-(end - first) // each)])
        for slot in range(each):
            rank = first + (cuts[lo:hi] - base) * each + slot
            there = rank < end
            used[lo:hi] += np.where(there, by_length[np.searchsorted(ends, np.minimum(rank, end - 1), "right")], 0)
    left: dict[int, int] = defaultdict(int)
    for room, n in zip(capacity - used, np.diff(cuts)):
        left[int(room)] += int(n)
    return dict(left)


def best_fit_places(lengths: dict[int, int], rooms: dict[int, int], capacity: int) -> tuple[Places, int]:
    """Places of the small pieces, ranked from the longest, in sequences ranked by their room; and how many are new.

    The tightest room that holds a piece takes it, and goes on taking pieces of this length while it can, for it stays
    the tightest. So sequences with equal room are filled alike, and a length splits one class of them at most.
    """
    classes: dict[int, list[tuple[int, int]]] = defaultdict(list)
    first = 0
    for room in sorted(rooms):
        if rooms[room]:
            classes[room].append((first, rooms[room]))
        first += rooms[room]
    rows, rank, new = [], 0, 0
    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            room = min((r for r in classes if r >= length), default=None)
            if room is None:
                opened = -(-left // (capacity // length))
                classes[capacity].append((first + new, opened))
                new += opened
                continue
            start, n = classes[room].pop()
            if not classes[room]:
                del classes[room]
            each = room // length
            taken = min(left, n * each)
            rows.append((rank, rank + taken, start, each))
            whole, rest = divmod(taken, each)
            if whole:
                classes[room - each * length].append((start, whole))
            if rest:
                classes[room - rest * length].append((start + whole, 1))
            if whole + (rest > 0) < n:
                classes[room].append((start + whole + (rest > 0), n - whole - (rest > 0)))
            rank += taken
            left -= taken
    return Places.of(rows), new


@dataclass(frozen=True)
class Plan:
    limit: int
    large: Places
    small: Places
    sequences: int  # of large pieces
    new: int  # further ones, of small pieces alone


def plan_of(lengths: dict[int, int], capacity: int, groups: int = GROUPS) -> Plan:
    """The plan with the fewest sequences for pieces shorter than a sequence. Its work depends on the capacity only."""
    plans = []
    for part in LARGE_PARTS:
        limit = capacity // part
        large = {n: c for n, c in lengths.items() if n > limit}
        places, sequences = grouped_places(large, capacity, groups)
        rooms = rooms_left(large, places, sequences, capacity)
        small, new = best_fit_places({n: c for n, c in lengths.items() if n <= limit}, rooms, capacity)
        plans.append(Plan(limit, places, small, sequences, new))
    return min(plans, key=lambda p: p.sequences + p.new)


# ---- packing ---------------------------------------------------------------------------------------------------------


def _placed(batches: Iterator[pa.RecordBatch], places: Places, rank: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ranks = batch.column(rank).to_numpy(zero_copy_only=False)
        yield batch.append_column(name, pa.array(places(ranks), pa.int64()))


def with_places(df: DataFrame, places: Places, rank: str, name: str) -> DataFrame:
    return df.mapInArrow(
        partial(_placed, places=places, rank=rank, name=name), df.withColumn(name, F.lit(0).cast("bigint")).schema
    )


def counts_by(df: DataFrame, column: str) -> dict[int, int]:
    """Rows per value of a column that has no more values than a sequence has tokens."""
    return {int(r[0]): int(r[1]) for r in df.groupBy(column).count().collect()}


def packed(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """`cut` (doc_id, piece, start, length, ids_crc32; lengths 1 to `capacity`) with sequence_id and offset."""
    columns = cut.columns
    ordered = in_order(
        written(cut, "pieces"),
        [F.col("length").desc(), F.col("doc_id").asc_nulls_first(), F.col("piece"), F.col("ids_crc32")],
        "pieces",
    )
    lengths = counts_by(ordered, "length")
    places = written(ranked(ordered.withColumn("_all", F.lit(0)), "_all", "_rank").drop("_id", "_all"), "ranked")
    full = lengths.pop(capacity, 0)
    plan = plan_of(lengths, capacity, groups)
    # Ranks and sequences are counted from the first piece that is not full.
    whole = places.where(F.col("length") == capacity).withColumn("sequence_id", F.col("_rank"))
    short = places.where(F.col("length") < capacity)
    large = short.where(F.col("length") > plan.limit).withColumn("_rank", F.col("_rank") - full)
    large = written(with_places(large, plan.large, "_rank", "sequence_id"), "substituted")
    shift = full + sum(n for length, n in lengths.items() if length > plan.limit)
    small = short.where(F.col("length") <= plan.limit).withColumn("_rank", F.col("_rank") - shift)
    # Small pieces know their sequence by its rank among the rooms left; new sequences come after all others.
    used = large.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("_room"))
    rooms = in_order(used, [F.col("_room"), F.col("sequence_id")], "rooms")
    numbers = ranked(rooms.withColumn("_all", F.lit(0)), "_all", "_number").select("_number", "sequence_id")
    small = with_places(small, plan.small, "_rank", "_number").join(numbers, "_number", "left")
    small = small.withColumn("sequence_id", F.coalesce("sequence_id", "_number"))
    both = large.select(*columns, (F.col("sequence_id") + full).alias("sequence_id")).unionByName(
        small.select(*columns, (F.col("sequence_id") + full).alias("sequence_id"))
    )
    order = [F.col("length").desc(), "doc_id", "piece", "ids_crc32"]
    before = Window.partitionBy("sequence_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    shared = both.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint"))
    return whole.select(*columns, "sequence_id", F.lit(0).cast("bigint").alias("offset")).unionByName(shared)


def op12_linear_grouping_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return packed(pieces(read(spark, sf_dir, "documents"), path or vocabulary()))
