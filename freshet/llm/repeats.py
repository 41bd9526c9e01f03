"""Removal of repeated passages: a radix sort of text positions, only as deep as the threshold.

A window is a stretch of WINDOW bytes of one text. Sorting all suffixes of the corpus by their first WINDOW bytes puts
equal windows next to each other; the sort runs from the most significant digit, and whatever stands alone, or in one
document only, after a digit has been looked at cannot be repeated and leaves. Groups left at full depth are exactly the
windows that several documents share.

First digit. It is not the window's first bytes but its anchor, the GRAM-byte string inside it that comes first in a
fixed order of all such strings. Equal windows have the same anchor at the same place, and neighbouring windows mostly
share one, so one record stands for the windows of a whole run, about one for eighteen bytes. The order puts strings
that are frequent in a bounded sample of documents last; so it is rare strings that windows meet by. That sample
only moves work between groups and never changes a result.
  Each task sends an anchor's hash once for all of its documents; anchors that occur in one document only leave here.
Further digits. Runs of windows with a shared anchor meet by its hash, each distinct text of a run once per task, with
  the smallest document that has it. There the windows are grouped by their bytes, eight at a time, and groups of one
  document leave after each digit. What comes back to a run is a bit for each window that a smaller document has too.
  Copies within the same task need no answer: a smaller document with the very same run settles it. Runs of one anchor are
  told apart by 64 bits of a hash of their bytes.

A string shared by a third of all documents is one record per batch in both steps. Texts and records travel compressed.

Defined results: a null text is empty. Texts shorter than a window keep everything. Rows without an id neither lose
bytes nor cause others to. Rows with equal ids never remove from each other. Repeated rows get equal results. An empty
table gives an empty table. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import read
from freshet.llm.textbytes import mixed_bits, slices, span_hashes

WINDOW = 50
GRAM = 16
# Bytes of a text that are looked at together; a longer text is taken in overlapping parts.
PART = 1 << 18
SAMPLE_DOCS = 2048
# Text per bucket and per partition. Records of a bucket unpacked are a few times its text at most.
BUCKET_BYTES, PARTITION_BYTES = 1 << 22, 1 << 26
# Packed records that a task holds before they leave it.
PACKED_BYTES = 1 << 20
FREQUENT = 8
FREQUENT_BITS = 22

_SPREAD = mixed_bits(np.arange(1, 257, dtype=np.uint64))
_STEPS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_AT = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling; the last GRAM - 1 positions are left out."""
    h, width = _SPREAD[data], 1
    for step in _STEPS:
        h = h[:-width] * step + h[width:]
        h = h ^ (h >> np.uint64(31))
        width *= 2
    return h * _STEPS[0]


class Runs:
    """The runs of windows with one anchor in a stretch of concatenated texts.

    text: number of the text; start, stop: first and last window (as positions of their first bytes) of the run;
    anchor: position of the anchor; key: its hash.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, frequent: np.ndarray, window: int):
        wide = window - GRAM + 1
        empty = np.zeros(0, np.int64)
        self.text, self.start, self.stop, self.anchor, self.key = empty, empty, empty, empty, np.zeros(0, np.uint64)
        if len(data) < window:
            return
        h = gram_hashes(data)
        late = frequent[(h >> np.uint64(64 - FREQUENT_BITS)).astype(np.int64)]
        order = (h >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))
        low = (order & ~_AT) | np.arange(len(h), dtype=np.uint64)
        have = 1
        while have * 2 <= wide:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < wide:
            low = np.minimum(low[: -(wide - have)], low[wide - have :])
        at = (low & _AT).astype(np.int64)
        # Windows that reach into the next text are none.
        valid = np.ones(len(at), bool)
        for back in range(1, window):
            ends = offsets[1:-1] - back
            valid[ends[(ends >= 0) & (ends < len(at))]] = False
        fresh = valid.copy()
        fresh[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
        last = valid
        last[:-1] &= fresh[1:] | ~valid[1:]
        self.start, self.stop = np.flatnonzero(fresh), np.flatnonzero(last)
        self.anchor = at[self.start]
        self.key = h[self.anchor]
        self.text = np.searchsorted(offsets, self.start, "right") - 1


def parts(data: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, first text, first byte) of stretches of about PART bytes; a longer text in overlapping ones."""
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PART, "right")) - 1)
        low, high = int(offsets[row]), int(offsets[end])
        if high - low <= 2 * PART:
            yield data[low:high], offsets[row : end + 1] - low, row, low
        else:
            for at in range(low, high - window + 1, PART):
                stop = min(high, at + PART + window - 1)
                yield data[at:stop], np.array([0, stop - at]), row, at
        row = end


def _bytes_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of slices of the unpacked texts."""
    unpack = zstandard.ZstdDecompressor()
    for at in range(0, batch.num_rows, 512):
        packed = batch.column("packed")[at : at + 512]
        texts = [unpack.decompress(p.as_py()) for p in packed]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        yield at, np.frombuffer(b"".join(texts), np.uint8), offsets


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text")
        packed = pa.array([pack.compress((t.as_py() or "").encode()) for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed], ["doc_id", "packed"])


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, so that what is small or alike compresses well."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: type, count: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, count)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class Packed:
    """Records in the order of their keys, as one compressed value: keys, documents and small numbers, and bytes."""

    @staticmethod
    def of(key: np.ndarray, doc: np.ndarray, small: np.ndarray, data: bytes) -> bytes:
        docs, index = np.unique(doc, return_inverse=True)
        head = np.array([len(key), len(docs), small.shape[1]], np.int64)
        raw = b"".join(
            [
                head.tobytes(), _planes(np.diff(key, prepend=np.uint64(0))), docs.astype(np.int64).tobytes(),
                _planes(index.astype(np.uint32)), _planes(np.ascontiguousarray(small.astype(np.uint8))), data,
            ]
        )
        return zstandard.ZstdCompressor(level=3).compress(raw)

    @staticmethod
    def read(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        raw = memoryview(zstandard.ZstdDecompressor().decompress(packed))
        count, docs, width = np.frombuffer(raw[:24], np.int64)
        at = 24
        parts_ = []
        for size in (8 * count, 8 * docs, 4 * count, width * count):
            parts_.append(raw[at : at + size])
            at += size
        key = np.cumsum(_from_planes(parts_[0], np.uint64, count), dtype=np.uint64)
        doc = np.frombuffer(parts_[1], np.int64)[_from_planes(parts_[2], np.uint32, count)]
        small = np.frombuffer(parts_[3], np.uint8).reshape(count, width) if width else np.zeros((count, 0), np.uint8)
        return key, doc, small, np.frombuffer(raw[at:], np.uint8)


def _buckets(key: np.ndarray, count: int) -> np.ndarray:
    """Where each bucket's keys begin and end among sorted keys; buckets are equal ranges of the hash."""
    bucket = ((key >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(count + 1, dtype=np.uint64))


def _lists_by_doc(doc: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """One row per document: its id, and the values of each array in a list."""
    order = np.argsort(doc, kind="stable")
    start, _ = _bounds(doc[order])
    ends = pa.array(np.append(start, len(doc)).astype(np.int32))
    return [pa.array(doc[order][start]), *[pa.ListArray.from_arrays(ends, pa.array(v[order])) for v in values]]


def _filter_key(key: np.ndarray) -> np.ndarray:
    """32 bits of a key, enough to pick runs out of one document."""
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def _anchors(frequent: np.ndarray, window: int, buckets: int):
    """The anchors of a batch, each once with the smallest document that has it, packed by bucket; and, where several
    documents of the batch share one, rows (doc_id, keys) that say so."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            docs, keys = [], []
            for first, _, data, offsets in slices(batch.column("text")):
                for piece, cuts, row, _ in parts(data, offsets, window):
                    runs = Runs(piece, cuts, frequent, window)
                    docs.append(ids[first + row + runs.text])
                    keys.append(runs.key)
            if not keys:
                continue
            doc, key = np.concatenate(docs).astype(np.int64), np.concatenate(keys)
            order = np.lexsort((doc, key))
            doc, key = doc[order], key[order]
            keep = np.ones(len(key), bool)
            keep[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            doc, key = doc[keep], key[keep]
            lead = np.ones(len(key), bool)
            lead[1:] = key[1:] != key[:-1]
            many = ~lead
            many[:-1] |= ~lead[1:]
            lead_key, lead_doc = key[lead], doc[lead]
            cut = _buckets(lead_key, buckets)
            full = np.flatnonzero(cut[1:] > cut[:-1])
            none = np.zeros((len(lead_key), 0), np.uint8)
            packed = (
                Packed.of(lead_key[cut[b] : cut[b + 1]], lead_doc[cut[b] : cut[b + 1]], none[cut[b] : cut[b + 1]], b"") for b in full
            )
            yield from _two_kinds(full, packed, _lists_by_doc(doc[many], _filter_key(key[many])), ["keys"], pa.int32(), buckets)

    return find


def _two_kinds(
    full: np.ndarray, packed: Iterator[bytes], lists: list[pa.Array], names: list[str], kind: pa.DataType, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, packed, doc_id, lists): packed records for their buckets, about PACKED_BYTES of them at a time, and
    lists of documents, spread evenly."""
    columns = ["bucket", "packed", "doc_id", *names]
    held, size, at = [], 0, 0
    for n, value in enumerate(packed, 1):
        held.append(value)
        size += len(value)
        if size >= PACKED_BYTES or n == len(full):
            nothing = [pa.nulls(n - at, pa.list_(kind)) for _ in names]
            some = [pa.array(full[at:n].astype(np.int32)), pa.array(held, pa.binary()), pa.nulls(n - at, pa.int64())]
            held, size, at = [], 0, n
            yield pa.RecordBatch.from_arrays([*some, *nothing], columns)
    n = len(lists[0])
    spread = (mixed_bits(lists[0].to_numpy().astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(spread), pa.nulls(n, pa.binary()), *lists], columns)


def _by_bucket(batches: Iterator[pa.RecordBatch], ready) -> Iterator[pa.RecordBatch | list[bytes]]:
    """What `ready` makes of the rows that are done, and the packed records of each bucket. Rows come in the order of
    buckets, so that one bucket at a time is held, packed, and no other."""
    bucket, held = None, []
    for batch in batches:
        done = batch.filter(pc.is_null(batch.column("packed")))
        if done.num_rows:
            yield ready(done)
        rest = batch.filter(pc.is_valid(batch.column("packed")))
        for number, value in zip(rest.column("bucket"), rest.column("packed"), strict=True):
            if number.as_py() != bucket and held:
                yield held
                held = []
            bucket = number.as_py()
            held.append(value.as_py())
    if held:
        yield held


def _unpacked(held: list[bytes]) -> list[np.ndarray]:
    """Records of a bucket: keys, documents, small numbers, bytes. The packed form is given up on the way."""
    found = []
    while held:
        found.append(Packed.read(held.pop()))
    return [np.concatenate([f[i] for f in found]) for i in range(4)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, key): the anchors of these buckets that several documents have, once for each of them."""

    def ready(done: pa.RecordBatch) -> pa.RecordBatch:
        doc, values = _spelled_out(done, "keys")
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(values)], ["doc_id", "key"])

    for found in _by_bucket(batches, ready):
        if isinstance(found, pa.RecordBatch):
            yield found
            continue
        key, doc, _, _ = _unpacked(found)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        start, stop = _bounds(key)
        several = np.repeat(np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start), stop - start)
        yield from _rows(["doc_id", "key"], doc[several], _filter_key(key[several]))


def _spelled_out(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The document of each list's values, and the values."""
    offsets, values = _list_rows(batch.column(column))
    return np.repeat(batch.column("doc_id").to_numpy(), np.diff(offsets)), values


def _rows(names: list[str], *columns: np.ndarray, size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + size]) for c in columns], names)


def _list_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a list array whose nulls count as empty."""
    sizes = np.array(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), column.flatten().to_numpy(zero_copy_only=False)


def _places(rows: np.ndarray, wanted: np.ndarray, list_offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each wanted value its place in `values` within the list of its row, or -1. Lists are sorted, rows in order."""
    found = np.full(len(rows), -1, np.int64)
    for at, stop in zip(*_bounds(rows), strict=True):
        low, high = list_offsets[rows[at]], list_offsets[rows[at] + 1]
        if low < high:
            place = np.minimum(np.searchsorted(values[low:high], wanted[at:stop]), high - low - 1) + low
            found[at:stop] = np.where(values[place] == wanted[at:stop], place, -1)
    return found


def _bounds(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each group of equal values begins and ends."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return first, np.append(first[1:], len(sorted_values))


def _sorted_lists(offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists with their values sorted, and the order that does it."""
    order = np.lexsort((values, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))))
    return values[order], order


def _stretches(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> bytes:
    """The stretches of `flat` one after the other."""
    length = length.astype(np.int64)
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return flat[np.repeat(begin, length) + inside].tobytes()


def _contents(frequent: np.ndarray, window: int, buckets: int):
    """The runs with a repeated anchor, each once per batch for the smallest document with the same bytes, packed by
    bucket; and rows (doc_id, full) of the runs that a smaller document of the batch has too."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            lists, values = _list_rows(batch.column("keys"))
            values, _ = _sorted_lists(lists, values)
            key, doc, content, small, begin, flat = [], [], [], [], [], bytearray()
            for first, data, offsets in _bytes_of(batch):
                for piece, cuts, row, low in parts(data, offsets, window):
                    runs = Runs(piece, cuts, frequent, window)
                    rows = first + row + runs.text
                    take = np.flatnonzero(_places(rows, _filter_key(runs.key), lists, values) >= 0)
                    start, stop = runs.start[take], runs.stop[take] + window
                    key.append(runs.key[take])
                    doc.append(ids[rows[take]].astype(np.int64))
                    content.append(span_hashes(piece, start, stop, longest=2 * window))
                    small.append(np.column_stack([runs.anchor[take] - start, stop - start]).astype(np.uint8))
                    begin.append(start + (len(flat) + low))
                flat.extend(memoryview(data))
            if not key or not sum(map(len, key)):
                continue
            key, doc, content, small, begin = (np.concatenate(x) for x in (key, doc, content, small, begin))
            flat = np.frombuffer(flat, np.uint8)
            order = np.lexsort((doc, content, key))
            key, doc, content, small, begin = key[order], doc[order], content[order], small[order], begin[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
            lead = np.flatnonzero(new)
            later = doc != np.repeat(doc[lead], np.diff(np.append(lead, len(key))))
            cut = _buckets(key[lead], buckets)
            full = np.flatnonzero(cut[1:] > cut[:-1])
            of = (lead[cut[b] : cut[b + 1]] for b in full)
            packed = (Packed.of(key[at], doc[at], small[at], _stretches(flat, begin[at], small[at, 1])) for at in of)
            yield from _two_kinds(
                full, packed, _lists_by_doc(doc[later], content[later].view(np.int64)), ["full"], pa.int64(), buckets
            )

    return find


def _digits(flat: np.ndarray, at: np.ndarray, first: int, window: int) -> np.ndarray:
    """Bytes first .. first + 7 of the windows at the places `at` of a flat array, as numbers."""
    digit = np.zeros(len(at), np.uint64)
    for j in range(first, min(first + 8, window)):
        digit = (digit << np.uint64(8)) | flat[at + j]
    return digit


def repeated_bits(
    key: np.ndarray, doc: np.ndarray, before: np.ndarray, begins: np.ndarray, lengths: np.ndarray, flat: np.ndarray, window: int
) -> np.ndarray:
    """For each run, a bit per window (lowest first) that some run of a smaller document has too.

    `key` is the anchor's hash, in order; `before` the bytes of a run before its anchor; its bytes are those of `flat`
    from `begins`. Equal windows have the same key and the same distance from their first byte to the anchor.
    """
    bits = np.zeros(len(key), np.int64)
    start, stop = _bounds(key)
    group = np.repeat(np.arange(len(start)), stop - start)
    # A run whose anchor no other run has is left out before its windows are spelled out.
    meets = np.flatnonzero(np.repeat(stop - start > 1, stop - start))
    windows = lengths[meets] - window + 1
    run = np.repeat(meets, windows)
    number = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
    group = group[run] * (2 * window) + before[run] - number
    order = np.argsort(group, kind="stable")
    run, number, group = run[order], number[order], group[order]
    for first in range(0, window + 8, 8):
        # Groups of one document leave; after the last digit, those left are repeated windows.
        start, stop = _bounds(group)
        if not len(start):
            return bits
        owner = doc[run]
        low = np.minimum.reduceat(owner, start)
        stays = np.repeat(np.maximum.reduceat(owner, start) != low, stop - start)
        later = stays & (owner != np.repeat(low, stop - start))
        if first >= window:
            np.bitwise_or.at(bits, run[later], np.int64(1) << number[later])
            return bits
        run, number, group = run[stays], number[stays], group[stays]
        digit = _digits(flat, begins[run] + number, first, window)
        order = np.lexsort((digit, group))
        run, number, group, digit = run[order], number[order], group[order], digit[order]
        fresh = np.ones(len(group), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.cumsum(fresh)
    return bits


# Runs whose windows are sorted together in a task.
RUNS_AT_ONCE = 1 << 14


def _answers(window: int):
    """(doc_id, content, bits): the content hash of each document's runs of which windows are repeated; bits are null if
    all are."""

    def ready(done: pa.RecordBatch) -> pa.RecordBatch:
        doc, values = _spelled_out(done, "full")
        none = pa.nulls(len(doc), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(values), none], ["doc_id", "content", "bits"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _by_bucket(batches, ready):
            if isinstance(found, pa.RecordBatch):
                yield found
                continue
            key, doc, small, flat = _unpacked(found)
            before, lengths = small[:, 0].astype(np.int64), small[:, 1].astype(np.int64)
            begins = np.cumsum(lengths) - lengths
            order = np.argsort(key, kind="stable")
            in_order, at = key[order], 0
            while at < len(order):
                # Whole groups of a key, about RUNS_AT_ONCE runs.
                stop = min(len(order), at + RUNS_AT_ONCE)
                stop = int(np.searchsorted(in_order, in_order[stop - 1], "right"))
                yield _answered(*(x[order[at:stop]] for x in (key, doc, before, begins, lengths)), flat, window)
                at = stop

    return find


def _answered(
    key: np.ndarray, doc: np.ndarray, before: np.ndarray, begins: np.ndarray, lengths: np.ndarray, flat: np.ndarray, window: int
) -> pa.RecordBatch:
    content = span_hashes(flat, begins, begins + lengths, longest=2 * window)
    order = np.lexsort((doc, content, key))
    key, doc, content, before, begins, lengths = (x[order] for x in (key, doc, content, before, begins, lengths))
    # Of the runs with the same bytes the smallest document stands for all; the others lose every window.
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    lead = np.flatnonzero(new)
    leader = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(key))))
    own = repeated_bits(key[lead], doc[lead], before[lead], begins[lead], lengths[lead], flat, window)
    later = doc != doc[lead][leader]
    every = (np.int64(1) << (lengths - window + 1)) - 1
    bits = np.where(later, every, own[leader])
    some = np.flatnonzero(bits)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[some]), pa.array(content[some].view(np.int64)), pa.array(bits[some], mask=bits[some] == every[some])],
        ["doc_id", "content", "bits"],
    )


def _removed(frequent: np.ndarray, window: int):
    """doc_id, n_bytes, spans, kept: the stretches (start, end, in turn) to be removed from a text, and what remains."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full_of, full = _list_rows(batch.column("full"))
            part_of, part = _list_rows(batch.column("part"))
            full, _ = _sorted_lists(full_of, full)
            part, order = _sorted_lists(part_of, part)
            bits = _list_rows(batch.column("bits"))[1][order]
            for first, data, offsets in _bytes_of(batch):
                covered = np.zeros(len(data) + 1, np.int32)
                n = len(offsets) - 1
                if full_of[first] < full_of[first + n] or part_of[first] < part_of[first + n]:
                    for piece, cuts, row, low in parts(data, offsets, window):
                        runs = Runs(piece, cuts, frequent, window)
                        text = first + row + runs.text
                        content = span_hashes(piece, runs.start, runs.stop + window, longest=2 * window).view(np.int64)
                        whole = _places(text, content, full_of, full) >= 0
                        # Starts are all different, and so are ends.
                        covered[runs.start[whole] + low] += 1
                        covered[runs.stop[whole] + low + window] -= 1
                        place = _places(text, content, part_of, part)
                        for r in np.flatnonzero((place >= 0) & ~whole):
                            count = int(runs.stop[r] - runs.start[r] + 1)
                            on = np.flatnonzero((int(bits[place[r]]) >> np.arange(count)) & 1) + runs.start[r] + low
                            covered[on] += 1
                            covered[on + window] -= 1
                inside = np.cumsum(covered[:-1]) > 0
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                begin, end = inside.copy(), inside.copy()
                begin[1:] &= ~inside[:-1] | edge[1:-1]
                if len(data) > 1:
                    end[:-1] &= ~inside[1:] | edge[1:-1]
                begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
                owner = np.searchsorted(offsets, begin, "right") - 1
                of = np.searchsorted(owner, np.arange(n + 1))
                spans = [
                    np.column_stack([begin[of[i] : of[i + 1]], end[of[i] : of[i + 1]]]).ravel() - offsets[i] for i in range(n)
                ]
                kept = [kept_bytes(data[offsets[i] : offsets[i + 1]].tobytes(), spans[i].tolist()) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[first : first + n], pa.array(np.diff(offsets)),
                        pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "spans", "kept"],
                )

    return find


def frequent_grams(docs: DataFrame, window: int) -> np.ndarray:
    """A table by leading hash bits of the strings that many documents of a bounded sample have.

    It only sets the order in which anchors are preferred. At most SAMPLE_DOCS rows, those with the smallest hashes of
    their ids, come to the driver, as lists of hash bits of which each holds at most 2 ** FREQUENT_BITS.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << FREQUENT_BITS, np.int32)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    if b - a >= window:
                        own = gram_hashes(data[a:b]) >> np.uint64(64 - FREQUENT_BITS)
                        count[np.unique(own).astype(np.int64)] += 1
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], ["bit", "n"])

    chosen = docs.select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string"))).limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(chosen.distinct()), "doc_id")
    found = sample.mapInArrow(bits, "bit bigint, n int").groupBy("bit").agg(F.sum("n").alias("n"))
    table = np.zeros(1 << FREQUENT_BITS, bool)
    table[found.where(F.col("n") >= FREQUENT).select("bit").toArrow()["bit"].to_numpy()] = True
    return table


def with_spans(docs: DataFrame, window: int = WINDOW, bucket_bytes: int | None = None) -> DataFrame:
    """doc_id, n_bytes, spans and kept of every row: the stretches, as start, end, start, end, that smaller documents
    have too, and the bytes without them."""
    if not GRAM < window <= GRAM + 48:
        raise ValueError(f"a window has {GRAM + 1} to {GRAM + 48} bytes")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = texts.where("doc_id is not null")
    frequent = frequent_grams(named, window)
    # As many buckets as the bytes of the table ask for, since a task holds one at a time; and more than partitions, so
    # that these get about as many each. Their number is stated: adaptive execution would merge partitions by their
    # packed size.
    size = named.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    buckets = max(4 * partitions, -(-size // (bucket_bytes or BUCKET_BYTES)))
    found = named.mapInArrow(
        _anchors(frequent, window, buckets), "bucket int, packed binary, doc_id bigint, keys array<int>"
    )
    shared = found.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared, "doc_id bigint, key int")
    lists = shared.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    # Both joins below read these rows in the same form, so that texts are shuffled once.
    packed = named.mapInArrow(_pack, "doc_id bigint, packed binary").where("doc_id is not null")
    runs = packed.join(lists, "doc_id").mapInArrow(
        _contents(frequent, window, buckets), "bucket int, packed binary, doc_id bigint, full array<bigint>"
    )
    answers = (
        runs.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_answers(window), "doc_id bigint, content bigint, bits bigint")
        .groupBy("doc_id")
        .agg(
            F.collect_list(F.when(F.col("bits").isNull(), F.col("content"))).alias("full"),
            F.collect_list(F.when(F.col("bits").isNotNull(), F.col("content"))).alias("part"),
            F.collect_list("bits").alias("bits"),
        )
    )
    found = packed.join(answers, "doc_id", "left").mapInArrow(
        _removed(frequent, window), "doc_id bigint, n_bytes bigint, spans array<bigint>, kept binary"
    )
    nameless = texts.where("doc_id is null").select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        F.array().cast("array<bigint>").alias("spans"),
        F.coalesce("text", F.lit("")).cast("binary").alias("kept"),
    )
    return found.unionByName(nameless)


def kept_bytes(text: bytes, spans: list[int]) -> bytes:
    """The text without its spans."""
    out, at = [], 0
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def digests(found: DataFrame) -> DataFrame:
    """What is left of each text, as counts and a hash."""
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        (F.size("spans") / 2).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_depth_limited_radix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(with_spans(read(spark, sf_dir, "documents")))
