"""Near-duplicate detection by MinHash bands and odd sketches.

A text is the set of its shingles of `words` words (lower-cased A-Z). From MinHash samples of the set come two things:
band keys, which say what to compare, and the odd sketch: every sample flips one bit of a bitmap, so the population
count of the XOR of two bitmaps tells the number of samples that differ. In a bitmap of n bits and k samples, d set bits
of the XOR stand for a similarity of 1 + n ln(1 - 2 d / n) / (2 k). It is sharpest for similar sets, which is what a
candidate check needs. A sketch is a handful of words of the row, compared without Python. A second odd sketch takes in the whole
set: of two such bitmaps, the set bits of the XOR are at most as many as the shingles that differ, and close to it, so
pairs short of the threshold are told apart with hardly any of them left for the full check.

Steps, all joins on spread keys:
1. Texts with the same set become one class, its smallest id.
2. Each class is compared with the smallest and the largest id of each of its buckets (a bucket is a band and its key),
   not with all others: two pairs at most per class and band, however large a bucket is. A pair goes on if its set
   sizes and its odd sketches allow the threshold, and is then decided on the full sets of both texts.
   The likeliest pair of each class is decided first; pairs that this connects already need not be decided.
3. In buckets that still hold several components, members outside the largest component meet the rest in the same way.
So every pair that shares a band is decided, or is connected without it. The bands are so many that a pair at the
threshold shares none with a probability of at most MISS; the sketches reject such a pair as rarely.

Defined results: a null text or one without words has the empty set and is linked with nothing. A text with fewer words
than a shingle has one shingle, the whole sequence. Rows without an id are kept and linked with nothing. Rows that share
an id are one document, linked by any of their texts. Repeated rows get equal results. Columns of the input are kept;
the added columns replace those of the same names. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import read, written
from freshet.llm.components import components
from freshet.llm.textbytes import LOWER, mixed_bits, slices, span_hashes, word_spans

ROWS = 4
MISS = 1e-7
SKETCH_LONGS = 4
WHOLE_LONGS = 32
SEED = 0x0DD5E7C4


def band_count(percent: int, rows: int = ROWS) -> int:
    """Bands of `rows` samples so that a pair of `percent` similarity shares none with probability at most MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def most_odd_bits(percent: int, samples: int, bits: int = 64 * SKETCH_LONGS) -> int:
    """Set bits of the XOR that a pair of `percent` similarity exceeds with probability at most about MISS.

    Differing samples flip two bits each. Their number is binomial; the bits set by as many flips follow, with a spread
    below that of independent bits. Both tails are taken at 5.2 standard deviations and together.
    """
    differ = 1 - percent / 100
    most = min(samples, samples * differ + 5.2 * math.sqrt(samples * differ * (1 - differ)))
    share = (1 - math.exp(-4 * most / bits)) / 2
    return math.ceil(bits * share + 5.2 * math.sqrt(bits * share * (1 - share)) * 0.5)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of a slice, in order of both."""
    starts, ends, of = word_spans(data, offsets)
    hashes = span_hashes(LOWER[data], starts, ends)
    n = len(offsets) - 1
    count = np.bincount(of, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    # Words from here to the end of the text; a shingle starts where enough are left, or at the first word.
    left = count[of] - (np.arange(len(of)) - first[of])
    at = np.flatnonzero((left >= words) | (left == count[of]))
    out = np.full(len(at), SEED, np.uint64)
    for j in range(words):
        there = left[at] > j
        word = np.where(there, hashes[np.minimum(at + j, len(hashes) - 1)], np.uint64(j)) if len(hashes) else out
        out = mixed_bits(out * np.uint64(0x9E3779B97F4A7C15) + word)
    order = np.lexsort((out, of[at]))
    text, value = of[at][order], out[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def _sketcher(words: int, bands: int):
    random = np.random.default_rng(SEED)
    factors = random.integers(1, 1 << 63, bands * ROWS, dtype=np.uint64) | np.uint64(1)
    bits = 64 * SKETCH_LONGS

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in slices(batch.column("text")):
                n = end - start
                text, value = shingles(data, offsets, words)
                size = np.bincount(text, minlength=n)
                has = np.flatnonzero(size)
                first = np.concatenate([[0], np.cumsum(size)])[:-1][has]
                low = np.zeros((len(has), bands * ROWS), np.uint64)
                set_key = np.zeros((len(has), 2), np.uint64)
                if len(has):
                    for i, factor in enumerate(factors):
                        x = value * factor
                        low[:, i] = np.minimum.reduceat(x ^ (x >> np.uint64(29)), first)
                    set_key[:, 0] = np.add.reduceat(mixed_bits(value ^ np.uint64(SEED)), first)
                    set_key[:, 1] = np.add.reduceat(mixed_bits(value + np.uint64(SEED)), first)
                low = mixed_bits(low + np.arange(bands * ROWS, dtype=np.uint64))
                odd = np.zeros((len(has), bits), np.uint8)
                for i in range(bands * ROWS):
                    odd[np.arange(len(has)), (low[:, i] % np.uint64(bits)).astype(np.int64)] ^= 1
                odd = np.packbits(odd, axis=1, bitorder="little").view(np.int64)
                wide = 64 * WHOLE_LONGS
                bit = (mixed_bits(value * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(wide)).astype(np.int64)
                whole = (np.bincount(text * wide + bit, minlength=n * wide).reshape(n, wide)[has] & 1).astype(np.uint8)
                whole = np.packbits(whole, axis=1, bitorder="little").view(np.int64)
                keys = np.zeros((len(has), bands), np.uint64)
                for r in range(ROWS):
                    keys = mixed_bits(keys * np.uint64(0x9E3779B97F4A7C15) + low[:, r::ROWS])
                place = np.full(n, -1)
                place[has] = np.arange(len(has))
                none = place < 0

                def lists(values: np.ndarray, place=place, none=none) -> pa.Array:
                    width = values.shape[1]
                    ends = np.concatenate([[0], np.cumsum(np.where(none, 0, width))]).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64).ravel()))

                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[start:end],
                        pa.array(size.astype(np.int64)),
                        lists(set_key),
                        lists(keys),
                        lists(odd),
                        lists(whole),
                    ],
                    ["doc_id", "n_shingles", "set_key", "bands", "odd", "whole"],
                )

    return sketch


def sketches(docs: DataFrame, words: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits that stand for the set), band keys and odd sketch; one map over the texts."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _sketcher(words, bands),
        "doc_id bigint, n_shingles bigint, set_key array<bigint>, bands array<bigint>, odd array<bigint>, whole array<bigint>",
    )


def _decider(words: int, percent: int):
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            both = pa.concat_arrays([batch.column("text_a").cast(pa.large_string()), batch.column("text_b").cast(pa.large_string())])
            step = 256
            for at in range(0, batch.num_rows, step):
                n = min(step, batch.num_rows - at)
                pair = pa.concat_arrays([both[at : at + n], both[batch.num_rows + at : batch.num_rows + at + n]])
                text, value = [], []
                for start, _, data, offsets in slices(pair):
                    t, v = shingles(data, offsets, words)
                    text.append(t + start)
                    value.append(v)
                text, value = np.concatenate(text), np.concatenate(value)
                size = np.bincount(text, minlength=2 * n)
                order = np.lexsort((value, text % n))
                p, v = (text % n)[order], value[order]
                same = (p[1:] == p[:-1]) & (v[1:] == v[:-1])
                shared = np.bincount(p[1:][same], minlength=n)
                linked[at : at + n] = 100 * shared >= percent * (size[:n] + size[n:] - shared)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(linked)), batch.column("b").filter(pa.array(linked))], ["a", "b"]
            )

    return decide


def decided(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of documents whose full shingle sets reach the similarity.

    b's text is sought first: pairs are few per b, whereas one a may have very many, so that each text travels about
    once. A hot a is split by the join.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with_b = pairs.select("a", "b").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_decider(words, percent), "a bigint, b bigint")


def _likely(percent: int, most: int) -> Column:
    """Whether set sizes and odd sketches of the sides a and b (columns n_, odd_, whole_) allow the similarity.

    Sets of s elements in all reach it when at most s (100 - p) / (100 + p) differ. As many set bits, or the expected
    number and six standard deviations if that is less, is what the whole sets' sketches may show.
    """
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    differ = (F.col("n_a") + F.col("n_b")) * ((100 - percent) / (100 + percent))
    bits = 64 * WHOLE_LONGS
    expected = (1 - F.exp(differ * (-2 / bits))) * (bits / 2)
    spread = F.sqrt((1 - F.exp(differ * (-4 / bits))) * (bits / 4))
    # A loop over the array: spelled out, so many terms would make one huge method of the join's code.
    ones = F.zip_with("whole_a", "whole_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    whole = F.aggregate(ones, F.lit(0), lambda a, b: a + b) <= F.least(differ, expected + spread * 6)
    return sizes & (odd_bits("odd_a", "odd_b") <= most) & whole


def odd_bits(odd_a: str, odd_b: str) -> Column:
    """Population count of the XOR of two odd sketches."""
    counts = [F.bit_count(F.element_at(odd_a, i + 1).bitwiseXOR(F.element_at(odd_b, i + 1))) for i in range(SKETCH_LONGS)]
    return sum(counts[1:], counts[0])


def _side(sketch: DataFrame, side: str) -> DataFrame:
    return sketch.select(F.col("rep").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "odd", "whole")])


def classes_of(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs`; component_id is null for rows without an id."""
    bands = band_count(percent)
    most = most_odd_bits(percent, bands * ROWS)
    rows = written(sketches(docs, words, bands), "sketches")
    named = rows.where("doc_id is not null and n_shingles > 0")
    sets = written(
        named.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("odd").alias("odd"),
            F.any_value("whole").alias("whole"),
            F.any_value("bands").alias("bands"),
        ),
        "sets",
    )
    sketch = sets.select("rep", "n", "odd", "whole")
    member = sets.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = written(
        member.groupBy("band", "key")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .where("low <> high"),
        "buckets",
    )
    meeting = member.join(buckets, ["band", "key"]).select(
        F.col("rep").alias("b"), F.explode(F.array_distinct(F.array("low", "high"))).alias("a")
    )
    pairs = meeting.where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    likely = written(
        pairs.join(_side(sketch, "b"), "b")
        .join(_side(sketch, "a"), "a")
        .where(_likely(percent, most))
        .select("a", "b", odd_bits("odd_a", "odd_b").alias("odd")),
        "likely",
    )
    # The likeliest partner of each class first.
    best = likely.groupBy("b").agg(F.min_by("a", F.struct("odd", "a")).alias("a"))
    linked = written(decided(best, docs, words, percent), "linked")
    # Where that leads, followed twice; pairs on the way are connected whatever their own similarity.
    one = linked.groupBy("b").agg(F.min("a").alias("to")).withColumnRenamed("b", "node")
    two = written(
        one.join(one.select(F.col("node").alias("to"), F.col("to").alias("far")), "to", "left").select(
            "node", F.coalesce("far", "to").alias("to")
        ),
        "followed",
    )

    def towards(pairs: DataFrame, end: str) -> DataFrame:
        joined = pairs.join(two.select(F.col("node").alias(end), F.col("to").alias(f"_{end}")), end, "left")
        return joined.withColumn(f"_{end}", F.coalesce(f"_{end}", end))

    open_pairs = towards(towards(likely.join(best, ["a", "b"], "left_anti"), "b"), "a").where(
        "_a <> _b and _a <> b and _b <> a"
    )
    # A pair may stand both ways.
    open_pairs = open_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = written(decided(open_pairs, docs, words, percent), "linked")
    # A document with several texts of different sets connects their classes.
    several = named.groupBy("doc_id").agg(F.count_distinct("set_key").alias("k")).where("k > 1").select("doc_id")
    own = (
        named.join(several, "doc_id")
        .join(sets.select("set_key", "rep"), "set_key")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    labels = components(linked.unionByName(more).unionByName(own))
    labels = _across(docs, member, buckets, sketch, likely, labels, words, percent, most)
    found = (
        named.select("doc_id", "set_key")
        .join(sets.select("set_key", "rep"), "set_key")
        .groupBy("doc_id")
        .agg(F.min("rep").alias("node"))
    )
    final = found.join(labels, "node", "left").select("doc_id", F.least("node", F.coalesce("label", "node")).alias("_label"))
    return rows.select("doc_id", "n_shingles").join(final, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("_label", "doc_id").alias("component_id")
    )


def _across(
    docs: DataFrame, member: DataFrame, buckets: DataFrame, sketch: DataFrame, likely: DataFrame, labels: DataFrame,
    words: int, percent: int, most: int,
) -> DataFrame:
    """`labels` after deciding the pairs left in buckets that hold several components."""
    full = (
        member.join(buckets.select("band", "key"), ["band", "key"])
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("band", "key", "rep", F.coalesce("label", "rep").alias("label"))
    )
    full = written(full, "members")
    parts = full.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("size"))
    # Two members alone have met already.
    largest = (
        parts.groupBy("band", "key")
        .agg(
            F.max(F.struct("size", "label"))["label"].alias("largest"),
            F.count(F.lit(1)).alias("parts"),
            F.sum("size").alias("members"),
        )
        .where("parts > 1 and members > 2")
    )
    largest = written(largest.select("band", "key", "largest"), "mixed")
    mixed = (
        full.join(largest, ["band", "key"])
        .join(sketch, "rep")
        .select("band", "key", "rep", "label", "n", "odd", "whole", (F.col("label") == F.col("largest")).alias("main"))
    )
    mixed = written(mixed, "mixed")
    few = mixed.where("not main").select(
        F.col("band").alias("_band"), F.col("key").alias("_key"), F.col("rep").alias("a"), F.col("label").alias("la"),
        F.col("n").alias("n_a"), F.col("odd").alias("odd_a"), F.col("whole").alias("whole_a"),
    )
    rest = mixed.select(
        "band", "key", F.col("rep").alias("b"), F.col("label").alias("lb"), F.col("n").alias("n_b"),
        F.col("odd").alias("odd_b"), F.col("whole").alias("whole_b"), "main",
    )
    met = few.join(
        rest,
        (F.col("_band") == F.col("band")) & (F.col("_key") == F.col("key")) & (F.col("la") != F.col("lb"))
        & (F.col("main") | (F.col("a") < F.col("b")))
        & _likely(percent, most),
    )
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "la", "lb").groupBy("a", "b").agg(
        F.min("la").alias("la"), F.min("lb").alias("lb")
    )
    known = likely.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = written(pairs.join(known, ["a", "b"], "left_anti"), "across")
    new = written(decided(pairs, docs, words, percent).join(pairs, ["a", "b"]), "linked")
    if not new.limit(1).count():
        return labels
    joined = components(new.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    moved = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("_to")), "label", "left")
    moved = moved.select("node", F.coalesce("_to", "label").alias("label"))
    return written(moved.unionByName(joined.join(labels, "node", "left_anti").select("node", "label")), "labels")


def grouped(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with n_shingles, component_id and kept; one id of each component is kept, the smallest."""
    found = classes_of(docs, words, percent).groupBy("doc_id").agg(
        F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id")
    )
    plain = docs.drop("n_shingles", "component_id", "kept")
    joined = plain.join(found.where("doc_id is not null"), "doc_id", "left")
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes_of(read(spark, sf_dir, "documents"), words=3, percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
