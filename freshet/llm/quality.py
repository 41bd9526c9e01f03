"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector x. Its score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

The last term equals the sum of <v_i, v_j> x_i x_j over all pairs of features, in time linear in their number.

Features: the words of the text, lower-cased and hashed into BUCKETS columns, each with 1 + ln(count), scaled to length
1; statistics of the text's structure; numbers given as metadata columns, as ln(1 + |x|). Statistics and metadata are
standardized by the training rows and cut off at +-4.

The machine is fitted on the driver, on at most MAX_TRAIN labelled rows, those with the smallest hashes of their ids:
the bound makes the sample the same small amount of work at any size of the corpus. Scoring is a map over documents.

Defined results: a null text is an empty one; it has no words, all its statistics are 0, and it gets a score like any
other. Missing and non-finite metadata count as 0 and set a feature of its own. Without any labelled row the score is
0.5 for all; with labels of one kind only it is near that kind. Repeated rows get equal scores. Columns of the input are
kept; `score` replaces a column of that name. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import read
from freshet.llm.textbytes import LOWER, slices, span_hashes, word_spans

BUCKETS = 1 << 14
FACTORS = 8
MAX_TRAIN = 4096
EPOCHS = 6
BATCH = 64
RATE = 0.1
DECAY = 1e-4
SEED = 11
FOLDS = 5
THRESHOLD = 0.3

# Kinds of bytes whose shares are structure statistics.
KINDS = ("other", "upper", "lower", "digit", "blank", "newline", "stop", "bang", "symbol", "bar", "high")
KIND = np.zeros(256, np.int64)
for _name, _bytes in (
    ("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)), ("blank", b" \t\v\f\r"), ("newline", b"\n"),
    ("stop", b".,;:'\"()-?"), ("bang", b"!"), ("symbol", b"#$%&*@^~+=<>/\\_{}[]`"), ("bar", b"|"), ("high", range(128, 256)),
):
    KIND[list(_bytes)] = KINDS.index(_name)
WORD_STATS = ("length", "words", "distinct", "single", "capital", "shout", "ends_odd", "repeat")
N_STATS = len(KINDS) + len(WORD_STATS)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the hashed words of a slice, in row order, and its statistics (one row per text)."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    per = np.maximum(size, 1)[:, None]
    text = np.repeat(np.arange(n), size)
    kinds = np.bincount(text * len(KINDS) + KIND[data], minlength=n * len(KINDS)).reshape(n, len(KINDS))
    starts, ends, of = word_spans(data, offsets)
    words = np.bincount(of, minlength=n)
    each = np.maximum(words, 1)
    bucket = (span_hashes(LOWER[data], starts, ends) >> np.uint64(64 - 14)).astype(np.int64)
    keys, counts = np.unique(of * BUCKETS + bucket, return_counts=True)
    row, column = keys // BUCKETS, keys % BUCKETS
    value = 1 + np.log(counts)
    value /= np.sqrt(np.bincount(row, value * value, minlength=n))[row]
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & (text[1:] == text[:-1])
    length = ends - starts
    first, last = KIND[data[starts]], KIND[data[ends - 1]]
    odd = np.isin(last, [KINDS.index(k) for k in ("bang", "symbol", "bar", "other")])
    capital = first == KINDS.index("upper")
    stats = np.column_stack(
        [
            kinds / per,
            np.bincount(of, length, minlength=n) / each,
            np.log1p(words),
            np.bincount(row, minlength=n) / each,
            np.bincount(of, length == 1, minlength=n) / each,
            np.bincount(of, capital, minlength=n) / each,
            np.bincount(of, capital & (last == first) & (length > 1), minlength=n) / each,
            np.bincount(of, odd, minlength=n) / each,
            np.bincount(text, same, minlength=n) / per[:, 0],
        ]
    )
    return row, column, value, stats


def _metadata(columns: list[pa.Array], rows: int) -> np.ndarray:
    """ln(1 + |x|) of each column and whether it is missing."""
    found = []
    for c in columns:
        x = np.array(c.cast(pa.float64()).to_numpy(zero_copy_only=False), float)
        missing = ~np.isfinite(x)
        x[missing] = 0
        found += [np.log1p(np.abs(x)), missing.astype(float)]
    return np.column_stack(found) if found else np.zeros((rows, 0))


@dataclass
class Machine:
    """Weights of the features: the buckets first, then statistics and metadata."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4)

    def raw(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic, and the sums over v x that they need."""
        n = len(dense)
        wd, vd = self.w[BUCKETS:], self.v[BUCKETS:]
        linear = self.w0 + dense @ wd + np.bincount(row, self.w[column] * value, minlength=n)
        sums = dense @ vd
        squares = (dense**2) @ (vd**2)
        for f in range(self.v.shape[1]):
            vx = self.v[column, f] * value
            sums[:, f] += np.bincount(row, vx, minlength=n)
            squares[:, f] += np.bincount(row, vx * vx, minlength=n)
        return linear + 0.5 * (sums**2 - squares).sum(1), sums

    def score(self, texts: pa.Array, metadata: list[pa.Array]) -> np.ndarray:
        out = np.zeros(len(texts))
        meta = _metadata(metadata, len(texts))
        for start, end, data, offsets in slices(texts):
            row, column, value, stats = _features(data, offsets)
            raw, _ = self.raw(row, column, value, self.dense(np.column_stack([stats, meta[start:end]])))
            out[start:end] = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return out


def fit(texts: pa.Array, metadata: list[pa.Array], labels: np.ndarray) -> Machine:
    """A machine fitted by minibatch gradient steps with a step size of its own for every weight."""
    parts = []
    for start, _, data, offsets in slices(texts):
        row, column, value, stats = _features(data, offsets)
        parts.append((row + start, column, value, stats))
    width = N_STATS + 2 * len(metadata)
    random = np.random.default_rng(SEED)
    machine = Machine(
        0.0, np.zeros(BUCKETS + width), random.normal(0, 0.02, (BUCKETS + width, FACTORS)), np.zeros(width), np.ones(width)
    )
    if not len(labels) or not parts:
        machine.v[:] = 0
        return machine
    row, column, value = (np.concatenate([p[i] for p in parts]) for i in range(3))
    stats = np.column_stack([np.concatenate([p[3] for p in parts]), _metadata(metadata, len(labels))])
    machine.mean, machine.scale = stats.mean(0), np.maximum(stats.std(0), 1e-3)
    dense = machine.dense(stats)
    share = np.clip(labels.mean(), 0.01, 0.99)
    machine.w0 = float(np.log(share / (1 - share)))
    begins = np.searchsorted(row, np.arange(len(labels) + 1))
    gw, gv, g0 = np.full(machine.w.shape, 1e-6), np.full(machine.v.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            docs = np.sort(order[at : at + BATCH])
            span = np.concatenate([np.arange(begins[d], begins[d + 1]) for d in docs])
            r, c, x = np.searchsorted(docs, row[span]), column[span], value[span]
            raw, sums = machine.raw(r, c, x, dense[docs])
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[docs]) / len(docs)
            g0 += error.sum() ** 2
            machine.w0 -= RATE * error.sum() / np.sqrt(g0)
            used, where = np.unique(c, return_inverse=True)
            ex, exx = error[r] * x, error[r] * x * x
            step = np.empty((len(used) + width, 1 + FACTORS))
            step[: len(used), 0] = np.bincount(where, ex)
            own = np.bincount(where, exx)
            d = dense[docs]
            step[len(used) :, 0] = error @ d
            all_of = np.concatenate([used, np.arange(BUCKETS, BUCKETS + width)])
            own = np.concatenate([own, error @ (d * d)])
            for f in range(FACTORS):
                step[: len(used), 1 + f] = np.bincount(where, ex * sums[r, f])
                step[len(used) :, 1 + f] = (error * sums[:, f]) @ d
            step[:, 1:] -= own[:, None] * machine.v[all_of]
            step[:, 0] += DECAY * machine.w[all_of]
            step[:, 1:] += DECAY * machine.v[all_of]
            gw[all_of] += step[:, 0] ** 2
            gv[all_of] += step[:, 1:] ** 2
            machine.w[all_of] -= RATE * step[:, 0] / np.sqrt(gw[all_of])
            machine.v[all_of] -= RATE * step[:, 1:] / np.sqrt(gv[all_of])
    return machine


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, metadata: list[str], max_train: int = MAX_TRAIN) -> Machine:
    """A machine fitted on `labels` (doc_id, label), of which at most `max_train` rows are used."""
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("label")]
    usable = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = usable.orderBy(*order).limit(max_train)
    texts = docs.select(F.col("doc_id"), F.col("text"), *[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(metadata)])
    # The chosen rows are at most `max_train` ids: small enough to send to every task.
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy(*order, "text").limit(max_train).toArrow()
    labels_ = np.array(rows["label"].to_numpy(), float)
    return fit(rows["text"], [rows[f"_m{i}"].combine_chunks() for i in range(len(metadata))], labels_)


def scored(docs: DataFrame, machine: Machine, metadata: list[str], name: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 in the column `name`."""

    @F.arrow_udf("double")
    def score(text: pa.Array, *numbers: pa.Array) -> pa.Array:
        return pa.array(machine.score(text, list(numbers)), pa.float64())

    return docs.withColumn(name, score(F.col("text"), *[F.col(c).cast("double") for c in metadata]))


METADATA = ["n_chars"]


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with held_out, score and predicted, learned from the labels of documents that are not held out."""
    known = labels.where(~is_held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    machine = train(docs, known, METADATA)
    out = scored(docs, machine, METADATA)
    return out.withColumn("held_out", is_held_out(F.col("doc_id"))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def op1_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted"
    )
