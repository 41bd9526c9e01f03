"""Personal data: candidate spans judged by boosted trees.

Rules find the spans that are personal data by their form alone (`base_spans`); these always stay. Beyond them, wide
patterns propose candidates: addresses spelled out, numbers with other separators or without their marks. Candidates may
overlap. Boosted trees judge each by its format (digits, groups, separators, check digit) and its context (neighbouring
characters, cue words, digits around). A candidate is taken if its calibrated probability reaches its kind's threshold;
of overlapping ones the likeliest; none that overlaps a base span.

Training needs no annotated text. Examples come from all documents: candidates that a rule confirms count as personal
data, also in a second form with their telling mark taken away (a plus sign, an at sign, the usual separator), so that
the trees must learn from what remains; other candidates, and those that hold only a part of such a form, count as none.
Every fourth document is kept out of training; on it, scores are turned into probabilities and each kind gets the
smallest threshold whose decisions there are right in PRECISION of the cases.

All examples count. Equal ones of all documents are added up, so that what is kept are the different rows of features
and how often they occur. A document stands for at most PER_DOC examples of a kind and label, each of a larger number
weighing less, so that a long table of numbers in one document counts no more than a few other documents. For the
trees, the weights of a kind and label are scaled down to at most an equal share of MAX_TRAIN, so that a rare kind is not
lost among others; shifts of each kind's scores make up for that. The cuts of the features are exact weighted
quantiles, and the trees grow by sums of gradients over all rows, which Spark adds up level by level; up to DRIVER_ROWS
different rows are added up by the same function on the driver. The sums are whole numbers of fine units, so their order
does not matter. Scores are rounded to GRID, so that calibration and thresholds, from all kept-out examples, need one
count for each score.

That share is the kind's own, shrunk towards the share of all kinds together by the weight of LEAST decisions, so that a
kind with few examples leans on the others; where no kept-out example is personal data, a calibrated probability of
PRECISION is asked for. If all documents
fall on one side, the trees learn from all. Only a table without examples of both labels adds nothing.

Defined results: a null text is empty and has no spans. Rows are judged one by one; repeated rows get equal spans. Very
long texts are judged whole, in time that grows with their candidates. Documents without an id are judged like others, but no examples are taken from them. An empty table gives an empty
table. Columns of the input are kept; `base` and `added` replace columns of those names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from heapq import nsmallest
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions.sizes import at_most
from freshet.llm.common import read, written

KINDS = ("email", "ip", "card", "phone")
MAX_TRAIN = 40_000
PER_DOC = 16
SALTS = 16
LEAST = 20
PRECISION = 0.98
TREES, DEPTH, BINS, RATE, LEAF = 60, 3, 32, 0.2, 5.0
CONTEXT = 40
# Different rows of features that the driver may add up itself: 12 MB.
DRIVER_ROWS = 50_000
# Units of weights and of gradients, and steps of a score.
WEIGHT, FINE, GRID = 1 << 10, float(1 << 30), 256
QUANTILES = [i / BINS for i in range(1, BINS)]

_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Wide patterns of candidates. Spelled-out addresses are sought from their "at".
_AT = re.compile(r"\s?[(\[{<]\s?at\s?[)\]}>]\s?|\sat\s|\s@\s?|@\s", re.IGNORECASE)
_DOTTED = re.compile(r"[A-Za-z0-9-]+(?:(?:\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s|\s?\.\s?(?=[a-z]{2,3}\b)|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
_FOUR = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?[.:,_-]\s?[0-9]{1,3}){3}(?![0-9])")
# A run of digits and separators; any neighbouring groups of digits in it are a proposal, up to MOST_DIGITS.
_RUN = re.compile(r"[0-9](?:[\x20().\-/_]{0,3}[0-9])*+")
_GROUP = re.compile(r"[0-9]+")
MOST_DIGITS = 19
_CUES = (
    re.compile(r"mail|contact|write|reply", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|addr|client|login", re.IGNORECASE),
    re.compile(r"card|visa|credit|payment|charge|\biban\b", re.IGNORECASE),
    re.compile(r"phone|\btel\b|call|mobile|fax|whatsapp|sms", re.IGNORECASE),
    re.compile(r"version|isbn|order|serial|\bid\b|\bno\b|ref|token|hash|page", re.IGNORECASE),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the spans that the rules find, in order.

    Each kind takes its leftmost matches, one after the other, and drops those that fail its check.
    """
    found = []
    # An address has one at sign; its first part is the run of fitting characters before it, as far as it is free.
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            found.append((begin, 0, free))
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(map(_at_most_255, m.group().split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m.group()) if m.end() - m.start() < 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_only_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all proposals; they may overlap. Base spans propose themselves."""
    found = set(base_spans(text))
    for m in _AT.finditer(text):
        low = m.start()
        # No "at" is made of such characters only, so these runs do not overlap.
        while low > 0 and text[low - 1] in _LOCAL_CHARS:
            low -= 1
        rest = _DOTTED.match(text, m.end()) if low < m.start() else None
        if rest:
            found.add((low, 0, rest.end()))
    for m in _FOUR.finditer(text):
        found.add((m.start(), 1, m.end()))
    for m in _RUN.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (start, _) in enumerate(groups):
            digits = 0
            # Marks that belong to the number stand right before it.
            while start > 0 and text[start - 1] in "+(" and groups[i][0] - start < 2:
                start -= 1
            for low, end in groups[i : i + MOST_DIGITS]:
                digits += end - low
                if digits > MOST_DIGITS:
                    break
                if digits >= 12:
                    found.add((start, 2, end))
                if 7 <= digits <= 15:
                    found.add((start, 3, end))
    return sorted(found)


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span = text[start:end]
    digits = _only_digits(span)
    groups = _GROUP.findall(span)
    letters = sum(c.isalpha() for c in span)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    labels = re.split(r"[^A-Za-z0-9]+", span)
    last = labels[-1] if labels else ""
    sizes = [len(g) for g in groups]

    def neighbour(c: str) -> float:
        return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0

    return [
        *(float(kind == k) for k in range(len(KINDS))),
        float(len(span)), float(len(digits)), float(letters), float(len(groups)),
        float(max(sizes, default=0)), float(min(sizes, default=0)), float(sizes[-1] if sizes else 0), float(sizes[0] if sizes else 0),
        float(sum(c.isspace() for c in span)), float(span.count("-")), float(span.count(".")), float(span.count("(")),
        float(span.count("/")), float(len(set(digits))), float(digits[:1] == "0"),
        float(bool(digits) and luhn(digits)), float(all(map(_at_most_255, groups)) and len(groups) == 4),
        float(2 <= len(last) <= 6 and last.isalpha()), neighbour(before[-1:]), neighbour(after[:1]),
        sum(c.isdigit() for c in before + after) / (len(before) + len(after) + 1),
        *(float(bool(cue.search(before))) for cue in _CUES),
    ]


def without_mark(span: str, kind: int) -> str:
    """The span as it may be written without what the rules look for."""
    if kind == 0:
        return span.replace("@", " at ", 1)
    if kind == 1:
        return span.replace(".", "-")
    if kind == 2:
        digits = _only_digits(span)
        return ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return span.lstrip("+")


def clear_of(spans: list[tuple[int, int, int]]) -> Callable[[int, int], bool]:
    """Whether a range of the text meets none of `spans`, which are in the order of their starts."""
    starts, ends = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))

    def free(start: int, end: int) -> bool:
        # Of the spans that begin before its end, none may reach past its start.
        before = bisect_left(starts, end)
        return not before or ends[before - 1] <= start

    return free


def examples(text: str) -> Iterator[tuple[int, int, str, int, int]]:
    """(kind, label, text, start, end) of the candidates of a text, and of its base spans without their marks."""
    sure = base_spans(text)
    known, free = set(sure), clear_of(sure)
    for start, kind, end in candidates(text):
        if (start, kind, end) in known:
            yield kind, 1, text, start, end
            other = without_mark(text[start:end], kind)
            around = text[max(0, start - CONTEXT) : start] + other + text[end : end + CONTEXT]
            at = min(start, CONTEXT)
            yield kind, 1, around, at, at + len(other)
            # Proposals that hold a part of it, or more than it, are wrong.
            for s, k, e in candidates(around):
                if s < at + len(other) and at < e and (s, e) != (at, at + len(other)):
                    yield k, 0, around, s, e
        elif free(start, end):
            yield kind, 0, text, start, end


@dataclass
class Trees:
    """Boosted trees of fixed depth: per tree and inner node a feature and a cut, per leaf a value."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, (1 << DEPTH) - 1), np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, (1 << DEPTH) - 1)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 1 << DEPTH)))
    start: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - ((1 << DEPTH) - 1)]
        return out


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])


def level_sums(
    trees: Trees, feature: np.ndarray, cut: np.ndarray, level: int, x: np.ndarray, bins: np.ndarray, y: np.ndarray, w: np.ndarray
) -> np.ndarray:
    """First and second derivatives of the logistic loss, in units of 1 / FINE, by node of a level, feature and bin."""
    p = 1 / (1 + np.exp(-trees.raw(x)))
    g, h = np.rint(FINE * w * (p - y)), np.rint(FINE * w * p * (1 - p))
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(level):
        node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    node -= (1 << level) - 1
    out = np.zeros((1 << level, x.shape[1], BINS, 2))
    for f in range(x.shape[1]):
        for i, of in enumerate((g, h)):
            out[:, f, :, i] = np.bincount(node * BINS + bins[:, f], of, minlength=BINS << level).reshape(-1, BINS)
    return out


Sums = Callable[[Trees, np.ndarray, np.ndarray, int], np.ndarray]


def local_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, cuts: list[np.ndarray]) -> Sums:
    bins = binned(x, cuts)
    return lambda trees, feature, cut, level: level_sums(trees, feature, cut, level, x, bins, y, w)


def spark_sums(rows: DataFrame, cuts: list[np.ndarray]) -> Sums:
    """The sums over rows (x, label, w) of any number; a task passes on its sums alone."""

    def sums(trees: Trees, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column("x"))
                    y, w = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("label", "w"))
                    part = level_sums(trees, feature, cut, level, x, binned(x, cuts), y, w)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

        parts = (np.frombuffer(r.s) for r in rows.mapInArrow(add, "s binary").collect())
        return sum(parts).reshape(1 << level, -1, BINS, 2)

    return sums


def grown(start: float, cuts: list[np.ndarray], sums: Sums) -> Trees:
    """Trees for the logistic loss, each split the best of all features' histogram cuts by the gain of second order."""
    trees = Trees(start=start)
    inner = (1 << DEPTH) - 1
    for _ in range(TREES):
        feature, cut, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(1 << DEPTH)
        for level in range(DEPTH):
            by_bin = sums(trees, feature, cut, level) / FINE
            left = np.cumsum(by_bin, axis=2)
            whole = left[:, :, -1:]
            left = left[:, :, :-1]
            gain = sum(
                sign * part[..., 0] ** 2 / (part[..., 1] + LEAF) for sign, part in ((1, left), (1, whole - left), (-1, whole))
            )
            for n in range(1 << level):
                f, b = divmod(int(gain[n].argmax()), BINS - 1)
                split = b < len(cuts[f]) and gain[n, f, b] > 1e-6
                if split:
                    feature[(1 << level) - 1 + n], cut[(1 << level) - 1 + n] = f, cuts[f][b]
                if level == DEPTH - 1:
                    sides = (left[n, f, b], whole[n, f, 0] - left[n, f, b]) if split else (whole[n, f, 0], np.zeros(2))
                    leaf[2 * n : 2 * n + 2] = [-RATE * g / (h + LEAF) for g, h in sides]
        trees.feature, trees.cut, trees.leaf = (
            np.vstack([trees.feature, feature]), np.vstack([trees.cut, cut]), np.vstack([trees.leaf, leaf])
        )
    return trees


def log_odds(right: float, of: float) -> float:
    share = min(max(right / of, 0.001), 0.999)
    return float(np.log(share / (1 - share)))


def boosted(x: np.ndarray, y: np.ndarray) -> Trees:
    """The trees of a few rows."""
    cuts = [np.unique(np.quantile(x[:, f], QUANTILES)) for f in range(x.shape[1])]
    return grown(log_odds(y.sum(), len(y)), cuts, local_sums(x, y, np.ones(len(y)), cuts))


def matrix(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as rows."""
    flat = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(x), -1)


@dataclass
class Judge:
    """Trees, for each kind a shift and the probability from which a candidate is taken, and the scores' calibration."""

    trees: Trees
    shifts: tuple[float, ...] = (0.0,) * len(KINDS)
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)

    def raw(self, x: np.ndarray) -> np.ndarray:
        raw = self.trees.raw(x) + x[:, : len(KINDS)] @ np.array(self.shifts)
        return np.rint(GRID * np.clip(raw, -30, 30)) / GRID

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(x))

    def spans(self, texts: list[str]) -> list[tuple[list, list]]:
        """For each text its base spans and the added ones, as (start, kind, end, probability)."""
        out, asked, x = [], [], []
        for n, text in enumerate(texts):
            sure = base_spans(text)
            out.append(([(*b, 1.0) for b in sure], []))
            free = clear_of(sure)
            for start, kind, end in candidates(text):
                if self.thresholds[kind] <= 1 and free(start, end):
                    asked.append((n, start, kind, end))
                    x.append(features(text, kind, start, end))
        if x:
            p = self.probability(np.array(x))
            # The spans that are taken do not overlap, so only the neighbours of a further one can meet it.
            taken: list[list[tuple[int, int]]] = [[] for _ in texts]
            for i in sorted(range(len(asked)), key=lambda i: (-p[i], asked[i])):
                n, start, kind, end = asked[i]
                at = bisect_left(taken[n], (start, start))
                meets = (at and taken[n][at - 1][1] > start) or (at < len(taken[n]) and taken[n][at][0] < end)
                if p[i] >= self.thresholds[kind] and not meets:
                    taken[n].insert(at, (start, end))
                    out[n][1].append((start, kind, end, float(p[i])))
        for _, added in out:
            added.sort()
        return out


def lowest_cut(p: np.ndarray, label: np.ndarray, weight: np.ndarray, own: np.ndarray) -> float:
    """The smallest probability from which the decisions of a kind are right in PRECISION of the cases.

    `own` marks the kind's examples. To their count are added LEAST decisions that are right as often as those of all
    kinds together: the fewer examples a kind has, the more those of the others decide. If there is no such probability,
    it is one that all given ones are below.
    """
    order = np.argsort(-p, kind="stable")
    p, label, weight, own = p[order], label[order], weight[order], own[order]
    # Equal probabilities are decided alike.
    whole = np.append(p[1:] != p[:-1], True)[: len(p)]
    right, asked = np.cumsum(weight * label), np.cumsum(weight)
    own_right, own_asked = np.cumsum(weight * label * own), np.cumsum(weight * own)
    good = np.flatnonzero(whole & (own_right + LEAST * right / asked >= PRECISION * (own_asked + LEAST)))
    return float(p[good[-1]]) if len(good) else float(np.nextafter(p.max(initial=0.0), 2.0))


def fit(judge: Judge, kind: np.ndarray, label: np.ndarray, raw: np.ndarray, weight: np.ndarray) -> Judge:
    """Calibration and thresholds of a judge from the scores of all kept-out examples, each with its weight."""
    y = label.astype(float)
    # The logistic curve through the held-out scores, by Newton steps with a little shrinkage.
    slope, shift = 1.0, 0.0
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(slope * raw + shift, -30, 30)))
        w = weight * (p * (1 - p) + 1e-4)
        gradient = np.array([(weight * (p - y) * raw).sum() + (slope - 1), (weight * (p - y)).sum() + shift])
        hessian = np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1]])
        slope, shift = np.array([slope, shift]) - np.linalg.solve(hessian, gradient)
    judge.slope, judge.shift = float(slope), float(shift)
    p = judge.calibrated(raw)
    # Without a kept-out example that is personal data nothing is known of the cut but the calibration.
    least = 0.5 if y.any() else PRECISION
    judge.thresholds = tuple(max(lowest_cut(p, y, weight, kind == n), least) for n in range(len(KINDS)))
    return judge


class Least:
    """The `most` smallest of the rows that are added, or a few more."""

    def __init__(self, most: int):
        self.most, self.rows, self.last = most, [], 1 << 63

    def add(self, place: int, x: list[float]) -> None:
        self.rows.append((place, x))
        if len(self.rows) >= 2 * self.most:
            self.rows = sorted(self.rows)[: self.most]
            self.last = self.rows[-1][0]


def drawn(docs: DataFrame, share: int) -> DataFrame:
    """kind, label, held, n, place, x: of each kind, label and side the `share` examples of the smallest places.

    A look at the examples; no judge is fitted on it. A document gives PER_DOC of a kind and label at most. A task passes on a share at most, and the salt keeps the shares of many tasks from meeting in one.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[int, int, bool], Least] = {}
        for batch in batches:
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held = int(h[-1], 16) % 4 == 0
                own: dict[tuple[int, int], list] = {}
                for n, (kind, label, *where) in enumerate(examples(text or "")):
                    own.setdefault((kind, label), []).append((blake2b(f"{h}{n}".encode(), digest_size=16).digest(), n, where))
                for (kind, label), found in own.items():
                    of = least.setdefault((kind, label, held), Least(share))
                    # One half of the hash chooses within the document; the other is the place, which the choice leaves even.
                    for digest, _, (around, start, end) in nsmallest(PER_DOC, found):
                        place = int.from_bytes(digest[8:]) >> 1
                        if place <= of.last:
                            of.add(place, features(around, kind, start, end))
        for (kind, label, held), of in least.items():
            rows = sorted(of.rows)[:share]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([kind] * len(rows), pa.int32()),
                    pa.array([label] * len(rows), pa.int32()),
                    pa.array([held] * len(rows), pa.bool_()),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                ],
                ["kind", "label", "held", "place", "x"],
            )

    h = F.md5(F.col("doc_id").cast("string"))
    named = docs.where("doc_id is not null").select(h.alias("h"), F.col("text").cast("string").alias("text"))
    rows = named.mapInArrow(take, "kind int, label int, held boolean, place bigint, x array<double>")
    rows = rows.withColumn("_salt", F.pmod("place", F.lit(SALTS)))
    of = ["kind", "label", "held"]
    for by in ([*of, "_salt"], of):
        n = F.row_number().over(Window.partitionBy(*by).orderBy("place", "x"))
        rows = rows.withColumn("n", n).where(F.col("n") <= share)
    return rows.select(*of, "n", "place", "x")


def counted(docs: DataFrame) -> DataFrame:
    """kind, label, held, x, weight: the different rows of features of all examples.

    `weight` is the number of examples in units of 1 / WEIGHT; those of a document, kind and label weigh PER_DOC at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            kind, label, held, x = zip(*seen, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(kind, pa.int32()), pa.array(label, pa.int32()), pa.array(held, pa.bool_()),
                    pa.array(x, pa.list_(pa.float64())), pa.array(list(seen.values()), pa.int64()),
                ],
                ["kind", "label", "held", "x", "weight"],
            )

        for batch in batches:
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held = int(h[-1], 16) % 4 == 0
                found = list(examples(text or ""))
                numbers = Counter(e[:2] for e in found)
                for kind, label, around, start, end in found:
                    weight = max(1, WEIGHT * PER_DOC // max(PER_DOC, numbers[kind, label]))
                    seen[kind, label, held, tuple(features(around, kind, start, end))] += weight
                    if len(seen) >= 10_000:
                        yield rows()
                        seen.clear()
        if seen:
            yield rows()

    h = F.md5(F.col("doc_id").cast("string"))
    named = docs.where("doc_id is not null").select(h.alias("h"), F.col("text").cast("string").alias("text"))
    rows = named.mapInArrow(count, "kind int, label int, held boolean, x array<double>, weight bigint")
    return rows.groupBy("kind", "label", "held", "x").agg(F.sum("weight").alias("weight"))


def train(docs: DataFrame, max_train: int = MAX_TRAIN, driver_rows: int = DRIVER_ROWS) -> Judge:
    """A judge fitted on all examples of the table; those of all kinds and labels weigh `max_train` in the trees at most."""
    rows = written(counted(docs), "op4-examples")
    found = rows.groupBy("kind", "label", "held").agg(F.sum("weight").alias("weight")).orderBy("kind", "label", "held").collect()
    sums = {(r.kind, r.label, r.held): r.weight for r in found}
    if len({label for _, label, _ in sums}) < 2:
        return Judge(Trees())
    if len({label for _, label, held in sums if not held}) < 2:
        rows = rows.withColumn("held", F.lit(False))
        sums = {(k, y, False): sum(sums.get((k, y, side), 0) for side in (True, False)) for k, y, _ in sums}
    share = WEIGHT * max(2, max_train // (4 * len(KINDS)))
    scales = {(k, y): min(1.0, share / n) for (k, y, held), n in sums.items() if not held}
    # What the scales hide of how frequent the two labels are.
    shifts = [float(np.log(scales[n, 0] / scales[n, 1])) if (n, 0) in scales and (n, 1) in scales else 0.0 for n in range(len(KINDS))]

    scale = F.create_map(*[F.lit(v) for (k, y), f in scales.items() for v in (2 * k + y, f)])
    w = F.col("weight") * F.element_at(scale, 2 * F.col("kind") + F.col("label"))
    taught = rows.where("not held").select("x", "label", (w / WEIGHT).alias("w"), F.ceil(w).alias("_n"))
    at, size = F.array(*map(F.lit, QUANTILES)), len(features("", 0, 0, 0))
    cuts = [np.unique(q) for q in taught.agg(*[F.percentile(F.col("x")[f], at, F.col("_n")).alias(f"f{f}") for f in range(size)]).first()]
    scaled = {(k, y): sums[k, y, False] * f for (k, y), f in scales.items()}
    start = log_odds(sum(n for (_, y), n in scaled.items() if y), sum(scaled.values()))
    if at_most(taught, driver_rows):
        table = taught.select("x", "label", "w").toArrow()
        of = local_sums(matrix(table["x"]), table["label"].to_numpy().astype(float), table["w"].to_numpy(), cuts)
    else:
        of = spark_sums(taught.select("x", "label", "w"), cuts)
    judge = Judge(grown(start, cuts, of), tuple(shifts))

    @F.arrow_udf("double")
    def raw(x: pa.Array) -> pa.Array:
        return pa.array(judge.raw(matrix(x)) if len(x) else [], pa.float64())

    # There are as many scores as steps of the grid at most.
    scores = rows.where("held").groupBy("kind", "label", raw("x").alias("raw")).agg(F.sum("weight").alias("weight"))
    table = scores.orderBy("kind", "label", "raw").toArrow()
    kind, label, score, weight = (table[c].to_numpy() for c in ("kind", "label", "raw", "weight"))
    return fit(judge, kind, label, score, weight / WEIGHT)


_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def with_spans(docs: DataFrame, judge: Judge) -> DataFrame:
    """`docs` with `base` and `added`: arrays of (kind, start, end, score) in the order of start and kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @F.arrow_udf(f"struct<base:{_SPANS},added:{_SPANS}>")
    def find(text: pa.Array) -> pa.Array:
        both = judge.spans([t or "" for t in text.to_pylist()])
        named = [
            [[{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in found] for found in pair] for pair in both
        ]
        return pa.StructArray.from_arrays([pa.array([n[i] for n in named], kind) for i in (0, 1)], ["base", "added"])

    plain = docs.drop("base", "added")
    return plain.withColumn("_found", find(F.col("text").cast("string"))).select(
        *plain.columns, F.col("_found.base").alias("base"), F.col("_found.added").alias("added")
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets. `spans` must be in order; overlaps are joined."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.concat(acc["out"], gap, mark).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    return F.aggregate(spans, state, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed, then end."""
    number = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], F.element_at(number, s["kind"]).alias("n"), s["end"], s["kind"]))),
        lambda s: F.struct(s["kind"], s["start"], s["end"]),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(in_order(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def op4_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, train(docs))
    return found.select(
        "doc_id",
        *[_count(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"),
    )
