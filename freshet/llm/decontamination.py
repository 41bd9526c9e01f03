"""Benchmark decontamination by pigeonhole edit matching.

A test item of L characters counts as leaked into a text if some stretch of the text is within k = floor(ERROR_RATE * L)
edits (insert, delete, replace) of it. Cut into k + 1 pieces, such an item has a piece without any edit, so exact hits of
pieces, found for all items in one pass over the text, show every place worth a look. Each is decided by the bit-parallel
edit distance of Myers, whose columns are integers of L bits.

Most hits of short pieces are chance. Before the distance is computed, the same argument is used once more, with pieces
half as long: of 2 (k + 1) pieces at most k are touched by an edit, so more than k missing ones rule the place out.

Texts and items are compared in lower case and with runs of white space as one blank, none at the ends.

The items are sent to the tasks in blocks of about BLOCK_CHARS characters, so no task holds more than a block however
many items there are; the texts are mapped and never shuffled.

Short items, of fewer than MIN_CHARS characters, are too short for edits to be told from chance. They are sought by the
same pass as one piece without an edit, and count where they stand as whole words.

Defined results: a null or empty text has no leaks. Null items and items that are empty after normalization are not
sought. Very long texts are searched whole. Repeated items are found each under its id; rows are judged one by one,
whatever their ids. Columns of the input are kept; `leaks` replaces a column of that name. An empty
table of texts gives an empty table; without items nothing is leaked.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import read

ERROR_RATE = 0.1
MIN_CHARS = 32
BLOCK_CHARS = 1 << 22
LEAKS = "array<struct<item_id:bigint,distance:int,start:int,end:int>>"

_SPACES = re.compile(r"\s+")


def normalized(text: str | None) -> str:
    plain = " ".join((text or "").split())
    lower = plain.lower()
    # A few capitals have two characters in lower case; they stay, so that places can be told.
    return lower if len(lower) == len(plain) else "".join(x if len(x := c.lower()) == 1 else c for c in plain)


def places(text: str) -> list[int]:
    """For each character of the normalized text, and its end, the place in the text it comes from."""
    found, at = [], 0
    for gap in (*_SPACES.finditer(text), None):
        found.extend(range(at, gap.start() if gap else len(text)))
        if gap:
            if gap.start() and gap.end() < len(text):
                found.append(gap.start())
            at = gap.end()
    return [*found, (found[-1] + 1) if found else 0]


def best_end(pattern: str, text: str, budget: int) -> tuple[int, int]:
    """(distance, end) of the stretch of `text` nearest to `pattern`, the first of equals; distance budget + 1 if none."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = budget + 1, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        if score < best:
            best, end = score, j
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return best, end


def cut(text: str, pieces: int) -> list[str]:
    """`text` in that many pieces of nearly equal length."""
    ends = [len(text) * i // pieces for i in range(pieces + 1)]
    return [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word goes on across the ends of a stretch."""
    return not (
        start and text[start - 1].isalnum() and text[start].isalnum()
        or end < len(text) and text[end - 1].isalnum() and text[end].isalnum()
    )


class Finder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE, min_chars: int = MIN_CHARS):
        self.items = [(i, t) for i, t in ((i, normalized(t)) for i, t in items) if t]
        self.short = [len(t) < min_chars for _, t in self.items]
        self.budgets = [0 if short else math.floor(rate * len(t)) for (_, t), short in zip(self.items, self.short, strict=True)]
        self.automaton = None
        self.halves = [cut(t, 2 * (k + 1)) for (_, t), k in zip(self.items, self.budgets, strict=True)]

    def _possible(self, n: int, window: str) -> bool:
        missing = 0
        for piece in self.halves[n]:
            if piece not in window:
                missing += 1
                if missing > self.budgets[n]:
                    return False
        return True

    def _build(self) -> None:
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, ((_, text), k) in enumerate(zip(self.items, self.budgets, strict=True)):
            end = 0
            for piece in cut(text, k + 1):
                end += len(piece)
                pieces.setdefault(piece, []).append((n, end))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, uses)
        self.automaton.make_automaton()

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of each item's nearest stretch within its budget; places in the given text."""
        if not self.items or not text:
            return []
        if self.automaton is None:
            self._build()
        plain = normalized(text)
        windows: dict[int, list[list[int]]] = {}
        for last, uses in self.automaton.iter(plain):
            for n, piece_end in uses:
                begin = last + 1 - piece_end
                if self.short[n] and not _whole_words(plain, begin, last + 1):
                    continue
                low, high = begin - self.budgets[n], begin + len(self.items[n][1]) + self.budgets[n]
                if high - low < 0 or high < self.budgets[n] or low > len(plain) - len(self.items[n][1]) + 2 * self.budgets[n]:
                    continue
                of = windows.setdefault(n, [])
                if of and low <= of[-1][1] and low >= of[-1][0]:
                    of[-1][1] = max(of[-1][1], high)
                else:
                    of.append([low, high])
        found = []
        where = None
        for n, spans in sorted(windows.items()):
            item, pattern = self.items[n]
            best = (self.budgets[n] + 1, 0)
            merged: list[list[int]] = []
            for low, high in sorted([max(0, a), min(len(plain), b)] for a, b in spans):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            for low, high in merged:
                if not self._possible(n, plain[low:high]):
                    continue
                distance, end = best_end(pattern, plain[low:high], best[0] - 1)
                if distance < best[0]:
                    best = (distance, low + end)
            distance, end = best
            if distance <= self.budgets[n]:
                low = max(0, end - len(pattern) - distance)
                _, back = best_end(pattern[::-1], plain[low:end][::-1], distance)
                where = places(text) if where is None else where
                start = end - back
                found.append((item, distance, where[start], where[end - 1] + 1))
        return found


def _blocks(items: DataFrame) -> list[list[tuple[int, str]]]:
    """The items in blocks of bounded size. What is collected at once is one block."""
    usable = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    chars = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(chars / BLOCK_CHARS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [[(r.item_id, r.text) for r in usable.where(block == n).orderBy("item_id", "text").collect()] for n in range(count)]


def _leaks_of(finder: Finder):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(LEAKS)
    def find(text: pa.Array) -> pa.Array:
        names = ("item_id", "distance", "start", "end")
        return pa.array([[dict(zip(names, x, strict=True)) for x in finder.leaks(t.as_py())] for t in text], kind)

    return find


def with_leaks(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with the array `leaks` of (item_id, distance, start, end), by item; places are characters of the text."""
    docs = docs.drop("leaks")
    kept = docs.columns
    for block in _blocks(items):
        found = _leaks_of(Finder(block, rate, min_chars))(F.col("text").cast("string"))
        docs = docs.select(*kept, (F.concat("leaks", found) if "leaks" in docs.columns else found).alias("leaks"))
    return docs


def op9_pigeonhole_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and leaked item."""
    found = with_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("leaks"))
