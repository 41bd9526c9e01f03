"""Cheapest repair of conversations, by the auction algorithm for shortest paths.

A conversation's edits are a path over a lattice: a node is (rows passed, state of the role grammar), an arc keeps,
reroles or deletes the next row or inserts a turn before it, and costs are small integers. The auction keeps a price per
node, never above the cheapest arc plus the price at its head, and one path from the origin along which both are equal.
The path's end either moves on to its best head or, if its price can rise, raises it and steps back. Prices start at what
each row costs at least. When the path has arrived, the origin's price is the distance, and every shortest path consists
of tight arcs, those whose cost is the difference of prices. Among them the least audit string is traced.

A conversation of up to SEGMENT rows is solved at once. A longer one is cut into segments: auctions give the distances
between the four states at both ends of a segment, distances are combined by min-plus products (in groups of SEGMENT, and
groups of groups, so no task holds a whole conversation), and each segment is then solved with the prices that hold at
its end. Rows are put into order by ranges; a hot conversation is split over many parts. Only the digest of a repaired
conversation is formed in one task, since SHA-256 cannot be split; its rows stream through and are not collected.

Defined results: a null role or text counts as one space, which is no legal role and a blank text; a null turn comes first
and is left out of `gaps`; a null conv_id is a conversation of its own. Rows of one turn are ordered by role, by the
first 64 characters of the text and by a hash of it; a repeated row is a duplicate. An empty role has no initial and
cannot be kept. Long texts are streamed. An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import in_order, read, written

SEGMENT = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANKS = " \t\n\x0b\f\r"
# States of the grammar (s?(ua)+)? : nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
# More than any path costs, and more than sums of that.
BARRED = 1 << 48
FAR = 1 << 60
ROLE = {USER: "user", ASSISTANT: "assistant"}


# ---- one segment -----------------------------------------------------------------------------------------------------


def arcs_of(code: str, exits: tuple[int, ...], last: bool) -> tuple[list[list[tuple[str, int, int]]], list[int]]:
    """The lattice of a segment: per node its arcs (label, cost, head), in the order of labels, and starting prices.

    `code` has two characters a row: the role's initial and the row's fault, "F" for one that must go, "T" for truncated.
    Node 4 * i + g is state g before row i; the last node is where the segment ends. `exits` are the prices behind it.
    Turns at the end of a segment are inserted in front of the next one's rows, unless it is the last.
    """
    n = len(code) // 2
    end = STATES * (n + 1)
    arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(end)]
    least = min(exits)
    prices = [0] * (end + 1)
    # Arcs into nodes that cannot reach the end are left out: around inserts, prices there would rise without end.
    alive = [False] * end + [True]
    for i in range(n, -1, -1):
        initial, fault = (code[2 * i], code[2 * i + 1]) if i < n else ("", "")
        extra = TRUNCATED if fault == "T" else 0
        if i < n:
            least += DELETE if fault == "F" else min(DELETE, KEEP + extra)
        for g in range(STATES):
            node, below = STATES * i + g, STATES * (i + 1)
            prices[node] = least
            out = arcs[node]
            if i == n and exits[g] < BARRED:
                out.append(("", exits[g], end))
            if i < n:
                out.append(("D", DELETE, below + g))
            if i < n or last:
                out.append(("I", INSERT, STATES * i + NEXT[g]))
            if i < n and fault != "F":
                if (g, initial) in KEPT:
                    out.append(("K", KEEP + extra, below + KEPT[g, initial]))
                out.append(("R", REROLE + extra, below + NEXT[g]))
        layer = range(STATES * i, STATES * (i + 1))
        for _ in range(STATES):
            for node in layer:
                alive[node] = any(alive[to] for _, _, to in arcs[node])
        for node in layer:
            arcs[node] = [a for a in arcs[node] if alive[a[2]]]
    return arcs, prices


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int, end: int) -> int:
    """Raises `prices` until `origin` has a path of tight arcs to `end`; the distance between them."""
    if not arcs[origin]:
        return BARRED
    path = [origin]
    while True:
        node = path[-1]
        best, head = FAR, end
        for _, cost, to in arcs[node]:
            if cost + prices[to] < best:
                best, head = cost + prices[to], to
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        elif head == end:
            return prices[origin]
        else:
            path.append(head)


def traced(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int, end: int) -> tuple[str, int]:
    """The least label string of all tight paths from `origin` to `end`, and the last state."""
    reaches = [False] * (end + 1)
    reaches[end] = True
    # Inserts stay inside a layer; twice round a layer settles them.
    for layer in range(end // STATES - 1, -1, -1):
        for _ in range(STATES):
            for node in range(STATES * layer, STATES * (layer + 1)):
                if not reaches[node]:
                    reaches[node] = any(reaches[to] and cost + prices[to] == prices[node] for _, cost, to in arcs[node])
    labels, node = [], origin
    while True:
        # An arc out of the segment has the empty label and goes first; a tight insert cannot also be open then.
        label, _, to = min(a for a in arcs[node] if reaches[a[2]] and a[1] + prices[a[2]] == prices[node])
        if to == end:
            return "".join(labels), node % STATES
        labels.append(label)
        node = to


@lru_cache(maxsize=1 << 15)
def distances(code: str) -> tuple[int, ...]:
    """Costs from each state in front of a segment to each state behind its last row."""
    found = [BARRED] * (STATES * STATES)
    end = STATES * (len(code) // 2 + 1)
    for to in range(STATES):
        arcs, prices = arcs_of(code, tuple(0 if g == to else BARRED for g in range(STATES)), False)
        for g in range(STATES):
            found[STATES * g + to] = min(BARRED, auction(arcs, prices, g, end))
    return tuple(found)


@lru_cache(maxsize=1 << 15)
def solved(code: str, exits: tuple[int, ...], last: bool, whole: bool) -> tuple[tuple[str, int, int], ...]:
    """For each entry state (only the first, if the segment is a `whole` conversation): labels, last state, cost."""
    end = STATES * (len(code) // 2 + 1)
    arcs, prices = arcs_of(code, exits, last)
    found = []
    for g in range(1 if whole else STATES):
        cost = auction(arcs, prices, g, end)
        labels, state = traced(arcs, prices, g, end) if cost < BARRED else ("", g)
        found.append((labels, state, cost - exits[state]))
    return tuple(found)


FINAL = tuple(0 if g in ENDS else BARRED for g in range(STATES))
# The same with the turns that are inserted after the last row.
CLOSING = (0, 2 * INSERT, INSERT, 0)


def edits(code: str, labels: str, state: int) -> Iterator[tuple[str, str]]:
    """(label, role written or "" for the row's own) along a path, starting in `state`."""
    row = 0
    for label in labels:
        if label in "IR":
            state = NEXT[state]
        elif label == "K":
            state = KEPT[state, code[2 * row]]
        yield label, ROLE[state] if label in "IR" else ""
        row += label != "I"


# ---- many segments ---------------------------------------------------------------------------------------------------


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), BARRED * 4)


def _matrix(cells) -> np.ndarray:
    return np.array(cells, np.int64).reshape(STATES, STATES)


def _product(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("seg")
    whole = _matrix(pdf["cells"].iloc[0])
    for cells in pdf["cells"].iloc[1:]:
        whole = _times(whole, _matrix(cells))
    return pd.DataFrame({"conv": pdf["conv"].iloc[:1], "seg": pdf["up"].iloc[:1], "cells": [whole.ravel()]})


def _behind(pdf: pd.DataFrame) -> pd.DataFrame:
    """Prices behind each of some consecutive segments, from those behind the last one."""
    pdf = pdf.sort_values("seg", ascending=False)
    prices, out = np.array(pdf["behind"].iloc[0], np.int64), []
    for cells in pdf["cells"]:
        out.append(prices)
        prices = np.minimum((_matrix(cells) + prices[None, :]).min(axis=1), BARRED * 4)
    return pd.DataFrame({"conv": pdf["conv"], "seg": pdf["seg"], "behind": out})


CELLS = "conv string, seg bigint, cells array<bigint>"
BEHIND = "conv string, seg bigint, behind array<bigint>"


def prices_behind(cells: DataFrame, final: tuple[int, ...], width: int) -> DataFrame:
    """(conv, seg, behind): prices of the four states behind each segment; seg counts from 0 in a conversation.

    Segments are multiplied together in groups of `width`, these again, until each conversation is one; then prices go
    back down. One number reaches the driver per level.
    """
    most = cells.agg(F.max("seg")).first()[0]
    if most is None or most < width:
        ends = F.array(*[F.lit(p).cast("bigint") for p in final])
        return cells.withColumn("behind", ends).groupBy("conv").applyInPandas(_behind, BEHIND)
    up = F.call_function("div", F.col("seg"), F.lit(width).cast("bigint"))
    grouped = cells.withColumn("up", up)
    above = written(grouped.groupBy("conv", "up").applyInPandas(_product, CELLS), "products")
    upper = prices_behind(above, final, width).withColumnRenamed("seg", "up")
    joined = grouped.join(upper, ["conv", "up"])
    return written(joined.groupBy("conv", "up").applyInPandas(_behind, BEHIND), "behind")


def _one_way(found: list) -> list[int]:
    """The moves of a solved segment, transposed: from each last state back to the entries that lead to it."""
    cells = np.full((STATES, STATES), BARRED, np.int64)
    for g, (_, state, _) in enumerate(found):
        cells[state, g] = 0
    return cells.ravel().tolist()


# ---- conversations ---------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `lost` of every row after the damage; a lost row is there to name its conversation."""
    space = F.lit(" ")
    kind = F.crc32(
        F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    ) % 20
    text = F.coalesce("text", space)
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), kind.alias("_kind"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    )
    return rows.select(
        "conv_id", "turn", "role", "text", (F.col("_kind") == 0).alias("lost"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _null_key(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def _solve(batches: Iterator[pa.RecordBatch], last: bool, whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        behind = [FINAL] * len(batch) if whole else [tuple(p) for p in batch.column("behind").to_pylist()]
        lasts = [True] * len(batch) if whole else batch.column("last").to_pylist()
        found = [solved(c, FINAL if is_last else b, is_last, whole) for c, b, is_last in zip(batch.column("code").to_pylist(), behind, lasts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv"), batch.column("seg"),
                pa.array([[f[0] for f in of] for of in found], pa.list_(pa.string())),
                pa.array([[f[2] for f in of] for of in found], pa.list_(pa.int64())),
                pa.array([_one_way(of) for of in found], pa.list_(pa.int64())),
            ],
            ["conv", "seg", "labels", "costs", "back"],
        )


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [list(distances(c)) for c in batch.column("code").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("seg"), pa.array(cells, pa.list_(pa.int64()))], ["conv", "seg", "cells"]
        )


SOLVED = "conv string, seg bigint, labels array<string>, costs array<bigint>, back array<bigint>"


def cheapest(segments: DataFrame, width: int = SEGMENT) -> DataFrame:
    """(conv, seg, piece, entry, cost): the audit string of each segment on the cheapest path through its conversation,
    the state it begins in and what it costs. `segments`: conv, seg from 0, segs in the conversation, code."""
    one = segments.where("segs = 1").mapInArrow(partial(_solve, last=True, whole=True), SOLVED)
    one = one.select("conv", "seg", F.col("labels")[0].alias("piece"), F.lit(START).alias("entry"), F.col("costs")[0].alias("cost"))
    many = segments.where("segs > 1")
    cells = written(many.select("conv", "seg", "code").mapInArrow(_cells, CELLS), "cells")
    behind = prices_behind(cells, CLOSING, width)
    ways = many.withColumn("last", F.col("seg") == F.col("segs") - 1).join(behind, ["conv", "seg"]).select(
        "conv", "seg", "code", "last", "behind"
    )
    ways = written(ways.mapInArrow(partial(_solve, last=False, whole=False), SOLVED), "ways")
    # Which state each segment begins in: the same products, over the moves taken and from the other end.
    flipped = ways.join(segments.select("conv", "seg", "segs"), ["conv", "seg"]).select(
        "conv", (F.col("segs") - 1 - F.col("seg")).alias("seg"), F.col("segs"), F.col("back").alias("cells")
    )
    begins = prices_behind(
        flipped.select("conv", "seg", "cells"), tuple(0 if g == START else BARRED for g in range(STATES)), width
    )
    begins = begins.join(flipped.select("conv", "seg", "segs"), ["conv", "seg"]).select(
        "conv", (F.col("segs") - 1 - F.col("seg")).alias("seg"),
        (F.array_position("behind", F.lit(0).cast("bigint")) - 1).cast("int").alias("entry"),
    )
    chosen = ways.join(begins, ["conv", "seg"]).select(
        "conv", "seg", F.col("labels")[F.col("entry")].alias("piece"), "entry", F.col("costs")[F.col("entry")].alias("cost")
    )
    return one.unionByName(chosen)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by conversation and segment, each segment's edits before its rows; nothing is kept but a hash."""
    conv, state, plan, first = None, None, iter(()), True
    out: list[tuple[str, str]] = []

    def write(role: str, text: str) -> None:
        nonlocal first
        state.update((("" if first else "\n") + f"{role}:{text}").encode())
        first = False

    def rest() -> None:
        for _, role in plan:
            write(role, "")

    for batch in batches:
        convs, codes, pieces, entries = (batch.column(c) for c in ("conv", "code", "piece", "entry"))
        roles, texts = batch.column("role"), batch.column("text")
        for i in range(len(batch)):
            here = convs[i].as_py()
            if here != conv:
                if conv is not None:
                    rest()
                    out.append((conv, state.hexdigest()))
                conv, state, plan, first = here, sha256(), iter(()), True
            if pieces[i].is_valid:
                rest()
                plan = edits(codes[i].as_py(), pieces[i].as_py(), entries[i].as_py())
                continue
            for label, role in plan:
                if label == "I":
                    write(role, "")
                    continue
                if label != "D":
                    write(role or roles[i].as_py(), texts[i].as_py())
                break
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out]), pa.array([o[1] for o in out])], ["conv", "repaired_sha256"])
            out = []
    if conv is not None:
        rest()
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], ["conv", "repaired_sha256"])


def repaired(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation in `rows` (conv_id, turn, role, text, lost)."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    prefix, hashed = F.substring("text", 1, 64), F.xxhash64("text")
    kept = rows.where("not lost").withColumn("conv", _null_key(F.col("conv_id")))
    ordered = in_order(kept, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), prefix, hashed], "turns")
    ordered = ordered.withColumn("part", F.call_function("div", F.col("_id"), F.lit(segment).cast("bigint")))
    slim = ordered.select(
        "conv", "_id", "part", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.when(trimmed == "", "B").when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), ".").otherwise("T").alias("fault"),
        F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256).alias("said"),
    )
    slim = written(slim, "slim")
    # The first row of each wording, by row number: a wording may be that of all rows, a number is that of one.
    firsts = slim.groupBy("conv", "said").agg(F.min("_id").alias("_id")).select("_id", F.lit(True).alias("first"))
    marked = slim.drop("said").join(firsts, "_id", "left").withColumn(
        "fault", F.when(F.col("fault") == "B", "B").when(F.col("first").isNull(), "D").otherwise(F.col("fault"))
    )
    rows_of = F.sort_array(F.collect_list(F.struct("_id", "initial", "fault")))
    segments = marked.groupBy("conv", "part").agg(rows_of.alias("rows")).select(
        "conv", "part",
        F.concat_ws("", F.transform("rows", lambda r: F.concat(r["initial"], F.translate(r["fault"], "BD", "FF")))).alias("code"),
        F.concat_ws("", F.transform("rows", lambda r: r["fault"])).alias("faults"),
        F.concat_ws("", F.transform("rows", lambda r: r["initial"])).alias("initials"),
    )
    in_conv = Window.partitionBy("conv").orderBy("part")
    segments = written(
        segments.withColumn("seg", F.row_number().over(in_conv).cast("bigint") - 1)
        .withColumn("before", F.coalesce(F.lag(F.right("initials", F.lit(1))).over(in_conv), F.lit("")))
        .withColumn("segs", F.count(F.lit(1)).over(Window.partitionBy("conv"))),
        "segments",
    )
    paths = written(cheapest(segments.select("conv", "seg", "segs", "code"), segment), "paths")

    def count_of(letter: str) -> Column:
        return F.length("faults") - F.length(F.translate("faults", letter, ""))

    joined = F.concat("before", "initials")
    # Pairs overlap, so a look-ahead counts them.
    legal = F.regexp_count(joined, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    told = segments.join(paths, ["conv", "seg"]).groupBy("conv").agg(
        F.sum(count_of("B")).alias("blank"), F.sum(count_of("D")).alias("duplicate"), F.sum(count_of("T")).alias("truncated"),
        F.sum(F.length(joined) - 1 - legal).alias("illegal"), F.sum("cost").alias("cost"),
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("seg", "piece"))), lambda p: p["piece"])).alias("audit"),
    )
    plans = segments.join(paths, ["conv", "seg"]).select(
        "conv", "part", F.lit(-1).cast("bigint").alias("_id"), "code", "piece", "entry",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    texts = ordered.select(
        "conv", "part", "_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("piece"),
        F.lit(None).cast("int").alias("entry"), "role", "text",
    )
    digests = (
        plans.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "part", "_id")
        .select("conv", "code", "piece", "entry", "role", "text").mapInArrow(_digests, "conv string, repaired_sha256 string")
    )
    turn = F.when(~F.col("lost"), F.col("turn"))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("bigint")
    every = rows.groupBy("conv_id").agg(gaps.alias("gaps")).withColumn("conv", _null_key(F.col("conv_id")))
    zero = F.lit(0).cast("bigint")
    return every.join(told, "conv", "left").join(digests, "conv", "left").select(
        "conv_id", "gaps", *[F.coalesce(c, zero).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op11_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(read(spark, sf_dir, "conversations")))
