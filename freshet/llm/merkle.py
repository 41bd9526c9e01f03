"""A Merkle manifest of a dataset: a digest for every row, one root for all, and a proof for each row.

The leaves of a source, in the order of doc_id, are cut into blocks of 4,096, the partitions of the exchange. A block
hashes its own leaves. Above the blocks there is no pass up and down: in each round the aligned groups of sixteen
subtrees swap their roots, every block of a subtree with one partner in each of the other fifteen, and each block hashes
the common ancestor for itself. So after round r a block knows its ancestor r + 1 levels up and all siblings on the way,
and after the last round it can prove its leaves. A ragged last subtree has fewer blocks than the others; its blocks
serve several partners each. The subroots of the sources are then exchanged in the same way, with one row per source.

A round is one window over at most sixteen rows of a block number; the number of rounds is the logarithm of the largest
source. Leaves are shuffled as digests; texts are read once and not shuffled.

Defined results: a null field is hashed as "-". Rows are ordered by doc_id, null first, and rows of one doc_id by their
leaf; repeated rows are leaves of their own. A null source is a source of its own. An empty text is "0:", a long one is
hashed whole. An empty table gives an empty table. Columns of the input that are no field are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import in_order, named_key, ranked, read, salted_join, written

FANOUT = 16
LEAF_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def levels_above(leaves: int, fanout: int) -> int:
    """How many levels of hashing make one node of so many."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // fanout), levels + 1
    return levels


def block_levels(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes of a block, level by level; the last level is the block's root."""
    found = [leaves]
    for _ in range(levels):
        nodes = found[-1]
        found.append([digest(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)])
    return found


def block_root(table: pa.Table, fanout: int, leaf_levels: int) -> pa.Table:
    table = table.sort_by("_rank")
    size = table["_size"][0].as_py()
    levels = min(leaf_levels, levels_above(size, fanout))
    (root,) = block_levels(table["leaf"].to_pylist(), levels, fanout)[-1]
    return pa.table(
        {
            "_key": table["_key"].slice(0, 1), "_block": table["_block"].slice(0, 1),
            "_blocks": pa.array([-(-size // fanout**leaf_levels)], pa.int64()), "node": pa.array([root], pa.string()),
        }
    )


def butterfly(nodes: DataFrame, tree: str, place: str, count: str, fanout: int = FANOUT) -> DataFrame:
    """`nodes` (tree, place from 0 without gaps, count of the tree's rows, node) after the exchange: `node` is the root of
    the tree and `siblings` has, level by level, the place of the row's ancestor in its run and the others of the run."""
    largest = nodes.agg(F.max(count)).first()[0] or 0
    nodes = nodes.withColumn("siblings", F.array().cast("array<struct<place:int,others:array<string>>>"))
    kept = nodes.columns
    for step in range(levels_above(largest, fanout)):
        span = F.lit(fanout**step).cast("bigint")
        child = F.call_function("div", F.col(place), span)
        run = F.call_function("div", child, F.lit(fanout).cast("bigint"))
        lane = F.col(place) % span
        # Blocks of this subtree, and of the first of its run, than which none is larger.
        mine = F.least(span, F.col(count) - child * span)
        most = F.least(span, F.col(count) - run * fanout * span)
        sent = nodes.select(
            *kept, (child % fanout).cast("int").alias("_digit"), run.alias("_run"), lane.alias("_own"),
            F.explode(F.sequence(lane, most - 1, mine)).alias("_lane"),
        )
        swap = Window.partitionBy(tree, "_run", "_lane")
        swapped = sent.withColumn(
            "_roots", F.sort_array(F.collect_list(F.struct(F.col("_digit").alias("d"), F.col("node").alias("n"))).over(swap))
        ).where("_lane = _own")
        more = F.col(count) > span
        others = F.transform(F.filter("_roots", lambda r: r["d"] != F.col("_digit")), lambda r: r["n"])
        level = F.array(F.struct(F.col("_digit").alias("place"), others.alias("others")))
        nodes = swapped.select(
            *[c for c in kept if c not in ("node", "siblings")],
            F.when(more, F.sha2(F.concat_ws("", F.transform("_roots", lambda r: r["n"])), 256)).otherwise(F.col("node")).alias("node"),
            F.when(more, F.concat("siblings", level)).otherwise(F.col("siblings")).alias("siblings"),
        )
    return nodes


PROVED = "doc_id bigint, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, folded_root string"


def prove(leaves: pa.Table, block: pa.Table, fanout: int, leaf_levels: int, whole: bool) -> pa.Table:
    """Proofs of a block's leaves, and the root that each one's `claimed` leaf folds to with them."""
    leaves = leaves.sort_by("_rank")
    above = block["siblings"][0].as_py()
    levels = min(leaf_levels, levels_above(leaves["_size"][0].as_py(), fanout))
    digests = leaves["leaf"].to_pylist()
    nodes = block_levels(digests, levels, fanout)
    upper = [d for level in above for d in level["others"]]
    known: dict[str, str] = {}

    def to_root(node: str) -> str:
        if node not in known:
            at = node
            for level in above:
                at = digest([*level["others"][: level["place"]], at, *level["others"][level["place"] :]])
            known[node] = at
        return known[node]

    proofs, hashes, folded = [], [], []
    for i, node in enumerate(leaves["claimed"].to_pylist()):
        siblings: list[str] = []
        for level in nodes[:-1]:
            first = i - i % fanout
            before, after = level[first:i], level[i + 1 : first + fanout]
            siblings += before + after
            node = digest([*before, node, *after])
            i //= fanout
        siblings += upper
        proofs.append(siblings if whole else None)
        hashes.append(digest(siblings))
        folded.append(to_root(node))
    n = len(digests)
    return pa.table(
        {
            "doc_id": leaves["doc_id"], "leaf": leaves["leaf"], "subroot": pa.array([block["subroot"][0].as_py()] * n, pa.string()),
            "root": pa.array([block["root"][0].as_py()] * n, pa.string()), "proof": pa.array(proofs, pa.list_(pa.string())),
            "proof_sha256": hashes, "folded_root": folded,
        }
    )


def proved(
    docs: DataFrame, claimed: Callable[[dict[str, Column]], dict[str, Column]] | None = None, whole: bool = False,
    fanout: int = FANOUT, leaf_levels: int = LEAF_LEVELS,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (with `whole`: all sibling digests), proof_sha256, folded_root of every row.

    `claimed` gives the fields of the row as somebody claims them to be; folded_root is the root that follows from them.
    """
    fields = {f: F.col(f) for f in FIELDS}
    stated = fields | (claimed(fields) if claimed else {})
    leaf = leaf_of(list(fields.values()))
    changed = [stated[f] for f in FIELDS] if claimed else None
    slim = docs.select(
        named_key(F.col("source")).alias("_key"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf.alias("leaf"),
        (leaf_of(changed) if changed else leaf).alias("claimed"),
    )
    ordered = in_order(written(slim, "leaves"), [F.col("_key"), F.col("doc_id").asc_nulls_first(), F.col("leaf")], "leaves")
    places = ranked(ordered, "_key", "_rank")
    sizes = ordered.groupBy("_key").agg(F.count(F.lit(1)).alias("_size"))
    leaves = written(
        salted_join(places.drop("_id"), sizes, "_key").withColumn(
            "_block", F.call_function("div", F.col("_rank"), F.lit(fanout**leaf_levels).cast("bigint"))
        ),
        "ranked",
    )
    blocks = leaves.groupBy("_key", "_block").applyInArrow(
        lambda table: block_root(table, fanout, leaf_levels),
        "_key string, _block bigint, _blocks bigint, node string",
    )
    blocks = written(butterfly(written(blocks, "blocks"), "_key", "_block", "_blocks", fanout), "exchanged")
    subroots = blocks.where("_block = 0").select("_key", F.col("node").alias("subroot"), F.lit(0).alias("_all"))
    sources = ranked(in_order(subroots, [F.col("_key")], "sources"), "_all", "_source")
    sources = written(
        sources.select("_key", "subroot", "_all", "_source", F.lit(subroots.count()).cast("bigint").alias("_sources"), F.col("subroot").alias("node")),
        "sources",
    )
    sources = butterfly(sources, "_all", "_source", "_sources", fanout).select(
        "_key", "subroot", F.col("node").alias("root"), F.col("siblings").alias("_upper")
    )
    known = salted_join(blocks.select("_key", "_block", "siblings"), sources, "_key").select(
        "_key", "_block", "subroot", "root", F.concat("siblings", "_upper").alias("siblings")
    )
    return (
        leaves.groupBy("_key", "_block")
        .cogroup(known.groupBy("_key", "_block"))
        .applyInArrow(lambda mine, block: prove(mine, block, fanout, leaf_levels, whole), PROVED)
    )


def lower_case(fields: dict[str, Column]) -> dict[str, Column]:
    """The tampering of the query: the text's A-Z in lower case where 5 divides the checksum of doc_id."""
    hit = F.crc32(fields["doc_id"].cast("string")) % 5 == 0
    return {"text": F.when(hit, F.translate(fields["text"], A_TO_Z, A_TO_Z.lower())).otherwise(fields["text"])}


def op13_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proved(read(spark, sf_dir, "documents"), lower_case).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
