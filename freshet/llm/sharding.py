"""Sharding by a hierarchical weighted hash tree.

A document goes down from the root to a region, from there to a rack and from there to a shard. On each level every
child makes a draw, -ln(u) / weight, with u from a hash of the key and the child's name, and the smallest draw wins; a
child's weight is the sum of the weights of its shards. So a child is chosen in proportion to its weight, and when the
weight of one child changes, keys move between it and its siblings only: subtrees whose weights stay as they are hand
nothing to each other.

Only DataFrame functions are used. A draw is an expression over one row; nothing is shuffled to place a document. Very long
texts are read once, for their sizes and checksums.

Defined results: a null key is drawn like the key "" and a null text has no bytes. Repeated keys go to the same shard.
Columns of the input are kept under their names; the columns added replace columns of the same names. An empty table
gives an empty table. A tree without shards of positive weight is refused with ValueError.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import hex_bits, read, shuffled_offsets, written

SHARDS_PER_RACK, RACKS_PER_REGION, BASE_SHARDS = 2, 2, 8


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


def uniform_tree(shards: int) -> list[Shard]:
    """Shards of equal weight: the first eight in two regions of two racks of two, each further one in a new region.

    A new region takes keys from all others and none of them passes keys to another, so a further shard takes rows
    only into itself.
    """
    tree = []
    for s in range(shards):
        if s < BASE_SHARDS:
            per_region = SHARDS_PER_RACK * RACKS_PER_REGION
            region, rack = f"r{s // per_region}", f"k{s % per_region // SHARDS_PER_RACK}"
        else:
            region, rack = f"r{s - BASE_SHARDS + BASE_SHARDS // (SHARDS_PER_RACK * RACKS_PER_REGION)}", "k0"
        tree.append(Shard(s, region, rack))
    return tree


def _draw(key: Column, child: str, weight: float) -> Column:
    # 13 hexadecimal digits, moved off zero, give u in (0, 1).
    u = (hex_bits(F.md5(F.concat_ws("/", F.lit(child), key)), 1, 13) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(weight))


def _winner(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the smallest draw; equal draws go to the child named first."""
    if len(children) == 1:
        return children[0][2]
    draws = [F.struct(_draw(key, name, weight).alias("d"), F.lit(i).alias("i")) for i, (name, weight, _) in enumerate(children)]
    first = F.least(*draws)["i"]
    value = F.when(first == 0, children[0][2])
    for i, (_, _, column) in enumerate(children[1:-1], 1):
        value = value.when(first == i, column)
    return value.otherwise(children[-1][2])


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """The shard number of a key: region, then rack, then shard."""
    shards = [s for s in tree if s.weight > 0]
    if not shards:
        raise ValueError("the tree has no shard of positive weight")
    key = F.coalesce(key.cast("string"), F.lit(""))

    def level(members: list[Shard], path: tuple[str, ...]) -> Column:
        if len(path) == 3:
            return F.lit(members[0].number)
        names: dict[str, list[Shard]] = {}
        for s in members:
            names.setdefault((s.region, s.rack, f"s{s.number}")[len(path)], []).append(s)
        return _winner(
            key,
            [("/".join((*path, n)), sum(s.weight for s in of), level(of, (*path, n))) for n, of in names.items()],
        )

    return level(shards, ())


def assign(docs: DataFrame, tree: list[Shard], key: str = "doc_id", name: str = "shard") -> DataFrame:
    """`docs` with its shard in the column `name`."""
    return docs.withColumn(name, shard_of(F.col(key), tree))


def with_slots(docs: DataFrame, key: str, ties: list[str], shard: str = "shard", name: str = "slot") -> DataFrame:
    """Adds `name`: the place of a row in its shard, without gaps from 0, in the order of a hash of the key."""
    hashed = docs.withColumn("_md5", F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))).withColumn(
        "_one", F.lit(1).cast("bigint")
    )
    return shuffled_offsets(hashed, shard, "_md5", ties, "_one", name).drop("_md5", "_one")


def placed(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of `docs`.

    Texts are read and keys are drawn once; the slots are found on what that wrote.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    slim = assign(slim, uniform_tree(shards))
    slim = written(assign(slim, uniform_tree(shards + 1), name="grown_shard"), "shards")
    return with_slots(slim, "doc_id", ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op7_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(read(spark, sf_dir, "documents"))


# ---- the same in SQL -------------------------------------------------------------------------------------------------


def _draw_sql(child: str, weight: float) -> str:
    u = f"(cast('0x'||substr(md5('{child}/'||k), 1, 13) as bigint) + 0.5::double) / {float(1 << 52)}::double"
    return f"-ln({u}) / {float(weight)}::double"


def shard_sql(tree: list[Shard]) -> str:
    """The shard number of the key `k`, a string."""

    def level(members: list[Shard], path: tuple[str, ...]) -> str:
        if len(path) == 3:
            return str(members[0].number)
        names: dict[str, list[Shard]] = {}
        for s in members:
            names.setdefault((s.region, s.rack, f"s{s.number}")[len(path)], []).append(s)
        if len(names) == 1:
            return level(members, (*path, next(iter(names))))
        draws = ", ".join(_draw_sql("/".join((*path, n)), sum(s.weight for s in of)) for n, of in names.items())
        whens = " ".join(f"when {i} then {level(of, (*path, n))}" for i, (n, of) in enumerate(names.items(), 1))
        return f"case list_position([{draws}], list_min([{draws}])) {whens} end"

    return level([s for s in tree if s.weight > 0], ())


# CRC-32 has no function there. It is linear: the state after a block is the state before it, moved past the block's
# bytes, with what each byte becomes after those that follow it. 3988292384 is the polynomial, 4294967295 are 32 ones.
SQL = f"""
with recursive bits(step, b, v) as (
 select 0, i, i from range(256) t(i)
 union all select step + 1, b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where step < 8),
one as materialized (select b, v from bits where step = 8),
-- The state after the byte b and d bytes of zero.
moved(d, b, v) as (
 select 0, b, v from one
 union all select d + 1, m.b, xor(m.v >> 8, one.v) from moved m join one on one.b = m.v & 255 where d < 255),
far as materialized (select cast(d as bigint) as d, b, v from moved),
-- What byte p of a state becomes after a whole block.
past as materialized (select 255 - d as p, b, v from far where d > 251),
docs as materialized (
 select row_number() over () as r, cast(doc_id as bigint) as doc_id, coalesce(cast(doc_id as varchar), '') as k,
  strlen(coalesce(text, '')) as bytes, hex(encode(coalesce(text, ''))) as x from documents),
-- Blocks of 256 bytes after a first one that takes what is left over.
blocks as materialized (
 select r, n, case when n = 0 then substr(x, 1, 2 * (bytes % 256)) else substr(x, 2 * (bytes % 256) + 512 * n - 511, 512) end as x
 from (select r, x, bytes, unnest(range(bytes // 256 + 1)) as n from docs)),
single as (
 select r, n, len(x) // 2 - 1 - i as d, cast('0x'||substr(x, 2 * i + 1, 2) as bigint) as b
 from (select r, n, x, unnest(range(len(x) // 2)) as i from blocks)),
sums as (select r, n, bit_xor(far.v) as v from single join far using (d, b) group by r, n),
own as materialized (select r, n, coalesce(v, 0) as v from blocks left join sums using (r, n)),
start as (
 select m, xor(coalesce(bit_xor(far.v), 0), case when m < 4 then 4294967295 >> (8 * m) else 0 end) as v
 from range(256) t(m) left join far on far.b = 255 and far.d between m - 4 and m - 1 group by m),
state(r, n, v) as (
 select own.r, own.n, xor(own.v, start.v) from own join docs using (r) join start on m = bytes % 256 where own.n = 0
 union all
 select own.r, own.n, xor(own.v, xor(xor(a.v, b.v), xor(c.v, d.v))) from state s join own on own.r = s.r and own.n = s.n + 1
  join past a on a.p = 0 and a.b = s.v & 255 join past b on b.p = 1 and b.b = s.v >> 8 & 255
  join past c on c.p = 2 and c.b = s.v >> 16 & 255 join past d on d.p = 3 and d.b = s.v >> 24),
placed as (
 select doc_id, k, bytes + 1 as size, xor(v, 4294967295) as text_crc32, {shard_sql(uniform_tree(8))} as shard,
  {shard_sql(uniform_tree(9))} as grown_shard
 from docs join state using (r) where n = bytes // 256)
select doc_id, size, text_crc32, 'key' as law, shard,
 row_number() over (partition by shard order by md5(k), doc_id nulls first, size, text_crc32) - 1 as slot, grown_shard from placed
"""
