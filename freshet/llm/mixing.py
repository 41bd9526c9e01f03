"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled and laid end to end, as often as the mix repeats them, and that stream of words is
cut into blocks of equal size. The mix is a schedule of slots, one block each. Slot n is the point of the van der Corput
sequence in base 2 whose digits are those of n in reverse; the interval from 0 to 1 is divided between the sources in
proportion to their targets, and the point tells the source. So each stretch of the schedule holds every source in
proportion, up to a logarithmic number of slots. The k-th slot of a source takes the k-th block of its stream.

The rank k needs no sorting: the number of earlier points in an interval is a sum over the digits of the point (`_rank`).
Only DataFrame functions are used. Texts are read once, for their sizes, and never shuffled; a source that holds most
documents is laid out run by run (`shuffled_offsets`).

Defined results: a null text has size 0; documents of size 0 are taken 0 times. A null source is a source of its own,
the last one. Repeated rows are documents of their own. Without any words every target is 0. An empty table gives an
empty table. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import named_key, read, salted_join, shuffled_offsets, total_of, word_count, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 1024
# Digits of a point: up to 2**40 slots.
DIGITS = 40
CHUNK = 4096


def source_targets(sized: DataFrame, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source (`_key`): source, source_size, target and the whole number of words to take.

    Targets are shares of `share` times all sizes by weight, at most `repeats` times the source's own size, the excess
    going to the others by weight. With sources in the order of cap / weight, those up to some place are full and the
    rest gets level * weight; the level is the one that the sums before a source give at the first source not full.
    """
    sums = sized.groupBy("_key").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("_n"), F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = sums.withColumn("_n", F.row_number().over(order) - 1).withColumn("_w", weight)
    ranked = ranked.withColumn("_cap", F.col("source_size").cast("double") * repeats).withColumn(
        "_ratio", F.col("_cap") / F.col("_w")
    )
    by_ratio = Window.orderBy("_ratio", "_n").rowsBetween(Window.unboundedPreceding, -1)
    full = ranked.withColumn("_caps", F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0))).withColumn(
        "_ws", F.coalesce(F.sum("_w").over(by_ratio), F.lit(0.0))
    )
    level = (F.sum("source_size").over(every) * F.lit(share) - F.col("_caps")) / (
        F.sum("_w").over(every) - F.col("_ws")
    )
    full = full.withColumn("_level", level)
    # The level at the first source, by ratio, that does not reach its cap; infinite if all do.
    chosen = full.withColumn(
        "_level", F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "_n", "_level"))).over(every)
    )
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level._level") * F.col("_w"), F.col("_cap")))
    return chosen.select("_key", "source", "source_size", target.alias("target")).withColumn(
        "_take", F.floor("target").cast("bigint")
    )


def _rank(point: Column, low: Column, high: Column) -> Column:
    """How many points of [low, high) come before `point` in the van der Corput sequence.

    Points are numbers of DIGITS bits. Where bit q of `point` is set, the earlier ones that differ there first have
    the same lower bits and a zero at q: they are the numbers of one residue modulo 2 ** (q + 1).
    """

    def below(bound: Column, q: int) -> Column:
        residue = point.bitwiseAND(F.lit((1 << q) - 1))
        return F.greatest(F.lit(0).cast("bigint"), F.shiftright(bound - residue + F.lit((1 << (q + 1)) - 1), q + 1))

    return total_of(
        [
            F.when(F.getbit(point, F.lit(q)) == 1, below(high, q) - below(low, q)).otherwise(F.lit(0).cast("bigint"))
            for q in range(DIGITS)
        ]
    )


def schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The slots: _key, source, slot (its order in the mix), _block (number of the source's block) and its words.

    A source owns as many neighbouring points as it takes blocks; its last block may be shorter.
    """
    n = F.ceil(F.col("_take") / block).cast("bigint")
    before = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    owned = targets.withColumn("_blocks", n).withColumn(
        "_low", F.coalesce(F.sum("_blocks").over(before), F.lit(0).cast("bigint"))
    )
    # A source's points are made in chunks that are dealt out before they are spelled out.
    chunks = owned.where("_blocks > 0").select(
        "_key", "source", "_take", "_low", "_blocks",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_blocks") - 1) / CHUNK).cast("bigint"))).alias("_chunk"),
    )
    first = F.col("_chunk") * CHUNK
    last = F.least(first + (CHUNK - 1), F.col("_blocks") - 1)
    points = chunks.repartition("_key", "_chunk").select(
        "_key", "source", "_take", "_low", "_blocks", F.explode(F.sequence(first, last)).alias("_i")
    )
    point = F.col("_low") + F.col("_i")
    ranked = points.withColumn("_point", point).withColumn(
        "_block", _rank(F.col("_point"), F.col("_low"), F.col("_low") + F.col("_blocks"))
    )
    reverse = F.conv(F.reverse(F.lpad(F.bin("_point"), DIGITS, "0")), 2, 10).cast("bigint")
    return ranked.select(
        "_key",
        "source",
        reverse.alias("slot"),
        "_block",
        F.least(F.lit(block).cast("bigint"), F.col("_take") - F.col("_block") * block).alias("slot_words"),
    )


def pieces(laid: DataFrame, slots: DataFrame, block: int = BLOCK_WORDS, repeats: int = REPEATS) -> DataFrame:
    """What each slot takes of each document: the row of `laid`, epoch, slot, and the number of words.

    `laid` has _key, source_size, _offset and size. A document lies in the stream once per epoch.
    """
    epochs = laid.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    start = F.col("epoch") * F.col("source_size") + F.col("_offset")
    cut = epochs.withColumn("_start", start).withColumn(
        "_block",
        F.explode(
            F.sequence(
                F.floor(F.col("_start") / block).cast("bigint"),
                F.floor((F.col("_start") + F.col("size") - 1) / block).cast("bigint"),
            )
        ),
    )
    begin = F.greatest(F.col("_start"), F.col("_block") * block)
    end = F.least(F.col("_start") + F.col("size"), F.col("_block") * block + F.col("slot_words"))
    joined = cut.join(slots.drop("source"), ["_key", "_block"])
    return joined.withColumn("words", F.greatest(F.lit(0).cast("bigint"), end - begin)).where("words > 0")


def laid_out(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sized rows (doc_id, source, size, _key, _md5) with offsets in their source's stream, and the targets."""
    sized = written(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
        )
        .withColumn("_key", named_key(F.col("source")))
        .withColumn("_md5", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
        "sizes",
    )
    targets = written(source_targets(sized), "targets")
    laid = shuffled_offsets(sized.drop("source"), "_key", "_md5", ["doc_id", "size"], "size", "_offset")
    return salted_join(laid, targets, "_key"), targets


def mixed(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row of `docs`."""
    laid, targets = laid_out(docs)
    laid = written(laid, "streams")
    place = ["_key", "_md5", "_offset", "doc_id"]
    taken = pieces(laid, schedule(targets, block), block).groupBy(*place).agg(F.sum("words").alias("taken"))
    # A row of size 0 shares its place with the row after it, and takes nothing.
    nothing = laid.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    joined = laid.where("size > 0").join(
        taken.select(*[F.col(c).alias(f"_t{c}") for c in place], "taken"),
        (F.col("_key") == F.col("_t_key"))
        & (F.col("_md5") == F.col("_t_md5"))
        & (F.col("_offset") == F.col("_t_offset"))
        & F.col("doc_id").eqNullSafe(F.col("_tdoc_id")),
        "left",
    )
    columns = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken")]
    return joined.select(*columns).unionByName(nothing.select(*columns))


def op2_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents"))


def _targets_sql() -> str:
    weights = ", ".join(str(w) for w in WEIGHTS)
    return f"""
sized as (select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as h,
  cast(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) as bigint) as size
  from documents),
sums as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
ranked as (select *, list_extract([{weights}]::double[], cast((row_number() over (order by source asc nulls last) - 1) % {len(WEIGHTS)} + 1 as int)) as w,
  row_number() over (order by source asc nulls last) as n, {float(REPEATS)} * source_size as cap from sums),
levels as (select *, cap / w as ratio, ({SHARE} * sum(source_size) over () - coalesce(sum(cap) over b, 0)) /
  (sum(w) over () - coalesce(sum(w) over b, 0)) as level from ranked
  window b as (order by cap / w, n rows between unbounded preceding and 1 preceding)),
chosen as (select arg_min(level, (ratio, n)) as level from levels where ratio > level),
targets as (select source, source_size, least(cap, coalesce((select level from chosen) * w, cap)) as target from ranked)"""


SQL = f"""
with {_targets_sql()},
laid as (select doc_id, size, source_size, target, cast(floor(target) as bigint) as t,
  cast(sum(size) over (partition by s.source order by h, doc_id, size rows unbounded preceding) - size as bigint) as o
  from sized s join targets g on s.source is not distinct from g.source)
select doc_id, size, source_size, target,
  cast(greatest(0, least(o + size, t) - o) + greatest(0, least(source_size + o + size, t) - source_size - o) as bigint) as taken
from laid"""
