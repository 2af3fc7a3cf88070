"""Mixing sources to target weights.

The texts of a source are packed, in pseudorandom order, into blocks of a fixed
number of words; long sources are packed as many independent streams, so that no
window holds a whole source. The mix is a list of output shards of SHARD_SLOTS slots
(the last one of fewer). The slots of each source in the whole mix follow from its
share, by one uniform number for all sources, to within one slot. Which shards they
fall into is drawn: all slots are dealt by one pseudorandom permutation, so the
counts of the sources in a shard are multinomial counts, given their totals, and differ
from shard to shard. The slots of a source are numbered through all shards; slot number
-> block is a pseudorandom permutation of the source's blocks in each pass, and the
blocks are joined by that index. No block is taken more than twice.

A null source is a source of its own, the last one. A null, empty or wordless text
has size 0 and is never taken. Repeated rows are mixed one by one. An empty table
gives an empty mix. The only single-task windows are over one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revcat.llm.common import WORD, whole_text
from revcat.session import written

BLOCK_WORDS = 128
#: Words of one packed stream; a larger source is split into several.
STREAM_WORDS = 2_000_000
SHARD_SLOTS = 1 << 16
SHARE, MAX_PASSES = 1.5, 2
WEIGHTS = (5, 2, 1)
ROUNDS = 12  # of the permutation


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: number_, weight, source_size, target (words).

    Sources share SHARE of all words by weight; none gets more than MAX_PASSES of
    itself. Ordered by cap over weight, the capped sources come first: a source is
    capped if its cap is within what the level of the sources from it on would be.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("number_") - 1) % len(WEIGHTS))
    rows = sizes.withColumn("number_", number).withColumn("weight", weights).withColumn("cap", F.lit(float(MAX_PASSES)) * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    every, before = Window.partitionBy(), Window.orderBy("ratio", "number_").rowsBetween(Window.unboundedPreceding, -1)
    pool = SHARE * F.sum("source_size").over(every)
    left = pool - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("pool", pool).withColumn("capped", F.col("ratio") <= left / weight_left)
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    given = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    target = F.when(F.col("capped"), F.col("cap")).otherwise((F.col("pool") - given) * F.col("weight") / open_weight)
    return rows.select("source", "number_", "weight", "source_size", target.alias("target"))


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, chosen by the key: rounds that swap x with k - x, or not.

    Both partners of a pair hash the same number, so both swap or neither does.
    """

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("shift"), *key, r), n) - x, n)
        coin = F.xxhash64(F.lit("coin"), *key, r, F.greatest(x, partner))
        return F.when(coin.bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, step)


def uniform(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53))


def _packed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with its stream and its offset in it; rows of size 0, which no block covers, are in no window.

    Any other row has a word or more, so a stream has no more rows than words.
    """
    of_source = sources.select(F.col("source").alias("source_"), "number_", "source_size", "target")
    rows = sized.join(of_source, F.col("source").eqNullSafe(F.col("source_")))
    streams = F.greatest(F.lit(1), F.ceil(F.col("source_size") / STREAM_WORDS))
    rows = rows.withColumn("stream", F.pmod(F.xxhash64(F.lit("stream"), "doc_id", "size"), streams))
    order = Window.partitionBy("number_", "stream").orderBy(F.xxhash64(F.lit("order"), F.col("doc_id")), "doc_id", "size")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    columns = ["doc_id", "size", "source_size", "target", "number_", "stream"]
    packed = rows.where("size > 0").select(*columns, F.coalesce(before, F.lit(0)).alias("at"))
    return packed.unionByName(rows.where("size = 0").select(*columns, F.lit(0).cast("long").alias("at")))


def _slots(blocks: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """(shard, place, number_, slot, block): each slot of the mix, by its source's number and its own number in it."""
    totals = blocks.groupBy("number_").agg(F.sum("n_blocks").alias("n_blocks"))
    rows = sources.join(totals, "number_").where("n_blocks > 0 AND source_size > 0")
    # Slots that give the target on average: the last block of a stream is shorter.
    rows = rows.withColumn("slots", F.col("target") * F.col("n_blocks") / F.col("source_size"))
    every, to_here = Window.partitionBy(), Window.orderBy("number_").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("all_slots", F.sum("slots").over(every)).withColumn("to", F.sum("slots").over(to_here))
    rows = rows.withColumn("n_slots", F.round("all_slots").cast("long"))
    is_last = F.col("number_") == F.max("number_").over(every)
    upper = F.when(is_last, F.lit(1.0)).otherwise(F.col("to") / F.col("all_slots"))
    lower = F.coalesce(F.lag("upper").over(Window.orderBy("number_")), F.lit(0.0))
    rows = rows.withColumn("upper", upper).withColumn("lower", lower)
    # Of the points m + u, m = 0..n_slots-1, those of the source are from .. to - 1.
    u = uniform(F.lit(seed), F.lit("shard"), F.lit(0).cast("long"))
    rows = rows.withColumn("from", F.ceil(F.col("n_slots") * F.col("lower") - u)).withColumn("to", F.ceil(F.col("n_slots") * F.col("upper") - u))
    # Few rows here become all slots: spread them first, by number, which adaptive execution leaves alone.
    step = F.lit(SHARD_SLOTS).cast("long")
    runs = rows.where(F.col("from") < F.col("to")).select("*", F.explode(F.sequence(F.col("from"), F.col("to") - 1, step)).alias("first"))
    runs = runs.repartition(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    last = F.least(F.col("first") + step, F.col("to")) - 1
    slots = runs.select("number_", "n_blocks", "n_slots", "from", F.explode(F.sequence(F.col("first"), last)).alias("point"))
    slots = slots.withColumn("slot", F.col("point") - F.col("from")).where(F.col("slot") < MAX_PASSES * F.col("n_blocks"))
    dealt = permuted(F.col("point"), F.col("n_slots"), F.lit(seed), F.lit("places"))
    block = permuted(F.col("slot") % F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("number_"), F.expr("slot div n_blocks"))
    slots = slots.select("number_", "slot", block.alias("block"), dealt.alias("dealt"))
    return slots.select(
        F.expr(f"dealt div {SHARD_SLOTS}").alias("shard"), (F.col("dealt") % SHARD_SLOTS).alias("place"), "number_", "slot", "block"
    )


def _taken_blocks(blocks: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """(number_, block, times): how often the mix takes each block, in all shards."""
    return _slots(blocks, sources, seed).groupBy("number_", "block").agg(F.count("*").alias("times"))


def _blocks(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sources with targets, packed rows, and streams with the number of their first block."""
    size = F.regexp_count(whole_text(f"`{text_col}`"), F.lit(WORD)).cast("long")
    sized = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.alias("size")), "mix")
    sources = written(targets(sized), "mix-sources")
    packed = written(_packed(sized, sources), "mix-packed")
    streams = packed.groupBy("number_", "stream").agg(F.ceil(F.sum("size") / BLOCK_WORDS).alias("n_blocks"))
    earlier = Window.partitionBy("number_").orderBy("stream").rowsBetween(Window.unboundedPreceding, -1)
    return sources, packed, streams.withColumn("first_block", F.coalesce(F.sum("n_blocks").over(earlier), F.lit(0)))


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1) -> DataFrame:
    """The mix as written out: shard, place in it, source, and the block that fills the place.

    A block is BLOCK_WORDS words of its source (the last of a stream fewer).
    """
    sources, _, streams = _blocks(docs, id_col, text_col, source_col)
    named = sources.select("number_", "source")
    return _slots(streams, sources, seed).join(named, "number_").select("shard", "place", "source", "block")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (of its source), taken (words)."""
    sources, packed, streams = _blocks(docs, id_col, text_col, source_col)
    taken = _taken_blocks(streams, sources, seed)
    covers = packed.where("size > 0").join(streams.select("number_", "stream", "first_block"), ["number_", "stream"])
    inside = F.explode(F.sequence(F.expr(f"at div {BLOCK_WORDS}"), F.expr(f"(at + size - 1) div {BLOCK_WORDS}")))
    covers = covers.withColumn("inside", inside).withColumn("block", F.col("first_block") + F.col("inside"))
    overlap = F.least(F.col("at") + F.col("size"), (F.col("inside") + 1) * BLOCK_WORDS) - F.greatest(F.col("at"), F.col("inside") * BLOCK_WORDS)
    row = ["doc_id", "size", "source_size", "target"]
    words = F.sum(F.col("overlap") * F.coalesce("times", F.lit(0)))
    mixed = (
        covers.select(*row, "number_", "block", "stream", "at", overlap.alias("overlap"))
        # Never broadcast: there are as many blocks as the corpus has, and the planner's estimate does not see the explode.
        .join(taken.hint("merge"), ["number_", "block"], "left")
        .groupBy(*row, "number_", "stream", "at")
        .agg(words.alias("taken"))
    )
    return mixed.select(*row, "taken").unionByName(packed.where("size = 0").select(*row, F.lit(0).cast("long").alias("taken")))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1) -> DataFrame:
    """``docs`` as the mix takes them, in whole documents and their own columns.

    A document that is taken x times its size appears floor(x) times, and once
    more with probability x - floor(x), by a hash of its identifier. Rows that
    repeat an identifier share one x; a null identifier counts as one. Columns may
    have any name.
    """
    parts = mix(docs, id_col, text_col, source_col, seed).groupBy("doc_id").agg((F.sum("taken") / F.sum(F.greatest("size", F.lit(1)))).alias("x"))
    copies = F.floor(F.col("x") + uniform(F.lit(seed), F.lit("copies"), F.col("doc_id"))).cast("int")
    chosen = parts.select(F.col("doc_id").alias("chosen"), copies.alias("copies")).where("copies > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"))
    rows = rows.join(chosen, F.col("id").eqNullSafe(F.col("chosen")))
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
