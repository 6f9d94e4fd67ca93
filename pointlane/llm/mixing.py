"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame operations only.

A row's size is its number of words (ASCII white space separates). Sources in
code-point order, null last, carry ``weights`` in turn and share the words of
all sources; a target stops at ``most`` times its source's size, and the excess
is shared by weight among the others.

Slots of about ``words`` words are dealt to sources by the golden-ratio points
frac(i * 0.618...) mapped through the cumulative targets, so any stretch of
slots is near the mix; a source too small for a point has one slot where its
interval begins. Slots are ranked within their source (by stretches of about
the square root of their number, whose counts are summed up, so no task ranks a
whole source).

Each source's rows stand in a shuffled order (md5 of seed and id), and the
source goes round in it as often as its target asks. What it gives is cut into
as many equal blocks as it has slots, and the slot of rank r takes block r. So
at every size of input and blocks each source gives its target, rounded to a
word. A row's ``taken`` words are those of the blocks that it overlaps.

The order is found by a range-partitioned sort that also splits ties, and sums
of partitions; so neither a source nor rows without an id go through one task.
What does is a row for each source.

Defined cases: null and wordless texts have size 0 and taken 0; a null id is
shuffled as an empty one; rows that repeat id and size are interchangeable;
an empty table, or one without words, gives taken 0 everywhere; clashing
columns: only doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import WORD, named, stored, unpacked

GOLDEN = 0.6180339887498949
#: Words of a slot; slots grow with the input.
WORDS = 1024
CELLS = 4096


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, sid, source_size, target) from rows of (source, size); sid counts sources from 0 in order."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("sid", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    by = by.withColumn("w", weight.cast("long"))
    # Sources in the order in which a rising level reaches their limits: those before the first within its share are at theirs.
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.orderBy(F.col("source_size") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(rising), F.lit(0))
    total, all_w = F.sum("source_size").over(everything), F.sum("w").over(everything)
    by = by.withColumn("total", total).withColumn("rest", F.col("total") - most * before("source_size")).withColumn("rest_w", all_w - before("w"))
    by = by.withColumn("full", F.col("w") * F.col("rest") > most * F.col("source_size") * F.col("rest_w"))
    level_words = F.col("total") - most * F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))).over(everything), F.lit(0))
    level_w = all_w - F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(everything), F.lit(0))
    by = by.withColumn("level", level_words.cast("double") / F.nullif(level_w, F.lit(0)).cast("double"))
    target = F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise(F.coalesce(F.col("w") * F.col("level"), F.lit(0.0)))
    return by.select("source", "sid", "source_size", target.alias("target"))


def slots(sources: DataFrame, n: int, total: int) -> DataFrame:
    """(slot, sid, slot_rank): the source of each of n slots and the slot's rank within it."""
    spark = sources.sparkSession
    running = Window.orderBy("sid")
    spans = sources.select("sid", "due", (F.sum("target").over(running) / F.lit(float(max(total, 1)))).alias("high"))
    spans = spans.withColumn("low", F.coalesce(F.lag("high").over(running), F.lit(0.0)))
    last = F.col("sid") == F.max("sid").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    spans = spans.withColumn("start", F.col("low")).withColumn("high", F.when(last, F.lit(2.0)).otherwise(F.col("high"))).where("low < high")
    cell = lambda c: F.least(F.floor(F.col(c) * CELLS), F.lit(CELLS - 1))
    spans = spans.withColumn("cell", F.explode(F.sequence(cell("low"), cell("high"))))
    point = F.col("slot") * F.lit(GOLDEN)
    drawn = spark.range(n).select(F.col("id").alias("slot")).withColumn("u", point - F.floor(point)).withColumn("at", cell("u"))
    drawn = drawn.join(spans, (F.col("at") == F.col("cell")) & (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))).select("slot", "sid")
    stretch = max(256, int(n**0.5) + 1)
    drawn = drawn.withColumn("stretch", F.floor(F.col("slot") / stretch))
    # A source that has words to give has a slot at least.
    none = spans.where("due > 0").select("sid", F.floor(F.col("start") * n).alias("slot")).distinct().join(drawn.select("sid").distinct(), "sid", "left_anti")
    drawn = drawn.unionByName(none.select("slot", "sid", F.floor(F.col("slot") / stretch).alias("stretch")))
    counts = drawn.groupBy("sid", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("sid").alias("of_sid"), F.col("stretch").alias("of_stretch"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("sid", "stretch").orderBy("slot"))
    ranked = drawn.withColumn("own", own).join(counts, (F.col("sid") == F.col("of_sid")) & (F.col("stretch") == F.col("of_stretch")))
    return ranked.select("slot", "sid", (F.col("own") - 1 + F.col("before")).alias("slot_rank"))


def placed(rows: DataFrame, seed: int) -> DataFrame:
    """Rows with ``place``: the words of the source before the row in its shuffled order."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    order = ["h", "size", "tie"]
    ranged = rows.withColumn("h", digest).withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("sid", *order)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("sid", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("sid").alias("of_sid"), F.col("part").alias("of_part"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("sid", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("own", F.coalesce(F.sum("size").over(own), F.lit(0)))
    joined = within.join(sums, (F.col("sid") == F.col("of_sid")) & (F.col("part") == F.col("of_part")))
    return joined.withColumn("place", F.col("own") + F.col("before")).drop("h", "tie", "part", "own", "before", "of_sid", "of_part")


def _start(block):
    """The first word of a block of what a source gives; the first ``more`` blocks have a word more than the others."""
    return block * F.col("even") + F.least(block, F.col("more"))


def _block(word):
    """The block that holds a word of what a source gives."""
    wide = F.col("more") * (F.col("even") + 1)
    return F.when(word < wide, F.floor(word / (F.col("even") + 1))).otherwise(F.col("more") + F.floor((word - wide) / F.greatest("even", F.lit(1))))


def schedule(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 8, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with sid, source_size, target, due, even, more and place; slots of (of_sid, of_block, slot)) for rows of (doc_id, source, size, ...)."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    sources = stored(targets(rows, weights, most).withColumn("due", F.round("target").cast("long")), "sources")
    dealt = stored(slots(sources, max(1, -(-total // words)), total), "slots")
    blocks = dealt.groupBy(F.col("sid").alias("s")).agg(F.count("*").alias("blocks"))
    sources = sources.join(blocks, F.col("sid") == F.col("s"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    sources = sources.select("source", "sid", "source_size", "target", "due", F.floor(F.col("due") / F.col("blocks")).alias("even"), (F.col("due") % F.col("blocks")).alias("more"))
    sources = stored(sources, "shares")
    own = rows.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("of", "source")
    return placed(own, seed), dealt.select(F.col("sid").alias("of_sid"), F.col("slot_rank").alias("of_block"), "slot")


def _rounds(rows: DataFrame, most: int) -> DataFrame:
    """A row for each time that the source's round may reach the row: ``start`` among the words that the source gives."""
    return rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn("start", F.col("place") + F.col("turn") * F.col("source_size"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 8, words: int = WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot (null: none takes it) of every row of ``docs`` (doc_id, text, source)."""
    rows = stored(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    rows, dealt = schedule(rows, weights, most, seed, words)
    rows = stored(rows, "placed")
    pieces = _rounds(rows.where("size > 0"), most).where("start < due").withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("due")))
    pieces = pieces.withColumn("block", F.explode(F.sequence(_block(F.col("start")), _block(F.col("stop") - 1))))
    overlap = F.least("stop", _start(F.col("block") + 1)) - F.greatest("start", _start(F.col("block")))
    pieces = pieces.select("sid", "place", "block", overlap.alias("overlap")).join(dealt, (F.col("sid") == F.col("of_sid")) & (F.col("block") == F.col("of_block")))
    taken = pieces.groupBy(F.col("sid").alias("t_sid"), F.col("place").alias("t_place")).agg(F.sum("overlap").alias("taken"), F.min("slot").alias("first_slot"))
    out = rows.join(taken, (F.col("sid") == F.col("t_sid")) & (F.col("place") == F.col("t_place")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 8, words: int = WORDS) -> DataFrame:
    """The mix in whole rows of ``docs``; each partition (a share of the rows by hash) in the order of the slots.

    A row comes as often as its source's rounds take half of its words or
    more, so a source is off its target by half of one row at most. A row
    without words takes none; it comes once.
    """
    names = docs.columns
    # The number of a row is written beside it, so rows that are alike stay apart.
    keyed = stored(docs.select(F.struct(*[named(c) for c in names]).alias("carried"), F.monotonically_increasing_id().alias("row")), "keyed")
    rows = keyed.select("row", "carried.doc_id", "carried.source", word_count("carried.text").alias("size"))
    rows, dealt = schedule(stored(rows, "sizes"), weights, most, seed, words)
    whole = (F.col("size") > 0) & (2 * (F.col("due") - F.col("start")) >= F.col("size"))
    copies = _rounds(rows, most).where(whole | ((F.col("size") == 0) & (F.col("turn") == 0)))
    copies = copies.withColumn("block", _block(F.greatest(F.least(F.col("start"), F.col("due") - 1), F.lit(0))))
    copies = copies.join(dealt, (F.col("sid") == F.col("of_sid")) & (F.col("block") == F.col("of_block")), "left")
    copies = copies.select(F.col("row").alias("of_row"), F.coalesce("slot", F.lit(0)).alias("at_slot"))
    out = keyed.join(copies, F.col("row") == F.col("of_row"))
    return unpacked(out.sortWithinPartitions("at_slot", "row"), names, ())
