"""Mixing sources to target weights: blocks, multinomial shard counts, index permutations.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, let, materialize, prefix_sums, words

#: Words of a block, slots of an output shard.
BLOCK = 32
SHARD_SLOTS = 4096
#: Documents of a bucket, about: the unit within which offsets are summed in order.
BUCKET_DOCS = 500
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_USES = 2
SEED = 17


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_uses: int = MOST_USES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Sources stand by code point, null last, and take the weights in turn.
    Water-filling: a source stops at most_uses times its size, and what is
    over goes to the others by weight.  Sources fill up in the order of
    room / weight, so the first k of that order are full, where k is the number
    whose room is at most their part of what the fuller ones leave.
    """
    # a source's number is found without a window over all rows in one task only for few sources;
    # the table has one row for each source, after aggregation
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8")))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.select("source", "source_size", w.alias("weight")).withColumn("room", F.col("source_size") * F.lit(float(most_uses)))
    every = Window.partitionBy()
    up = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8")).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("total", F.lit(share) * F.sum("source_size").over(every)).withColumn("weights", F.sum("weight").over(every))
    t = t.withColumn("used", F.coalesce(F.sum("room").over(up), F.lit(0.0))).withColumn("gone", F.coalesce(F.sum("weight").over(up), F.lit(0.0)))
    level = (F.col("total") - F.col("used")) / (F.col("weights") - F.col("gone"))
    t = t.withColumn("level", level).withColumn("full", F.col("room") <= F.col("weight") * level)
    last = F.max(F.when(~F.col("full"), F.col("level"))).over(every)  # of the first that is not full: later ones are lower
    return t.select("source", "source_size", F.when(F.col("full"), F.col("room")).otherwise(F.col("weight") * last).alias("target"))


def uniform(*parts: Column) -> Column:
    """A deterministic number in [0, 1) from the parts."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11).cast("double") / F.lit(float(1 << 53))


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """The place of x in a pseudorandom permutation of 0..n-1 chosen by the key.

    A Feistel network permutes a square grid of at least n cells; a place beyond
    n is walked on until it falls below n, which takes at most as many steps as
    the grid has spare cells, and only about 2 in sqrt(n) places walk at all.
    """
    side = F.ceil(F.sqrt(n.cast("double"))).cast("long")

    def grid(at: Column) -> Column:
        a, b = (at / side).cast("long"), at % side
        for turn in range(4):
            a, b = b, (a + F.pmod(F.xxhash64(F.lit(SEED + turn), *key, b), side)) % side
        return a * side + b

    first = grid(x)
    spare = side * side - n + 1
    walked = F.aggregate(F.sequence(F.lit(1).cast("long"), spare), first, lambda at, _: F.when(at < n, at).otherwise(grid(at)))
    return F.when(first < n, first).otherwise(walked)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def document_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc, source, hash, size) of every row, written once."""
    sized = docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), text_hash(F.col(text_col)).alias("hash"), F.size(words(F.col(text_col))).cast("long").alias("size"))
    return materialize(sized, "sizes")


def place_documents(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(doc, source, hash, copy, size, start, source_size, target): where each row's words begin in its source.

    The order within a source is by bucket, id and text hash; copy numbers the
    rows that are equal in all three.  Offsets are summed inside buckets and,
    in runs, over buckets, so no task needs a whole source.
    """
    buckets = max(16, sized.count() // BUCKET_DOCS)
    # the hash spreads rows without an id over the buckets
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED), "doc", "hash"), F.lit(buckets)))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    named = targets.withColumnRenamed("source", "w")
    sums = prefix_sums(materialize(sums, "bucket-sizes"), "in_bucket", "before", "bucket", "source")
    bucket = Window.partitionBy("source", "bucket").orderBy("doc", "hash", "size")
    same = Window.partitionBy("source", "bucket", "doc", "hash").orderBy("size")
    placed = sized.withColumn("offset", F.coalesce(F.sum("size").over(bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("copy", F.row_number().over(same))
    sums = sums.join(named, F.col("source").eqNullSafe(F.col("w"))).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "source_size", "target")
    sums = materialize(sums, "bucket-starts")
    joined = placed.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.select("doc", "source", "hash", "copy", "size", (F.col("before") + F.col("offset")).alias("start"), "source_size", "target")


#: Cells into which a range is cut to find the part of it that holds a place by an equal cell, not by comparing all.
CELLS = 4096


def in_ranges(places: DataFrame, at: str, ranges: DataFrame, low: str, high: str, most: Column) -> DataFrame:
    """places joined to the one range (low <= at < high) that holds each; ranges lie side by side in 0..most."""
    cell = lambda x: F.least(F.floor(x * CELLS / most), F.lit(CELLS - 1))
    cut = ranges.where(F.col(low) < F.col(high)).withColumn("__cell", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high)))))
    return places.withColumn("__cell", cell(F.col(at))).join(cut, "__cell").where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop("__cell")


def draw_slots(targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, most_uses: int = MOST_USES) -> DataFrame:
    """(source, epoch, index, shard): the block that each output slot takes.

    Every shard gives a source the whole part of its expected slots and draws
    the rest from a multinomial over the fractional parts, by the inverse of
    their cumulative weights.  The whole parts and the draws are made by ranges
    of numbers, split over tasks, and meet their source by cells, so nothing is
    made from a few rows and no table is broadcast by force.  A source has room
    for most_uses times its blocks; slots drawn beyond that go, evenly, to the
    room that the other sources have left, so every shard is full.
    """
    spark = targets.sparkSession
    order = [F.col("source").isNull(), F.encode("source", "UTF-8")]
    up = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    t = targets.where("target > 0").withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long")).withColumn("nr", F.row_number().over(Window.orderBy(*order)))
    total = t.agg(F.sum("target")).first()[0] or 0.0
    slots = math.ceil(total / block)
    full, last = divmod(slots, shard_slots)
    # all shards but the last have one width
    kinds, widths = [], []
    for width, shards, first in ((shard_slots, full, 0), (last, 1, full)):
        if width and shards:
            widths.append((width, shards, first))
            kinds.append(t.select("nr", (F.col("target") * width / total).alias("want"), F.lit(width).alias("width")))
    if not widths:
        return t.select("source", F.lit(0).cast("long").alias("epoch"), F.col("blocks").alias("index"), F.lit(0).cast("long").alias("shard")).where("false")
    made = drawn = None
    for (width, shards, first), kind in zip(widths, kinds, strict=True):
        kind = kind.withColumn("base", F.floor("want")).withColumn("part", F.col("want") - F.col("base"))
        above = Window.orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)
        kind = materialize(kind.withColumn("low", F.coalesce(F.sum("base").over(above), F.lit(0))).withColumn("part_low", F.coalesce(F.sum("part").over(above), F.lit(0.0))), "slot-shares")
        whole, parts = kind.agg(F.sum("base"), F.sum("part")).first()
        # slot i of a shard: the sources' whole parts lie side by side below `whole`, and draws stand above
        if whole:
            ranges = kind.select("nr", "base", F.col("low").alias("from"), (F.col("low") + F.col("base")).alias("to"))
            places = spark.range(shards * whole).select(F.floor(F.col("id") / whole).alias("k"), (F.col("id") % whole).alias("i"))
            some = in_ranges(places, "i", ranges, "from", "to", F.lit(whole))
            some = some.select("nr", (F.col("k") + first).alias("shard"), (F.col("k") * F.col("base") + F.col("i") - F.col("from")).alias("slot"), F.lit(width).alias("width"))
            made = some if made is None else made.unionByName(some)
        if draws := width - whole:
            # the last source's range is open, as rounding may leave the sum of the parts short of a draw
            ranges = kind.where("part > 0").select("nr", F.col("part_low").alias("from"), F.coalesce(F.lead("part_low").over(Window.orderBy("nr")), F.lit(float(parts) + 1)).alias("to"))
            places = spark.range(shards * draws).select((F.floor(F.col("id") / draws) + first).alias("shard"), (F.col("id") % draws).alias("draw"))
            places = places.withColumn("u", uniform(F.col("shard"), F.col("draw")) * F.lit(float(parts)))
            some = in_ranges(places, "u", ranges, "from", "to", F.lit(float(parts) + 1)).select("nr", "shard")
            drawn = some if drawn is None else drawn.unionByName(some)
    shares = None
    for (_, shards, _), kind in zip(widths, kinds, strict=True):
        some = kind.select("nr", (F.floor("want") * shards).alias("whole"), "width")
        shares = some if shares is None else shares.unionByName(some)
    # the whole parts of the last shard follow those of all others
    after = shares.where(F.col("width") == widths[0][0]).select("nr", F.col("whole").alias("skip")) if len(widths) > 1 else None
    if made is not None and after is not None:
        made = made.join(after, "nr").withColumn("slot", F.when(F.col("width") == widths[0][0], F.col("slot")).otherwise(F.col("slot") + F.col("skip")))
    taken = shares.groupBy("nr").agg(F.sum("whole").alias("whole"))
    room = t.select("nr", "source", "blocks").join(taken, "nr").withColumn("most", F.lit(most_uses) * F.col("blocks"))
    slots_of = made.select("nr", "shard", "slot") if made is not None else None
    if drawn is not None:
        counts = materialize(drawn.groupBy("nr", "shard").agg(F.count("*").alias("n")), "draws")
        counts = materialize(prefix_sums(counts, "n", "first", "shard", "nr"), "draw-places")
        extra = counts.select("nr", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("j"))
        gotten = counts.groupBy("nr").agg(F.sum("n").alias("drawn"))
        side = room.join(gotten, "nr", "left").withColumn("used", F.col("whole") + F.coalesce("drawn", F.lit(0)))
        nr_up = Window.orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)
        side = side.withColumn("over", F.greatest(F.col("used") - F.col("most"), F.lit(0))).withColumn("free", F.greatest(F.col("most") - F.col("used"), F.lit(0)))
        side = side.withColumn("over_low", F.coalesce(F.sum("over").over(nr_up), F.lit(0))).withColumn("free_low", F.coalesce(F.sum("free").over(nr_up), F.lit(0)))
        side = materialize(side.select("nr", "whole", "most", "used", "over_low", "free", "free_low"), "room")
        over, free = side.agg(F.sum(F.greatest(F.col("used") - F.col("most"), F.lit(0))), F.sum("free")).first()
        extra = extra.join(side.select("nr", "whole", "most", "over_low"), "nr").withColumn("slot", F.col("whole") + F.col("j"))
        fits = extra.where("slot < most").select("nr", "shard", "slot")
        slots_of = fits if slots_of is None else slots_of.unionByName(fits)
        if over:
            # the k-th of the slots beyond takes place floor(k * free / over) of the room left: each place at most once
            beyond = extra.where("slot >= most").select("shard", F.floor((F.col("over_low") + F.col("slot") - F.col("most")) * F.lit(float(free) / over)).alias("at"))
            ranges = side.select("nr", "used", F.col("free_low").alias("from"), (F.col("free_low") + F.col("free")).alias("to"))
            moved = in_ranges(beyond, "at", ranges, "from", "to", F.lit(free)).select("nr", "shard", (F.col("used") + F.col("at") - F.col("from")).alias("slot"))
            slots_of = slots_of.unionByName(moved)
    named = slots_of.join(t.select("nr", "source", "blocks"), "nr")
    named = named.select("source", "shard", "blocks", F.floor(F.col("slot") / F.col("blocks")).alias("epoch"), (F.col("slot") % F.col("blocks")).alias("at"))
    return named.select("source", "epoch", permuted(F.col("at"), F.col("blocks"), F.coalesce("source", F.lit("\0null")), F.col("epoch")).alias("index"), "shard")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shard_slots: int = SHARD_SLOTS, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """The documents' places, and the pieces the mixture takes.

    Places: doc, source, hash, copy, size, start, source_size, target for every row.
    Pieces: doc, source, hash, copy, start, size, epoch, shard, low, high: the
    words low..high-1 of the row that a slot of that shard takes in that epoch.
    Null texts have no words; a null source is a source of its own; rows that
    repeat an id are rows of their own, told apart by text and copy; a long text
    is cut into blocks like any other; an empty table gives empty results.
    """
    # each step is written, so that no plan holds all of them: the driver plans a plan anew whenever a part of it ends
    sized = document_sizes(docs, id_col, text_col, source_col)
    targets = materialize(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share), "targets")
    placed = materialize(place_documents(sized, targets), "places")
    discard(sized)
    slots = materialize(draw_slots(targets, block, shard_slots), "slots")
    spans = placed.where("size > 0").select("doc", "source", "hash", "copy", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("index"))
    s = slots.select(F.col("source").alias("s"), F.col("index").alias("i"), "epoch", "shard")
    low = F.greatest(F.col("index") * block - F.col("start"), F.lit(0))
    high = F.least((F.col("index") + 1) * block - F.col("start"), F.col("size"))
    pieces = spans.join(s, F.col("source").eqNullSafe(F.col("s")) & (F.col("index") == F.col("i"))).select("doc", "source", "hash", "copy", "start", "size", "epoch", "shard", low.alias("low"), high.alias("high"))
    return placed, pieces


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(doc, source, size, source_size, target, taken) of every row; taken counts repeats."""
    placed, pieces = mix(docs, **options)
    got = pieces.groupBy("doc", "source", "start", "size").agg(F.sum(F.col("high") - F.col("low")).alias("n"))
    got = got.select(F.col("doc").alias("d"), F.col("source").alias("s"), F.col("start").alias("b"), F.col("size").alias("z"), "n")
    on = F.col("doc").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("start") == F.col("b")) & (F.col("size") == F.col("z"))
    return placed.join(got, on, "left").select("doc", "source", "size", "source_size", "target", F.coalesce("n", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars", **options) -> DataFrame:
    """The columns of docs, one row for each row of docs of which the mixture takes words.

    Its text is what each epoch takes, in order, epochs apart by a line end: the
    text itself where an epoch takes all of it, else the taken words with single
    spaces.  Rows that repeat an id are rows of their own: each takes its words
    at most as often as the mixture may use a block.  Null and blank texts go.
    """
    _, pieces = mix(docs, id_col, text_col, source_col, **options)
    row = ["doc", "source", "hash", "copy"]
    runs = pieces.groupBy(*row, "size", "epoch").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("runs"), F.sum(F.col("high") - F.col("low")).alias("n"))
    epochs = runs.groupBy(*row).agg(F.sort_array(F.collect_list(F.struct("epoch", "n", "size", "runs"))).alias("__epochs")).withColumnsRenamed({c: f"__{c}" for c in row})
    hashed = docs.withColumn("__h", text_hash(F.col(text_col)))
    same = Window.partitionBy("__h", id_col, source_col).orderBy(F.lit(0))
    hashed = hashed.withColumn("__c", F.row_number().over(same))
    on = (F.col("__h") == F.col("__hash")) & (F.col("__c") == F.col("__copy")) & hashed[id_col].eqNullSafe(epochs["__doc"]) & hashed[source_col].eqNullSafe(epochs["__source"])
    joined = hashed.join(epochs, on)

    def part(ws: Column, e: Column) -> Column:
        runs = F.transform(e["runs"], lambda r: F.slice(ws, (r["low"] + 1).cast("int"), (r["high"] - r["low"]).cast("int")))
        return F.when(e["n"] == e["size"], F.col(text_col)).otherwise(F.array_join(F.flatten(runs), " "))

    # let() binds the words: as a plain column they would be split anew for each run
    text = let(words(F.col(text_col)), lambda ws: F.array_join(F.transform("__epochs", lambda e: part(ws, e)), "\n"))
    out = joined.withColumn("__text", text)
    cols = [F.col("__text").alias(c) if c == text_col else F.length("__text").cast(docs.schema[c].dataType).alias(c) if c == length_col else F.col(c) for c in docs.columns]
    return out.select(*cols)
