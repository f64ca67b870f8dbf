"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule: its share of the stream at training
time t in [0, 1] is target * (a + 2 (1 - a) t), early for a > 1 and late for
a < 1, so its cumulative demand is target * (a t + (1 - a) t**2).  The
documents of a source stand in a fixed random order, repeated when the target
exceeds the source; the words before a document invert to the time at which
the curriculum calls for it, and the mix is the documents sorted by that time.

Targets share a budget by weight and stop at ``cap`` times the size of the
source; what is cut off is shared again by weight until no target is above.

Cumulative words come from two steps without a task that holds a source:
sums by (source, slice of the hash), and a running sum within each slice, where
equal rows are one row with a number of copies.  Sources are never collected.

Defined cases: a null text has size 0 and is taken 0 words; a null source is
a source of its own, last; documents of size 0 take no words; repeated rows
count each time; an empty table has an empty mix; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm import work

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a slice of a source, about.
SLICE_WORDS = 4 << 20
#: Schedules by class of weight: early, even, late.
RAMPS = (1.6, 1.0, 0.4)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(rows: DataFrame, order: list[Column], path: str) -> DataFrame:
    """rows with number, from 0 in that order: ranges first, then a running sum over ranges only."""
    n = work.partitions(rows.sparkSession)
    place = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = work.stored(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1))), path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))  # as many rows as partitions
    parts = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    return ranged.join(parts, "part").withColumn("number", F.col("first") + F.col("at")).drop("part", "at", "first")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], budget: float, cap: float) -> DataFrame:
    """(source, source_size) to (source, source_size, target, ramp, pace): one row a source.

    Targets share budget times all sizes by weight, none above cap times its
    size: a level per weight rises until what is full no longer changes.  pace
    is the mean ramp, weighted by target.
    """
    spark = sizes.sparkSession
    base = work.folder(spark, "sources")
    order = [F.col("source").isNull(), F.col("source")]  # code points, null last
    turn = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("number") % len(values) + 1).cast("int"))
    own = numbered(sizes.select("source", "source_size"), order, f"{base}/numbered")
    own = work.stored(own.select("source", "source_size", turn([float(w) for w in weights]).alias("weight"), turn(RAMPS).alias("ramp")), f"{base}/weighted")
    most = F.col("source_size") * float(cap)
    total, weight = own.agg(F.sum("source_size"), F.sum(F.when(F.col("source_size") > 0, F.col("weight")))).first()
    left, open_, full, level = budget * float(total or 0), float(weight or 0), 0, 0.0
    while True:
        level = max(level, left / open_) if open_ > 0 else float("inf")
        is_full = (F.col("source_size") > 0) & (F.col("weight") * level >= most)
        told = own.agg(F.count_if(is_full), F.sum(F.when(is_full, most)), F.sum(F.when(is_full, F.col("weight")))).first()
        if told[0] == full:
            break
        full, left, open_ = told[0], budget * total - told[1], weight - told[2]
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).when(F.col("weight") * level >= most, most).otherwise(F.col("weight") * level)
    own = own.select("source", "source_size", target.alias("target"), "ramp")
    pace = own.agg(F.try_divide(F.sum(F.col("target") * F.col("ramp")), F.sum("target"))).first()[0]
    return work.stored(own.withColumn("pace", F.lit(float(pace if pace is not None else 1.0))), f"{base}/targets")


def _time(done: Column) -> Column:
    """The time at which a share done of a source's demand is met: a t + (1 - a) t^2 = done."""
    a = F.col("ramp")
    root = F.sqrt(F.greatest(a * a + 4 * (1 - a) * done, F.lit(0.0)))
    return F.least(F.greatest(2 * done / (a + root), F.lit(0.0)), F.lit(1.0))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), budget: float = 1.5, cap: int = 2, seed: int = 17, whole: bool = False) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, taken, repeats, position.

    taken counts the words that the mix takes, over at most cap passes; the
    document at which a source reaches its target is taken in part, or with
    whole, taken if at least half of it fits.  position is the time of the
    first pass, null where nothing is taken.
    """
    spark = docs.sparkSession
    source = F.col("source").cast("string")
    light = docs.select("doc_id", source.alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", F.crc32(F.col("text").cast("binary"))).alias("lot"))
    base = work.folder(spark, "mix")
    light = light.groupBy("doc_id", "source", "size", "lot").agg(F.count(F.lit(1)).alias("copies"))
    light = work.stored(light, f"{base}/light")
    words = F.col("size") * F.col("copies")
    sizes = light.groupBy("source").agg(F.sum(words).alias("source_size"))
    plan = source_targets(sizes, weights, budget, cap)
    bulk = light.agg(F.coalesce(F.sum(words), F.lit(0)).alias("n")).first().n
    slices = 1
    while slices * SLICE_WORDS < bulk and slices < 1 << 20:
        slices *= 2
    slices = max(slices, 256)

    light = light.withColumn("slice", F.pmod(F.shiftrightunsigned("lot", 20), F.lit(slices)))
    sums = light.groupBy("source", "slice").agg(F.sum(words).alias("slice_size"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"), F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("s_before"))
    within = Window.partitionBy("source", "slice").orderBy("lot", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    light = light.withColumn("own", F.coalesce(F.sum(words).over(within), F.lit(0)))
    placed = light.join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    placed = placed.withColumn("copy", copy).withColumn("before", F.col("own") + F.col("s_before") + F.col("copy") * F.col("size"))
    placed = placed.drop("own", "s_source", "s_slice", "s_before", "slice", "lot", "copies", "copy")
    plan = plan.withColumnRenamed("source", "p_source")
    rows = placed.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    goal = F.round("target").cast("long")
    taken, repeats = F.lit(0).cast("long"), F.lit(0)
    for k in range(cap):
        room = goal - (F.col("source_size") * k + F.col("before"))
        if whole:
            used = F.when((room >= F.col("size")) | (room * 2 >= F.col("size")), F.col("size")).otherwise(0)
        else:
            used = F.greatest(F.least(room, F.col("size")), F.lit(0))
        used = F.when(F.col("size") > 0, used).otherwise(F.lit(0)).cast("long")
        taken, repeats = taken + used, repeats + F.when(used > 0, 1).otherwise(0)
    rows = rows.withColumn("taken", taken).withColumn("repeats", repeats)
    position = F.when(F.col("taken") > 0, _time(F.col("before") / F.col("target")))
    return rows.withColumn("position", position).select("doc_id", "source", "size", "source_size", "target", "taken", "repeats", "position", "before", "ramp", "pace")


def in_order(mixed: DataFrame) -> DataFrame:
    """The mix range-sorted by training position, what is not taken last."""
    stored = work.stored(mixed, work.folder(mixed.sparkSession, "positions"))
    return stored.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def passes(mixed: DataFrame) -> DataFrame:
    """A row for each pass over a document, with the time of that pass."""
    each = mixed.filter(F.col("repeats") > 0).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)))
    at = (F.col("before") + F.col("turn") * F.col("source_size")) / F.col("target")
    return each.withColumn("position", _time(at))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, once for each pass, range-sorted by training position.

    Documents are taken whole; the columns are those of docs.
    """
    columns = docs.columns
    p = "__mix_"  # own columns carry a prefix, so that none of docs clashes
    turns = passes(work.stored(mix(docs, whole=True, **settings), work.folder(docs.sparkSession, "positions")))
    turns = turns.select(F.col("doc_id").alias(f"{p}doc"), F.col("source").alias(f"{p}source"), F.col("size").alias(f"{p}words"), F.col("pace").alias(f"{p}pace"), "turn", "position")
    own = [f"{p}doc", f"{p}source", f"{p}words", f"{p}pace"]
    one = turns.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("turn", "position"))).alias(f"{p}turns"))
    one = one.withColumn(f"{p}at", F.expr(f"transform({p}turns, x -> x.position)")).drop(f"{p}turns")
    body = docs.withColumn(f"{p}size", word_count(F.col("text")))
    at = F.col(f"{p}at")
    # repeated rows of a document share its list of passes: each row takes its own part
    if turns.groupBy(*own, "turn").count().filter("count > 1").limit(1).count():
        same = Window.partitionBy("doc_id", "source", f"{p}size")
        body = body.withColumn(f"{p}rank", F.row_number().over(same.orderBy(F.xxhash64("text")))).withColumn(f"{p}rows", F.count(F.lit(1)).over(same))
        at = F.expr(f"filter({p}at, (x, i) -> i % {p}rows = {p}rank - 1)")
    match = F.col("doc_id").eqNullSafe(F.col(f"{p}doc")) & F.col("source").cast("string").eqNullSafe(F.col(f"{p}source")) & (F.col(f"{p}size") == F.col(f"{p}words"))
    sent = body.join(one, match).withColumn(f"{p}now", F.explode(at))
    # the share of all words that the schedules ask for until then: equal ranges of it are even partitions, without sampling
    n = work.partitions(docs.sparkSession)
    now, pace = F.col(f"{p}now"), F.col(f"{p}pace")
    part = F.least(F.floor((pace * now + (1 - pace) * now * now) * n), F.lit(n - 1)).cast("int")
    return sent.repartitionById(n, part).sortWithinPartitions(f"{p}now", "doc_id").select(*columns)
