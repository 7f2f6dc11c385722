"""Mixing sources to target weights along a training run whose weights change over time.

Each source has a schedule: its weight at points of the run, linear between them. The integral of the schedule up to
time t, times the source's target, is the words it has to deliver by then. A source delivers its documents in an order
fixed by a hash, over and over, and each delivery gets the time at which the demand reaches the words delivered so far:
the integral is inverted, a quadratic in each span of the schedule. Sorting by that time gives the training order.

All of it is DataFrame expressions. Running sums never gather a source in one task: a source is cut into buckets
by its hash, sums of buckets are added up per source, and only a bucket is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import ASC
from tillbook.llm.common import packed, stored, word_count
from tillbook.operators.ranking import global_position

Schedule = Sequence[tuple[float, float]]

#: Hex digits of the hash that make a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3
MOST_REPEATS = 3

#: Weight and schedule of sources in code point order, repeating: heavy sources lead, light ones close the run.
WEIGHTS = (5, 2, 1)
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (0.5, 1.25), (1.0, 0.5)),
    ((0.0, 0.25), (0.75, 1.0), (1.0, 2.0)),
)


def integral(schedule: Schedule) -> float:
    """Area under a schedule from its first to its last point."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def time_of(share: Column, schedule: Schedule) -> Column:
    """The time at which ``share`` (0 to 1) of the schedule's integral has passed."""
    total, passed, time = integral(schedule), 0.0, F.lit(float(schedule[-1][0]))
    spans = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area = (t1 - t0) * (w0 + w1) / 2
        spans.append((t0, w0, (w1 - w0) / (t1 - t0), passed, passed + area))
        passed += area
    for t0, weight, slope, before, after in reversed(spans):
        rest = F.greatest(share * total - before, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(weight * weight) + 2 * slope * rest, F.lit(0.0)))
        # 2r / (w + root) solves w x + slope x^2 / 2 = r for flat spans as well
        into = F.when(root + weight > 0, 2 * rest / (root + weight)).otherwise(0.0)
        time = F.when(share * total < after, F.lit(float(t0)) + into).otherwise(time)
    return time


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Target of each source from (source, source_size): its weight's share of all words, at most ``most`` times its size.

    What a full source can't take goes to the others by weight. The words per unit of weight follow in one go: sources
    fill in ascending order of size per weight, so with the first k full the level is (all - their limits) / (weight
    of the rest). It rises as long as the next source is full as well and falls after that, so its largest value
    counts. The windows span the sources, one row each; documents never get into them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = sizes.withColumn("turn", turn).withColumn("weight", weight)
    full = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = most * F.col("source_size")
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = left.cast("double") / open_weight.cast("double")
    chosen = ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least(limit.cast("double"), F.col("level") * F.col("weight"))
    return chosen.select("source", "source_size", "turn", target.alias("target"))


def planned(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Each document as ``row``, with size, source_size, target, turn, the words delivered before it, and its copies.

    A source with target r times its size delivers all its documents floor(r) times. The rest is a prefix of its
    hash order, whole documents only, that ends where it is nearest to the target.
    """
    rank = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        packed(docs), "doc_id", "source", word_count(F.col("text")).alias("size"), rank.alias("rank")
    ).withColumn("bucket", F.substring("rank", 1, BUCKET_DIGITS))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    per_source = targets(sums.groupBy("source").agg(F.sum("in_bucket").alias("source_size")), weights, most)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0).cast("long"))).alias("s")
    starts = starts.join(per_source.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
    starts = starts.select("s.source", "s.bucket", "s.start", "p.source_size", "p.turn", "p.target").alias("s")
    within = (
        Window.partitionBy("source", "bucket")
        .orderBy("rank", F.col("doc_id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = sized.withColumn("earlier", F.coalesce(F.sum("size").over(within), F.lit(0).cast("long"))).alias("d")
    same = F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.bucket") == F.col("s.bucket"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")
    more = F.col("before").cast("double") + F.col("size") / 2.0 <= rest
    copies = F.least(F.col("whole") + F.when(more, 1).otherwise(0), F.lit(most)).cast("long")
    return (
        rows.join(starts, same)
        .select("row", "d.doc_id", "size", "source_size", "turn", "target", "start", "earlier")
        .withColumn("before", F.col("start") + F.col("earlier"))
        .withColumn("whole", whole)
        .withColumn("copies", F.when(F.col("source_size") > 0, copies).otherwise(F.lit(0).cast("long")))
        .drop("start", "earlier", "whole")
    )


def taken(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """doc_id, size, source_size, target and the words the mix takes of each document, repeats counted."""
    plan = planned(docs.select("doc_id", "text", "source"), weights, most)
    words = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", words)


def timed(plan: DataFrame, schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """A row for each delivery of the documents of ``plan``, with repeat (0 and up) and time."""
    words = F.col("repeat") * F.col("source_size") + F.col("before") + F.col("size") / 2.0
    share = F.when(F.col("target") > 0, F.least(words / F.col("target"), F.lit(1.0))).otherwise(0.0)
    time = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        time = F.when(F.col("turn") % len(schedules) == i, time_of(share, schedule)).otherwise(time)
    repeats = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)
    return plan.filter(F.col("copies") > 0).withColumn("repeat", F.explode(repeats)).withColumn("time", time)


def delivered(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """The columns of ``taken``, summed over deliveries, with positions (from 1) and times of these in the training order.

    A document that is not delivered has 0 words and empty lists. Rows that repeat a document are documents of their
    own; of equal ones any may come first.
    """
    plan = planned(docs.select("doc_id", "text", "source"), weights, most).drop("row")
    plan = stored(plan.withColumn("document", F.monotonically_increasing_id()), "plan")
    # null ids come first, as in a plain sort
    keys = ("time", F.col("doc_id").isNotNull().alias("named"), "doc_id", "repeat", "document")
    order = [(name, ASC) for name in ("time", "named", "doc_id", "repeat", "document")]
    placed = global_position(timed(plan, schedules).select(*keys, "size"), order, "position")
    own = placed.groupBy("document").agg(
        F.sum("size").alias("words"), F.sort_array(F.collect_list(F.struct("position", "time"))).alias("deliveries")
    )
    listed = lambda name: F.coalesce(F.col(f"deliveries.{name}"), F.array())
    return plan.join(own, "document", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken"),
        listed("position").cast("array<long>").alias("positions"), listed("time").cast("array<double>").alias("times"),
    )


def curriculum(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """The documents of the mix in training order, a row for each delivery, with the columns of ``docs``.

    Needs doc_id, text and source; further columns pass through, whatever their names. Null text: size 0. Null ids
    count as empty text in the hash order. Documents without words are delivered like others at their place in it;
    sources without words not at all. Repeated rows are documents of their own. An empty table gives an empty table.
    """
    return timed(planned(docs, weights, most), schedules).orderBy("time", "doc_id", "repeat").select("row.*")
