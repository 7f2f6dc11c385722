"""Row numbers, n-tiles and ranks over a whole table, without a one-task window.

Row numbers: a global sort leaves partition ``i`` wholly in front of partition ``i + 1``. Once that result is checkpointed, a
row's place is the number of rows in the partitions before it plus its index inside its own partition. Only the partition
sizes pass through the driver.

N-tiles by one order take the places of one such sort. By several orders a sort for each is spared: the first row of each
tile is all that is needed. Samples of keys narrow down where it can be, exact counts say on which side
it is, and the few rows left in between are looked at one by one.

Ranks need the order of values, not of rows: rows are counted per value, counts are summed up in value order, and rows are
joined to the rank of their value.

The functions run the passes they need when they are called.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import ASC, SortKey, directed
from tillbook.session import checkpointed

_PART, _START, _INDEX, _POSITION = "_part", "_start", "_index", "_position"

# monotonically_increasing_id() keeps the index of a row inside its partition in the low 33 bits.
_INDEX_BITS = (1 << 33) - 1

# Keys that may be looked at one by one on the driver, and keys of a sample.
_FEW_KEYS, _SAMPLE_KEYS = 50_000, 4_000

# A long holds every decimal of this many digits; a double tells any two decimals of _DOUBLE_DIGITS digits apart.
_LONG_DIGITS, _DOUBLE_DIGITS = 18, 15


def _sorted(df: DataFrame, order: Sequence[SortKey]) -> DataFrame:
    """Global sort. Decimals too wide for a long compare slowly, so they are sorted by their double first, and by
    their own value only where two different ones could share a double."""
    helpers, keys = {}, []
    for name, direction in order:
        kind = df.schema[name].dataType
        if isinstance(kind, T.DecimalType) and kind.precision > _LONG_DIGITS:
            value, limit = F.col(name), 10.0 ** (_DOUBLE_DIGITS - kind.scale)
            near, rest = f"_near_{name}", f"_rest_{name}"
            helpers[near] = value.cast("double")
            helpers[rest] = F.when(F.abs(helpers[near]) >= limit, value)
            keys += [directed(near, direction), directed(rest, direction)]
        else:
            keys.append(directed(name, direction))
    return df.withColumns(helpers).orderBy(*keys).select(*df.columns) if helpers else df.orderBy(*keys)


def _placed(df: DataFrame, order: Sequence[SortKey], out: str) -> tuple[DataFrame, int]:
    rows = checkpointed(_sorted(df, order)).select(
        "*",
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX_BITS)).alias(_INDEX),
    )
    sizes = {row[_PART]: row["count"] for row in rows.groupBy(_PART).count().collect()}
    ends = list(accumulate(sizes.get(part, 0) for part in range(max(sizes, default=0) + 1)))
    # a row of two numbers per partition, so its size is bounded by the number of partitions
    starts = df.sparkSession.createDataFrame(list(enumerate([0, *ends[:-1]])), f"{_PART} int, {_START} bigint")
    placed = rows.join(F.broadcast(starts), _PART).withColumn(out, F.col(_START) + F.col(_INDEX))
    return placed.select(*df.columns, out), ends[-1]


def global_position(df: DataFrame, order: Sequence[SortKey], out: str) -> DataFrame:
    """Row number from 1 in ``order``. For a repeatable result ``order`` ends in a unique column."""
    placed, _ = _placed(df, order, out)
    return placed.withColumn(out, F.col(out) + 1)


def global_ntile(df: DataFrame, tiles: int, order: Sequence[SortKey], out: str) -> DataFrame:
    """Number of the tile, 1 to ``tiles``, when the rows in ``order`` are cut into tiles of equal size.

    As in SQL, sizes differ by one at most and the larger tiles come first.
    """
    placed, rows = _placed(df, order, _POSITION)
    size, larger = divmod(rows, tiles)
    in_larger = larger * (size + 1)
    tile = F.when(F.col(_POSITION) < in_larger, F.expr(f"{_POSITION} div {size + 1}")).otherwise(
        F.expr(f"({_POSITION} - {in_larger}) div {max(size, 1)} + {larger}")
    )
    return placed.withColumn(out, tile + 1).drop(_POSITION)


def _reached(df: DataFrame, order: Sequence[SortKey], first: Row) -> Column:
    """Whether a row stands at ``first`` or behind it; NULL is the largest value."""
    reached = F.lit(True)
    for name, direction in reversed(order):
        value, bound = F.col(name), F.lit(first[name]).cast(df.schema[name].dataType)
        if direction == ASC:
            behind = F.lit(False) if first[name] is None else value.isNull() | (value > bound)
        else:
            behind = value.isNotNull() if first[name] is None else F.coalesce(value < bound, F.lit(False))
        reached = behind | (value.eqNullSafe(bound) & reached)
    return reached


def _in_order(keys: Sequence[Row], order: Sequence[SortKey]) -> list[Row]:
    """Keys sorted as Spark sorts them here: NULL above NaN above all other values."""

    def placed(value: object) -> tuple:
        return (2,) if value is None else (1,) if value != value else (0, value)

    for name, direction in reversed(order):
        keys = sorted(keys, key=lambda row, name=name: placed(row[name]), reverse=direction != ASC)
    return list(keys)


@dataclass
class _Sought:
    """The row at ``position`` in ``order``: at ``low`` or behind it and before ``high``, the one of the ``inside`` rows
    there that has ``position - before`` of them before it."""

    order: Sequence[SortKey]
    position: int
    inside: int
    before: int = 0
    low: Row | None = None
    high: Row | None = None

    def holds(self, df: DataFrame) -> Column:
        low = F.lit(True) if self.low is None else _reached(df, self.order, self.low)
        return low if self.high is None else low & ~_reached(df, self.order, self.high)


def _marked(rows: DataFrame, names: Sequence[str], marks: Sequence[Column]) -> list[Row]:
    """The keys with any of the marks, and which, in columns ``_0``, ``_1`` and so on."""
    columns = [mark.alias(f"_{number}") for number, mark in enumerate(marks)]
    return rows.filter(reduce(Column.__or__, marks)).select(*names, *columns).collect()


def _narrowed(rows: DataFrame, sought: Sequence[_Sought], seed: int) -> None:
    """Two passes: a sample of the keys in each range, then exact counts around where the row should be in it."""
    names = sorted({name for row in sought for name, _ in row.order})
    bits = F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(1 << 30))
    drawn = [row.holds(rows) & (bits < int(_SAMPLE_KEYS / row.inside * (1 << 30))) for row in sought]
    sample = _marked(rows, names, drawn)
    cuts: list[tuple[_Sought, Row]] = []
    for number, row in enumerate(sought):
        keys = _in_order([key for key in sample if key[f"_{number}"]], row.order)
        at, margin = (row.position - row.before) * len(keys) // row.inside, 2 * isqrt(len(keys)) + 1
        cuts += [(row, keys[place]) for place in (at - margin, at + margin) if 0 <= place < len(keys)]
    if not cuts:
        return
    counts = rows.agg(*(F.count_if(row.holds(rows) & ~_reached(rows, row.order, key)) for row, key in cuts)).first()
    found = [(row, key, row.before + count) for (row, key), count in zip(cuts, counts, strict=True)]
    for row in sought:
        ends = [(row.before, row.low), (row.before + row.inside, row.high)]
        own = [(before, key) for of, key, before in found if of is row]
        row.before, row.low = max((end for end in [ends[0], *own] if end[0] <= row.position), key=lambda end: end[0])
        last, row.high = min((end for end in [ends[1], *own] if end[0] > row.position), key=lambda end: end[0])
        row.inside = last - row.before


def _rows_at(rows: DataFrame, count: int, sought: Sequence[tuple[Sequence[SortKey], int]]) -> list[Row]:
    """The keys of the rows at these places (from 0) in these orders, each of which tells all rows apart.

    A pass leaves about a fifteenth of a range, whatever its size; ranges of ``_FEW_KEYS`` in all are collected.
    """
    goals = [_Sought(order, position, count) for order, position in sought]
    seed, patience, few = 0, 20, max(64, _FEW_KEYS // len(goals))
    while wide := [goal for goal in goals if goal.inside > few]:
        if seed > patience:
            raise ValueError("an order must end in columns that tell all rows apart")
        _narrowed(rows, wide, seed)
        seed += 1
    names = sorted({name for goal in goals for name, _ in goal.order})
    keys = _marked(rows, names, [goal.holds(rows) for goal in goals])
    out = []
    for number, goal in enumerate(goals):
        own = _in_order([key for key in keys if key[f"_{number}"]], goal.order)
        out.append(own[goal.position - goal.before])
    return out


def global_ntiles(df: DataFrame, tiles: int, orders: Mapping[str, Sequence[SortKey]]) -> DataFrame:
    """``global_ntile`` by several orders, named by their output columns; each must end in unique columns.

    The rows are computed once and stay where they are; all tiles of all orders share the passes over them. What
    reaches the driver are samples, counts and a bounded number of keys for each first row of a tile, and these rows
    become the bounds that all rows are held against.
    """
    rows = checkpointed(df)
    names = sorted({name for order in orders.values() for name, _ in order})
    keys = rows.select(*names).limit(_FEW_KEYS + 1).collect()
    count = len(keys) if len(keys) <= _FEW_KEYS else rows.count()
    size, larger = divmod(count, tiles)
    starts = [start for tile in range(1, tiles) if (start := tile * size + min(tile, larger)) < count]
    sought = [(out, order, start) for out, order in orders.items() for start in sorted(set(starts))]
    if count <= _FEW_KEYS:
        placed = {out: _in_order(keys, order) for out, order in orders.items()}
        firsts = [placed[out][start] for out, _, start in sought]
    else:
        firsts = _rows_at(rows, count, [(order, start) for _, order, start in sought]) if sought else []
    scores = {}
    for out, order in orders.items():
        own = [first for (of, _, _), first in zip(sought, firsts, strict=True) if of == out]
        scores[out] = reduce(Column.__add__, (_reached(rows, order, first).cast("int") for first in own), F.lit(1).cast("bigint"))
    return rows.withColumns(scores)


def _running(counts: DataFrame, direction: str, out: str) -> DataFrame:
    """``_value`` with the number of ``_rows`` before it, from 1."""
    ordered = checkpointed(_sorted(counts, [("_value", direction)])).withColumn(_PART, F.spark_partition_id())
    sums = {row[_PART]: row["_rows"] for row in ordered.groupBy(_PART).agg(F.sum("_rows").alias("_rows")).collect()}
    ends = list(accumulate(sums.get(part, 0) for part in range(max(sums, default=0) + 1)))
    starts = counts.sparkSession.createDataFrame(list(enumerate([0, *ends[:-1]])), f"{_PART} int, {_START} bigint")
    ahead = Window.partitionBy(_PART).orderBy(directed("_value", direction)).rowsBetween(Window.unboundedPreceding, -1)
    # starts: two numbers per partition
    return ordered.join(F.broadcast(starts), _PART).select(
        "_value", (F.col(_START) + F.coalesce(F.sum("_rows").over(ahead), F.lit(0)) + 1).alias(out)
    )


def global_rank(df: DataFrame, value: SortKey, out: str) -> DataFrame:
    """Rank by ``value``: equal values share a rank, and as many ranks are left out behind them.

    Rows are counted per value. A table of many values, a value and a count a row, is sorted and checkpointed: sums of its
    partitions pass through the driver, running sums follow inside each. Few values are summed up on the driver. Rows meet
    the rank of their value in a join, in which adaptive execution splits a value on most rows.
    """
    name, direction = value
    counts = df.groupBy(F.col(name).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    few = counts.limit(_FEW_KEYS + 1).collect()
    if len(few) <= _FEW_KEYS:
        few = _in_order(few, [("_value", direction)])
        places = accumulate((row["_rows"] for row in few), initial=1)
        kind = T.StructType([T.StructField("_value", df.schema[name].dataType), T.StructField(out, T.LongType())])
        ranks = df.sparkSession.createDataFrame([(row["_value"], place) for row, place in zip(few, places, strict=False)], kind)
    else:
        ranks = _running(counts, direction, out)
    return df.join(ranks, F.col(name).eqNullSafe(F.col("_value"))).select(*df.columns, out)
