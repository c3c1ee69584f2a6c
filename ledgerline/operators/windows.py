"""Window operators: previous value, running totals, frames, numbering, centred average.

Two of them would need a one-task window if written directly: a running total
and a row number over a whole table. ``running_total`` cuts the order into
buckets instead, adds up each bucket, and starts every bucket with the sum of
those before it. The buckets are either expressions the caller gives (the plan
stays lazy) or ranges sampled from the data (even sizes for any distribution, at
the price of writing the rows to the checkpoint folder).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators.ordering import ascending
from ledgerline.session import cut_lineage

#: Rows of one range, and so of one window task, at most (about).
ROWS_PER_RANGE = 2_000_000
_VALUE = "__value"
_ROW = "__is_row"


def previous_or_zero(value: str, partition_by: Sequence[str], order_by: Sequence[str]) -> Column:
    """``LAG`` by row; the first row of a partition gets 0."""
    window = W.partitionBy(*partition_by).orderBy(*ascending(*order_by))
    return F.coalesce(F.lag(value).over(window), F.lit(0))


def partition_total(value: str, partition_by: Sequence[str]) -> Column:
    """Total of an already aggregated value over each partition."""
    return F.sum(value).over(W.partitionBy(*partition_by))


def _bucket_offsets(totals: DataFrame, fixed: list[str], levels: list[str], values: list[str]) -> DataFrame:
    """Sum of all earlier buckets, per bucket and value.

    Earlier means earlier at the last level within the same parent, plus the
    offset of that parent; so no step sorts more than one parent's children.
    """
    parent, last = levels[:-1], levels[-1]
    before = (
        W.partitionBy(*fixed, *parent)
        .orderBy(*ascending(last))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    inside = totals.select(
        *fixed, *levels, *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(v) for v in values]
    )
    if not parent:
        return inside
    parent_totals = totals.groupBy(*fixed, *parent).agg(*[F.sum(v).alias(v) for v in values])
    above = _bucket_offsets(parent_totals, fixed, parent, values).select(
        *[F.col(c).alias(f"__p_{c}") for c in [*fixed, *parent]], *[F.col(v).alias(f"__above_{v}") for v in values]
    )
    return inside.join(above, _same([*fixed, *parent], "__p_"), "inner").select(
        *fixed, *levels, *[(F.col(v) + F.col(f"__above_{v}")).alias(v) for v in values]
    )


def _same(columns: Sequence[str], prefix: str) -> Column:
    """Each column equals its prefixed copy, NULL equal to NULL."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return condition


def range_buckets(
    df: DataFrame, order_by: Sequence[Column], unique_order: bool = False, name: str = "__range"
) -> DataFrame:
    """Cut ``df`` into ranges of ``order_by`` of about equal size.

    There are as many as shuffle partitions, or more where a range would hold over ``ROWS_PER_RANGE``
    rows; AQE joins neighbours where the data is small. The ranges are sampled, so they are written to the checkpoint
    folder: a range number that later stages compute anew could differ. Unless the
    order tells every row from every other, the rows are written with a last key
    ``__tie`` before, so that even a run of equal rows can be cut and a retried task
    cuts it in the same place.
    """
    if unique_order:
        stored = df.withColumn("__tie", F.lit(0).cast("bigint"))
    else:
        stored = cut_lineage(df.withColumn("__tie", F.monotonically_increasing_id()))
    cut = _by_range(stored, [*order_by, F.col("__tie").asc()])
    return cut_lineage(cut.withColumn(name, F.spark_partition_id()))


def _by_range(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned; the number of ranges follows the number of rows, so none grows with the table."""
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = -(-df.count() // ROWS_PER_RANGE)
    return df.repartitionByRange(ranges, *order) if ranges > shuffles else df.repartitionByRange(*order)


def running_totals(
    df: DataFrame,
    values: Mapping[str, tuple[Column, str]],
    order_by: Sequence[Column],
    buckets: Mapping[str, Column] | None = None,
    partition_by: Sequence[str] = (),
    unique_order: bool = False,
) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY .. ORDER BY .. ROWS UNBOUNDED PRECEDING)`` at any size.

    ``values`` maps each output column to its value and exact type. ``buckets`` are
    named expressions, outermost first, that never decrease along ``order_by`` (year,
    then day, then ``id div 1000000``). Choose the innermost so that its buckets have
    a known largest size; a unique id cut into ranges does. Without them,
    ``range_buckets`` finds some, with one write less where ``unique_order`` holds. Each bucket then gets one leading row that carries
    the sums of all earlier buckets, so the result needs one shuffle of the rows and
    no join. A NULL value adds nothing.
    """
    if buckets is None:
        by = [F.col(c).asc_nulls_last() for c in partition_by]
        df = range_buckets(df, [*by, *order_by], unique_order)
        order_by = [*order_by, F.col("__tie").asc()]
        buckets = {"__range": F.col("__range")}
    fixed, levels = list(partition_by), list(buckets)
    inputs = {f"{_VALUE}_{name}": F.coalesce(value, F.lit(0)).cast(kind) for name, (value, kind) in values.items()}
    kinds = {f"{_VALUE}_{name}": kind for name, (_, kind) in values.items()}
    valued = df.withColumns({**buckets, **inputs})
    totals = valued.groupBy(*fixed, *levels).agg(*[F.sum(v).cast(kinds[v]).alias(v) for v in inputs])
    seeds = _bucket_offsets(totals, fixed, levels, list(inputs)).select(
        *fixed, *levels, *[F.col(v).cast(kinds[v]).alias(v) for v in inputs], F.lit(0).alias(_ROW)
    )
    rows = valued.withColumn(_ROW, F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    window = (
        W.partitionBy(*fixed, *levels)
        .orderBy(F.col(_ROW), *order_by)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    summed = {name: F.sum(f"{_VALUE}_{name}").over(window).cast(kind) for name, (_, kind) in values.items()}
    return rows.withColumns(summed).filter(F.col(_ROW) == 1).drop(*inputs, _ROW, "__tie", *levels)


def running_total(
    df: DataFrame,
    value: Column,
    order_by: Sequence[Column],
    buckets: Mapping[str, Column] | None = None,
    name: str = "running_total",
    partition_by: Sequence[str] = (),
    value_type: str = "decimal(38,2)",
    unique_order: bool = False,
) -> DataFrame:
    """``running_totals`` of one value."""
    return running_totals(df, {name: (value, value_type)}, order_by, buckets, partition_by, unique_order)


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    buckets: Mapping[str, Column] | None = None,
    name: str = "row_num",
    start: int | Column = 0,
    partition_by: Sequence[str] = (),
    unique_order: bool = False,
) -> DataFrame:
    """Dense numbers ``start + 1, start + 2, ...`` in a declared total order, per partition if one is given."""
    base = start if isinstance(start, Column) else F.lit(start)
    if buckets is None and not partition_by:
        numbered = _number_ranges(df, order_by, name, unique_order)
    else:
        numbered = running_total(df, F.lit(1), order_by, buckets, name, partition_by, "bigint", unique_order)
    return numbered.withColumn(name, (F.col(name) + base).cast("bigint"))


def _number_ranges(df: DataFrame, order_by: Sequence[Column], name: str, unique_order: bool) -> DataFrame:
    """Numbers from 1: sort within ranges, take the place in the range, add the rows of all earlier ranges.

    The rows are range-partitioned and written once, with range and place; a second shuffle is not needed. The
    counts are one row per range, and so is what is broadcast.
    """
    order = list(order_by)
    if not unique_order:
        df = cut_lineage(df.withColumn("__tie", F.monotonically_increasing_id()))
        order.append(F.col("__tie").asc())
    # The low 33 bits of that id count the rows of the task.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = _by_range(df, order).sortWithinPartitions(*order)
    placed = cut_lineage(sorted_rows.withColumns({"__range": F.spark_partition_id(), "__place": place}))
    counts = placed.groupBy(F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    earlier = counts.select("__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    joined = placed.join(F.broadcast(earlier), F.col("__range") == F.col("__r"))
    return joined.withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__range", "__place", "__r", "__before", "__tie")


def daily_running_total(
    daily: DataFrame, value: str, day: str, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """ROWS frame over one row per day: at most 366 rows a year, so a plain window."""
    window = (
        W.partitionBy(*partition_by)
        .orderBy(*ascending(day))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return daily.withColumn(name, F.sum(value).over(window))


def daily_range_total(
    daily: DataFrame, value: str, day: str, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """RANGE frame over day rows: all rows of the current date count."""
    window = (
        W.partitionBy(*partition_by)
        .orderBy(*ascending(day))
        .rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    return daily.withColumn(name, F.sum(value).over(window))


def peer_totals(
    df: DataFrame, value: Column, order_by: str, partition_by: Sequence[str] = (), value_type: str = "decimal(38,2)"
) -> DataFrame:
    """One row per peer group (equal order key), with the group's sum.

    Both RANGE and GROUPS frames give equal keys an equal result, so the frame can
    run over peer groups instead of rows. The sums combine on the map side: a key
    that holds a third of the table is one row here.
    """
    return df.groupBy(*partition_by, order_by).agg(F.sum(value.cast(value_type)).cast(value_type).alias(_VALUE))


def groups_frame(
    df: DataFrame,
    value: Column,
    order_by: str,
    name: str,
    lower: int | None = None,
    upper: int | None = 0,
    partition_by: Sequence[str] = (),
    value_type: str = "decimal(38,2)",
) -> DataFrame:
    """``SUM(value) OVER (.. ORDER BY k GROUPS BETWEEN lower AND upper)``.

    Spark has no GROUPS mode. A frame of peer groups is a ROWS frame over the peer
    totals; the rows then pick their group's figure up by an equi-join. ``None`` is
    an unbounded side; negative numbers are preceding groups.

    The window sorts the *distinct* order keys of one partition in one task. Where
    those may be many, ``large_groups_frame`` does the same in buckets.
    """
    window = (
        W.partitionBy(*partition_by)
        .orderBy(*ascending(order_by))
        .rowsBetween(
            W.unboundedPreceding if lower is None else lower,
            W.unboundedFollowing if upper is None else upper,
        )
    )
    framed = peer_totals(df, value, order_by, partition_by, value_type).select(
        *partition_by, order_by, F.sum(_VALUE).over(window).alias(name)
    )
    return _attach(df, framed, [*partition_by, order_by], name)


def large_groups_frame(
    df: DataFrame,
    value: Column,
    order_by: str,
    name: str,
    lower: int | None = None,
    upper: int | None = 0,
    partition_by: Sequence[str] = (),
    value_type: str = "decimal(38,2)",
    buckets: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``groups_frame`` for any number of distinct keys.

    With two bounded sides, see ``_bounded_groups``. Otherwise peer groups get their number and the running
    sum up to them. The sum over a frame is then the difference of two running sums, which a peer group fetches
    from the groups at the frame's ends by equi-joins on the group number.
    """
    parts = list(partition_by)
    peers = peer_totals(df, value, order_by, parts, value_type)
    if lower is not None and upper is not None:
        framed = _bounded_groups(peers, order_by, name, lower, upper, parts, value_type, buckets)
        return _attach(df, framed, [*parts, order_by], name)
    figures = {
        "__g": (F.lit(1), "bigint"),
        "__s": (F.col(_VALUE), value_type),
        # How many sums are not NULL: a frame without any is NULL, not 0.
        "__n": (F.col(_VALUE).isNotNull().cast("int"), "bigint"),
    }
    running = cut_lineage(
        running_totals(peers, figures, ascending(order_by), buckets, parts, unique_order=True).select(
            *parts, order_by, "__g", "__s", "__n"
        )
    )
    whole = running.groupBy(*parts).agg(*[F.max_by(c, "__g").alias(f"__all{c}") for c in ("__g", "__s", "__n")])
    whole = whole.select(*[F.col(c).alias(f"__w_{c}") for c in parts], "__all__g", "__all__s", "__all__n")
    if parts:
        framed = running.join(whole, _same(parts, "__w_"), "inner")
    else:
        one = whole.select(F.struct("__all__g", "__all__s", "__all__n").alias("w")).scalar()
        framed = running.withColumn("__w", one).select("*", "__w.*").drop("__w")

    def fetch(rows: DataFrame, position: Column, tag: str) -> DataFrame:
        ends = running.select(
            *[F.col(c).alias(f"__{tag}_{c}") for c in parts],
            F.col("__g").alias(f"__{tag}g"), F.col("__s").alias(f"__{tag}s"), F.col("__n").alias(f"__{tag}n"),
        )
        at = _same(parts, f"__{tag}_") & (position == F.col(f"__{tag}g"))
        return rows.join(ends, at, "left")

    g, last = F.col("__g"), F.col("__all__g")
    first_in = F.lit(1) if lower is None else F.greatest(g + lower, F.lit(1))
    last_in = last if upper is None else F.least(g + upper, last)
    framed = fetch(framed.withColumns({"__from": first_in - 1, "__to": last_in}), F.col("__from"), "lo")
    framed = fetch(framed, F.col("__to"), "hi")
    total = F.col("__his") - F.coalesce(F.col("__los"), F.lit(0))
    counted = F.col("__hin") - F.coalesce(F.col("__lon"), F.lit(0))
    result = F.when((F.col("__to") > F.col("__from")) & (counted > 0), total).cast(value_type)
    return _attach(df, framed.select(*parts, order_by, result.alias(name)), [*parts, order_by], name)


def _bounded_groups(
    peers: DataFrame,
    order_by: str,
    name: str,
    lower: int,
    upper: int,
    parts: list[str],
    value_type: str,
    buckets: Mapping[str, Column] | None,
    block: int = 100_000,
) -> DataFrame:
    """A frame of numbered peer groups, block by block.

    A block of consecutive groups also gets the few groups beyond its ends that its frames reach, so a ROWS
    frame inside the block is complete. Each group moves once, those near an end twice.
    """
    size = max(block, abs(lower), abs(upper), 1)
    numbered = number_rows(peers, ascending(order_by), buckets, "__g", 0, parts, unique_order=True)
    at, home = F.pmod("__g", F.lit(size)), F.floor(F.col("__g") / F.lit(size))
    near = [
        home,
        F.when(at < max(0, upper), home - 1),
        F.when(at >= size - max(0, -lower), home + 1),
    ]
    placed = numbered.withColumn("__home", home).withColumn("__block", F.explode(F.array_compact(F.array(*near))))
    window = W.partitionBy(*parts, "__block").orderBy("__g").rowsBetween(lower, upper)
    framed = placed.withColumn(name, F.sum(_VALUE).over(window).cast(value_type))
    return framed.filter(F.col("__block") == F.col("__home")).select(*parts, order_by, name)


def running_groups_total(
    df: DataFrame,
    value: Column,
    order_by: str,
    name: str,
    buckets: Mapping[str, Column] | None = None,
    partition_by: Sequence[str] = (),
    value_type: str = "decimal(38,2)",
) -> DataFrame:
    """RANGE or GROUPS ``UNBOUNDED PRECEDING .. CURRENT ROW`` over any number of distinct keys."""
    peers = peer_totals(df, value, order_by, partition_by, value_type)
    framed = running_total(
        peers, F.col(_VALUE), ascending(order_by), buckets, name, partition_by, value_type, unique_order=True
    )
    return _attach(df, framed.select(*partition_by, order_by, name), [*partition_by, order_by], name)


def _attach(df: DataFrame, framed: DataFrame, keys: list[str], name: str) -> DataFrame:
    right = framed.select(*[F.col(k).alias(f"__k_{k}") for k in keys], name)
    return df.join(right, _same(keys, "__k_"), "inner").drop(*[f"__k_{k}" for k in keys])


def weekday_centered_average(sales: str, day: str, day_name: str, partition_by: Sequence[str] = ()) -> Column:
    """Average of the previous, current and next row.

    Monday also takes the Saturday before and Friday the Sunday after, each over
    four days. A neighbour that is not in the input counts as zero but still
    divides.
    """
    window = W.partitionBy(*partition_by).orderBy(*ascending(day))

    def at(step: int) -> Column:
        shifted = F.lag(sales, -step) if step < 0 else F.lead(sales, step)
        return F.coalesce(shifted.over(window), F.lit(0))

    today = F.col(sales)
    monday = (at(-2) + at(-1) + today + at(1)) / F.lit(4)
    friday = (at(-1) + today + at(1) + at(2)) / F.lit(4)
    other = (at(-1) + today + at(1)) / F.lit(3)
    return F.round(
        F.when(F.col(day_name) == "Monday", monday).when(F.col(day_name) == "Friday", friday).otherwise(other), 2
    )
