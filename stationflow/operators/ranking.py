"""Row numbers without a single-task sort.

``row_number`` over one huge partition (or over 24 hours) puts that partition
in one task. Here rows are range-partitioned by the full order instead, each
row learns its bucket and its position in the bucket, and ranks follow from
the row counts of the buckets before it. A hot group spreads over as many
buckets as its rows fill. One placement serves every rank in the same order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationflow.session import materialise

BUCKET, POSITION, IN_GROUP = "_bucket", "_position", "_in_group"

_PART_BITS = 33

Order = Sequence[Column | str]


def _place() -> Column:
    """The place of a row in its task."""
    # The id Spark assigns here is the partition number above 33 bits of row number.
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PART_BITS) - 1))


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def place_in_order(df: DataFrame, order: Order, by: str | Sequence[str] | None = None) -> DataFrame:
    """Sort ``df`` across buckets; add each row's bucket and position within it.

    With ``by`` a row also learns its place in the bucket sorted by group, from which
    ``number_rows_within`` follows without another shuffle. The placed rows are written to
    the shared folder: bucket and position must be the same every time they are read, also
    after an executor is lost. ``order`` has to be total for ranks to be reproducible.
    """
    part = F.shiftright(F.monotonically_increasing_id(), _PART_BITS).cast("int")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({BUCKET: part, POSITION: _place()})
    )
    if by is not None:
        placed = placed.sortWithinPartitions(*_keys(by), POSITION).withColumn(IN_GROUP, _place())
    return materialise(placed, "placed")


def number_rows(placed: DataFrame, name: str) -> DataFrame:
    """Row number over all placed rows."""
    sizes = placed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per bucket, so never more than the shuffle has partitions.
    before = F.sum("_rows").over(
        Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(BUCKET, F.coalesce(before, F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(starts), BUCKET)
        .withColumn(name, F.col("_before") + F.col(POSITION) + 1)
        .drop("_before")
    )


def number_rows_within(
    df: DataFrame, placed: DataFrame, by: str | Sequence[str], name: str
) -> DataFrame:
    """Row number within each value of ``by``, for ``df`` derived from ``placed``, which was placed with this ``by``.

    A group's rows lie together in each bucket, so a row's rank follows from its place, the first
    place of its group in the bucket and the number of rows the group has in earlier buckets. These are
    stored, one row per group and bucket, so that Spark knows their size before it plans the join
    and rows are not shuffled for a few groups.
    """
    # As a struct, a NULL key is a group of its own, in the window and in the join.
    group = F.struct(*_keys(by))
    sizes = (
        placed.select(group.alias("_group"), BUCKET, IN_GROUP)
        .groupBy("_group", BUCKET)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(IN_GROUP).alias("_first"))
    )
    before = F.sum("_rows").over(
        Window.partitionBy("_group").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    skipped = F.coalesce(before, F.lit(0)) - F.col("_first") + 1
    starts = materialise(sizes.select("_group", BUCKET, skipped.alias("_skipped")), "starts")
    return (
        df.withColumn("_group", group)
        .join(starts, ["_group", BUCKET])
        .withColumn(name, F.col(IN_GROUP) + F.col("_skipped"))
        .drop("_group", "_skipped")
    )


def global_row_number(df: DataFrame, order: Order, name: str = "row_number") -> DataFrame:
    """``row_number`` over all rows in ``order``, on every task at once."""
    return number_rows(place_in_order(df, order), name).select(*df.columns, name)


def rank_in(
    df: DataFrame, by: str | Sequence[str], order: Order, name: str = "rank"
) -> DataFrame:
    """``row_number`` within ``by`` in ``order``; groups of any size."""
    placed = place_in_order(df, order, by)
    return number_rows_within(placed, placed, by, name).select(*df.columns, name)
