"""Z-order: rows laid out so that a filter on any of several columns skips most of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 20_000
_SEED = 11
_NOT_HASHED = ("map", "array", "struct", "variant")


def _cuts(values: list, cells: int) -> list:
    """At most ``cells - 1`` different values that split sorted ``values`` evenly."""
    at = (values[i * len(values) // cells] for i in range(1, cells)) if values else ()
    return [cut for cut in dict.fromkeys(at) if cut > values[0]]


def _spread(cell: int, bits: int, place: int, width: int) -> int:
    """The bits of ``cell`` with ``width - 1`` free ones after each, moved up by ``place``."""
    return sum((cell >> i & 1) << (i * width + place) for i in range(bits))


def _cell(column: Column, cuts: list, codes: list[int]) -> Column:
    """The code of the cell a value lies in, found by halving; NULL lies in the first."""

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(codes[low]).cast("long")
        middle = (low + high + 1) // 2
        return F.when(column < F.lit(cuts[middle - 1]), pick(low, middle - 1)).otherwise(pick(middle, high))

    return F.when(column.isNull(), F.lit(codes[0]).cast("long")).otherwise(pick(0, len(cuts)))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6, sample: int = SAMPLE_ROWS) -> Column:
    """The place of a row on the Z-curve over ``columns``: their cells' bits in turn, the first column's foremost.

    A column has up to ``2 ** bits`` cells, cut at quantiles of a sample of ``sample`` rows that
    is taken now, in one pass over these columns. The sample decides how even the cells are and
    nothing else. Values of any type that Spark orders will do.
    """
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a long")
    rows = df.select(*columns).orderBy(F.rand(_SEED)).limit(sample).collect()
    codes = []
    for i, name in enumerate(columns):
        cuts = _cuts(sorted(r[name] for r in rows if r[name] is not None and r[name] == r[name]), 1 << bits)
        # Few cells are spaced out, so that a column of few values counts from the first bit on.
        cells = [(n << bits) // (len(cuts) + 1) for n in range(len(cuts) + 1)]
        place = len(columns) - 1 - i
        codes.append(_cell(F.col(name), cuts, [_spread(c, bits, place, len(columns)) for c in cells]))
    return reduce(lambda a, b: a.bitwiseOR(b), codes)


def z_ordered(
    df: DataFrame,
    columns: Sequence[str],
    bits: int = 6,
    sample: int = SAMPLE_ROWS,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """``df`` range-partitioned and sorted along the Z-curve over ``columns``.

    Each file then covers a small box of all columns instead of a narrow span of the first. Rows of one cell
    are told apart by their columns and by a hash of the row, so a cell that holds a third of all
    rows is split over tasks like any other. Reads ``df`` for the sample, for the
    ranges and for the rows; store what is dear to compute.
    """
    plain = [name for name, kind in df.dtypes if not kind.startswith(_NOT_HASHED)]
    placed = df.withColumn("_z", z_value(df, columns, bits, sample))
    return (
        placed.repartitionByRange("_z", *columns, F.xxhash64(*plain))
        .sortWithinPartitions(*partition_by, "_z", *columns)
        .drop("_z")
    )
