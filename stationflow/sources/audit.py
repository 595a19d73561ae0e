"""Row counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F


def with_row_audit(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its row count, filled when ``df`` is first written.

    No extra job and no second scan.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def row_counts(
    relations: Mapping[str, DataFrame],
    subsets: Mapping[str, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Rows of every relation, as one small table.

    ``subsets`` names conditions per relation, whose rows are counted by the
    same scan.
    """

    def counted(name: str, df: DataFrame) -> DataFrame:
        conditions = {name: F.lit(True), **(subsets or {}).get(name, {})}
        totals = df.agg(*(F.count_if(c).alias(n) for n, c in conditions.items()))
        rows = (F.struct(F.lit(n).alias("relation"), F.col(n).alias("row_count")) for n in conditions)
        return totals.select(F.inline(F.array(*rows)))

    return reduce(DataFrame.unionByName, (counted(n, df) for n, df in relations.items()))
