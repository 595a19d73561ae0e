"""Mixing sources to target weights by hash thresholds; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationflow.llm.scratch import numbered, stored

#: Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"
_DIGIT_BITS, _DIGITS = 12, 5


def word_count(text: str = "text") -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _sums_before(df: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """`df` with the sum of each of `values` over all rows before a row in `order`, which has to be total.

    Rows are dealt to buckets by range; a window covers one bucket, and the sums of earlier buckets come by a broadcast
    of one row per shuffle partition. Sums of whole numbers are exact, wherever the buckets begin.
    """
    placed = stored(df.repartitionByRange(*order).withColumn("bucket", F.spark_partition_id()), "placed")
    sums = placed.groupBy("bucket").agg(*(F.sum(v).alias(n) for n, v in values.items()))
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(F.col("bucket").alias("b"), *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_start") for n in values))
    local = W.partitionBy("bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = placed.select("*", *(F.coalesce(F.sum(v).over(local), F.lit(0)).alias(f"{n}_local") for n, v in values.items()))
    joined = inside.join(F.broadcast(starts), inside["bucket"] == starts["b"])
    return joined.select(*df.columns, *((F.col(f"{n}_local") + F.col(f"{n}_start")).alias(n) for n in values))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per source (`source`, `source_size`): its `weight` and `target`.

    Sources in code-point order, null last, get the weights in turn. The targets
    share the sum of all sizes by weight; none exceeds `most` times its source's
    size, and what is cut off goes to the others by weight. Sources that reach
    their limit come first in order of limit / weight, so the common factor of the
    rest follows from sums over the sources before each. Sources may be many: no task meets all of them, and the driver
    sees the factor alone.
    """
    by_name = F.asc_nulls_last("source")
    turn = F.col("turn") % len(weights)
    limit = (most * F.col("source_size")).cast("double")
    weighed = _sums_before(sizes.select("source", "source_size"), [by_name], {"turn": F.lit(1)}).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    )
    ranked = weighed.drop("turn").withColumns({"limit": limit, "ratio": limit / F.col("weight")})
    summed = stored(
        _sums_before(ranked, [F.asc("ratio"), by_name], {"limits": F.col("limit"), "weights": F.col("weight")}), "ranked-sources"
    )
    everything = summed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    factor = (F.lit(everything["words"]) - F.col("limits")) / (F.lit(everything["weight"]) - F.col("weights"))
    # the first source below its limit fixes the factor; sources before it are at their limits
    place = F.struct("ratio", F.col("source").isNull().alias("none"), "source", factor.alias("factor"))
    found = summed.agg(F.min(F.when(factor <= F.col("ratio"), place)).alias("at")).first()["at"]
    common = F.lit(found["factor"] if found else None).cast("double")
    target = F.least(F.col("limit"), F.col("weight") * common)
    return summed.select("source", "source_size", "weight", target.alias("target"))


def _digit(i: int) -> Column:
    """Digit `i` of a row: first those of the hash of its content, then those of a number that tells equal rows apart."""
    word, place = ("h", i) if i < _DIGITS else ("t", i - _DIGITS)
    return F.shiftrightunsigned(word, 64 - _DIGIT_BITS * (place + 1)).bitwiseAND(F.lit((1 << _DIGIT_BITS) - 1)).cast("int")


def _thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the digits `edge`, below which documents hold `budget` words, to within half a document.

    Words are summed by source and digit, and a running sum finds the digit in
    which the budget ends. Only that digit's documents are read for the next
    level, until a single one is left. No documents are sorted.
    """
    docs = docs.select("source", "size", "h", "t")
    level = stored(
        budgets.select("source", F.col("budget").alias("left"), F.array().cast("array<int>").alias("edge"), (F.col("budget") > 0).alias("open")),
        "thresholds",
    )
    for i in range(2 * _DIGITS):
        last = i == 2 * _DIGITS - 1
        prefix = F.array(*[_digit(j) for j in range(i)]).cast("array<int>")
        open_ = level.where("open").select(F.col("source").alias("s"), "edge", "left")
        inside = docs.join(open_, docs["source"].eqNullSafe(open_["s"]) & (prefix == open_["edge"]))
        sums = inside.where("size > 0").groupBy("source", _digit(i).alias("digit")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.first("left").alias("left")
        )
        running = W.partitionBy("source").orderBy("digit").rowsBetween(W.unboundedPreceding, W.currentRow)
        crossed = sums.withColumn("upto", F.sum("words").over(running)).where("upto > left")
        edge = F.struct("digit", (F.col("left") - F.col("upto") + F.col("words")).alias("rest"), "words", "n")
        found = crossed.groupBy(F.col("source").alias("s")).agg(F.min(edge).alias("at"))
        joined = level.join(found, level["source"].eqNullSafe(found["s"]), "left")
        one = (F.col("at.n") == 1) | F.lit(last)
        digit = (
            F.when(F.col("at").isNull(), F.lit(1 << _DIGIT_BITS))
            .when(one & (2 * F.col("at.rest") >= F.col("at.words")), F.col("at.digit") + 1)
            .otherwise(F.col("at.digit"))
        )
        level = stored(
            joined.select(
                "source",
                F.coalesce("at.rest", "left").alias("left"),
                F.when(F.col("open"), F.concat("edge", F.array(digit))).otherwise(F.col("edge")).alias("edge"),
                (F.col("open") & F.col("at").isNotNull() & ~one).alias("open"),
            ),
            "thresholds",
        )
        if level.where("open").isEmpty():
            break
    return level.select("source", "edge")


def _keyed(doc_id: str, source: str, text: str, row_id: str) -> list[Column]:
    """Size and hashes of a document; the second hash tells rows apart that are equal in all three."""
    return [
        word_count(text).alias("size"),
        F.xxhash64(doc_id, source, text).alias("h"),
        F.xxhash64(row_id).alias("t"),
    ]


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per source (`mixed_source`): `source_size`, `target`, and from what `copies` follows, `whole` and `edge`.

    From `source`, `size`, `h`, `t` of every document. A source takes each document as often as its target holds its
    size, and one time more for those whose hash lies below the threshold for the rest.
    """
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    targets = source_targets(sizes, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = stored(
        targets.withColumn("whole", whole.cast("int")).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")),
        "targets",
    )
    edges = _thresholds(sized, plan).withColumnRenamed("source", "mixed_source")
    return stored(
        plan.join(edges, plan["source"].eqNullSafe(edges["mixed_source"])).select("mixed_source", "source_size", "target", "whole", "edge"),
        "plan",
    )


def _copies() -> Column:
    digits = F.array(*[_digit(i) for i in range(2 * _DIGITS)])
    return F.col("whole") + (digits < F.col("edge")).cast("int")


def mix(df: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, from_files: bool = False) -> DataFrame:
    """The rows of `df`, each as often as the mix takes it; all columns stay. `from_files` as in `numbered`.

    The hash is over doc_id, source and text, so reruns agree; rows equal in all
    three are interchangeable and may be taken in part. A null source is a source;
    documents without words are taken as often as others of their source; an empty
    table gives no rows. No document is taken more than `most` times. Texts are not shuffled while the sources'
    plan is small enough to be broadcast by Spark's own rule.
    """
    docs = numbered(df, "documents", from_files)
    keyed = docs.select("row", F.col("row.source").alias("source"), *_keyed("row.doc_id", "row.source", "row.text", "row_id"))
    plan = plan_mix(stored(keyed.select("source", "size", "h", "t"), "sizes"), weights, most)
    joined = keyed.join(plan, keyed["source"].eqNullSafe(plan["mixed_source"]))
    often = joined.select("row", _copies().alias("copies")).where("copies > 0")
    return often.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def mix_report(df: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target` and `taken` words per row of `df`, as `mix` takes them.

    Texts that are null or without words have size 0 and take nothing; other columns are not read.
    """
    docs = df.select("doc_id", "source", "text", F.monotonically_increasing_id().alias("row_id"))
    sized = stored(docs.select("doc_id", "source", *_keyed("doc_id", "source", "text", "row_id")), "sizes")
    plan = plan_mix(sized, weights, most)
    return sized.join(plan, sized["source"].eqNullSafe(plan["mixed_source"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken")
    )
