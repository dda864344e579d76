"""Multiset comparison of two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COPIES_PER_BLOCK = 100_000


def _check_columns(left: DataFrame, right: DataFrame) -> None:
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")


def _signed_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each distinct row of either side with its copies left minus its copies right."""
    _check_columns(left, right)
    sides = left.withColumn("_sign", F.lit(1)).unionByName(right.withColumn("_sign", F.lit(-1)))
    return sides.groupBy(*[F.col(f"`{c}`") for c in left.columns]).agg(F.sum("_sign").alias("_copies"))


def _close(x: Column, y: Column, tolerance: float) -> Column:
    larger = F.greatest(F.abs(x), F.abs(y))
    near = (F.abs(x - y) <= F.lit(tolerance) * larger) & (larger < float("inf"))  # NaN is larger still
    return x.eqNullSafe(y) | F.coalesce(near, F.lit(False))


def diff_count(left: DataFrame, right: DataFrame, tolerance: float | None = None) -> DataFrame:
    """Rows that occur more often on one side than on the other: one row, one number.

    With a ``tolerance``, floating columns may differ by that share of the larger
    value; sums, means and deviations need it, as their last bits depend on
    partition order. Rows that are equal to the last bit cancel out first, before any
    of them is shuffled by key. Of the rest, rows alike in all other columns are put
    in the order of each floating column: neighbours within the tolerance are one
    value, and rows are counted per combination of values. Two windows over one
    shuffle do it; one task sorts the rows of a key that are not equal to the last bit.
    """
    counts = _signed_counts(left, right)
    floating = [c for c, kind in left.dtypes if tolerance and kind in ("double", "float")]
    if floating:
        counts = counts.filter("_copies <> 0")
        keys = [F.col(f"`{c}`") for c in left.columns if c not in floating]
        for i, name in enumerate(floating):
            order = Window.partitionBy(*keys or [F.lit(0)]).orderBy(F.asc_nulls_first(f"`{name}`"))
            before = F.lag(F.col(f"`{name}`")).over(order)
            first = F.row_number().over(order) == 1
            same = first | _close(before.cast("double"), F.col(f"`{name}`").cast("double"), tolerance)
            counts = counts.withColumn(f"_new_{i}", F.when(same, 0).otherwise(1))
            so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            counts = counts.withColumn(f"_value_{i}", F.sum(f"_new_{i}").over(so_far))
        values = [F.col(f"_value_{i}") for i in range(len(floating))]
        counts = counts.groupBy(*keys, *values).agg(F.sum("_copies").alias("_copies"))
    return counts.agg(F.coalesce(F.sum(F.abs("_copies")), F.lit(0)).cast("bigint").alias("diff_row_count"))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks, as often as it lacks them.

    The missing copies of a row are cut into blocks, and the blocks are dealt over a
    stated number of partitions before they are unfolded, so no task writes more
    than its share of blocks.
    """
    missing = _signed_counts(left, right).filter("_copies > 0")
    size = F.lit(COPIES_PER_BLOCK).cast("bigint")
    last_block = F.floor((F.col("_copies") - 1) / size)
    blocks = missing.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(parts, *[F.col(f"`{c}`") for c in left.columns], "_block")
    count = F.least(size, F.col("_copies") - F.col("_block") * size).cast("int")
    copies = F.explode(F.array_repeat(F.lit(1), count)).alias("_copy")
    return dealt.select(*[F.col(f"`{c}`") for c in left.columns], copies).drop("_copy")


def overlap_audit(current: DataFrame, all_data: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys two overlapping exports share, and how many each has alone. One pass over both."""
    def side(df: DataFrame, in_current: bool) -> DataFrame:
        return df.select(*keys, F.lit(in_current).alias("_current"), F.lit(not in_current).alias("_all"))

    per_key = side(current, True).unionByName(side(all_data, False)).groupBy(*keys).agg(
        F.max("_current").alias("_current"), F.max("_all").alias("_all")
    )
    where = F.when(F.col("_current") & F.col("_all"), "both").when(F.col("_current"), "current only")
    return per_key.groupBy(where.otherwise("all data only").alias("coverage")).agg(F.count(F.lit(1)).alias("keys"))
