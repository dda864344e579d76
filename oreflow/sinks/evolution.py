"""Tables whose columns change: merged schemas with wider types, and writes that keep to them.

A column keeps its place; new ones go to the end. Of two types of one column the
narrowest that holds both counts: byte, short, int, long, then double, then text;
decimals that hold all digits of both; date, then timestamp. Long to double keeps 53 bits,
as it does in Spark's own widening.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType, ShortType,
    StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from oreflow.sinks.publish import mark_published, published_version

WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]
DIGITS = dict(zip(WHOLE, (3, 5, 10, 19)))
TIMES = [DateType(), TimestampNTZType(), TimestampType()]


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return WHOLE[max(WHOLE.index(a), WHOLE.index(b))]
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        parts = [DecimalType(DIGITS[t], 0) if t in DIGITS else t for t in (a, b)]
        if all(isinstance(t, DecimalType) for t in parts):
            scale = max(t.scale for t in parts)
            digits = max(t.precision - t.scale for t in parts) + scale
            return DecimalType(digits, scale) if digits <= 38 else DoubleType()
    numbers = (DecimalType, FloatType, DoubleType)
    if all(t in WHOLE or isinstance(t, numbers) for t in (a, b)):
        return DoubleType()
    if a in TIMES and b in TIMES:
        return TIMES[max(TIMES.index(a), TIMES.index(b))]
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(wider(a.elementType, b.elementType))
    if any(isinstance(t, (StructType, ArrayType, MapType)) for t in (a, b)):
        raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")
    return StringType()


def merged_schema(stored: StructType, arriving: StructType) -> StructType:
    """The columns of both; names are compared without regard to case, stored spellings stay."""
    fresh = {f.name.casefold(): f for f in arriving}
    fields = []
    for f in stored:
        other = fresh.pop(f.name.casefold(), None)
        fields.append(StructField(f.name, wider(f.dataType, other.dataType) if other else f.dataType, True, f.metadata))
    return StructType(fields + [StructField(f.name, f.dataType, True, f.metadata) for f in arriving if f.name.casefold() in fresh])


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly these columns: cast to their types, NULL where it has none."""
    actual = {name.casefold(): name for name in df.columns}

    def column(field: StructField):
        name = actual.get(field.name.casefold())
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        return value.cast(field.dataType).alias(field.name, metadata=field.metadata)

    return df.select(*[column(f) for f in schema])


def read_evolved(spark: SparkSession, root: str) -> DataFrame:
    """The newest version, as one table whatever columns its files have."""
    version = published_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version below {root}")
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/data/version={version}")


def _stage(df: DataFrame, root: str, version: int) -> int:
    df.write.mode("overwrite").parquet(f"{root}/data/version={version}")
    mark_published(df.sparkSession, root, version)
    return version


def overwrite_evolved(df: DataFrame, root: str) -> int:
    """Replace all rows; columns that the table had before stay, NULL where ``df`` lacks them."""
    version = published_version(df.sparkSession, root)
    if version is None:
        return _stage(df, root, 1)
    return _stage(aligned(df, merged_schema(read_evolved(df.sparkSession, root).schema, df.schema)), root, version + 1)


def append_evolved(df: DataFrame, root: str) -> int:
    """Add rows, whose columns may differ from the stored ones.

    New and absent columns cost nothing: files are added and read as one table. Where a
    stored column gets a wider type, all rows are rewritten beside the old
    version, which readers keep until the new one is complete.
    """
    spark = df.sparkSession
    version = published_version(spark, root)
    if version is None:
        return _stage(df, root, 1)
    stored = read_evolved(spark, root)
    merged = merged_schema(stored.schema, df.schema)
    kinds = {f.name: f.dataType for f in merged}
    if any(kinds[f.name] != f.dataType for f in stored.schema):
        return _stage(aligned(stored, merged).unionByName(aligned(df, merged)), root, version + 1)
    here = {f.name.casefold() for f in df.schema}
    mine = StructType([f for f in merged if f.name.casefold() in here])
    aligned(df, mine).write.mode("append").parquet(f"{root}/data/version={version}")
    return version
