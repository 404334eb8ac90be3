"""One feed from deliveries whose files differ in types, column case and columns.

A reader with one schema fails on (or silently nulls) a column that is an integer in one file and text in another.
Here each delivery (a folder of files of one schema) is read by itself and brought to one schema:

* with a contract, its columns are cast to its types; a value that can't be cast is kept as text in ``extras`` under
  the column's name, so nothing is lost;
* without one, a column gets the narrowest type that holds the types of all deliveries;
* columns are matched without regard to case; missing ones are null; columns outside the contract go to
  ``extras``, a map of texts without null values.

All of it is projections over the scans: no shuffle, and columns that are not asked for are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricekit.sources.tables import columns_ci

EXTRAS = "extras"
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_WHOLE = list(_DIGITS)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both types' values; text where no other does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = type(a), type(b)
    if all(k in _WHOLE for k in kinds):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if all(isinstance(t, T.NumericType) for t in (a, b)):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
            return T.DoubleType()
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if all(isinstance(t, _TIMES) for t in (a, b)):
        return max((a, b), key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def widened(schemas: Sequence[T.StructType]) -> T.StructType:
    """One schema for all, columns in order of first appearance and in the case they first have."""
    names: dict[str, str] = {}
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            low = field.name.lower()
            names.setdefault(low, field.name)
            kinds[low] = wider(kinds[low], field.dataType) if low in kinds else field.dataType
    return T.StructType([T.StructField(names[low], kinds[low]) for low in names])


def conform_to(df: DataFrame, contract: T.StructType, extras: str | None = EXTRAS) -> DataFrame:
    """``df`` in the columns and types of ``contract``, then the map of what does not fit."""
    have = columns_ci(df)
    if len(have) != len(df.columns):
        raise ValueError(f"columns that differ in case only: {df.columns}")
    out, kept = [], []

    def keep(name: str, text: Column, where: Column) -> None:
        kept.append(F.when(where, F.struct(F.lit(name).alias("key"), text.alias("value"))))

    for field in contract.fields:
        name = have.pop(field.name.lower(), None)
        if name is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        given, dtype = F.col(f"`{name}`"), df.schema[name].dataType
        if dtype == field.dataType:
            out.append(given.alias(field.name))
            continue
        cast = given.try_cast(field.dataType)
        out.append(cast.alias(field.name))
        keep(field.name, given.cast("string"), given.isNotNull() & cast.isNull())
    for name in have.values():
        given = F.col(f"`{name}`")
        atomic = not isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
        keep(name, given.cast("string") if atomic else F.to_json(given), given.isNotNull())
    if extras is not None:
        entries = F.array(*kept) if kept else F.array().cast("array<struct<key:string,value:string>>")
        out.append(F.map_from_entries(F.filter(entries, lambda e: e.isNotNull())).alias(extras))
    return df.select(*out)


def reconcile(frames: Sequence[DataFrame], contract: T.StructType | None = None, extras: str | None = EXTRAS) -> DataFrame:
    """The rows of all frames in one schema: the contract's, or else the widened one (nothing is extra then)."""
    if not frames:
        raise ValueError("no deliveries")
    schema = contract or widened([f.schema for f in frames])
    return reduce(DataFrame.unionByName, [conform_to(f, schema, extras) for f in frames])


def deliveries(spark: SparkSession, path: str) -> list[str]:
    """Folders under ``path`` that hold parquet files; only names are listed, and one row a folder reaches the driver."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")))
    return sorted(r["folder"] for r in files.distinct().collect())


def read_drifting(spark: SparkSession, path: str, contract: T.StructType | None = None, extras: str | None = EXTRAS) -> DataFrame:
    """All deliveries under ``path``, each read with its own schema, as one feed."""
    return reconcile([spark.read.parquet(f) for f in deliveries(spark, path)], contract, extras)
