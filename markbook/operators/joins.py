"""Joins of a large table with a lookup that has one row per key.

Three ways, all exact:

* a lookup whose measured size is small is broadcast, so the large table is not shuffled;
* otherwise the rows of hot and missing keys are scattered over all shuffle partitions, the hot
  keys taking their lookup row from a broadcast that can never exceed ``HOT_KEYS`` rows;
* all other rows meet their lookup row in a shuffle join, where no key is large any more.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_ROWS = 1_000_000
HOT_KEYS = 256

_HOT, _COLD, _IS_HOT, _SCATTER = "_hot_row", "_cold_row", "_is_hot", "_scatter"


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a lookup; only the total comes to the driver."""
    width = F.octet_length(F.to_json(F.struct("*")))
    return (df.agg(F.sum(width)).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a lookup measured to be small; otherwise Spark's own choice."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, limit: int = HOT_KEYS) -> DataFrame:
    """The most frequent keys with at least ``hot_rows`` rows; counted before any shuffle.

    A key left out by the limit holds less than ``1/limit`` of all rows.
    """
    return (
        df.select(*keys)
        .where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= hot_rows)
        .orderBy(F.col("_n").desc(), *keys)
        .limit(limit)
        .select(*keys)
    )


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    limit: int = HOT_KEYS,
) -> DataFrame:
    """Join ``df`` to a lookup with at most one row per key: left, inner, left_semi or left_anti."""
    keys = list(keys)
    if fits_broadcast(lookup, max_bytes):
        return df.join(F.broadcast(lookup), keys, how)
    return scattered_join(df, lookup, keys, how, hot_rows, limit)


def no_scatter(keys: Sequence[str]) -> Column:
    """Zero, computed from the keys: a literal would be folded out of the join keys, and with it the scatter."""
    return F.pmod(F.xxhash64(*keys), F.lit(1))


def scattered_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    limit: int = HOT_KEYS,
) -> DataFrame:
    """The shuffle form of ``lookup_join``.

    The scatter value is the input partition's number: it spreads equal rows too, and a task that
    is run again after a lost executor computes the same value.
    """
    keys = list(keys)
    values = [c for c in lookup.columns if c not in keys]
    packed = F.struct(*values) if values else F.struct(F.lit(True).alias("found"))
    rows = lookup.select(*keys, packed.alias(_COLD))

    hot = hot_keys(df, keys, hot_rows, limit)
    hot_rows_of_lookup = rows.join(F.broadcast(hot), keys, "left_semi").withColumnRenamed(_COLD, _HOT)
    hot_side = hot.withColumn(_IS_HOT, F.lit(True)).join(F.broadcast(hot_rows_of_lookup), keys, "left")

    missing_key = reduce(or_, [F.col(k).isNull() for k in keys])
    diverted = missing_key | F.col(_IS_HOT).isNotNull()
    joined = (
        df.join(F.broadcast(hot_side), keys, "left")
        .withColumn(_SCATTER, F.when(diverted, F.spark_partition_id() + 1).otherwise(F.lit(0)).cast("bigint"))
        .join(rows.withColumn(_SCATTER, no_scatter(keys)), [*keys, _SCATTER], "left")
    )
    found = F.coalesce(F.col(_HOT), F.col(_COLD))
    if how in ("inner", "left_semi"):
        joined = joined.where(found.isNotNull())
    elif how == "left_anti":
        joined = joined.where(found.isNull())
    elif how != "left":
        raise ValueError(f"unsupported join type {how!r}")
    keep = [F.col(c) for c in keys] + [F.col(c) for c in df.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        return joined.select(*[F.col(c) for c in df.columns])
    return joined.withColumn(_COLD, found).select(*keep, *[F.col(f"{_COLD}.{v}").alias(v) for v in values])


def anti_join(df: DataFrame, existing: DataFrame, keys: Sequence[str], null_safe: bool = False, once: bool = False) -> DataFrame:
    """Rows of ``df`` with no equal key in ``existing``.

    By plain equality a row with a missing key part never matches and is always kept;
    with ``null_safe`` missing equals missing. ``once``: ``df`` has each key once, so that none is hot and needs to be counted.
    """
    return _exists(df, existing, keys, "left_anti", null_safe, once)


def semi_join(df: DataFrame, existing: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` with an equal key in ``existing``."""
    return _exists(df, existing, keys, "left_semi", null_safe)


def _exists(df: DataFrame, existing: DataFrame, keys: Sequence[str], how: str, null_safe: bool, once: bool = False) -> DataFrame:
    keys = list(keys)
    found = existing.select(*keys)
    if null_safe:
        # Missing equals missing: a struct of one missing part is itself not missing.
        names = [f"_k{i}" for i in range(len(keys))]
        parts = {n: F.struct(F.col(k).alias("v")) for n, k in zip(names, keys)}
        df_out, df, found, keys = df.columns, df.withColumns(parts), found.withColumns(parts).select(*names), names
    else:
        df_out, found = df.columns, found.dropna()
    # Measured before the distinct, which then is computed once.
    if fits_broadcast(found):
        return df.join(F.broadcast(found.distinct()), keys, how).select(*df_out)
    if once:
        return df.join(found, keys, how).select(*df_out)
    return scattered_join(df, found.distinct(), keys, how).select(*df_out)
