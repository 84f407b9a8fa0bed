"""Tables bucketed and sorted by a key, so that tables bucketed alike are joined without a shuffle.

The shuffle is paid once, when a table is written; every join on the key after that reads bucket by bucket. One task reads a bucket, whatever
its size, so a join should first ask ``even``: where one key holds much of a table, the scattered join is the better way.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .snapshots import _hadoop

# A bucket of so many times the mean size is left to the scattered join.
MOST_UNEVEN = 4.0


# Rows that one task sorts into a bucket of a table, or joins from it.
BUCKET_ROWS = 500_000


def buckets_for(rows: DataFrame, least: int = 8) -> int:
    """How many buckets keep each of them at about ``BUCKET_ROWS`` rows; tables that are to be joined need the same number."""
    return max(least, -(-rows.count() // BUCKET_ROWS))


def write_bucketed(rows: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Write rows as table ``name`` in ``path``: one sorted file a bucket."""
    dealt = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    dealt.mode("overwrite").option("path", path).format("parquet").saveAsTable(name)


def register(spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int) -> None:
    """Make a table written in another session known to this one; the rows are not read."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")


def layout(spark: SparkSession, name: str) -> tuple[str, int, tuple[str, ...]]:
    """Folder, number of buckets (0 if none) and bucket columns of a table, from the catalog."""
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    keys = tuple(re.findall(r"`([^`]+)`", found.get("Bucket Columns", "")))
    return found["Location"], int(found.get("Num Buckets", 0) or 0), keys


def alike(spark: SparkSession, key: str, *names: str) -> bool:
    """Whether the tables have the same number of buckets, all by ``key``."""
    found = [layout(spark, n) for n in names]
    return all(keys == (key,) and n == found[0][1] > 0 for _, n, keys in found)


def even(spark: SparkSession, name: str, most: float = MOST_UNEVEN) -> bool:
    """Whether no bucket is much larger than the mean; only file sizes are looked at."""
    folder, buckets, _ = layout(spark, name)
    fs, at = _hadoop(spark, folder)
    sizes: dict[str, int] = {}
    for status in fs.listStatus(at):
        if found := re.search(r"_(\d{5})\.c\d+", status.getPath().getName()):
            sizes[found[1]] = sizes.get(found[1], 0) + status.getLen()
    return not sizes or max(sizes.values()) <= most * sum(sizes.values()) / max(buckets, 1)
