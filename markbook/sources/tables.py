"""Write modes of the stored tables: parquet, the landing fact by year. What replaces rows publishes a snapshot, see ``snapshots``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.predicates import between_dates
from ..schemas import EXTRACTION_LOG, conform
from ..session import scratch_dir
from . import snapshots
from .snapshots import YEAR, Part

# Rows that one task numbers.
BUCKET_ROWS = 100_000


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The landing fact; the year column keeps its type whatever the folder names look like."""
    return snapshots.read(spark, path)


def stage(rows: DataFrame) -> DataFrame:
    """The rows as a written table in the shared scratch folder: computed once, whatever reads them.

    It also cuts the lineage, so a lost executor costs a re-read and not a recomputation.
    """
    path = scratch_dir(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def append_results(rows: DataFrame, path: str) -> None:
    """Add rows: plain files to a plain folder, or a snapshot with one more folder."""
    if snapshots.latest(rows.sparkSession, path):
        snapshots.add_rows(rows, path, {"what": "append"})
    else:
        rows.write.mode("append").partitionBy(YEAR).parquet(path)


def full_refresh(rows: DataFrame, path: str, note: dict | None = None) -> None:
    """Replace the whole landing fact at once: a reader has the old rows until all new ones are stored."""
    snapshots.replace_rows(rows, path, {"what": "refresh", **(note or {})})


def replace_table(rows: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Replace a table with rows that may be computed from it.

    They are staged in the shared scratch folder first: a table is never read and overwritten in one job,
    and the staged copy outlives a failed overwrite.
    """
    writer = stage(rows).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def window_replace(target: DataFrame, batch: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Target rows outside the window, and the batch. A row without a date is outside."""
    inside = F.coalesce(between_dates(F.col("DateCompleted"), start, end), F.lit(False))
    return target.where(~inside).unionByName(batch, allowMissingColumns=True)


def in_years(years: Sequence[str | None]):
    """Rows of the given years; NULL is a year like any other."""
    found = F.lit(False)
    for year in years:
        found = found | F.col(YEAR).eqNullSafe(F.lit(year).cast("string"))
    return found


def overwrite_years(rows: DataFrame, path: str, years: Sequence[str | None], note: dict | None = None, changes: str | None = None) -> None:
    """Replace the given years of a table by ``rows``, which hold no other years; other years stay untouched.

    ``rows`` may be computed from the table. All years change at once.
    """
    spark = rows.sparkSession
    before = snapshots.base(spark, path)
    kept = [p for p in before.parts if p.year not in years] if before else []
    parts = [*kept, *snapshots.write_parts(rows, path)]
    snapshots.publish(spark, path, before, parts, rows.schema, {"what": "years", **(note or {})}, changes)


def replace_window(spark: SparkSession, path: str, batch: DataFrame, start: dt.date, end: dt.date, run: str | None = None) -> list:
    """Replace a date window of the stored fact, rewriting only the years it touches. Returns the years rewritten.

    The rows taken out and put in are written first, as the change of the snapshot: the batch is computed once, and a
    summary can follow without reading the years. The snapshot names the window, and ``run`` where given: the same run
    published before changes nothing and returns its years. Without a stored fact the batch becomes it.
    """
    before = snapshots.base(spark, path)
    if run is not None and (done := find_run(spark, path, run)) is not None:
        return done
    window = between_dates(F.col("DateCompleted"), start, end)
    target = snapshots.read_parts(spark, path, before.columns, before.parts) if before else batch.limit(0)
    changes = snapshots.write_changes(target.where(window), batch, path)
    change = spark.read.parquet(f"{path}/{changes}")
    # One value per year folder, never more.
    years = sorted((r[0] for r in change.select(YEAR).distinct().collect()), key=lambda y: (y is None, y))
    put_in = change.where("_change = 1").drop("_change")
    kept = target.where(in_years(years)) if years else target.limit(0)
    note = {"what": "window", "window": f"{start}..{end}", "run": run, "years": years}
    rows = window_replace(kept, put_in, start, end)
    parts = [p for p in before.parts if p.year not in years] if before else []
    if years:
        parts += snapshots.write_parts(rows, path)
    if years or run is not None or before is None:
        snapshots.publish(spark, path, before, parts, rows.schema, note, changes)
    return years


def find_run(spark: SparkSession, path: str, run: str) -> list | None:
    """Years that a run changed, or None if the ledger does not have it."""
    return next((s.note["years"] for s in snapshots.history(spark, path) if s.note.get("run") == run), None)


def archive_by_year(results: DataFrame, before: str) -> tuple[DataFrame, DataFrame]:
    """(live, archive): years before the given one, compared as text; a missing year stays live."""
    old = F.coalesce(F.col(YEAR) < before, F.lit(False))
    return results.where(~old), results.where(old)


def archive_years(spark: SparkSession, path: str, archive_path: str, before: str) -> list[str]:
    """Move old years from the live table to the archive. Returns the years.

    First the archive publishes the rows, and with them the names of the files they came from; then the live table publishes itself without
    them. A run that breaks off in between leaves the rows in both; the next one finds the names and only takes them out.
    """
    live = snapshots.base(spark, path)
    old = [p for p in live.parts if p.year is not None and p.year < before] if live else []
    if not old:
        return []
    archive = snapshots.base(spark, archive_path)
    moved = {name for s in snapshots.history(spark, archive_path) for name in s.note.get("moved", [])}
    named = lambda p: {n: f"{path}/{p.root}/{p.folder}/{n}" for n in snapshots.file_names(spark, path, p)}
    files = {p: named(p) for p in old}
    new = [Part(p.root, p.folder, tuple(n for n, full in f.items() if full not in moved)) for p, f in files.items()]
    new = [p for p in new if p.files]
    if new:
        rows = snapshots.read_parts(spark, path, live.columns, new)
        parts = [*(archive.parts if archive else []), *snapshots.write_parts(rows, archive_path)]
        note = {"what": "archive", "moved": sorted(full for f in files.values() for full in f.values())}
        snapshots.publish(spark, archive_path, archive, parts, rows.schema, note)
    snapshots.publish(spark, path, live, [p for p in live.parts if p not in old], live.columns, {"what": "archived", "before": before})
    return sorted({p.year for p in old})


def incremental_rows(rows: DataFrame, as_of: dt.date, days: int = fixed.DEFAULT_DAYS_BACK) -> DataFrame:
    """Rows of the last days up to a run date, both ends included."""
    return rows.where(between_dates(F.col("DateCompleted"), as_of - dt.timedelta(days=days), as_of))


def next_id(table: DataFrame, id_column: str) -> int:
    return (table.agg(F.max(id_column)).first()[0] or 0) + 1


def surrogate_key(rows: DataFrame, id_column: str, key: Sequence[str], start: int = 1) -> DataFrame:
    """Consecutive ids for rows with a unique key, in the order of the key's hash.

    Rows are counted per bucket of the hash, a bucket starts where the one before ends, and rows are
    numbered inside their bucket. There are as many buckets as keep one at about ``BUCKET_ROWS`` rows, so no window is over
    the whole table. The rows are staged: counts and ids come from the same ones.
    """
    rows = stage(rows)
    count, digits = rows.count(), 1
    while count > BUCKET_ROWS * 16**digits:
        digits += 1
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]).cast("binary"))
    marked = rows.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, digits))
    counts = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # A row a bucket: the one place where a window has no partition.
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("_bucket").orderBy("_digest", *[F.col(k).asc_nulls_first() for k in key])
    return (
        marked.join(starts, "_bucket")
        .withColumn(id_column, F.row_number().over(order) + F.col("_before") + F.lit(start - 1))
        .drop("_digest", "_bucket", "_before")
    )


def sparse_ids(rows: DataFrame, id_column: str, start: int = 1) -> DataFrame:
    """Unique ids with gaps, without a shuffle, for rows that are written at once."""
    return rows.withColumn(id_column, F.monotonically_increasing_id() + F.lit(start))


def audit_columns(rows: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return rows.withColumns({"CreatedDate": now, "UpdatedDate": now})


def extraction_log(
    spark: SparkSession, endpoint: str, records: int, status: str, error: str | None = None
) -> DataFrame:
    """One audit row."""
    row = spark.range(1).select(
        F.lit(endpoint).alias("endpoint"),
        F.current_timestamp().alias("extraction_date"),
        F.lit(records).cast("bigint").alias("records_extracted"),
        F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error_message"),
    )
    return conform(row, EXTRACTION_LOG.columns)


def logged_append(rows: DataFrame, path: str, endpoint: str, log_path: str) -> int:
    """Append rows and an audit row; the count is taken while writing, or from the footers of the files written.

    In a plain folder it is taken in the tasks that write: those count once, whatever was run again.
    """
    spark = rows.sparkSession
    try:
        if before := snapshots.latest(spark, path):
            new = snapshots.write_parts(rows, path)
            snapshots.publish(spark, path, before, [*before.parts, *new], rows.schema, {"what": "append", "endpoint": endpoint})
            stored = snapshots.read_parts(spark, path, rows.schema, new).count()
        else:
            seen = Observation()
            counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
            counted.write.mode("append").partitionBy(YEAR).parquet(path)
            stored = seen.get["n"]
    except Exception as error:
        extraction_log(spark, endpoint, 0, "error", str(error)).write.mode("append").parquet(log_path)
        raise
    extraction_log(spark, endpoint, stored, "success").write.mode("append").parquet(log_path)
    return stored
