"""The periodic update: re-pull a date window, merge the lookups, rebuild the summary, sync the program copy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fixed
from ..functions.scalars import parse_date
from ..operators import merges, program_sync
from ..operators.reports import table_counts
from ..schemas import ASSIGNMENTS, LANDING, REJECTS, STANDARDS, SUMMARY, Table, conform
from ..sources import pages, snapshots, tables
from ..streaming import incremental
from .enrichment import STUDENT, build_profile, full_enrichment
from .summary import STATE, changed_summary, stored_summary

PROGRAM_PREFIX = "program_"


@dataclass(frozen=True)
class Warehouse:
    """Folder with one sub-folder per stored table."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str, columns=None) -> DataFrame:
        """A stored table, or an empty one of the given layout if it was never written.

        A folder that is there but cannot be read as a table raises: it is no new table.
        """
        try:
            df = snapshots.read(self.spark, self.path(name))
        except AnalysisException as error:
            if columns is None or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], columns)
        return conform(df, columns) if columns is not None else df

    def table(self, table: Table, prefix: str = "") -> DataFrame:
        return self.read(prefix + table.name, table.columns)


def undated_rows(raw: DataFrame, profile: DataFrame) -> DataFrame:
    """Raw rows of students with a school for which no date can be read."""
    return raw.where(parse_date(F.col("date_taken")).isNull()).join(profile.select(STUDENT), STUDENT, "left_semi")


def reject(warehouse: Warehouse, reason: str, origin: str, rows: DataFrame, key: str, detail: str) -> int:
    """Keep rows that could not be loaded, in place of those of the same reason and origin; returns and logs their number."""
    staged = tables.stage(
        rows.select(F.lit(reason).alias("reason"), F.lit(origin).alias("origin"), F.col(key).cast("string").alias("record_key"), F.col(detail).cast("string").alias("detail"))
    )
    others = warehouse.table(REJECTS).where(~((F.col("reason") == reason) & (F.col("origin") == origin)))
    snapshots.replace_rows(others.unionByName(staged), warehouse.path(REJECTS.name))
    found = staged.count()
    tables.extraction_log(warehouse.spark, f"reject:{reason}", found, "success").write.mode("append").parquet(warehouse.path("extraction_log"))
    return found


def with_ids(rows: DataFrame, start: int = 1) -> DataFrame:
    """The rows with unique ids from ``start`` on and the time of the load, for rows that are written at once.

    An id is the task's number and the row's place in it, so whatever runs again, the rows that are kept of a task have ids of their own.
    """
    return tables.audit_columns(tables.sparse_ids(rows, "ResultID", start))


def full_load(warehouse: Warehouse, raw: DataFrame, profile: DataFrame, academic_year: str | None = None) -> None:
    """Replace the landing fact by everything in the raw rows."""
    tables.full_refresh(with_ids(full_enrichment(raw, profile, academic_year)), warehouse.path("results"))


PAGES = {
    "results": schemas.DETAIL_RESULT,
    "enrollment": schemas.ENROLLMENT,
    "sites": schemas.SITES,
    "users": schemas.USERS,
    "roster": schemas.ROSTER,
}


def load_from_pages(
    warehouse: Warehouse,
    landed: Mapping[str, str],
    section_roster: DataFrame,
    subject_map: DataFrame,
    academic_year: str | None = None,
    most_bad: float = fixed.MOST_BAD_PAGES,
) -> None:
    """A full load from landed pages (``PAGES`` names the folders), with the summary.

    Of a key that a lookup lists more than once the last record by arrival counts. Unreadable pages, pages and records that a
    request announces but that did not land, and rows without a readable date are kept as rejects and counted in the log; undated
    rows are loaded all the same. A share of more than ``most_bad`` unreadable pages of one kind, or of pages that did not land,
    stops the load before anything of it is written.
    """
    spark = warehouse.spark
    landing = {name: tables.stage(pages.landed_pages(spark, landed[name])) for name in PAGES}
    gaps = reduce(DataFrame.unionByName, [pages.page_gaps(found).withColumn("name", F.lit(name)) for name, found in landing.items()])
    gaps = tables.stage(gaps)
    reject(warehouse, "missing_pages", "pages", gaps.withColumn("what", F.concat("name", F.lit(": "), "detail")), "request", "what")
    for row in gaps.where("kind = 'pages'").groupBy("name").agg(F.sum("missing").alias("lost")).collect():
        if row.lost > most_bad * (row.lost + pages.page_count(spark, landed[row.name])):
            raise ValueError(f"{row.lost} pages of {row.name} did not land")
    parsed = {}
    for name, record in PAGES.items():
        # results need no arrival: all of them are loaded
        parsed[name] = pages.parsed_pages(spark, landed[name], record, arrival=name != "results")
        found = reject(warehouse, "bad_page", name, pages.page_rejects(spark, landed[name], record, parsed=parsed[name]), "file", "text")
        if found and found > most_bad * pages.page_count(spark, landed[name]):
            raise ValueError(f"{found} pages of {name} cannot be read")
    read = {n: pages.read_pages(spark, landed[n], record, arrival=None if n == "results" else "seq", parsed=parsed[n]) for n, record in PAGES.items()}
    profile = build_profile(read["enrollment"], read["sites"], read["users"], read["roster"], section_roster, subject_map)
    raw = read["results"]
    reject(warehouse, "undated", "full load", undated_rows(raw, profile), "local_student_id", "date_taken")
    full_load(warehouse, raw, profile, academic_year)
    rebuild_summary(warehouse)


def window_load(
    warehouse: Warehouse, raw: DataFrame, profile: DataFrame, start: dt.date, end: dt.date, year: str | None = None, run: str | None = None
) -> list:
    """Replace one date window of the landing fact by the raw rows of that window; returns the years changed.

    A row whose date is missing or cannot be read has no place in a window. It goes to the table of rejects with its
    date text, instead of those that an earlier run of the same window put there, and is counted in the log.
    A ``run`` that is in the table's ledger is not loaded again.
    """
    rows = full_enrichment(raw, profile, year)
    batch = rows.where(F.col("DateCompleted").between(F.lit(start), F.lit(end)))
    spark = warehouse.spark
    reject(warehouse, "undated", f"{start}..{end}", undated_rows(raw, profile), "local_student_id", "date_taken")
    path = warehouse.path("results")
    before = snapshots.base(spark, path)
    known = before is not None and "ResultID" in before.columns.names
    first = tables.next_id(tables.read_results(spark, path), "ResultID") if known else 1
    return tables.replace_window(spark, path, with_ids(tables.stage(batch), first), start, end, run)


def rebuild_summary(warehouse: Warehouse, years: list | None = None) -> None:
    """Rebuild the summary, or only the given years of it, those that it lacks and those that have changed since.

    The year is part of every summary group, so the groups of other years cannot have changed. Without a stored
    summary all of it is built. The summary's snapshot names that of the results it was computed from.
    """
    spark, path = warehouse.spark, warehouse.path("summary")
    now = snapshots.latest(spark, warehouse.path("results"))
    results = conform(snapshots.read(spark, warehouse.path("results"), now and now.version), LANDING) if now else warehouse.read("results", LANDING)
    note = {"results": now.version} if now else {}
    if years is not None:
        # One value per year, read from the folder names.
        have = lambda df: {r[0] for r in df.select(tables.YEAR).distinct().collect()}
        stored = warehouse.table(SUMMARY)
        summarised = have(stored)
        missing = have(results.where(F.col("AssessmentID").isNotNull() & F.col("StudentID_SASID").isNotNull())) - summarised
        then = _summarised(warehouse)
        if then is None:
            note = {}
        changed = set(_changed_years(then, now)) if then else set()
        years = sorted({*years, *missing, *changed}, key=lambda y: (y is None, y)) if summarised else None
    if years is None:
        tables.full_refresh(stored_summary(results), path, note)
    elif years:
        tables.overwrite_years(stored_summary(results.where(tables.in_years(years))), path, years, note)


def _summarised(warehouse: Warehouse) -> snapshots.Snapshot | None:
    """The results that the stored summary was computed from, if both are known."""
    stored = snapshots.latest(warehouse.spark, warehouse.path("summary"))
    if stored is None or stored.note.get("results") is None or not set(STATE) <= set(stored.columns.names):
        return None
    return snapshots.numbered(warehouse.spark, warehouse.path("results"), stored.note["results"])


def _changed_years(then: snapshots.Snapshot, now: snapshots.Snapshot) -> list:
    """Years whose folders or files are not the same in both."""
    of = lambda s: {p.year: {q for q in s.parts if q.year == p.year} for p in s.parts}
    a, b = of(then), of(now)
    return sorted((y for y in {*a, *b} if a.get(y) != b.get(y)), key=lambda y: (y is None, y))


def refresh_summary(warehouse: Warehouse) -> None:
    """Bring the summary up to the stored results.

    Where every change since kept its rows, they are taken out of and put into their groups; the results themselves are not read.
    Otherwise the years that changed are rebuilt, and all of it where the summary's origin is not known. A run that broke off
    between results and summary is made up for by the next one, as the snapshots tell what the summary lacks.
    """
    spark, path = warehouse.spark, warehouse.path("summary")
    then, now = _summarised(warehouse), snapshots.latest(spark, warehouse.path("results"))
    if then is None or now is None:
        rebuild_summary(warehouse)
    elif then.version != now.version:
        changes = snapshots.read_changes(spark, warehouse.path("results"), then, now)
        if changes is None:
            rebuild_summary(warehouse, _changed_years(then, now))
            return
        # One value per year folder, never more.
        years = sorted((r[0] for r in changes.select(tables.YEAR).distinct().collect()), key=lambda y: (y is None, y))
        stored = snapshots.read(spark, path).where(tables.in_years(years))
        tables.overwrite_years(changed_summary(stored, changes), path, years, {"what": "changes", "results": now.version})


def update_lookups(warehouse: Warehouse, catalogue: DataFrame | None = None) -> None:
    results = warehouse.read("results", LANDING)
    assignments = merges.merge_assignments(warehouse.table(ASSIGNMENTS), results)
    snapshots.replace_rows(assignments, warehouse.path("assignments"))
    known = warehouse.table(STANDARDS)
    if catalogue is None:
        standards = merges.merge_standards(known, results)
    else:
        standards = merges.merge_standards_catalogue(known, results, catalogue)
    snapshots.replace_rows(standards, warehouse.path("standards"))


MONTH = "_month"


def _with_month(rows: DataFrame) -> DataFrame:
    """The month of a row's date, by which copies lie in folders: equal keys have equal dates, so they share a folder."""
    return rows.withColumn(MONTH, F.date_format("DateCompleted", "yyyy-MM"))


def possible_copies(warehouse: Warehouse, name: str, candidates: DataFrame, layout) -> DataFrame:
    """Rows of a program copy in the months of the candidates; no row of another month can have one of their keys.

    The snapshot lists the copy's folders by month, so those of other months are not scanned.
    """
    path = warehouse.path(PROGRAM_PREFIX + name)
    stored = snapshots.base(warehouse.spark, path)
    if stored is None:
        return warehouse.spark.createDataFrame([], layout)
    # One value per month of school history.
    months = {r[0] for r in _with_month(candidates).select(MONTH).distinct().collect()}
    parts = [p for p in stored.parts if p.by != MONTH or p.value in months]
    return conform(snapshots.read_parts(warehouse.spark, path, stored.columns, parts), layout)


def _add_copies(warehouse: Warehouse, name: str, rows: DataFrame, note: dict) -> None:
    path = warehouse.path(PROGRAM_PREFIX + name)
    before = snapshots.base(warehouse.spark, path)
    new = _with_month(rows) if "DateCompleted" in rows.columns else rows
    parts = snapshots.write_parts(new, path, MONTH)
    snapshots.publish(warehouse.spark, path, before, [*(before.parts if before else []), *parts], new.schema, note)


def _since(warehouse: Warehouse, source: str, copy: str) -> tuple[snapshots.Snapshot | None, snapshots.Snapshot | None]:
    """The snapshot of a table that its copy has seen, and the newest."""
    spark = warehouse.spark
    seen = snapshots.latest(spark, warehouse.path(PROGRAM_PREFIX + copy))
    version = seen.note.get("seen") if seen else None
    return version and snapshots.numbered(spark, warehouse.path(source), version), snapshots.latest(spark, warehouse.path(source))


def result_candidates(warehouse: Warehouse, null_safe: bool) -> DataFrame:
    """Results that the copy may lack: those put in since it was last brought up, or all where that is not known.

    By plain equality rows without a key are new in every run, so all are candidates.
    """
    then, now = _since(warehouse, "results", "results")
    changes = snapshots.read_changes(warehouse.spark, warehouse.path("results"), then, now) if then and null_safe else None
    return conform(changes.where("_change = 1"), LANDING) if changes is not None else warehouse.read("results", LANDING)


def summary_candidates(warehouse: Warehouse, null_safe: bool) -> DataFrame:
    then, now = _since(warehouse, "summary", "summary")
    rows = warehouse.table(SUMMARY)
    return rows.where(tables.in_years(_changed_years(then, now))) if then and null_safe else rows


def sync_program(warehouse: Warehouse, null_safe: bool = True) -> DataFrame:
    """Append what is new to the program copies and report their sizes; rows already there are not rewritten.

    Missing key parts compare as equal, so that a second sync finds nothing new; ``null_safe=False`` compares as plain
    equality does and appends rows without a key again. A sync compares the rows that came since the last one with the
    copy's rows of their months, so its work grows with what is new and not with the copy.
    """
    w = warehouse
    seen = {n: snapshots.latest(w.spark, w.path(n)) for n in ("results", "summary")}
    candidates = {"results": program_sync.program_view(result_candidates(w, null_safe)), "summary": summary_candidates(w, null_safe)}
    results, standards, assignments = w.read("results", LANDING), w.table(STANDARDS), w.table(ASSIGNMENTS)
    copies = {n: possible_copies(w, n, candidates[n], layout) for n, layout in (("results", LANDING), ("summary", SUMMARY.columns))}
    copies |= {t.name: w.table(t, PROGRAM_PREFIX) for t in (STANDARDS, ASSIGNMENTS)}
    new = {
        "results": conform(program_sync.new_program_results(candidates["results"], copies["results"], null_safe), LANDING),
        "summary": conform(program_sync.new_program_summary(candidates["summary"], copies["summary"], null_safe), SUMMARY.columns),
        "standards": conform(program_sync.new_program_standards(standards, results, copies["standards"]), STANDARDS.columns),
        "assignments": conform(program_sync.new_program_assignments(assignments, copies["assignments"]), ASSIGNMENTS.columns),
    }
    for name, rows in new.items():
        _add_copies(w, name, rows, {"what": "sync", "seen": seen[name].version if seen.get(name) else None})
        snapshots.compact(w.spark, w.path(PROGRAM_PREFIX + name), by=MONTH)
    return program_sync.sync_status(*[w.read(PROGRAM_PREFIX + n) for n in new])


def weekly_update(
    warehouse: Warehouse,
    raw: DataFrame,
    profile: DataFrame,
    as_of: dt.date,
    days: int = fixed.DEFAULT_DAYS_BACK,
    academic_year: str | None = None,
    program: bool = True,
) -> DataFrame:
    """All steps for the window that ends at ``as_of``; returns the row counts of the four tables."""
    window_load(warehouse, raw, profile, as_of - dt.timedelta(days=days), as_of, academic_year)
    return follow_results(warehouse, program)


def follow_results(warehouse: Warehouse, program: bool = True) -> DataFrame:
    """Bring the other tables up to the stored results; returns the row counts of the four tables."""
    update_lookups(warehouse)
    refresh_summary(warehouse)
    if program:
        sync_program(warehouse)
    names = ("results", "assignments", "standards", "summary")
    return table_counts(**{n: warehouse.read(n) for n in names})


def weekly_from_pages(
    warehouse: Warehouse,
    path: str,
    profile: DataFrame,
    as_of: dt.date,
    days: int = fixed.DEFAULT_DAYS_BACK,
    academic_year: str | None = None,
    program: bool = True,
) -> DataFrame:
    """``weekly_update`` with the result pages that landed in ``path`` since the last one.

    A file stream finds the new files and lands their rows in batches below the warehouse. Which batches the results hold stands in
    their ledger, so a run that breaks off anywhere is made up for by the next one: batches landed but not loaded are loaded, and
    tables that lag behind the results follow. A result that landed twice, by student, assessment, standard and date, counts as it landed last.
    """
    spark, landed = warehouse.spark, warehouse.path("landed_results")
    incremental.new_pages(spark, path, schemas.DETAIL_RESULT, incremental.land_batches(landed), warehouse.path("landed_checkpoint"))
    batches = sorted(int(n.partition("=")[2]) for n in snapshots.children(spark, landed) if n.startswith("batch="))
    runs = [s.note["run"] for s in snapshots.history(spark, warehouse.path("results")) if str(s.note.get("run")).startswith("batch ")]
    new = [b for b in batches if not runs or b > int(runs[0].split()[1])]
    if new:
        rows = spark.read.option("basePath", landed).parquet(*[f"{landed}/batch={b}" for b in new])
        key = ["local_student_id", "assessment_id", "standard_code", "date_taken"]
        last = F.max("batch").over(Window.partitionBy(*key))
        raw = rows.withColumn("_last", last).where("batch = _last").drop("batch", "_last")
        window_load(warehouse, raw, profile, as_of - dt.timedelta(days=days), as_of, academic_year, run=f"batch {new[-1]}")
    return follow_results(warehouse, program)
