"""A load from landed pages as a source sends them: repeated, cut short and badly typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markbook.plans import weekly
from markbook.session import scratch_dir

from .joins_merges import FULL_SQL, half_even
from .landing import envelopes, write_envelopes
from .registry import query
from .views import Views

# Every third points text has a third place, some are no number, and some dates are no date.
POINTS_TEXT = """CASE WHEN result_seq % 101 = 0 THEN 'n/a' WHEN result_seq % 3 = 0 THEN CAST(points AS {text}) || '5'
                      ELSE CAST(points AS {text}) END"""
DATE_TEXT = "CASE WHEN result_seq % 103 = 0 THEN 'oops' ELSE date_taken END"

SENT = f"""sent AS (SELECT * REPLACE (TRY_CAST({POINTS_TEXT.format(text='VARCHAR')} AS DECIMAL(20,6)) AS points,
                                      CAST(points_possible AS DECIMAL(20,6)) AS points_possible, {DATE_TEXT} AS date_taken)
                    FROM raw_results)"""
LOADED = (
    FULL_SQL.replace("WITH ", f"WITH {SENT}, ", 1)
    .replace("FROM raw_results)", "FROM sent)")
    .replace(half_even("r.points", "r.points_possible"), half_even("r.points * 10", "r.points_possible * 10"))
    .replace("r.points AS PointsAchieved", "CAST(r.points AS DECIMAL(10,2)) AS PointsAchieved")
    .replace("r.points_possible AS PointsPossible", "CAST(r.points_possible AS DECIMAL(10,2)) AS PointsPossible")
)
KEPT = (
    "StudentID_LASID",
    "StudentGrade",
    "SchoolName",
    "TeacherLastName",
    "AssessmentID",
    "StandardCodingNumber",
    "DateCompleted",
    "PointsAchieved",
    "PercentCorrect",
)
ORACLE = f"""
WITH {SENT}
SELECT 'loaded' AS kind, {', '.join(KEPT)}, CAST(NULL AS BIGINT) AS n FROM ({LOADED}) q
UNION ALL
SELECT 'undated', {', '.join('NULL' for _ in KEPT)}, COUNT(*) FROM sent JOIN enrollment ON local_student_id = district_student_id
WHERE date_taken = 'oops' AND site_id <> 0
UNION ALL
SELECT 'bad_page', {', '.join('NULL' for _ in KEPT)}, 2
UNION ALL
SELECT 'ids', {', '.join('NULL' for _ in KEPT)}, COUNT(*) FROM ({LOADED}) q
UNION ALL
SELECT 'summary', {', '.join('NULL' for _ in KEPT)}, COUNT(*) FROM (
  SELECT DISTINCT AcademicYear, SchoolName, StudentID_SASID, StudentID_LASID, LastName, FirstName, StudentGrade, TeacherLastName,
    TeacherFirstName, coalesce(Subject, '') AS s, AssignmentName, AssessmentID, DateCompleted, SchoolID
  FROM ({LOADED.replace("r.subj AS Subject", "CASE WHEN r.title LIKE '%Math%' OR r.title LIKE '%math%' THEN 'M' "
                        "WHEN r.title LIKE '%ELA%' OR r.title LIKE '%ela%' OR r.title LIKE '%English%' THEN 'E' "
                        "WHEN r.title LIKE '%Science%' OR r.title LIKE '%science%' THEN 'Sc' "
                        "WHEN r.title LIKE '%Social%' OR r.title LIKE '%History%' THEN 'So' ELSE 'own ' || r.subj END AS Subject")}) q
  WHERE AssessmentID IS NOT NULL AND StudentID_SASID IS NOT NULL) d
"""


def land(rows: DataFrame, order: str, path: str) -> None:
    """Pages in the given order, in files whose names are in that order too."""
    write_envelopes(envelopes(rows.orderBy(order).drop("seq")), path)


def land_all(v: Views) -> dict[str, str]:
    """Landed folders; files of a folder arrive in order of their names."""
    base = scratch_dir(v.spark)
    sent = v.raw_results.withColumns({"points": F.expr(POINTS_TEXT.format(text="STRING")), "date_taken": F.expr(DATE_TEXT)})
    land(sent, "result_seq", f"{base}/results/1")
    # an earlier listing of every student, with another school and grade, and every site under another name
    old = v.enrollment.withColumns({"school": F.lit("Old school"), "site_id": F.lit(3), "grade_level_id": F.lit(2)})
    land(old, "seq", f"{base}/enrollment/1")
    land(v.enrollment, "seq", f"{base}/enrollment/2")
    land(v.sites.withColumn("site_name", F.lit("Old site")), "site_id", f"{base}/sites/1")
    land(v.sites, "site_id", f"{base}/sites/2")
    land(v.users.withColumn("last_name", F.lit("Old name")), "user_id", f"{base}/users/1")
    land(v.users, "user_id", f"{base}/users/2")
    land(v.roster, "seq", f"{base}/roster/1")
    cut = v.spark.createDataFrame([('{"results": [{"local_student_id": "1", "points": "3"}, {"local_stu',)], "value string")
    cut.write.text(f"{base}/results/2")
    cut.write.text(f"{base}/roster/2")
    return {name: f"{base}/{name}/*" for name in weekly.PAGES}


@query("load_from_pages", ORACLE)
def load_from_pages(v):
    warehouse = weekly.Warehouse(v.spark, scratch_dir(v.spark))
    weekly.load_from_pages(warehouse, land_all(v), v.section_roster, v.subject_map, most_bad=0.5)
    stored, rejects = warehouse.read("results"), warehouse.read("rejects")
    none = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in KEPT]
    n = F.lit(None).cast("long").alias("n")
    return (
        stored.select(F.lit("loaded").alias("kind"), *KEPT, n)
        .unionByName(rejects.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n")).select("kind", *none, "n"))
        .unionByName(stored.agg(F.countDistinct("ResultID").alias("n")).select(F.lit("ids").alias("kind"), *none, "n"))
        .unionByName(warehouse.read("summary").agg(F.count(F.lit(1)).alias("n")).select(F.lit("summary").alias("kind"), *none, "n"))
    )
