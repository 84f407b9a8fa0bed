"""Input views the parity queries run on, as SQL text.

The same text is valid in Spark SQL and DuckDB, so an operator and its oracle start from identical rows.
Every view is derived from the driver's tables and grows with them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")



# Columns of ``results_base`` by the numbers they are made of; landed records use them too.
def standard_set(supplier: str) -> str:
    return f"""CASE WHEN {supplier} % 10 IN (2, 3) THEN 'Common Core State Standards'
              WHEN {supplier} % 10 IN (0, 1) THEN 'Michigan State Standards' ELSE NULL END"""


def coding_number(supplier: str, line: str) -> str:
    return f"""CASE {supplier} % 10
           WHEN 0 THEN 'ELA-Literacy.RL.' || CAST({line} AS STRING)
           WHEN 1 THEN 'Math.Content.OA.' || CAST({line} AS STRING)
           WHEN 2 THEN 'CCSS.ELA-Literacy.W.' || CAST({line} AS STRING)
           WHEN 3 THEN 'CCSS.Math.Content.G.' || CAST({line} AS STRING)
           WHEN 4 THEN 'ELA.' || CAST({line} AS STRING)
           WHEN 5 THEN 'MI.ELA.K.' || CAST({line} AS STRING)
           WHEN 6 THEN 'HS-LS1-' || CAST({line} AS STRING)
           WHEN 7 THEN 'Overall' WHEN 8 THEN '' ELSE NULL END"""


def described(supplier: str, line: str) -> str:
    return f"'Desc ' || CAST({supplier} % 20 AS STRING) || '.' || CAST({line} AS STRING)"


def achieved(quantity: str) -> str:
    return f"CASE WHEN {quantity} = 50 THEN NULL ELSE CAST({quantity} AS DECIMAL(10,2)) END"


def possible(line: str) -> str:
    return f"CAST(CASE {line} WHEN 7 THEN 0 WHEN 6 THEN 32 WHEN 5 THEN 64 ELSE 50 END AS DECIMAL(10,2))"


RESULTS_FROM = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

VIEWS: dict[str, str] = {
    "raw_results": """
SELECT ((l_orderkey*8 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey AS result_seq,
         CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS local_student_id,
         'L' || CAST(o_custkey AS STRING) AS last_name,
         'F' || CAST(o_custkey % 50 AS STRING) AS first_name,
         CAST(l_partkey % 150 AS INT) AS assessment_id,
         CASE l_partkey % 12
           WHEN 0 THEN '3ELAMod' || CAST(l_partkey % 4 AS STRING)
           WHEN 1 THEN '5Math Unit ' || CAST(l_partkey % 4 AS STRING)
           WHEN 2 THEN 'Science Lab' WHEN 3 THEN 'SS History 7'
           WHEN 4 THEN 'HMH Into Math 4' WHEN 5 THEN 'Into Literature 9'
           WHEN 6 THEN 'Discipline Survey' WHEN 7 THEN '12 english relay'
           WHEN 8 THEN 'Social Studies 8' WHEN 9 THEN 'Reading Check'
           WHEN 10 THEN 'Benchmark A' ELSE NULL END AS title,
         CASE l_partkey % 4
           WHEN 0 THEN CAST(CAST(l_shipdate AS DATE) AS STRING)
           WHEN 1 THEN CAST(month(l_shipdate) AS STRING) || '/' || CAST(day(l_shipdate) AS STRING) || '/' || CAST(year(l_shipdate) AS STRING)
           WHEN 2 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T08:30:00'
           ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 08:30:00' END AS date_taken,
         CASE l_suppkey % 10
           WHEN 0 THEN 'ELA-Literacy.RL.' || CAST(l_linenumber AS STRING)
           WHEN 1 THEN 'Math.Content.OA.' || CAST(l_linenumber AS STRING)
           WHEN 2 THEN 'CCSS.ELA-Literacy.W.' || CAST(l_linenumber AS STRING)
           WHEN 3 THEN 'CCSS.Math.Content.G.' || CAST(l_linenumber AS STRING)
           WHEN 4 THEN 'ELA.' || CAST(l_linenumber AS STRING)
           WHEN 5 THEN 'MI.ELA.K.' || CAST(l_linenumber AS STRING)
           WHEN 6 THEN 'HS-LS1-' || CAST(l_linenumber AS STRING)
           WHEN 7 THEN 'Overall' WHEN 8 THEN '' ELSE NULL END AS standard_code,
         CASE WHEN l_suppkey % 10 = 6 THEN 'Local Set' ELSE NULL END AS standard_set,
         'Desc ' || CAST(l_suppkey % 10 AS STRING) || '.' || CAST(l_linenumber AS STRING) AS standard_description,
         CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_quantity AS DECIMAL(10,2)) END AS points,
         CAST(CASE l_linenumber WHEN 7 THEN 0 WHEN 6 THEN 32 WHEN 5 THEN 64 ELSE 50 END AS DECIMAL(10,2)) AS points_possible
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    "enrollment": """
SELECT CAST(c_custkey AS STRING) AS district_student_id,
         CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 'S' || CAST(c_custkey AS STRING) END AS state_student_id,
         CAST(c_custkey % 15 AS INT) AS grade_level_id,
         CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_nationkey AS INT) END AS site_id,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name END AS school,
         r_name AS district, c_custkey AS seq
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
    "sites": """
SELECT CAST(n_nationkey AS INT) AS site_id, n_name AS site_name FROM nation
""",
    "users": """
SELECT CAST(s_suppkey AS STRING) AS user_id, s_name AS first_name,
         'T' || CAST(s_nationkey AS STRING) AS last_name FROM supplier
""",
    "roster": """
SELECT CAST(o_custkey AS STRING) AS district_student_id, CAST(o_orderkey % 120 AS STRING) AS user_id,
         CAST(o_orderkey AS STRING) AS section_id, CAST(o_orderkey % 14 AS INT) AS grade_level_id,
         o_orderkey AS seq FROM orders
""",
    "section_roster": """
SELECT CAST(o_custkey AS STRING) AS student_id, CAST(o_orderkey AS STRING) AS section_id,
         'TF' || CAST(o_orderkey % 40 AS STRING) AS teacher_first, 'TL' || CAST(o_orderkey % 40 AS STRING) AS teacher_last,
         CAST(o_orderkey % 4 + 1 AS INT) AS subject_area,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(28 + o_orderkey % 10 AS INT) END AS content_area,
         o_orderkey AS seq FROM orders
""",
    "subject_map": """
SELECT DISTINCT CASE CAST(p_size % 4 AS INT) WHEN 0 THEN 'English Language Arts' WHEN 1 THEN 'Mathematics'
                       WHEN 2 THEN 'Science' ELSE 'Social Studies' END AS subject_area_name,
         CAST(p_size % 4 + 1 AS INT) AS sa_code, CAST(27 + p_size % 9 AS INT) AS course_id_code FROM part
""",
    "catalogue": """
SELECT DISTINCT standard_code AS glce_code, 'Catalogue ' || standard_code AS description,
         'Set ' || substring(standard_code, 1, 3) AS content_area, 'Subj ' || substring(standard_code, 1, 1) AS subject,
         substring(standard_code, length(standard_code), 1) AS grade_level,
         'Strand ' || substring(standard_code, 1, 6) AS subject_desc1, 'Type' AS type
  FROM raw_results WHERE standard_code LIKE '%ELA%' OR standard_code LIKE 'HS%'
""",
    "results_base": f"""
SELECT ((l_orderkey*8 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey AS ResultID,
         CASE WHEN month(l_shipdate) >= 7
              THEN CAST(year(l_shipdate) AS STRING) || '-' || CAST(year(l_shipdate) + 1 AS STRING)
              ELSE CAST(year(l_shipdate) - 1 AS STRING) || '-' || CAST(year(l_shipdate) AS STRING) END AS AcademicYear,
         r_name AS DistrictName, n_name AS SchoolName,
         CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 'S' || CAST(c_custkey AS STRING) END AS StudentID_SASID,
         CAST(c_custkey AS STRING) AS StudentID_LASID,
         'L' || CAST(c_custkey AS STRING) AS LastName, 'F' || CAST(c_custkey % 50 AS STRING) AS FirstName,
         CASE WHEN c_custkey % 15 = 0 THEN NULL WHEN c_custkey % 15 = 1 THEN 'K'
              ELSE CAST(c_custkey % 15 - 1 AS STRING) END AS StudentGrade,
         CAST(NULL AS STRING) AS ClassName,
         CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 'TL' || CAST(l_suppkey % 40 AS STRING) END AS TeacherLastName,
         CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 'TF' || CAST(l_suppkey % 40 AS STRING) END AS TeacherFirstName,
         CASE WHEN l_suppkey % 10 IN (0, 2, 5) THEN 'ELA' WHEN l_suppkey % 10 = 3 THEN 'Math' ELSE NULL END AS Subject,
         CASE l_partkey % 6 WHEN 0 THEN 'HMH Into Math' WHEN 1 THEN 'Into Reading' WHEN 2 THEN 'District' ELSE NULL END AS ProgramName,
         CASE l_partkey % 7 WHEN 0 THEN 'Houghton Mifflin Harcourt' WHEN 1 THEN 'NWEA' ELSE NULL END AS Publisher,
         CASE l_partkey % 3 WHEN 0 THEN 'Unit ' || CAST(l_partkey % 5 AS STRING) ELSE NULL END AS Component,
         CASE l_partkey % 12
           WHEN 0 THEN '3ELAMod' || CAST(l_partkey % 4 AS STRING)
           WHEN 1 THEN '5Math Unit ' || CAST(l_partkey % 4 AS STRING)
           WHEN 2 THEN 'Science Lab' WHEN 3 THEN 'SS History 7'
           WHEN 4 THEN 'HMH Into Math 4' WHEN 5 THEN 'Into Literature 9'
           WHEN 6 THEN 'Discipline Survey' WHEN 7 THEN '12 english relay'
           WHEN 8 THEN 'Social Studies 8' WHEN 9 THEN 'Reading Check'
           WHEN 10 THEN 'Benchmark A' ELSE NULL END AS AssignmentName,
         CASE WHEN l_partkey % 151 = 0 THEN NULL ELSE CAST(l_partkey % 150 AS INT) END AS AssessmentID,
         CAST(l_shipdate AS DATE) AS DateCompleted,
         {standard_set('l_suppkey')} AS StandardSet,
         {coding_number('l_suppkey', 'l_linenumber')} AS StandardCodingNumber,
         {described('l_suppkey', 'l_linenumber')} AS StandardDescription,
         {achieved('l_quantity')} AS PointsAchieved,
         {possible('l_linenumber')} AS PointsPossible,
         CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_nationkey AS INT) END AS SchoolID
  {RESULTS_FROM}
""",
    "results": """
SELECT * FROM results_base
  UNION ALL
  SELECT ResultID + 1000000000000000000 AS ResultID, AcademicYear, DistrictName, SchoolName, StudentID_SASID, StudentID_LASID,
         LastName, FirstName, StudentGrade, ClassName, TeacherLastName, TeacherFirstName, Subject, ProgramName, Publisher,
         Component, AssignmentName, AssessmentID, DateCompleted, StandardSet, StandardCodingNumber, StandardDescription,
         PointsAchieved, PointsPossible, SchoolID
  FROM results_base WHERE CAST(StudentID_LASID AS BIGINT) % 10 = 0
""",
    "assignments_seed": """
SELECT ProgramName, Component, AssignmentName, SchoolID, MIN(AssessmentID) AS SourceAssessmentID,
         CAST(NULL AS STRING) AS Publisher, 'Seed' AS Subject
  FROM results_base WHERE SchoolID % 2 = 0 AND AssessmentID IS NOT NULL
  GROUP BY ProgramName, Component, AssignmentName, SchoolID
""",
    "standards_seed": """
SELECT StandardCodingNumber, MIN(StandardSet) AS StandardSet, 'Seed description' AS StandardDescription,
         CAST(NULL AS STRING) AS Subject
  FROM results_base WHERE StandardCodingNumber LIKE '%1' OR StandardCodingNumber LIKE '%2' GROUP BY StandardCodingNumber
""",
    "program_results_seed": """
SELECT StudentID_LASID, AssignmentName, DateCompleted, StandardCodingNumber
  FROM results_base WHERE AssessmentID % 3 = 0
""",
}


# Records as the source sends them, with repeats, gaps and bad texts.
VIEWS |= {
    "site_records": """
SELECT CAST(n_nationkey AS INT) AS site_id, n_name || ' old' AS site_name, n_nationkey AS seq FROM nation
UNION ALL
SELECT CAST(n_nationkey AS INT) AS site_id, n_name AS site_name, n_nationkey + 1000 AS seq FROM nation
WHERE n_nationkey % 2 = 0
""",
    "enrollment_records": """
SELECT district_student_id, state_student_id, CAST(grade_level_id AS STRING) AS grade_level_id, site_id, school,
       district, seq
FROM enrollment
UNION ALL
SELECT district_student_id, state_student_id, CAST(grade_level_id + 1 AS STRING) AS grade_level_id, site_id, school,
       district, seq + 1000000000 AS seq
FROM enrollment WHERE seq % 10 = 0
""",
    "user_records": """
SELECT CAST(s_suppkey AS STRING) AS user_id, s_name AS first_name, 'T' || CAST(s_nationkey AS STRING) AS last_name,
       s_suppkey AS seq
FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS STRING) AS user_id, s_name AS first_name, 'Renamed' AS last_name, s_suppkey + 1000000000 AS seq
FROM supplier WHERE s_suppkey % 4 = 0
""",
    "level_records": """
SELECT o_orderkey AS seq,
       CASE WHEN o_orderkey % 17 = 0 THEN CAST(o_orderkey % 14 AS STRING) || '.0' WHEN o_orderkey % 19 = 0 THEN ''
            WHEN o_orderkey % 23 = 0 THEN '-1' WHEN o_orderkey % 29 = 0 THEN NULL
            ELSE CAST(o_orderkey % 14 AS STRING) END AS level_text
FROM orders
""",
    "date_records": """
SELECT result_seq, CASE result_seq % 29 WHEN 0 THEN '' WHEN 1 THEN 'not a date' WHEN 2 THEN '1997-13-45'
                        WHEN 3 THEN NULL ELSE date_taken END AS date_text
FROM raw_results
""",
    "number_records": """
SELECT result_seq, CASE result_seq % 31 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '12.345'
                        ELSE CAST(points AS STRING) END AS number_text
FROM raw_results
""",
    "header_records": """
SELECT CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE CAST(p_partkey % 400 AS INT) END AS assessment_id,
       CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 'Grade ' || CAST(p_size AS STRING) || ' ela unit'
                       WHEN 2 THEN 'Math ' || p_brand WHEN 3 THEN NULL ELSE p_name END AS title,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'Name Math ' || CAST(p_size AS STRING) END AS name,
       p_brand AS scope, p_type AS publisher,
       CASE WHEN p_size % 3 = 0 THEN '' ELSE 'S' || CAST(p_size % 3 AS STRING) END AS subject,
       'SN' || CAST(p_size % 6 AS STRING) AS subject_name, p_partkey AS seq
FROM part
""",
    "assessment_records": """
SELECT CAST(l_partkey % 300 AS INT) AS assessment_id, 'L' || CAST(l_partkey % 300 AS STRING) AS local_assessment_id,
       'Title ' || CAST(l_suppkey AS STRING) AS title,
       CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'About ' || CAST(l_suppkey AS STRING) END AS description,
       CAST(l_suppkey % 5 AS INT) AS subject_id, 'Subject ' || CAST(l_suppkey % 5 AS STRING) AS subject_name,
       CAST(l_linenumber AS INT) AS version, CAST(l_shipdate AS DATE) AS created_date,
       CASE WHEN l_linenumber % 2 = 0 THEN NULL WHEN l_linenumber = 1 THEN true ELSE false END AS deleted,
       ((l_orderkey*8 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey AS seq
FROM lineitem
""",
    "assessments_seed": """
SELECT CAST(p_partkey AS INT) AS assessment_id, 'Seed' AS local_assessment_id, 'Old ' || p_brand AS title,
       'Old text' AS description, CAST(p_size AS INT) AS subject_id, 'Old subject' AS subject_name,
       CAST(1 AS INT) AS version, CAST('1990-01-01' AS DATE) AS created_date, false AS deleted
FROM part WHERE p_partkey % 2 = 0
""",
    "band_rows": "SELECT CAST(p_partkey AS INT) AS assessment_id FROM part WHERE p_partkey % 2 = 0",
    "question_rows": """
SELECT CAST(p_partkey AS BIGINT) AS question_id, CAST(p_partkey % 170 AS INT) AS assessment_id FROM part WHERE p_partkey % 5 <> 0
""",
    "choice_rows": "SELECT CAST(l_partkey AS BIGINT) AS question_id FROM lineitem WHERE l_linenumber = 1",
    "legacy_rows": "SELECT CAST(s_suppkey AS INT) AS standard_id FROM supplier WHERE s_suppkey % 3 <> 0",
    "question_links": """
SELECT CAST(l_partkey AS BIGINT) AS question_id, CAST(l_suppkey AS INT) AS standard_id FROM lineitem WHERE l_linenumber = 2
""",
    "school_rows": "SELECT CAST(n_nationkey AS INT) AS school_id FROM nation WHERE n_nationkey % 4 <> 0",
    "student_rows": """
SELECT CAST(c_custkey AS INT) AS student_id, CAST(c_nationkey AS INT) AS school_id FROM customer WHERE c_custkey % 10 <> 0
""",
    "score_rows": """
SELECT CAST(o_orderkey AS BIGINT) AS score_id, CAST(o_custkey AS INT) AS student_id, CAST(o_orderkey % 170 AS INT) AS assessment_id
  FROM orders WHERE o_orderkey % 7 <> 0
""",
    "response_rows": """
SELECT CAST(l_orderkey AS BIGINT) AS score_id, CAST(o_custkey AS INT) AS student_id, CAST(l_partkey % 170 AS INT) AS assessment_id,
         CAST(l_partkey AS BIGINT) AS question_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    "question_records": """
SELECT CAST(l_partkey % 150 AS INT) AS assessment_id, CAST(l_linenumber AS INT) AS question_number,
       'Text ' || CAST(l_suppkey AS STRING) AS question_text,
       CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'T' || CAST(l_suppkey % 4 AS STRING) END AS question_type,
       CAST(l_quantity AS DECIMAL(10,2)) AS max_points, l_returnflag AS correct_answer,
       ((l_orderkey*8 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey AS seq
FROM lineitem
""",
    "questions_seed": """
SELECT DISTINCT CAST(p_partkey % 200 AS INT) AS assessment_id, CAST(2 AS INT) AS question_number, 'Old' AS question_text,
       'Old' AS question_type, CAST(1 AS DECIMAL(10,2)) AS max_points, 'Z' AS correct_answer
FROM part
""",
    "standard_records": """
SELECT CASE WHEN l_suppkey % 50 = 49 THEN NULL ELSE CAST((l_suppkey % 20) * 10 + l_linenumber AS INT) END AS standard_id,
       'Code ' || CAST(l_suppkey AS STRING) AS standard_code, 'Desc ' || CAST(l_partkey AS STRING) AS standard_description,
       CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE 'Math' END AS subject, CAST(l_linenumber AS STRING) AS grade_level,
       ((l_orderkey*8 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey AS seq
FROM lineitem
""",
    "legacy_standards_seed": """
SELECT DISTINCT CAST(p_partkey % 300 AS INT) AS standard_id, 'Old code' AS standard_code, 'Old' AS standard_description,
       'Old' AS subject, 'Old' AS grade_level
FROM part
""",
    "score_records": """
SELECT CASE WHEN o_custkey % 61 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS student_id,
       CAST(l_partkey % 150 AS INT) AS assessment_id, CAST(o_custkey AS STRING) AS local_student_id,
       CAST(o_orderdate AS DATE) AS test_date, CAST(l_quantity AS DECIMAL(10,2)) AS raw_score,
       CAST(l_quantity * 2 AS DECIMAL(5,2)) AS percent_correct,
       CASE WHEN l_quantity < 10 THEN NULL ELSE 'Band ' || CAST(l_linenumber AS STRING) END AS performance_band,
       CAST(l_linenumber AS INT) AS version,
       ((l_orderkey*8 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey AS seq
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    "scores_seed": """
SELECT DISTINCT student_id, assessment_id, local_student_id, test_date, CAST(0 AS DECIMAL(10,2)) AS raw_score,
       CAST(0 AS DECIMAL(5,2)) AS percent_correct, 'Old' AS performance_band, CAST(0 AS INT) AS version
FROM score_records WHERE assessment_id % 4 = 0
""",
    "link_records": """
SELECT l_partkey AS question_id, CAST(l_suppkey AS INT) AS standard_id FROM lineitem
""",
    "links_seed": """
SELECT DISTINCT l_partkey AS question_id, CAST(l_suppkey AS INT) AS standard_id FROM lineitem WHERE l_linenumber = 1
""",
    "standards_now": """
SELECT StandardSet, StandardCodingNumber, MIN(StandardDescription) AS StandardDescription, MIN(Subject) AS Subject,
       MIN(DateCompleted) AS CreatedDate
FROM results GROUP BY StandardSet, StandardCodingNumber
""",
    "assignments_now": """
SELECT ProgramName, Component, AssignmentName, SchoolID, MIN(Publisher) AS Publisher,
       MIN(AssessmentID) AS SourceAssessmentID, MIN(Subject) AS Subject,
       MIN(DateCompleted) AS CreatedDate
FROM results GROUP BY ProgramName, Component, AssignmentName, SchoolID
""",
    "program_summary_seed": """
SELECT DISTINCT StudentID_LASID, AssignmentName, DateCompleted FROM results_base WHERE AssessmentID % 3 = 0
""",
    "program_standards_seed": """
SELECT DISTINCT StandardSet, StandardCodingNumber FROM results_base WHERE StandardCodingNumber LIKE '%1'
""",
    "program_assignments_seed": """
SELECT DISTINCT ProgramName, Component, AssignmentName FROM results_base WHERE Component = 'Unit 1'
""",
}


# Spark joins in the order it reads. The same inner joins with the customers put to their orders first shuffle the line items, which are
# the most rows by far, once instead of twice.
AS_READ = "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
ORDERS_FIRST = "JOIN (orders JOIN customer ON o_custkey = c_custkey {rest}) ON l_orderkey = o_orderkey"
PLACES = "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


# Line items of one task, in ``Views.spread``.
TASK_ITEMS = 500_000


def orders_first(text: str) -> str:
    """The text with orders, customers and their places joined before the line items."""
    return re.sub(rf"{AS_READ}\s+{PLACES}", ORDERS_FIRST.format(rest=PLACES), text)


def _mentions(text: str, names) -> list[str]:
    return [name for name in names if re.search(rf"\b{name}\b", text)]


def with_views(sql: str) -> str:
    """Prefix a query with the views it mentions, directly or through other views."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _mentions(text, VIEWS):
            if name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    head, glue = ("WITH ", "\n") if not re.match(r"\s*WITH\b", sql, re.I) else ("WITH ", ",\n")
    body = sql if glue == "\n" else re.sub(r"^\s*WITH\b", "", sql, count=1, flags=re.I)
    return f"{head}{ctes}{glue}{body}"


class Views:
    """Lazy DataFrames over one data folder: ``Views(spark, dir).results`` and so on.

    No temp views are registered, so two folders can be used in one session.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in VIEWS:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, text: str, item_tasks: int = 1) -> DataFrame:
        full = orders_first(with_views(text))
        if item_tasks > 1:
            full = re.sub(r"\bFROM lineitem JOIN\b", f"FROM (SELECT /*+ REPARTITION({item_tasks}, l_orderkey) */ * FROM lineitem) AS items JOIN", full)
        for table in BASE_TABLES:
            full = re.sub(
                rf"\b(FROM|JOIN)(\s+\(?){table}\b",
                rf"\1\2parquet.`{self.sf_dir}/{table}.parquet` AS {table}",
                full,
            )
        return self.spark.sql(full)


    def spread(self, name: str) -> DataFrame:
        """The view, with its line items dealt by order to tasks of about ``TASK_ITEMS``.

        Line items are a few numbers each and what a view makes of them is ten times as long, so a task that is sized by what it reads can
        have more than it can hold.
        """
        tasks = -(-self.lineitem.count() // TASK_ITEMS)
        return self.sql(f"SELECT * FROM {name}", tasks) if tasks > 1 else getattr(self, name)


class LandedViews(Views):
    """The same views, each written as a parquet table when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str, files: int = 8):
        super().__init__(spark, sf_dir)
        self.folder, self.files = folder, files
        self._written: set[str] = set()

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return super().__getattr__(name)
        path = f"{self.folder}/{name}"
        if name not in self._written:
            rows = super().__getattr__(name)
            rows.repartition(self.files).write.mode("overwrite").parquet(path)
            self._written.add(name)
        return self.spark.read.parquet(path)
