"""Table and record layouts, with their keys, required columns and text widths."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, INT, LONG, DATE = StringType(), IntegerType(), LongType(), DateType()
POINTS, BOOL, TIME = DecimalType(10, 2), BooleanType(), TimestampType()


def _struct(**columns) -> StructType:
    return StructType([StructField(name, type_, True) for name, type_ in columns.items()])


@dataclass(frozen=True)
class Table:
    """A stored table: columns, surrogate id, unique key, required columns, VARCHAR widths."""

    name: str
    columns: StructType
    surrogate: str | None = None
    unique: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    widths: dict[str, int] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema, in its order and types; a column the input lacks is NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


# --- landing fact and the tables derived from it ---------------------------------------------------

LANDING = _struct(
    AcademicYear=TEXT,
    DistrictName=TEXT,
    SchoolName=TEXT,
    StudentID_SASID=TEXT,
    StudentID_LASID=TEXT,
    LastName=TEXT,
    FirstName=TEXT,
    StudentGrade=TEXT,
    ClassName=TEXT,
    TeacherLastName=TEXT,
    TeacherFirstName=TEXT,
    ClassGrade=TEXT,
    Subject=TEXT,
    ProgramName=TEXT,
    Publisher=TEXT,
    Component=TEXT,
    AssignmentName=TEXT,
    AssessmentID=INT,
    DateCompleted=DATE,
    StandardSet=TEXT,
    StandardCodingNumber=TEXT,
    StandardDescription=TEXT,
    PointsAchieved=POINTS,
    PointsPossible=POINTS,
    PercentCorrect=TEXT,
    SchoolID=INT,
    SectionID=TEXT,
)

# Text widths of the stored tables.
_NAME_WIDTHS = {
    "AcademicYear": 20,
    "SchoolName": 200,
    "StudentID_SASID": 50,
    "StudentID_LASID": 50,
    "LastName": 100,
    "FirstName": 100,
    "StudentGrade": 10,
    "ClassName": 200,
    "TeacherLastName": 100,
    "TeacherFirstName": 100,
    "Subject": 100,
    "ProgramName": 200,
    "Publisher": 200,
    "Component": 200,
    "AssignmentName": 500,
    "StandardSet": 500,
}

RESULTS = Table(
    "results",
    LANDING,
    surrogate="ResultID",
    required=("AcademicYear", "SchoolName"),
    widths={
        **_NAME_WIDTHS,
        "DistrictName": 200,
        "ClassGrade": 10,
        "StandardCodingNumber": 200,
        "PercentCorrect": 20,
    },
)

SUMMARY_KEYS = (
    "AcademicYear",
    "SchoolName",
    "StudentID_SASID",
    "StudentID_LASID",
    "LastName",
    "FirstName",
    "StudentGrade",
    "ClassName",
    "TeacherLastName",
    "TeacherFirstName",
    "Subject",
    "ProgramName",
    "Publisher",
    "Component",
    "AssignmentName",
    "AssessmentID",
    "DateCompleted",
    "SchoolID",
)

# Totals are wider than the points they add up, so a long history cannot overflow them.
TOTAL = DecimalType(20, 2)

SUMMARY = Table(
    "summary",
    _struct(
        AcademicYear=TEXT,
        SchoolName=TEXT,
        StudentID_SASID=TEXT,
        StudentID_LASID=TEXT,
        LastName=TEXT,
        FirstName=TEXT,
        StudentGrade=TEXT,
        ClassName=TEXT,
        TeacherLastName=TEXT,
        TeacherFirstName=TEXT,
        Subject=TEXT,
        ProgramName=TEXT,
        Publisher=TEXT,
        Component=TEXT,
        AssignmentName=TEXT,
        AssessmentID=INT,
        DateCompleted=DATE,
        StandardSet=TEXT,
        TotalPointsAchieved=TOTAL,
        TotalPointsPossible=TOTAL,
        OverallPercentCorrect=TEXT,
        SchoolID=INT,
    ),
    surrogate="SummaryID",
    required=("AcademicYear", "SchoolName"),
    widths={**_NAME_WIDTHS, "OverallPercentCorrect": 20},
)

STANDARDS = Table(
    "standards",
    _struct(
        StandardSet=TEXT,
        StandardCodingNumber=TEXT,
        StandardDescription=TEXT,
        Subject=TEXT,
        GradeLevel=TEXT,
        Strand=TEXT,
        Category=TEXT,
    ),
    surrogate="StandardID",
    unique=("StandardSet", "StandardCodingNumber"),
    widths={"StandardSet": 500, "StandardCodingNumber": 200, "Subject": 100, "GradeLevel": 2, "Category": 50},
)

ASSIGNMENTS = Table(
    "assignments",
    _struct(
        ProgramName=TEXT,
        Publisher=TEXT,
        Component=TEXT,
        AssignmentName=TEXT,
        SourceAssessmentID=INT,
        Subject=TEXT,
        SchoolID=INT,
    ),
    surrogate="AssignmentID",
    unique=("ProgramName", "Component", "AssignmentName", "SchoolID"),
    widths={"ProgramName": 200, "Publisher": 200, "Component": 200, "AssignmentName": 500, "Subject": 100},
)

# --- earlier, normalised model ---------------------------------------------------------------------

SCHOOLS = Table("schools", _struct(school_id=INT, school_name=TEXT, district_id=INT), unique=("school_id",))
ASSESSMENTS = Table(
    "assessments",
    _struct(
        assessment_id=INT,
        local_assessment_id=TEXT,
        title=TEXT,
        description=TEXT,
        subject_id=INT,
        subject_name=TEXT,
        scope_id=INT,
        scope_name=TEXT,
        author_id=INT,
        author_name=TEXT,
        version=INT,
        created_date=DATE,
        modified_date=DATE,
        deleted=BOOL,
    ),
    unique=("assessment_id",),
)
BANDS = Table(
    "performance_bands",
    _struct(assessment_id=INT, band_name=TEXT, min_score=POINTS, max_score=POINTS, color=TEXT),
    surrogate="band_id",
    references={"assessment_id": ("assessments", "assessment_id")},
)
QUESTIONS = Table(
    "assessment_questions",
    _struct(
        assessment_id=INT,
        question_number=INT,
        question_text=TEXT,
        question_type=TEXT,
        max_points=POINTS,
        correct_answer=TEXT,
    ),
    surrogate="question_id",
    references={"assessment_id": ("assessments", "assessment_id")},
)
CHOICES = Table(
    "answer_choices",
    _struct(question_id=LONG, choice_letter=TEXT, choice_text=TEXT, is_correct=BOOL),
    surrogate="choice_id",
    references={"question_id": ("assessment_questions", "question_id")},
)
LEGACY_STANDARDS = Table(
    "legacy_standards",
    _struct(standard_id=INT, standard_code=TEXT, standard_description=TEXT, subject=TEXT, grade_level=TEXT),
    unique=("standard_id",),
)
QUESTION_STANDARDS = Table(
    "question_standards",
    _struct(question_id=LONG, standard_id=INT),
    surrogate="mapping_id",
    unique=("question_id", "standard_id"),
    references={
        "question_id": ("assessment_questions", "question_id"),
        "standard_id": ("legacy_standards", "standard_id"),
    },
)
STUDENTS = Table(
    "students",
    _struct(
        student_id=INT,
        local_student_id=TEXT,
        first_name=TEXT,
        last_name=TEXT,
        grade_level=TEXT,
        school_id=INT,
        active=BOOL,
    ),
    unique=("student_id",),
    references={"school_id": ("schools", "school_id")},
)
SCORES = Table(
    "student_scores",
    _struct(
        student_id=INT,
        assessment_id=INT,
        local_student_id=TEXT,
        test_date=DATE,
        raw_score=POINTS,
        percent_correct=DecimalType(5, 2),
        performance_band=TEXT,
        version=INT,
    ),
    surrogate="score_id",
    references={
        "student_id": ("students", "student_id"),
        "assessment_id": ("assessments", "assessment_id"),
    },
)
RESPONSES = Table(
    "student_responses",
    _struct(
        score_id=LONG,
        student_id=INT,
        assessment_id=INT,
        question_id=LONG,
        response=TEXT,
        points_earned=POINTS,
        is_correct=BOOL,
    ),
    surrogate="response_id",
    references={
        "score_id": ("student_scores", "score_id"),
        "student_id": ("students", "student_id"),
        "assessment_id": ("assessments", "assessment_id"),
        "question_id": ("assessment_questions", "question_id"),
    },
)
EXTRACTION_LOG = Table(
    "extraction_log",
    _struct(endpoint=TEXT, extraction_date=TIME, records_extracted=LONG, status=TEXT, error_message=TEXT),
    surrogate="log_id",
)

# Rows that a load could not take, with what is needed to find them again.
REJECTS = Table("rejects", _struct(reason=TEXT, origin=TEXT, record_key=TEXT, detail=TEXT))

# --- records as the source sends them --------------------------------------------------------------

# Points as sent may have more than the two places of the stored columns; percents are taken before rounding.
SENT_POINTS = DecimalType(20, 6)

DETAIL_RESULT = _struct(
    result_seq=LONG,
    local_student_id=TEXT,
    last_name=TEXT,
    first_name=TEXT,
    assessment_id=INT,
    title=TEXT,
    date_taken=TEXT,
    standard_code=TEXT,
    standard_set=TEXT,
    standard_description=TEXT,
    points=TEXT,
    points_possible=TEXT,
)

NESTED_STANDARD = _struct(
    standard_set=TEXT,
    set_name=TEXT,
    standard_code=TEXT,
    code=TEXT,
    standard_description=TEXT,
    description=TEXT,
    points_achieved=SENT_POINTS,
    score=SENT_POINTS,
    points_possible=SENT_POINTS,
    max_score=SENT_POINTS,
)

NESTED_RESULT = _struct(
    district_name=TEXT,
    school_name=TEXT,
    site_name=TEXT,
    state_student_id=TEXT,
    sasid=TEXT,
    local_student_id=TEXT,
    lasid=TEXT,
    student_id=TEXT,
    last_name=TEXT,
    student_last_name=TEXT,
    first_name=TEXT,
    student_first_name=TEXT,
    grade_level=TEXT,
    student_grade=TEXT,
    class_name=TEXT,
    section_name=TEXT,
    teacher_last_name=TEXT,
    teacher_first_name=TEXT,
    class_grade_level=TEXT,
    subject=TEXT,
    subject_name=TEXT,
    program_name=TEXT,
    publisher=TEXT,
    component=TEXT,
    assessment_name=TEXT,
    assessment_title=TEXT,
    assignment_name=TEXT,
    assessment_id=INT,
    date_completed=TEXT,
    test_date=TEXT,
    school_id=INT,
    site_id=INT,
    standard_set=TEXT,
    overall_score=SENT_POINTS,
    points_achieved=SENT_POINTS,
    total_score=SENT_POINTS,
    raw_score=SENT_POINTS,
    points_possible=SENT_POINTS,
    max_score=SENT_POINTS,
    standards=ArrayType(NESTED_STANDARD),
    standard_results=ArrayType(NESTED_STANDARD),
)

ENROLLMENT = _struct(
    district_student_id=TEXT,
    state_student_id=TEXT,
    student_id=TEXT,
    grade_level_id=TEXT,
    site_id=INT,
    school=TEXT,
    district=TEXT,
)
SITES = _struct(
    site_id=INT, site_name=TEXT, state_school_id=TEXT, local_site_code=TEXT, city=TEXT, state=TEXT
)
USERS = _struct(user_id=TEXT, first_name=TEXT, last_name=TEXT, job_title=TEXT)
ROSTER = _struct(
    district_student_id=TEXT, user_id=TEXT, grade_level_id=TEXT, section_id=TEXT, site_id=INT, course_id=TEXT
)
ASSESSMENT_HEADER = _struct(
    assessment_id=INT,
    title=TEXT,
    name=TEXT,
    scope=TEXT,
    publisher=TEXT,
    subject=TEXT,
    subject_name=TEXT,
)
ASSESSMENT_DETAIL = _struct(
    assessment_id=INT,
    performance_band_sets=ArrayType(
        _struct(bands=ArrayType(_struct(name=TEXT, min_score=POINTS, max_score=POINTS, color=TEXT)))
    ),
    questions=ArrayType(
        _struct(
            question_number=INT,
            question_text=TEXT,
            question_type=TEXT,
            max_points=POINTS,
            correct_answer=TEXT,
            answer_choices=ArrayType(_struct(letter=TEXT, text=TEXT, is_correct=BOOL)),
            standards=ArrayType(
                _struct(standard_id=INT, code=TEXT, description=TEXT, subject=TEXT, grade_level=TEXT)
            ),
        )
    ),
)
SCORE_RECORD = SCORES.columns
