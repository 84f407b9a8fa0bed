"""Values fixed by the source system and by the reports that must agree with it."""

# Keywords that mark a program, as lower-case text to find inside a field.
PROGRAM_TERMS = ("hmh", "into literature", "into math", "into reading")
PUBLISHER_TERMS = ("houghton mifflin", "harcourt")
ANY_FIELD_TERMS = (
    "hmh",
    "into literature",
    "into math",
    "into reading",
    "houghton mifflin",
    "harcourt",
)

# Subject label on a result -> subject name in the subject map.
SUBJECT_LABELS = {
    "ELA": "English Language Arts",
    "English": "English Language Arts",
    "Math": "Mathematics",
    "Mathematics": "Mathematics",
    "Science": "Science",
    "Social Studies": "Social Studies",
}

# Subject name in the subject map -> section subject code, as the planned backfill states them.
SECTION_SUBJECT_CODES = {"ELA": 1, "Math": 2, "Science": 3, "Social Studies": 4}

# Standard set names by code prefix.
COMMON_CORE_SET = "Common Core State Standards"
MICHIGAN_SET = "Michigan State Standards"

# Fixed value: a code that marks a whole-assessment row, not a standard.
OVERALL_CODE = "Overall"

# The academic year starts in July; a re-pull covers 7 days unless told otherwise.
ACADEMIC_YEAR_FIRST_MONTH = 7
DEFAULT_DAYS_BACK = 7

# Subject by patterns in a standard code; the first match counts.
CODE_SUBJECTS = (
    ("ELA%", "ELA"),
    ("%ELA-%", "ELA"),
    ("%.ELA.%", "ELA"),
    ("Math%", "Math"),
    ("%Math.%", "Math"),
    ("%CCSS.ELA%", "ELA"),
    ("%CCSS.Math%", "Math"),
)

# Subject by the beginning of a standard code.
CODE_PREFIX_SUBJECTS = (
    ("ELA%", "ELA"),
    ("Math%", "Math"),
    ("CCSS.ELA%", "ELA"),
    ("CCSS.Math%", "Math"),
)

# Subject by patterns in an assessment title in lower case; the first match counts.
TITLE_SUBJECTS = (
    ("%science%", "Science"),
    ("%sci%", "Science"),
    ("ss%", "Social Studies"),
    ("%social%", "Social Studies"),
    ("%history%", "Social Studies"),
    ("%ela%", "ELA"),
    ("%english%", "ELA"),
    ("%reading%", "ELA"),
    ("%math%", "Math"),
)

# Long subject name by patterns in an assignment name; the first match counts.
ASSIGNMENT_SUBJECTS = (
    ("%Math%", "Mathematics"),
    ("%math%", "Mathematics"),
    ("%ELA%", "English Language Arts"),
    ("%ela%", "English Language Arts"),
    ("%English%", "English Language Arts"),
    ("%Science%", "Science"),
    ("%science%", "Science"),
    ("%Social%", "Social Studies"),
    ("%History%", "Social Studies"),
)

# Share of unreadable pages above which a load stops; not a value of the source system.
MOST_BAD_PAGES = 0.05
