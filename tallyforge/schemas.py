"""Record schemas and fixed vocabularies of the two form types."""

from __future__ import annotations

from pyspark.sql import types as T

_matrix = T.ArrayType(T.ArrayType(T.IntegerType()))
_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _struct(columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (c.split() for c in columns.split(", "))])


WORDS = _struct(
    "doc string, cell string, page int, block int, line int, word_seq int, value string, conf double, x0 double, y0 double, x1 double, y1 double, page_w double, page_h double"
)
#: content and confidence stay raw JSON: their shape depends on the field.
FIELDS = _struct("id string, section string, content string, confidence string")
FORM1 = _struct(
    "filename string, type_of_report string, employer_name string, state string, city string, headquarter_state string, headquarter_city string, "
    "EIN string, zipcode string, headquarter_zipcode string, NAICS string, NAICS_name string, reporting_year int"
).add("table", _matrix)
AGENT_FLAGS = ["Local Public School", "Special Regional Agency", "State Education Agency", "Other"]
FORM5 = _struct("filename string, state string, county string, city string, zipcode string, reporting_year string")
for _name in ("table_a", "table_b", "table_c"):
    FORM5 = FORM5.add(_name, _matrix)
for _name in AGENT_FLAGS:
    FORM5 = FORM5.add(_name, T.BooleanType())
INDUSTRY = _struct("seq_no int, code string, title string, note string")
ZIP_COUNTY = _struct("zcta string, county string, county_name string, zip_name string, pop20 string, afact string")
CITIES = _struct(
    "city string, city_ascii string, state_id string, state_name string, county_fips string, county_name string, lat string, lng string, population string, "
    "density string, source string, military string, incorporated string, timezone string, ranking string, zips string, id string"
)

# The forms' own vocabularies, in the order of the forms.
RACES = [
    "Hispanic or Latino",
    "White",
    "Black or African American",
    "Asian",
    "Native Hawaiian or Other Pacific Islander",
    "American Indian or Alaska Native",
    "Two or More Races",
]
GENDERS = ["Male", "Female"]
TOTAL = "Row Total"
#: Race and gender of a matrix's columns: both of the first race, then the others by gender.
RACE_GENDER = [(RACES[0], g) for g in GENDERS] + [(r, g) for g in GENDERS for r in RACES[1:]]
FORM1_COLUMNS = [f"{r} {g}" for r, g in RACE_GENDER] + [TOTAL]
FORM5_COLUMNS = [f"{r}_{g}" for r, g in RACE_GENDER] + [TOTAL]
# Rows of form 1's table.
JOB_CATEGORIES = [
    "Executive/Senior Level Officials and Managers",
    "First/Mid-Level Officials and Managers",
    "Professionals",
    "Technicians",
    "Sales Workers",
    "Administrative Support Workers",
    "Craft Workers",
    "Operatives",
    "Laborers and Helpers",
    "Service Workers",
    "CURRENT REPORTING YEAR TOTAL",
    "PRIOR REPORTING YEAR TOTAL",
]
SUMMARY_JOBS = JOB_CATEGORIES[-2:]
# Rows of form 5's tables.
TABLE_A_ROWS = [
    "Officials, Administrators, Managers",
    "Principals",
    "Assistant Principals, Teaching",
    "Assistant Principals, Non-Teaching",
    "Elementary Classroom Teachers",
    "Secondary Classroom Teachers",
    "Other Classroom Teachers",
    "Guidance",
    "Psychological",
    "Librarians/Audiovisual Stuff",
    "Consultants and Supervisors of Instruction",
    "Other Professional Stuff",
    "Teacher Aides",
    "Technicians",
    "Administrative Support Workers",
    "Service Workers",
    "Skilled Crafts",
    "Laborers and Helpers",
    "Table A Total",
]
TABLE_B_ROWS = ["Professional Instructional", "All Other", "Table B Total"]
TABLE_C_ROWS = ["Officials, Administrators, Managers", "Principals/Assistant Principals", "Classroom Teachers", "Other Professional Stuff", "Nonprofessional Stuff", "Table C Total"]
FORM5_TABLES = {"table_a": ("FULL-TIME STAFF", TABLE_A_ROWS), "table_b": ("PART-TIME STAFF", TABLE_B_ROWS), "table_c": ("FULL-TIME NEW HIRES", TABLE_C_ROWS)}
#: Rows of the parts in which a form-5 table is recognised, in their order.
SUB_TABLES = {"a1": ("a", 10, 0), "a2": ("a", 1, 10), "a3": ("a", 8, 11), "b": ("b", 3, 0), "c": ("c", 6, 0)}
# Names of the quartiles, and the columns that form 1's rows are summed by.
SIZE_LABELS = ["Small", "Medium", "Large", "Very Large"]
FORM1_KEYS = ["State", "City", "Headquarter State", "Headquarter City", "NAICS", "Year", "JobCategory", "NAICS Name", "zip code", "HQ zip code", "filename"]
