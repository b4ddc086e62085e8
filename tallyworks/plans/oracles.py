"""The catalogue's queries as SQL for DuckDB, over the same parquet tables.

Written from the meaning of each query rather than from its Spark plan: error
logs as unions, co-occurrence as a self-join of positions, TF-IDF over exploded
tokens.
"""

from __future__ import annotations

from tallyworks.functions import stemming as S
from tallyworks.plans import catalogue as C
from tallyworks.sources import schemas

# The allowed grades.
GRADES = ["A", "A-", "B+", "B", "B-", "C+", "C", "D", "F", "S"]

ROSTER = """roster AS (
  SELECT l_orderkey * 10 + l_linenumber AS student_id, c_mktsegment AS program,
    CAST(year(o_orderdate) AS VARCHAR) AS batch, p_brand AS course,
    CASE WHEN l_tax > 0.075 THEN NULL ELSE CAST(l_quantity * 2 AS DECIMAL(5,2)) END AS avg_attendance_percent,
    CASE WHEN l_discount > 0.095 THEN NULL
         ELSE l_returnflag || CAST(CAST(l_quantity AS INT) % 3 AS VARCHAR) END AS obtained_grade
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""

CLEANED = ROSTER + f""", cleaned AS (
  SELECT CASE WHEN student_id % 97 != 0 THEN CAST(student_id AS VARCHAR) END AS student_id,
    program AS program_name, batch, course, CAST(avg_attendance_percent AS DOUBLE) AS attendance,
    obtained_grade AS grade_obtained
  FROM roster WHERE NOT regexp_full_match(course, '{C.BAG_PATTERN}'))"""

ATTENDANCE_TEXT = """att_text AS (
  SELECT CASE WHEN l_suppkey % 83 = 0 THEN '' ELSE 'C' || l_linenumber END AS course,
    CASE WHEN l_partkey % 37 = 0 THEN '' WHEN l_partkey % 41 = 0 THEN NULL
         ELSE 'T' || l_suppkey || ', U' || l_linenumber END AS instructors,
    'n' || l_suppkey AS name_hash,
    CASE WHEN l_suppkey % 50 = 0 THEN 'bad' WHEN l_suppkey % 47 = 0 THEN ''
         ELSE md5(CAST(l_orderkey AS VARCHAR)) || md5(CAST(l_linenumber AS VARCHAR)) END AS email_hash,
    CASE WHEN l_partkey % 101 = 0 THEN '' ELSE 'S' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') END AS member_id_hash,
    CASE WHEN l_partkey % 29 = 0 THEN 'x' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS classes_attended,
    CAST(l_linenumber AS VARCHAR) AS classes_absent,
    CASE WHEN l_suppkey % 43 = 0 THEN '1000.00%'
         ELSE CAST(CAST(l_quantity * 2.04 AS DECIMAL(5,2)) AS VARCHAR) || '%' END AS avg_attendance_percent
  FROM lineitem)"""


def _attendance(text: str = "att_text") -> str:
    return f"""att AS (
  SELECT course, name_hash, email_hash, member_id_hash,
    TRY_CAST(classes_attended AS INT) AS classes_attended, TRY_CAST(classes_absent AS INT) AS classes_absent,
    string_split(replace(instructors, '"', ''), ',') AS instructors,
    TRY_CAST(replace(avg_attendance_percent, '%', '') AS DECIMAL(5,2)) AS avg_attendance_percent
  FROM {text})"""


ATTENDANCE = ATTENDANCE_TEXT + ", " + _attendance()

ENROLLMENT_TEXT = """enr_text AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS serial_no, 'C' || (1 + o_orderkey % 7) AS course, o_orderstatus AS status,
    o_orderpriority AS course_type, 'V' || (o_custkey % 3) AS course_variant, CAST(NULL AS VARCHAR) AS academia_lms,
    'S' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS student_id, 'N' || o_custkey AS student_name,
    'P' || (o_custkey % 7) AS program, CAST(year(o_orderdate) AS VARCHAR) AS batch,
    'T' || (month(o_orderdate) % 3) AS period,
    CASE WHEN o_orderkey % 53 = 0 THEN '' WHEN o_orderkey % 59 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%d/%m/%y') END AS enrollment_date,
    'F' || (o_custkey % 11) || ', G' AS primary_faculty
  FROM orders)"""

SHORT_DATE = """CASE WHEN regexp_full_match(enrollment_date, '[0-9]{2}/[0-9]{2}/[0-9]{2}')
    THEN make_date(2000 + CAST(substr(enrollment_date, 7, 2) AS INT), CAST(substr(enrollment_date, 4, 2) AS INT),
                   CAST(substr(enrollment_date, 1, 2) AS INT)) END"""

ENROLLMENT = ENROLLMENT_TEXT + """, enr AS (
  SELECT * REPLACE (TRY_CAST(serial_no AS INT) AS serial_no,
                    string_split(replace(primary_faculty, '"', ''), ',') AS primary_faculty)
  FROM enr_text)"""

GRADE_ROSTER = """grd AS (
  SELECT 'L1' AS academy_location, 'S' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS student_id,
    l_linestatus AS student_status, 'A' || (l_orderkey % 10) AS admission_id, 'ok' AS admission_status,
    CAST(NULL AS VARCHAR) AS student_name, 'P' || (l_orderkey % 7) AS program_code_name,
    'B' || (l_orderkey % 4) AS batch, 'T1' AS period, 'C' || l_linenumber AS subject_code_name,
    'core' AS course_type, 's' AS section, 'F' AS faculty_name, CAST(l_linenumber AS INT) AS course_credit,
    CASE WHEN l_suppkey % 71 = 0 THEN 'Z' WHEN l_returnflag = 'N' THEN 'b+ ' WHEN l_returnflag = 'R' THEN 'F'
         ELSE l_returnflag END AS obtained_marks_grade,
    'A' AS out_of_marks_grade,
    CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN l_partkey % 67 = 0 THEN 'ABSENT' WHEN l_partkey % 73 = 0 THEN '  '
         WHEN l_linestatus = 'O' THEN ' pass ' ELSE 'FAIL' END AS exam_result
  FROM lineitem)"""

ATT_ROW = """concat_ws(',', course, coalesce(array_to_string(instructors, ';'), ''), name_hash, email_hash,
    member_id_hash, CAST(classes_attended AS VARCHAR), CAST(classes_absent AS VARCHAR),
    CAST(avg_attendance_percent AS VARCHAR))"""
ENR_ROW = (
    "concat_ws(',', CAST(serial_no AS VARCHAR), " + ", ".join(schemas.ENROLLMENT_COLUMNS[1:-1])
    + ", coalesce(array_to_string(primary_faculty, ';'), ''))"
)
GRD_ROW = "concat_ws(',', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in schemas.GRADE_ROSTER_COLUMNS) + ")"

MISSING_LIST = "(instructors IS NULL OR len(instructors) = 0 OR list_contains(instructors, ''))"
BAD_HASH = "(email_hash IS NOT NULL AND NOT regexp_matches(email_hash, '^[a-fA-F0-9]{64}$'))"
BAD_RANGE = "(avg_attendance_percent < 0 OR avg_attendance_percent > 100)"
BAD_DATE = f"(enrollment_date IS NOT NULL AND {SHORT_DATE} IS NULL)"
BAD_EXAM = "(exam_result IS NOT NULL AND upper(trim(exam_result)) NOT IN ('PASS', 'FAIL'))"
BAD_GRADE = (
    "(obtained_marks_grade IS NOT NULL AND upper(trim(obtained_marks_grade)) NOT IN ("
    + ", ".join(f"'{g}'" for g in GRADES) + "))"
)


def _missing(column: str) -> str:
    return f"({column} IS NULL OR trim({column}) = '')"


def _log(source: str, table: str, row: str, key: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{source}' AS source_table, {row} AS original_row, '{column}' AS column_name,"
        f" '{issue}' AS issue_type, {key} AS entity_key FROM {table} WHERE {broken}"
        for column, issue, broken in rules
    )


ATT_LOG = _log("course_attendance", "att", ATT_ROW, "member_id_hash", [
    ("course", "Missing Value", _missing("course")),
    ("instructors", "Missing Value", MISSING_LIST),
    ("email_hash", "Missing Value", _missing("email_hash")),
    ("email_hash", "Invalid Format", BAD_HASH),
    ("member_id_hash", "Missing Value", _missing("member_id_hash")),
    ("avg_attendance_percent", "Out of Range", BAD_RANGE),
])
ENR_LOG = _log("enrollment_data", "enr", ENR_ROW, "student_id", [
    ("enrollment_date", "Missing Value", _missing("enrollment_date")),
    ("enrollment_date", "Invalid Format", BAD_DATE),
])
GRD_LOG = _log("grade_roster_report", "grd", GRD_ROW, "student_id", [
    ("exam_result", "Missing Value", _missing("exam_result")),
    ("exam_result", "Invalid Format", BAD_EXAM),
    ("obtained_marks_grade", "Invalid Format", BAD_GRADE),
])

ALL_SOURCES = ", ".join([ATTENDANCE, ENROLLMENT, GRADE_ROSTER])
LOG = ALL_SOURCES + f", log AS ({ATT_LOG} UNION ALL {ENR_LOG} UNION ALL {GRD_LOG})"


def _valid(name: str, table: str, source: str, key: str, by_text: bool) -> str:
    """The rows whose key is left when the keys of the error log are taken away; rows without a key stay."""
    if by_text:
        bad = (
            f"SELECT k FROM (SELECT DISTINCT {key} AS k FROM {table}) SEMI JOIN"
            f" (SELECT DISTINCT original_row FROM log WHERE source_table = '{source}') l"
            " ON l.original_row LIKE '%' || k || '%'"
        )
    else:
        bad = f"SELECT unnest([entity_key, '']) FROM log WHERE source_table = '{source}'"
    return (
        f"{name} AS (SELECT * FROM {table} WHERE {key} IS NULL"
        f" OR {key} IN (SELECT {key} FROM {table} WHERE {key} IS NOT NULL EXCEPT ({bad})))"
    )


def _fact(att: str, enr: str, grd: str) -> str:
    """Each student and course once, with what the three sources say of it as three lists; the lists are un-nested one
    after another, and a pair for which a source has nothing unfolds to no row."""
    return f"""SELECT student_id, e.student_name, e.program, e.batch, course, e.faculty, e.course_type, e.period,
    e.enrollment_date, a.classes_attended, a.classes_absent, a.avg_attendance_percent,
    g.obtained_grade, g.total_marks, g.exam_result
  FROM (SELECT *, unnest(gs) AS g FROM (SELECT *, unnest(aa) AS a FROM (SELECT *, unnest(es) AS e FROM (
    SELECT student_id, course, list(e) FILTER (e IS NOT NULL) AS es, list(a) FILTER (a IS NOT NULL) AS aa,
      list(g) FILTER (g IS NOT NULL) AS gs
    FROM (
      SELECT student_id, course, {{'student_name': student_name, 'program': program, 'batch': batch,
          'faculty': array_to_string(primary_faculty, ';'), 'course_type': course_type, 'period': period,
          'enrollment_date': CAST({SHORT_DATE} AS VARCHAR)}} AS e, NULL AS a, NULL AS g FROM {enr}
      UNION ALL SELECT member_id_hash, course, NULL, {{'classes_attended': classes_attended, 'classes_absent': classes_absent,
          'avg_attendance_percent': CAST(avg_attendance_percent AS VARCHAR)}}, NULL FROM {att}
      UNION ALL SELECT student_id, subject_code_name, NULL, NULL, {{'obtained_grade': obtained_marks_grade,
          'total_marks': out_of_marks_grade, 'exam_result': exam_result}} FROM {grd})
    WHERE student_id IS NOT NULL AND course IS NOT NULL GROUP BY student_id, course))))"""


def _warehouse(by_text: bool) -> str:
    return (
        f"WITH {LOG}, distinct_grd AS (SELECT DISTINCT * FROM grd), "
        + ", ".join([
            _valid("good_att", "att", "course_attendance", "member_id_hash", by_text),
            _valid("good_enr", "enr", "enrollment_data", "student_id", by_text),
            _valid("good_grd", "distinct_grd", "grade_roster_report", "student_id", by_text),
        ])
        + " " + _fact("good_att", "good_enr", "good_grd")
    )


ATT_OUT = """SELECT course, name_hash, email_hash, member_id_hash, classes_attended, classes_absent,
    coalesce(array_to_string(instructors, ';'), '') AS instructors,
    CAST(avg_attendance_percent AS VARCHAR) AS avg_attendance_percent"""


def _blank(columns: list[str]) -> str:
    return ", ".join(f"coalesce({c}, '') AS {c}" for c in columns)


# --- reports ---------------------------------------------------------------------------------

ATTENDED = "CAST(avg_attendance_percent AS FLOAT)"
AVERAGES = f"""SELECT course, batch, round(avg({ATTENDED}), 2) AS avg_attendance FROM roster
  WHERE avg_attendance_percent IS NOT NULL GROUP BY ALL"""
GRADE_COUNTS = """SELECT course, batch, obtained_grade, count(*) AS grade_count FROM roster
  WHERE obtained_grade IS NOT NULL GROUP BY ALL"""
# The mode is the smallest of the grades that reach the group's highest count.
MODES = f"""SELECT course, batch, min(obtained_grade) AS mode_grade FROM ({GRADE_COUNTS})
  JOIN (SELECT course, batch, max(grade_count) AS grade_count FROM ({GRADE_COUNTS}) GROUP BY ALL)
  USING (course, batch, grade_count) GROUP BY ALL"""
# Average and mode from one grouping: grades as a histogram.
REPORT_1 = f"""WITH {ROSTER}, grouped AS (
  SELECT course, batch, avg({ATTENDED}) AS a, histogram(obtained_grade) FILTER (obtained_grade IS NOT NULL) AS h
  FROM roster WHERE NOT contains(course, '{C.CONTAINS.strip("%")}') GROUP BY ALL)
  SELECT course, batch, round(a, 2) AS avg_attendance,
    list_min(list_filter(map_keys(h), lambda g: h[g] = list_max(map_values(h)))) AS mode_grade
  FROM grouped WHERE a IS NOT NULL AND h IS NOT NULL ORDER BY course, batch"""
# The share below 50 is the mean of a flag.
REPORT_2 = f"""WITH {ROSTER} SELECT course, batch,
    round(avg(CASE WHEN {ATTENDED} < 50 THEN 100::DOUBLE ELSE 0 END), 2) AS percentage_below_50_attendance
  FROM roster WHERE avg_attendance_percent IS NOT NULL AND NOT suffix(course, '{C.ENDS_IN.strip("%")}')
  GROUP BY ALL ORDER BY course, batch"""
# A rank is one more than the number of better courses.
REPORT_3 = f"""WITH {ROSTER}, means AS (SELECT course, batch, avg({ATTENDED}) AS a FROM roster
  WHERE avg_attendance_percent IS NOT NULL AND NOT suffix(course, '{C.ENDS_IN.strip("%")}') GROUP BY ALL),
  ranked AS (SELECT m.course, m.batch, m.a, CAST(1 + count(better.course) AS INT) AS rank FROM means m LEFT JOIN means better
    ON better.batch = m.batch AND (better.a > m.a OR better.a = m.a AND better.course < m.course) GROUP BY ALL)
  SELECT course, batch, round(a, 2) AS avg_attendance, rank FROM ranked WHERE rank <= 3 ORDER BY batch, rank"""

BAG_AVERAGES = "SELECT course, program_name, avg(attendance) AS avg_attendance FROM cleaned GROUP BY ALL"
BAG_COUNTS = """SELECT course, program_name, grade_obtained AS obtained_grade, count(student_id) AS grade_count
  FROM cleaned GROUP BY ALL"""
# No grade counts as the smallest grade.
BAG_MODES = f"""SELECT course, program_name, nullif(min(coalesce(obtained_grade, '')), '') AS mode_grade
  FROM ({BAG_COUNTS}) JOIN (SELECT course, program_name, max(grade_count) AS grade_count FROM ({BAG_COUNTS}) GROUP BY ALL)
  USING (course, program_name, grade_count) GROUP BY ALL"""
BAG_REPORT_1 = f"""SELECT course, program_name, avg_attendance, mode_grade
  FROM ({BAG_AVERAGES}) JOIN ({BAG_MODES}) USING (course, program_name)"""
BAG_REPORT_2 = """SELECT course, program_name, avg(CASE WHEN student_id IS NULL THEN NULL
    WHEN attendance < 50 THEN 100::DOUBLE ELSE 0 END) AS percentage_below_50_attendance
  FROM cleaned GROUP BY ALL"""
BAG_TOP = f"""SELECT m.course, m.program_name, m.avg_attendance AS average_attendance
  FROM ({BAG_AVERAGES}) m LEFT JOIN ({BAG_AVERAGES}) better ON better.program_name = m.program_name
    AND (coalesce(better.avg_attendance, -1) > coalesce(m.avg_attendance, -1)
      OR better.avg_attendance IS NOT DISTINCT FROM m.avg_attendance AND better.course < m.course)
  GROUP BY ALL HAVING count(better.course) < 3"""

# --- text --------------------------------------------------------------------------------------

STOP = "stop AS (SELECT unnest([" + ", ".join(f"'{w}'" for w in C.STOP_WORDS) + "]) AS word)"
LINES = r"""lines AS (SELECT doc_id, CAST(unnest(range(len(ls))) AS INT) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""


def _words(text: str = "lower(text)") -> str:
    return rf"""SELECT word, count(*) AS n FROM (
    SELECT unnest(string_split_regex({text}, '[^\w'']+')) AS word FROM documents) WHERE word != '' GROUP BY word"""


VOCABULARY = f"vocabulary AS (SELECT word FROM ({_words()}) ORDER BY n DESC, word LIMIT {C.TOP_WORDS})"
SLOTS = LINES + r""", slots AS (
  SELECT doc_id, line_no, unnest(range(len(ts))) AS position, unnest(ts) AS token
  FROM (SELECT doc_id, line_no, string_split_regex(line, '\s+') AS ts FROM lines)),
cleaned AS (SELECT doc_id, line_no, position, lower(regexp_replace(token, '[^a-zA-Z]', '', 'g')) AS word FROM slots)"""
GAPS = f"""{SLOTS}, {VOCABULARY},
kept AS (SELECT * FROM cleaned WHERE word IN (SELECT word FROM vocabulary)),
gaps AS (SELECT a.word, b.word AS neighbor, abs(a.position - b.position) AS gap FROM kept a JOIN kept b
  ON a.doc_id = b.doc_id AND a.line_no = b.line_no
  AND abs(a.position - b.position) BETWEEN 1 AND {C.MAX_DISTANCE})"""


def _pairs(distance: int) -> str:
    return f"WITH {GAPS} SELECT word, neighbor, count(*) AS n FROM gaps WHERE gap <= {distance} GROUP BY word, neighbor"


def _stripes(distance: int) -> str:
    return f"""SELECT word, '{{' || string_agg(neighbor || '=' || n, ', ' ORDER BY neighbor) || '}}' AS stripe
  FROM ({_pairs(distance)}) GROUP BY word"""


SWEEP = f"""WITH {GAPS} SELECT CAST(d AS INT) AS d, word, neighbor, count(*) AS n
  FROM gaps JOIN (SELECT unnest(range(1, {C.MAX_DISTANCE + 1})) AS d) ON gap <= d GROUP BY d, word, neighbor"""


def _stems(words: str, name: str) -> str:
    """CTEs that give ``name (token, stem)`` for the words of CTE ``words (token)``."""

    def suffixes(previous: str, table: dict[str, str], measure: str) -> str:
        cases = []
        for suffix, new in sorted(table.items(), key=lambda item: -len(item[0])):
            # only -sion and -tion keep a letter, which belongs to the measured part
            n = 3 if suffix in ("sion", "tion") else len(suffix)
            stem = f"left(w, len(w) - {n})"
            tail = "" if n < len(suffix) else new
            cases.append(
                f"WHEN suffix(w, '{suffix}') THEN CASE WHEN regexp_matches({stem}, '{measure}')"
                f" THEN {stem} || '{tail}' ELSE w END"
            )
        return f"SELECT token, CASE {' '.join(cases)} ELSE w END AS w FROM {previous}"

    def cut(n: int) -> str:
        return f"left(w, len(w) - {n})"

    vowel = f"regexp_matches({{}}, '{S.HAS_VOWEL}')"
    steps = [
        f"SELECT token, token AS w FROM {words} WHERE len(token) > 2",
        f"SELECT token, CASE WHEN suffix(w, 'sses') THEN {cut(2)} WHEN suffix(w, 'ies') THEN {cut(2)}"
        f" WHEN suffix(w, 'ss') THEN w WHEN suffix(w, 's') THEN {cut(1)} ELSE w END AS w FROM @",
        f"SELECT token, CASE WHEN suffix(w, 'eed') THEN CASE WHEN regexp_matches({cut(3)}, '{S.M_OVER_0}')"
        f" THEN {cut(1)} ELSE w END"
        f" WHEN suffix(w, 'ed') AND {vowel.format(cut(2))} THEN {cut(2)}"
        f" WHEN suffix(w, 'ing') AND {vowel.format(cut(3))} THEN {cut(3)} ELSE w END AS w, w AS before FROM @",
        "SELECT token, CASE WHEN w = before OR suffix(before, 'eed') THEN w"
        " WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e'"
        f" WHEN regexp_matches(w, '{S.DOUBLE_END}') THEN {cut(1)}"
        f" WHEN regexp_matches(w, '{S.ENDS_CVC}') THEN w || 'e' ELSE w END AS w FROM @",
        f"SELECT token, CASE WHEN suffix(w, 'y') AND {vowel.format(cut(1))} THEN {cut(1)} || 'i' ELSE w END AS w FROM @",
        suffixes("@", {**S.STEP_2_SUFFIXES, **S.STEP_2_REVISED}, S.M_OVER_0),
        suffixes("@", S.STEP_3_SUFFIXES, S.M_OVER_0),
        suffixes("@", S.STEP_4_SUFFIXES, S.M_OVER_1),
        f"SELECT token, CASE WHEN suffix(w, 'e') AND (regexp_matches({cut(1)}, '{S.M_OVER_1}')"
        f" OR (regexp_matches({cut(1)}, '{S.M_IS_1}') AND NOT regexp_matches({cut(1)}, '{S.ENDS_CVC}')))"
        f" THEN {cut(1)} ELSE w END AS w FROM @",
        f"SELECT token, CASE WHEN suffix(w, 'll') AND regexp_matches(w, '{S.M_OVER_1}') THEN {cut(1)}"
        " ELSE w END AS w FROM @",
    ]
    ctes = []
    for i, step in enumerate(steps):
        ctes.append(f"{name}_{i} AS ({step.replace('@', f'{name}_{i - 1}')})")
    ctes.append(
        f"{name} AS (SELECT token, w AS stem FROM {name}_{len(steps) - 1}"
        f" UNION ALL SELECT token, token FROM {words} WHERE len(token) <= 2)"
    )
    return ",\n".join(ctes)


def _letter_digit_tokens(table: str, text: str, keys: str) -> str:
    return rf"""SELECT DISTINCT {keys}, token FROM (
    SELECT {keys}, unnest(string_split_regex(regexp_replace(lower({text}), '[^a-zA-Z0-9\s]', '', 'g'), '\s+')) AS token
    FROM {table}) WHERE token != ''"""


def _frequencies(table: str = "documents", text: str = "text", keys: str = "doc_id") -> str:
    """CTEs up to ``df (term, df)``."""
    return f"""tokens AS ({_letter_digit_tokens(table, text, keys)}),
vocab AS (SELECT DISTINCT token FROM tokens),
{_stems('vocab', 'stems')},
{STOP},
terms AS (SELECT DISTINCT {keys}, stem AS term FROM tokens JOIN stems USING (token)),
df AS (SELECT term, count(*) AS df FROM terms WHERE term != '' AND term NOT IN (SELECT word FROM stop) GROUP BY term)"""


TOP_DF = f"{_frequencies()}, top AS (SELECT term, df FROM df ORDER BY df DESC, term LIMIT {C.TOP_TERMS})"
N_DOCS = "(SELECT count(*) FROM documents)"
QUOTIENT = f"({N_DOCS} // (df + 1))"
IDF = f"CASE WHEN {QUOTIENT} = 0 THEN '-inf'::DOUBLE ELSE ln({QUOTIENT}) END"
REAL_IDF = f"ln({N_DOCS}::DOUBLE / (df + 1))"
TF = TOP_DF + r""", raw AS (SELECT doc_id, token, count(*) AS n FROM (
    SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS token FROM documents) GROUP BY doc_id, token),
raw_vocab AS (SELECT DISTINCT token FROM raw),
""" + _stems("raw_vocab", "raw_stems") + """,
tf AS (SELECT doc_id, term, df, CAST(sum(n) AS BIGINT) AS tf
  FROM raw JOIN raw_stems USING (token) JOIN top ON stem = term GROUP BY doc_id, term, df)"""
CLEAN_TF = TOP_DF + r""", raw AS (SELECT doc_id, token, count(*) AS n FROM (
    SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(text), '[^a-zA-Z0-9\s]', '', 'g'), '\s+')) AS token
    FROM documents) GROUP BY doc_id, token),
tf AS (SELECT doc_id, term, df, CAST(sum(n) AS BIGINT) AS tf
  FROM raw JOIN stems USING (token) JOIN top ON stem = term GROUP BY doc_id, term, df)"""


def oracles() -> dict[str, str]:
    sql = {
        # reading and writing
        "load_attendance": f"""WITH {ATTENDANCE_TEXT}, blank AS (SELECT {_blank(schemas.ATTENDANCE_COLUMNS)}
            FROM att_text), {_attendance('blank')} {ATT_OUT} FROM att""",
        "load_enrollment": f"""WITH {ENROLLMENT} SELECT * REPLACE ('' AS academia_lms,
            array_to_string(primary_faculty, ';') AS primary_faculty) FROM enr""",
        "load_grade_roster": f"WITH {GRADE_ROSTER} SELECT * FROM grd",
        "load_export": f"""WITH {ALL_SOURCES} SELECT student_id, student_name, program AS program_name, batch, course,
            faculty AS instructor, course_type, period AS term, enrollment_date, classes_attended,
            classes_absent AS classes_missed,
            round(CAST(CAST(avg_attendance_percent AS FLOAT) AS DOUBLE), 2) AS attendance,
            obtained_grade AS grade_obtained, total_marks AS max_grade, exam_result AS status
            FROM ({_fact('att', 'enr', 'grd')})""",
        "corpus_lines": f"WITH {LINES} SELECT * FROM lines",
        "frequent_word_list": f"WITH {VOCABULARY} SELECT word FROM vocabulary",
        "document_frequency_list": f"WITH {TOP_DF} SELECT term, CAST(df AS INT) AS df FROM top",
        "orc_roundtrip": f"""WITH {ROSTER} SELECT * REPLACE (CAST(avg_attendance_percent AS VARCHAR)
            AS avg_attendance_percent) FROM roster""",
        "stripes_text": f"SELECT word || chr(9) || stripe AS value FROM ({_stripes(1)})",
        "pairs_text": f"SELECT word || ',' || neighbor || chr(9) || n AS value FROM ({_pairs(1)})",
        # projections and scalar expressions
        "project_rename": f"WITH {ROSTER} SELECT course AS subject, student_id, obtained_grade AS grade FROM roster",
        "split_to_array": f"""WITH {ATTENDANCE} SELECT name_hash, array_to_string(instructors, '|') AS items,
            len(instructors) AS n_items FROM att""",
        "percent_to_decimal": f"""WITH {ATTENDANCE_TEXT} SELECT member_id_hash, avg_attendance_percent,
            CAST(TRY_CAST(replace(avg_attendance_percent, '%', '') AS DECIMAL(5,2)) AS VARCHAR) AS percent
            FROM att_text""",
        "row_to_text": f"WITH {ATTENDANCE} SELECT {ATT_ROW} AS original_row FROM att",
        "parse_short_date": f"""WITH {ENROLLMENT_TEXT} SELECT student_id, enrollment_date,
            CAST({SHORT_DATE} AS VARCHAR) AS parsed FROM enr_text""",
        "tokenize_words": rf"""WITH {LINES} SELECT doc_id, line_no, array_to_string(ws, '|') AS words,
            len(ws) AS n_words FROM (SELECT doc_id, line_no, list_filter(
              string_split_regex(lower(line), '[^\w'']+'), lambda w: w != '') AS ws FROM lines)""",
        "tokenize_positions": f"WITH {SLOTS} SELECT doc_id, line_no, CAST(position AS INT) AS position, token FROM slots",
        "clean_letters": r"""SELECT lower(regexp_replace(token, '[^a-zA-Z]', '', 'g')) AS letters, count(*) AS n
            FROM (SELECT unnest(string_split_regex(text, '\s+')) AS token FROM documents) GROUP BY 1""",
        "letter_slots": f"""WITH {SLOTS} SELECT doc_id, line_no, string_agg(word, '|' ORDER BY position) AS slots
            FROM cleaned GROUP BY doc_id, line_no""",
        "stem_vocabulary": f"""WITH vocab AS (SELECT DISTINCT token FROM (
            {_letter_digit_tokens('documents', 'text', 'doc_id')})), {_stems('vocab', 'stems')}
            SELECT token, stem FROM stems""",
        "idf": f"WITH {TOP_DF} SELECT term, df, round({IDF}, 9) AS idf, round({REAL_IDF}, 9) AS real_idf FROM top",
        # data quality
        "dq_missing_text": f"""WITH {ATTENDANCE} SELECT {ATT_ROW} AS original_row FROM att
            WHERE {_missing('member_id_hash')}""",
        "dq_array_missing": f"WITH {ATTENDANCE} SELECT {ATT_ROW} AS original_row FROM att WHERE {MISSING_LIST}",
        "dq_regex_format": f"WITH {ATTENDANCE} SELECT {ATT_ROW} AS original_row FROM att WHERE {BAD_HASH}",
        "dq_out_of_range": f"WITH {ATTENDANCE} SELECT {ATT_ROW} AS original_row FROM att WHERE {BAD_RANGE}",
        "dq_not_in_list": f"WITH {GRADE_ROSTER} SELECT {GRD_ROW} AS original_row FROM grd WHERE {BAD_GRADE}",
        "dq_date_format": f"WITH {ENROLLMENT} SELECT {ENR_ROW} AS original_row FROM enr WHERE {BAD_DATE}",
        "dq_union_rules": f"WITH {ATTENDANCE} SELECT * EXCLUDE (entity_key) FROM ({ATT_LOG})",
        "dq_error_records": f"WITH {LOG} SELECT * EXCLUDE (entity_key) FROM log",
        # quarantine and warehouse
        "anti_join_key": f"""WITH {LOG}, {_valid('good', 'att', 'course_attendance', 'member_id_hash', False)}
            {ATT_OUT} FROM good""",
        "anti_join_like": f"""WITH {LOG}, {_valid('good', 'att', 'course_attendance', 'member_id_hash', True)}
            {ATT_OUT} FROM good""",
        "distinct_rows": f"WITH {GRADE_ROSTER} SELECT DISTINCT * FROM grd",
        "warehouse_join": f"""WITH {ALL_SOURCES}, distinct_grd AS (SELECT DISTINCT * FROM grd)
            {_fact('att', 'enr', 'distinct_grd')}""",
        "warehouse_build": _warehouse(False),
        "warehouse_build_like": _warehouse(True),
        # reports
        "roster_avg": f"WITH {ROSTER} {AVERAGES}",
        "roster_grade_counts": f"WITH {ROSTER} {GRADE_COUNTS}",
        "roster_mode": f"WITH {ROSTER} {MODES}",
        "roster_avg_mode": REPORT_1,
        "roster_pct_below": REPORT_2,
        "roster_top3": REPORT_3,
        "pig_filter_matches": f"WITH {CLEANED} SELECT * FROM cleaned",
        "pig_avg": f"WITH {CLEANED} {BAG_AVERAGES}",
        "pig_grade_counts": f"WITH {CLEANED} {BAG_COUNTS}",
        "pig_mode": f"WITH {CLEANED} {BAG_MODES}",
        "pig_avg_mode": f"WITH {CLEANED} {BAG_REPORT_1}",
        "pig_pct_below": f"WITH {CLEANED} {BAG_REPORT_2} ORDER BY course, program_name",
        "pig_top3": f"WITH {CLEANED} {BAG_TOP}",
        "pig_flatten_cross": f"""WITH {CLEANED}, best AS ({BAG_TOP}) SELECT a.course, b.program_name,
            c.average_attendance FROM best a JOIN best b ON a.program_name = b.program_name
            JOIN best c ON a.program_name = c.program_name""",
        "group_bag": f"""WITH {CLEANED} SELECT '[' || course || ']' AS course, '[' || program_name || ']' AS program_name,
            '[' || coalesce(mode_grade, 'null') || ']' AS mode_grade FROM ({BAG_MODES})""",
        "flatten_bag": f"WITH {CLEANED} {BAG_MODES}",
        "pig_all_reports": f"""WITH {CLEANED}
            SELECT 1 AS report, course, program_name, avg_attendance AS measure, mode_grade AS grade
            FROM ({BAG_REPORT_1}) UNION ALL SELECT 2, *, NULL FROM ({BAG_REPORT_2})
            UNION ALL SELECT 3, *, NULL FROM ({BAG_TOP})""",
        # word counts
        "word_count": _words(),
        "word_count_case_sensitive": _words("text"),
        "stopword_anti_join": f"WITH {STOP} SELECT * FROM ({_words()}) WHERE word NOT IN (SELECT word FROM stop)",
        "top_words": f"""WITH {STOP} SELECT * FROM ({_words()}) WHERE word NOT IN (SELECT word FROM stop)
            ORDER BY n DESC, word LIMIT {C.TOP_WORDS}""",
        "vocab_semi_join": f"""WITH {SLOTS}, {VOCABULARY} SELECT word, count(*) AS n FROM cleaned
            WHERE word IN (SELECT word FROM vocabulary) GROUP BY word""",
        # co-occurrence
        "cooc_pairs": _pairs(1),
        "cooc_stripes": _stripes(1),
        "cooc_pairs_line_agg": _pairs(C.MAX_DISTANCE),
        "cooc_stripes_line_agg": _stripes(C.MAX_DISTANCE),
        "cooc_stripes_flattened": _pairs(1),
        "cooc_distance_sweep": SWEEP,
        "cooc_distance_sweep_line_agg": SWEEP,
        # document frequency and TF-IDF
        "document_frequency": f"WITH {_frequencies()} SELECT * FROM df",
        "document_frequency_from_lines": f"WITH {_frequencies()} SELECT * FROM df",
        "line_frequency": f"WITH {LINES}, {_frequencies('lines', 'line', 'doc_id, line_no')} SELECT * FROM df",
        "top_terms_by_df": f"WITH {TOP_DF} SELECT * FROM top ORDER BY df DESC, term",
        "term_frequency": f"WITH {TF} SELECT doc_id, term, tf FROM tf",
        "tfidf": f"WITH {TF} SELECT doc_id, term, round(tf * {IDF}, 6) AS tfidf FROM tf",
        "tfidf_normalized": f"WITH {CLEAN_TF} SELECT doc_id, term, round(tf * {REAL_IDF}, 6) AS tfidf FROM tf",
    }
    for d in range(1, C.MAX_DISTANCE + 1):
        sql[f"cooc_pairs_d{d}"] = _pairs(d)
        sql[f"cooc_stripes_d{d}"] = _stripes(d)
    sql["warehouse_partitioned"] = sql["orc_roundtrip"]
    sql["roster_avg_mode_joined"] = REPORT_1
    sql["roster_avg_mode_partitioned"] = REPORT_1
    sql["roster_pct_below_partitioned"] = REPORT_2
    sql["roster_top3_partitioned"] = REPORT_3
    return sql
