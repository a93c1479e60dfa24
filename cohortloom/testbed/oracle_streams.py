"""DuckDB statements for the stream, section and report queries.

The source views of ``analogue`` are restated as CTEs, then each stream is
written out as plain joins over them, so nothing of the Spark plans is shared.
"""

from __future__ import annotations

import re

from cohortloom.testbed import analogue as a

_SITES = "(VALUES (0), (1), (2), (3), (4)) AS r(site)"

SOURCES: dict[str, str] = {
    "persons": """
        SELECT c.*, n.n_regionkey AS site
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "visits": """
        SELECT o.*, p.site FROM orders o JOIN persons p ON o.o_custkey = p.c_custkey""",
    "lines": """
        SELECT * FROM lineitem JOIN visits ON l_orderkey = o_orderkey""",
    "readings": """
        SELECT e.*, p.site,
               CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                               WHEN 'signup' THEN 4 ELSE 5 END AS kind
        FROM events e JOIN persons p ON e.user_id = p.c_custkey""",
    "suppliers": """
        SELECT s.*, n.n_regionkey AS site
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "exam_codes": f"""
        SELECT v.id, v.result, r.site
        FROM (VALUES {a.sql_values(a.EXAM_CODES)}) AS v(id, result), {_SITES}""",
    "morphs": f"""
        SELECT v.id, v.morphology, v.snomed, r.site
        FROM (VALUES {a.sql_values(a.MORPHOLOGIES)}) AS v(id, morphology, snomed), {_SITES}""",
    "factor_types": f"""
        SELECT * FROM (VALUES {a.sql_values(a.FACTOR_TYPES)}) AS v(id, kind_name, category)""",
    "lab_tests": f"""
        SELECT * FROM (VALUES {a.sql_values(a.LAB_TESTS)}) AS v(id, test_name)""",
    "procedures": """
        SELECT site, o_custkey AS person_id, l_orderkey AS visit, o_orderdate AS event_ts,
               nullif(l_returnflag, 'N') AS comments, p_name, p_type
        FROM lines JOIN part ON l_partkey = p_partkey""",
    "diagnoses": """
        SELECT site, o_custkey AS person_id, l_suppkey AS icd10, l_linenumber AS icd9,
               CASE WHEN l_returnflag = 'A' THEN l_orderkey ELSE -1 - l_orderkey END AS visit
        FROM lines""",
    "exams": """
        SELECT l.site, l.l_orderkey AS visit, c.result
        FROM lines l JOIN visits v ON v.o_orderkey = l.l_orderkey AND v.site = l.site
             JOIN exam_codes c ON c.id = l.l_linenumber AND c.site = l.site
        WHERE (l.l_returnflag IN ('A', 'R'))
          AND v.o_orderdate > TIMESTAMP '1998-08-01 10:00:00'""",
    "coded": """
        SELECT p.*, 'ICD10 ' || s.s_name AS code1, 'ICD9 ' || n.n_name AS code2
        FROM procedures p
        LEFT JOIN diagnoses d USING (site, person_id, visit)
        LEFT JOIN suppliers s ON s.s_suppkey = d.icd10 AND s.site = d.site
        LEFT JOIN nation n ON n.n_nationkey = d.icd9 AND n.n_regionkey = d.site""",
    "radiology_rows": """
        SELECT c.site, c.person_id, c.event_ts, 'CPT ' || c.p_name AS label, e.result AS detail,
               c.code1, c.code2,
               CASE WHEN e.result IN ('BI-RADS CATEGORY 0', 'BI-RADS CATEGORY 4',
                                      'MINOR ABNORMALITY', 'Outside Report')
                    THEN 'Y' ELSE 'N' END AS flag,
               NULL::VARCHAR AS rank_key, c.event_ts AS rank_ts
        FROM coded c JOIN exams e ON e.visit = c.visit AND e.site = c.site
        WHERE p_type = 'PROMO'
           OR (p_type IN ('ECONOMY', 'SMALL')
               AND (p_name LIKE '%ring' OR p_name LIKE 'blue%' OR p_name LIKE '%anvil%'))""",
    "procedure_rows": """
        SELECT site, person_id, event_ts, 'CPT ' || p_name AS label, comments AS detail, code1, code2,
               NULL::VARCHAR AS flag, NULL::VARCHAR AS rank_key, event_ts AS rank_ts
        FROM coded
        WHERE p_type = 'LARGE'
           OR (p_type IN ('MEDIUM', 'SMALL')
               AND (p_name LIKE '%widget%' OR p_name LIKE 'hot %' OR p_name LIKE '%rod'))""",
    "factors": """
        SELECT e.site, e.user_id AS person_id, e.ts AS event_ts, nullif(e.props, '{"k": 7}') AS detail,
               t.kind_name, t.category
        FROM readings e JOIN factor_types t ON t.id = e.kind + CASE WHEN e.value >= 40 THEN 5 ELSE 0 END""",
    "breast_factor_rows": """
        SELECT site, person_id, event_ts, 'HFT ' || kind_name AS label, detail,
               'HFC ' || category AS code1, NULL::VARCHAR AS code2,
               CASE WHEN kind_name = 'HFT WH OUTSIDE ABNL MAMMOGRAM' THEN 'Y'
                    WHEN kind_name = 'HFT WH BILATERAL MASTECTOMY' THEN 'MASTECTOMY' END AS flag,
               NULL::VARCHAR AS rank_key, event_ts AS rank_ts
        FROM factors
        WHERE category IN ('BREAST CANCER', 'WH MAMMOGRAM')
           OR (category IN ('CANCER SCREENING', 'OUTSIDE RESULTS', 'REMINDER FACTORS')
               AND regexp_matches(kind_name, 'MAMMO|BREAST|MAST'))""",
    "cervical_factor_rows": """
        SELECT site, person_id, event_ts, 'HFT ' || kind_name AS label, detail,
               'HFC ' || category AS code1, NULL::VARCHAR AS code2,
               CASE kind_name WHEN 'OUTSIDE CERVICAL HPV TESTING POSITIVE' THEN 'HPV POS'
                              WHEN 'WH HYSTERECTOMY W/CERVIX REMOVED' THEN 'HYSTERECTOMY'
                              WHEN 'WH PAP SMEAR SCREEN FREQ - 6M' THEN 'Y' END AS flag,
               NULL::VARCHAR AS rank_key, event_ts AS rank_ts
        FROM factors
        WHERE category IN ('PAP RESULTS', 'VA-HPV', 'WH PAP SMEAR', 'HFC MATERNITY CARE')
           OR (category IN ('OUTSIDE RESULTS', 'PROCEDURES', 'REMINDER FACTORS')
               AND regexp_matches(kind_name, 'CERVI|GYN|HPV|HYST|PAP|VAG'))""",
    "lab_rows": """
        SELECT e.site, e.user_id AS person_id, e.ts AS event_ts, 'LAB ' || t.test_name AS label,
               CASE WHEN value >= 60 THEN 'POSITIVE' WHEN value >= 40 THEN 'POS'
                    WHEN value >= 1 THEN props END AS detail,
               NULL::VARCHAR AS code1, NULL::VARCHAR AS code2,
               CASE WHEN value >= 40 THEN 'HPV POS' END AS flag,
               t.test_name AS rank_key,
               CASE WHEN value >= 40 THEN e.ts + INTERVAL 10 DAY ELSE e.ts END AS rank_ts
        FROM readings e JOIN lab_tests t ON t.id = e.kind
        WHERE t.test_name LIKE '%HPV%' OR t.test_name LIKE '%PREGNANCY%'""",
    "cyto": """
        SELECT v.site, v.o_custkey AS person_id,
               CASE WHEN v.o_orderstatus = 'P' THEN v.o_orderdate + INTERVAL 2 DAY
                    ELSE v.o_orderdate END AS event_ts,
               s.sample || ' ' || s.p_name AS label, m.morphology AS detail,
               'SNOMED ' || s.p_brand AS code1, 'Morph ' || m.snomed AS code2,
               CASE WHEN m.morphology IN ('DYSPLASIA', 'CARCINOMA') THEN 'Y' END AS flag,
               s.sample AS rank_key, s.p_name AS topography,
               CASE WHEN v.o_orderstatus <> 'P' THEN v.o_orderdate END AS rank_ts
        FROM visits v
        LEFT JOIN (SELECT CASE WHEN l_returnflag = 'R' THEN l_orderkey ELSE -1 - l_orderkey END AS l_orderkey,
                          site, l_linenumber FROM lines) b
               ON b.l_orderkey = v.o_orderkey AND b.site = v.site
        LEFT JOIN morphs m ON m.id = b.l_linenumber AND m.site = b.site
        JOIN (SELECT CASE WHEN l_linestatus = 'O' THEN l_orderkey ELSE -1 - l_orderkey END AS l_orderkey,
                     site, p_name, p_brand,
                     CASE l_returnflag WHEN 'A' THEN 'ASPIRATE' WHEN 'R' THEN 'SMEAR' END AS sample
              FROM lines JOIN part ON p_partkey = l_partkey) s
               ON s.l_orderkey = v.o_orderkey AND s.site = v.site""",
    "breast_cyto_rows": "SELECT * EXCLUDE (topography) FROM cyto WHERE topography LIKE '%ring%'",
    "cervical_cyto_rows": """
        SELECT * EXCLUDE (topography) FROM cyto
        WHERE topography IN ('red rod', 'hot anvil', 'cold bolt')
           OR topography LIKE 'blue%' OR topography LIKE '%gear'""",
    "surg": """
        SELECT v.site, v.o_custkey AS person_id,
               v.o_orderdate + CASE WHEN v.o_orderstatus = 'P' THEN INTERVAL 1 DAY
                                    ELSE INTERVAL 0 DAY END AS event_ts,
               nullif(v.o_orderpriority, '5-LOW') || ' ' || s.p_name AS label,
               m.field AS detail, 'SNOMED ' || f.s_name AS code1,
               NULL::VARCHAR AS code2, NULL::VARCHAR AS flag, s.p_name AS rank_key,
               CASE WHEN v.o_orderstatus <> 'P' THEN v.o_orderdate END AS rank_ts
        FROM visits v
        LEFT JOIN (SELECT CASE WHEN l_returnflag <> 'A' THEN l_orderkey ELSE -1 - l_orderkey END AS l_orderkey,
                          site, p_name FROM lines JOIN part ON p_partkey = l_partkey) s
               ON s.l_orderkey = v.o_orderkey AND s.site = v.site
        LEFT JOIN (SELECT CASE WHEN l_linestatus = 'F' THEN l_orderkey ELSE -1 - l_orderkey END AS l_orderkey,
                          site, l_suppkey, 'FIELD ' || l_linenumber AS field FROM lines) m
               ON m.l_orderkey = v.o_orderkey AND m.site = v.site
        LEFT JOIN suppliers f ON f.s_suppkey = m.l_suppkey AND f.site = m.site""",
    "breast_surg_rows": """
        SELECT * FROM surg WHERE rank_key LIKE '%plate%' OR rank_key LIKE '%hot%'""",
    "cervical_surg_rows": """
        SELECT * FROM surg
        WHERE rank_key LIKE '%widget%' OR rank_key LIKE '%anvil%' OR rank_key LIKE 'red%'""",
}

_TIES = ", ".join(
    f"{c} ASC NULLS FIRST" for c in ["event_ts", "label", "detail", "code1", "code2", "flag"]
)


def _ranked(rows: str, newest_first: bool = True) -> str:
    time = "rank_ts DESC NULLS LAST" if newest_first else "rank_ts ASC NULLS FIRST"
    return f"""
        SELECT site, person_id, event_ts, label, detail, code1, code2, flag,
               row_number() OVER (PARTITION BY site, person_id, rank_key
                                  ORDER BY {time}, {_TIES}) AS recency
        FROM {rows}"""


SOURCES |= {
    "breast_radiology": _ranked("radiology_rows"),
    "breast_observation": _ranked("breast_factor_rows"),
    "breast_cytology": _ranked("breast_cyto_rows"),
    "breast_surgical": _ranked("breast_surg_rows", newest_first=False),
    "cervical_procedure": _ranked("procedure_rows"),
    "cervical_observation": _ranked("cervical_factor_rows"),
    "cervical_lab": _ranked("lab_rows"),
    "cervical_cytology": _ranked("cervical_cyto_rows"),
    "cervical_surgical": _ranked("cervical_surg_rows", newest_first=False),
    "breast_section": """
        SELECT * FROM breast_radiology UNION SELECT * FROM breast_observation
        UNION SELECT * FROM breast_cytology UNION SELECT * FROM breast_surgical""",
    "cervical_section": """
        SELECT * FROM cervical_observation UNION SELECT * FROM cervical_procedure
        UNION SELECT * FROM cervical_lab UNION SELECT * FROM cervical_cytology
        UNION SELECT * FROM cervical_surgical""",
    "all_events": "SELECT * FROM breast_section UNION SELECT * FROM cervical_section",
    "report_rows": """
        SELECT e.site, p.name AS person_name, p.c_mktsegment || '-' || p.c_custkey AS person_national_id,
               CAST(30 + floor(p.c_acctbal / 200) - (2001 - year(e.event_ts)) AS INTEGER) AS age_at_event,
               CAST(e.event_ts AS DATE) AS event_date, e.label, e.detail, e.code1, e.code2, e.flag,
               e.recency
        FROM all_events e
        JOIN (SELECT *, CASE WHEN c_acctbal <= 9000 THEN 'Person ' || (c_custkey // 10)
                             WHEN c_acctbal <= 9500 THEN 'ZZ' || c_name END AS name
              FROM persons) p ON p.c_custkey = e.person_id AND p.site = e.site
        JOIN visits o ON o.o_custkey = p.c_custkey AND o.site = p.site
        WHERE p.name NOT LIKE 'ZZ%'
          AND p.c_mktsegment NOT IN ('AUTOMOBILE', 'MACHINERY')
          AND p.c_acctbal >= 0 AND p.c_acctbal < 8500
          AND o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT'
          AND e.label NOT LIKE '%ORDER%'""",
}


_ENROLLED = """JOIN visits o ON o.o_custkey = p.c_custkey AND o.site = p.site"""
_WHO = "o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT'"


def _report_of(events: str, enrolled: str, more: str = "TRUE") -> str:
    """The report's rows from other events, other enrolled persons, and a further condition."""
    text = SOURCES["report_rows"].replace("all_events e", f"{events} e").replace("e.recency", "1 AS recency")
    return text.replace(_ENROLLED, f"JOIN {enrolled} o ON o.o_custkey = p.c_custkey AND o.site = p.site").replace(_WHO, more)


_HELD = f"CASE WHEN {_WHO.replace('o.', '')} THEN 1 ELSE 0 END AS held"
_STATE = "flag IN ('MASTECTOMY', 'HYSTERECTOMY')"
SOURCES |= {
    "coded_as_of": """
        SELECT p.*, 'ICD10 ' || CASE
                   WHEN s.s_suppkey % 2 = 0 AND CAST(p.event_ts AS DATE) >= DATE '1999-01-01' THEN s.s_name || ' II'
                   WHEN CAST(p.event_ts AS DATE) >= DATE '1996-06-01' THEN s.s_name END AS code1,
               'ICD9 ' || n.n_name AS code2
        FROM procedures p
        LEFT JOIN diagnoses d USING (site, person_id, visit)
        LEFT JOIN suppliers s ON s.s_suppkey = d.icd10 AND s.site = d.site
        LEFT JOIN nation n ON n.n_nationkey = d.icd9 AND n.n_regionkey = d.site""",
    "as_of_rows": SOURCES["procedure_rows"].replace("FROM coded", "FROM coded_as_of"),
    "procedure_as_of": _ranked("as_of_rows"),
    "enrolled_newest": f"""
        SELECT o_custkey, site FROM (
            SELECT o_custkey, site, held,
                   row_number() OVER (PARTITION BY o_custkey, site ORDER BY o_orderdate DESC, held DESC) AS nth
            FROM (SELECT *, {_HELD} FROM visits))
        WHERE nth = 1 AND held = 1""",
    "old_and_new_factors": """
        SELECT 'breast' AS section, * FROM breast_factor_rows
        UNION ALL SELECT 'cervical' AS section, * FROM cervical_factor_rows""",
    "state_rows": f"""
        SELECT section, site, person_id, event_ts, label, detail, code1, code2, flag FROM (
            SELECT *, row_number() OVER (PARTITION BY section, site, person_id, flag
                                         ORDER BY event_ts DESC NULLS LAST, label DESC NULLS LAST,
                                                  detail DESC NULLS LAST, code1 DESC NULLS LAST) AS nth
            FROM old_and_new_factors WHERE {_STATE})
        WHERE nth = 1""",
    "recent_rows": f"""
        SELECT site, person_id, event_ts, label, detail, code1, code2, flag FROM old_and_new_factors
        WHERE event_ts > TIMESTAMP '{a.RECENT}' AND (flag IS NULL OR NOT {_STATE})""",
    "state_events": " UNION ALL ".join(
        f"SELECT site, person_id, event_ts, label, detail, code1, code2, flag FROM {rows}"
        for rows in (
            "radiology_rows", "procedure_rows", "lab_rows", "breast_cyto_rows", "cervical_cyto_rows",
            "breast_surg_rows", "cervical_surg_rows", "recent_rows", "state_rows",
        )
    ),
    "addresses": """
        SELECT o_custkey, site, o_orderdate - INTERVAL 2 YEAR AS changed,
               CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 0 ELSE 1 END AS inside FROM visits""",
    "moved_away": f"""
        SELECT o_custkey, site FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey, site ORDER BY changed DESC, inside DESC) AS nth
            FROM addresses)
        WHERE nth = 1 AND inside = 0 AND changed < TIMESTAMP '{a.AS_OF}' - INTERVAL 2 YEAR""",
}
SOURCES |= {
    "report_newest": _report_of("all_events", "enrolled_newest"),
    "report_in_region": _report_of(
        "state_events",
        "visits",
        f"{_WHO} AND NOT EXISTS (SELECT 1 FROM moved_away m WHERE m.o_custkey = p.c_custkey AND m.site = p.site)",
    ),
}


def statement(select: str) -> str:
    """``select`` preceded by the CTEs it needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in SOURCES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(SOURCES[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    ctes = ",\n".join(f"{name} AS ({SOURCES[name]})" for name in needed)
    return f"WITH {ctes}\n{select}" if ctes else select


def _both(stream: str) -> str:
    return f"""SELECT 'breast' AS section, * FROM breast_{stream}
        UNION ALL SELECT 'cervical' AS section, * FROM cervical_{stream}"""


_REPORT = (
    "site, person_name, person_national_id, age_at_event, event_date, label, detail, code1, code2, flag"
)
_STORED = """site AS Sta3n, person_name AS PatientName, person_national_id AS PatientSSN,
    age_at_event AS AgeAtEvent, event_date AS EventDate, label AS ProcedureName, detail AS Diagnosis,
    code1 AS Code1, code2 AS Code2, flag AS Abnormal"""
_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST" for c in ["recency", *_REPORT.split(", ")]
)

STREAMS: dict[str, str] = {
    "stream_radiology": "SELECT 'breast' AS section, * FROM breast_radiology",
    "stream_procedure": "SELECT 'cervical' AS section, * FROM cervical_procedure",
    "stream_observation": _both("observation"),
    "stream_lab": "SELECT 'cervical' AS section, * FROM cervical_lab",
    "stream_cytology": _both("cytology"),
    "stream_surgical": _both("surgical"),
    "section_breast": "SELECT * FROM breast_section",
    "section_cervical": "SELECT * FROM cervical_section",
    "section_union": "SELECT * FROM all_events",
    "report_eligible_events": f"SELECT DISTINCT {_REPORT} FROM report_rows",
    "report_ordered": f"""SELECT DISTINCT {_REPORT} FROM report_rows
        ORDER BY person_name ASC NULLS FIRST, event_date DESC NULLS LAST""",
    "report_latest_only": f"SELECT DISTINCT {_REPORT} FROM report_rows WHERE recency = 1",
    "report_with_ranks": f"""SELECT DISTINCT {_REPORT}, recency,
        row_number() OVER (PARTITION BY site, person_name ORDER BY {_ORDER}) AS person_rank
        FROM report_rows""",
    "stream_described_as_of": "SELECT 'cervical' AS section, * FROM procedure_as_of",
    "stream_states": """SELECT section, site, person_id, event_ts, label, detail, code1, code2, flag,
        CAST(1 AS BIGINT) AS recency FROM state_rows""",
    "report_newest_enrollment": f"SELECT DISTINCT {_REPORT} FROM report_newest",
    "report_states_in_region": f"SELECT DISTINCT {_REPORT} FROM report_in_region",
    "report_nightly": f"SELECT DISTINCT {_REPORT} FROM report_rows",
    "report_one_site": f"SELECT DISTINCT {_REPORT} FROM report_rows WHERE site = 2",
    "sink_replace_read": f"SELECT DISTINCT {_STORED} FROM report_rows",
    "sink_replace_site": f"SELECT DISTINCT {_STORED} FROM report_rows",
}


def oracle() -> dict[str, str]:
    return {name: statement(select) for name, select in STREAMS.items()}
