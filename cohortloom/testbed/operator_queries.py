"""One query per operator, each with its DuckDB statement beside it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import expressions as x
from cohortloom.functions import predicates as p
from cohortloom.operators import ranking, unions
from cohortloom.plans import report as plan
from cohortloom.plans import streams
from cohortloom.sources.loader import Tables, site_dimension
from cohortloom.spec import CodeSet, FlagRule, TextSet
from cohortloom.testbed import analogue
from cohortloom.testbed.oracle_streams import statement
from cohortloom.testbed.stream_queries import inputs


@dataclass(frozen=True)
class Entry:
    query: Callable[[SparkSession, str], DataFrame]
    sql: str


ENTRIES: dict[str, Entry] = {}


def entry(sql: str):
    """Register the decorated query under its name, with its oracle."""

    def register(query):
        ENTRIES[query.__name__] = Entry(query, sql)
        return query

    return register


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return analogue.Analogue(spark, sf_dir).raw(name)


# --- scans and projections -------------------------------------------------


@entry(
    """SELECT s_name AS "ICD10Description", s_suppkey AS "ICD10SID", s_nationkey AS "Sta3n"
       FROM supplier WHERE s_nationkey IN (3, 12)"""
)
def scan_site_dimension(spark, d):
    supplier = _raw(spark, d, "supplier").select(
        F.col("s_suppkey").alias("ICD10SID"),
        F.col("s_nationkey").alias("Sta3n"),
        F.col("s_name").alias("ICD10Description"),
    )
    tables = Tables(spark, {"icd10_description": supplier}, sites=(3, 12))
    return site_dimension(tables, "icd10_description", "ICD10Description", "ICD10SID")


@entry(
    """SELECT c_nationkey AS "Sta3n", c_name AS "PatientName", c_mktsegment AS "Diagnosis"
       FROM customer"""
)
def project_rename(spark, d):
    rows = _raw(spark, d, "customer").select(
        F.col("c_nationkey").alias("site"),
        F.col("c_name").alias("person_name"),
        F.col("c_mktsegment").alias("detail"),
    )
    return plan.client_names(rows)


# --- filters ---------------------------------------------------------------


@entry("SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'LARGE')")
def filter_code_set_exact(spark, d):
    part = _raw(spark, d, "part").select("p_partkey", "p_type", "p_name")
    chosen = CodeSet(exact=("PROMO", "LARGE"))
    return part.where(p.in_code_set(F.col("p_type"), F.col("p_name"), chosen)).drop("p_name")


@entry(
    """SELECT p_partkey, category, p_name
       FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN '*Missing*' WHEN 'MEDIUM' THEN NULL
                       ELSE p_type END AS category FROM part)
       WHERE category = 'PROMO'
          OR (category IN ('*Missing*', 'SMALL') AND regexp_matches(p_name, 'ring$|^blue|anvil'))"""
)
def filter_code_set_guarded(spark, d):
    category = F.when(F.col("p_type") == "ECONOMY", "*Missing*").when(
        F.col("p_type") != "MEDIUM", F.col("p_type")
    )
    chosen = CodeSet(
        exact=("PROMO",), guard=("*Missing*", "SMALL"), patterns=("%ring", "blue%", "%anvil%")
    )
    return (
        _raw(spark, d, "part")
        .select("p_partkey", category.alias("category"), "p_name")
        .where(p.in_code_set(F.col("category"), F.col("p_name"), chosen))
    )


def _parts_like(spark, d, column, *patterns: str) -> DataFrame:
    part = _raw(spark, d, "part").select("p_partkey", column.alias("text"))
    return part.where(p.in_text_set(F.col("text"), TextSet(patterns=patterns)))


@entry(
    """SELECT p_partkey, p_brand || '/' || p_name AS text FROM part
       WHERE contains(p_brand || '/' || p_name, '7/b') OR contains(p_name, 'ring')"""
)
def filter_like_contains(spark, d):
    text = F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name"))
    return _parts_like(spark, d, text, "%7/b%", "%ring%")


@entry("SELECT p_partkey, p_name AS text FROM part WHERE starts_with(p_name, 'hot ')")
def filter_like_prefix(spark, d):
    return _parts_like(spark, d, F.col("p_name"), "hot %")


@entry("SELECT p_partkey, p_name AS text FROM part WHERE ends_with(p_name, 'rod')")
def filter_like_suffix(spark, d):
    return _parts_like(spark, d, F.col("p_name"), "%rod")


@entry("SELECT p_partkey, p_name AS text FROM part WHERE p_name = 'red rod'")
def filter_like_exact(spark, d):
    return _parts_like(spark, d, F.col("p_name"), "red rod")


@entry(
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
       WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY')"""
)
def filter_not_like(spark, d):
    segment = F.col("segment")
    return (
        _raw(spark, d, "customer")
        .select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
        .where(segment.isNotNull() & p.unlike(segment, "AUTO%", "%HOUSE%"))
    )


@entry(
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
       WHERE nullif(c_mktsegment, 'BUILDING') <> 'MACHINERY'"""
)
def filter_not_equal(spark, d):
    return (
        _raw(spark, d, "customer")
        .select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
        .where(p.other_than(F.col("segment"), "MACHINERY"))
    )


@entry(
    """SELECT s_suppkey, CAST(floor(nullif(s_acctbal, 73.0) / 1000) AS BIGINT) AS reason
       FROM supplier WHERE CAST(floor(nullif(s_acctbal, 73.0) / 1000) AS BIGINT) <= 0"""
)
def filter_threshold(spark, d):
    reason = F.floor(F.nullif("s_acctbal", F.lit(73.0)) / 1000).cast("long").alias("reason")
    return _raw(spark, d, "supplier").select("s_suppkey", reason).where(p.without_reason(F.col("reason")))


@entry(
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate > TIMESTAMP '2000-02-29 10:00:00' - INTERVAL 3 YEAR"""
)
def filter_lookback(spark, d):
    moment = analogue.Run.at("2000-02-29 10:00:00").as_of
    orders = _raw(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return orders.where(x.within_years(F.col("o_orderdate"), moment, 3))


# --- joins -----------------------------------------------------------------


@entry(
    statement(
        """SELECT site, o_custkey AS person_id, l_orderkey AS visit, p_name, p_type
           FROM lines JOIN part ON l_partkey = p_partkey"""
    )
)
def join_inner_two_key(spark, d):
    t = inputs(spark, d).tables
    return (
        t["v_procedure"]
        .join(t["cpt"], ["CPTSID", "Sta3n"])
        .select(
            F.col("Sta3n").alias("site"),
            F.col("PatientSID").alias("person_id"),
            F.col("VisitSID").alias("visit"),
            F.col("CPTName").alias("p_name"),
            F.col("CPTCategory").alias("p_type"),
        )
    )


@entry(
    statement(
        """SELECT site, person_id, visit, 'CPT ' || p_name AS label, icd10,
                  CAST(icd9 AS BIGINT) AS icd9
           FROM procedures LEFT JOIN diagnoses USING (site, person_id, visit)
           WHERE p_type = 'LARGE'
              OR (p_type IN ('MEDIUM', 'SMALL')
                  AND (p_name LIKE '%widget%' OR p_name LIKE 'hot %' OR p_name LIKE '%rod'))"""
    )
)
def join_left_fanout(spark, d):
    given = inputs(spark, d, "cervical")
    keys = ["Sta3n", "PatientSID", "VisitSID"]
    return (
        streams.selected_procedures(given, given.spec.sections)
        .join(streams.diagnoses(given), keys, "left")
        .select(
            F.col("Sta3n").alias("site"),
            F.col("PatientSID").alias("person_id"),
            F.col("VisitSID").alias("visit"),
            "label",
            F.col("ICD10SID").alias("icd10"),
            F.col("ICD9SID").alias("icd9"),
        )
    )


@entry(
    statement(
        """SELECT d.site, d.visit, 'ICD10 ' || s.s_name AS code1, 'ICD9 ' || n.n_name AS code2
           FROM diagnoses d
           LEFT JOIN suppliers s ON s.s_suppkey = d.icd10 AND s.site = d.site
           LEFT JOIN nation n ON n.n_nationkey = d.icd9 AND n.n_regionkey = d.site"""
    )
)
def join_left_dim_chain(spark, d):
    given = inputs(spark, d)
    return streams.described(given, streams.diagnoses(given)).select(
        F.col("Sta3n").alias("site"), F.col("VisitSID").alias("visit"), "code1", "code2"
    )


@entry(
    statement(
        """SELECT p.site, p.person_id, p.visit, 'CPT ' || p.p_name AS label,
                  CAST(l.l_linenumber AS BIGINT) AS exam_code
           FROM procedures p JOIN lines l ON l.l_orderkey = p.visit AND l.site = p.site
           WHERE p_type = 'PROMO'
              OR (p_type IN ('ECONOMY', 'SMALL')
                  AND (p_name LIKE '%ring' OR p_name LIKE 'blue%' OR p_name LIKE '%anvil%'))"""
    )
)
def join_inner_visit(spark, d):
    given = inputs(spark, d, "breast")
    exams = given.tables["radiology_exam"].select("Sta3n", "VisitSID", "RadiologyDiagnosticCodeSID")
    return (
        streams.selected_procedures(given, given.spec.sections)
        .join(exams, ["Sta3n", "VisitSID"])
        .select(
            F.col("Sta3n").alias("site"),
            F.col("PatientSID").alias("person_id"),
            F.col("VisitSID").alias("visit"),
            "label",
            F.col("RadiologyDiagnosticCodeSID").alias("exam_code"),
        )
    )


@entry(statement("SELECT * FROM exams"))
def join_inner_chain(spark, d):
    return streams.exam_results(inputs(spark, d)).select(
        F.col("Sta3n").alias("site"), F.col("VisitSID").alias("visit"), "result"
    )


_UNRANKED = "site, person_id, event_ts, label, detail, code1, code2, flag"


@entry(
    statement(
        """SELECT e.site, e.user_id AS person_id, e.ts AS event_ts, 'HFT ' || t.kind_name AS label,
                  nullif(e.props, '{"k": 7}') AS detail, 'HFC ' || t.category AS code1,
                  NULL::VARCHAR AS code2,
                  CASE t.kind_name WHEN 'OUTSIDE CERVICAL HPV TESTING POSITIVE' THEN 'HPV POS'
                                   WHEN 'WH HYSTERECTOMY W/CERVIX REMOVED' THEN 'HYSTERECTOMY'
                                   WHEN 'WH PAP SMEAR SCREEN FREQ - 6M' THEN 'Y' END AS flag
           FROM readings e
           LEFT JOIN factor_types t ON t.id = e.kind + CASE WHEN e.value >= 40 THEN 5 ELSE 0 END
           WHERE t.category IN ('VA-HPV', 'WH PAP SMEAR')
              OR (t.category IN ('OUTSIDE RESULTS', 'PROCEDURES', 'REMINDER FACTORS')
                  AND (t.kind_name LIKE '%HPV%' OR t.kind_name LIKE '%HYST%'
                       OR t.kind_name LIKE '%PAP%'))"""
    )
)
def join_left_null_rejected(spark, d):
    return streams.observations(inputs(spark, d, "cervical")).drop("section", "rank_ts", "rank_key")


@entry(statement(f"SELECT {_UNRANKED} FROM breast_cyto_rows"))
def join_left_then_inner(spark, d):
    return streams.cytology(inputs(spark, d, "breast")).drop("section", "rank_ts", "rank_key")


@entry(statement(f"SELECT {_UNRANKED} FROM cervical_surg_rows"))
def join_left_chain_partial(spark, d):
    return streams.surgical(inputs(spark, d, "cervical")).drop("section", "rank_ts", "rank_key")


@entry(
    statement(
        """SELECT DISTINCT p.site, p.c_custkey AS person_id, 'Person ' || (c_custkey // 10) AS person_name,
                  CAST(30 + floor(p.c_acctbal / 200) AS INTEGER) AS age
           FROM persons p
           JOIN visits o ON o.o_custkey = p.c_custkey AND o.site = p.site
           JOIN (VALUES (0), (1), (2), (3), (4)) AS s(site) ON s.site = o.site
           WHERE p.c_mktsegment NOT IN ('AUTOMOBILE', 'MACHINERY')
             AND p.c_acctbal >= 0 AND p.c_acctbal < 8500
             AND o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT'"""
    )
)
def join_eligible_semi(spark, d):
    return plan.eligible_persons(inputs(spark, d)).select(
        F.col("Sta3n").alias("site"), F.col("PatientSID").alias("person_id"), "person_name", "age"
    )


# --- labels, flags, dates --------------------------------------------------


@entry(
    """SELECT p_partkey, 'CPT ' || nullif(p_name, 'red rod') AS label,
              CASE WHEN nullif(p_type, 'PROMO') IS NOT NULL
                   THEN 'HFC ' || nullif(p_type, 'PROMO') ELSE NULL END AS code1
       FROM part"""
)
def label_prefix_null(spark, d):
    return _raw(spark, d, "part").select(
        "p_partkey",
        x.labelled("CPT ", F.nullif("p_name", F.lit("red rod"))).alias("label"),
        x.labelled("HFC ", F.nullif("p_type", F.lit("PROMO"))).alias("code1"),
    )


@entry(
    """SELECT l_orderkey, l_linenumber,
              nullif(l_returnflag, 'N') || ' ' || nullif(l_linestatus, 'F') AS label FROM lineitem"""
)
def label_pair_null(spark, d):
    both = x.pair(F.nullif("l_returnflag", F.lit("N")), F.nullif("l_linestatus", F.lit("F")))
    return _raw(spark, d, "lineitem").select("l_orderkey", "l_linenumber", both.alias("label"))


@entry(
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 2 DAY
                   WHEN o_orderstatus = 'F' THEN o_orderdate END AS taken
       FROM orders"""
)
def null_replace(spark, d):
    status, ordered_at = F.col("o_orderstatus"), F.col("o_orderdate")
    taken = F.when(status == "F", ordered_at)
    received = F.when(status == "P", ordered_at + F.expr("INTERVAL 2 DAYS"))
    return _raw(spark, d, "orders").select(
        "o_orderkey", x.first_known(taken, received, "timestamp_ntz").alias("taken")
    )


@entry("SELECT o_orderkey, CAST(NULL AS VARCHAR) AS code2 FROM orders")
def typed_null(spark, d):
    return _raw(spark, d, "orders").select("o_orderkey", x.no_text().alias("code2"))


@entry(
    """SELECT p_partkey, CASE WHEN nullif(p_type, 'PROMO') IN ('SMALL', 'LARGE', 'PROMO')
                         THEN 'Y' ELSE 'N' END AS flag FROM part"""
)
def flag_in_else(spark, d):
    rule = FlagRule(branches=((("SMALL", "LARGE", "PROMO"), "Y"),), default="N")
    kind = F.nullif("p_type", F.lit("PROMO"))
    return _raw(spark, d, "part").select("p_partkey", p.flag(kind, rule).alias("flag"))


@entry(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'HPV POS'
                             WHEN event_type IN ('error', 'view') THEN 'HYSTERECTOMY'
                             WHEN event_type IN ('click', 'signup') THEN 'Y' END AS flag
       FROM events"""
)
def flag_multi_branch(spark, d):
    rule = FlagRule(
        branches=(
            (("error",), "HPV POS"),
            (("error", "view"), "HYSTERECTOMY"),
            (("click", "signup"), "Y"),
        )
    )
    flag = p.flag(F.col("event_type"), rule)
    return _raw(spark, d, "events").select("event_id", flag.alias("flag"))


@entry(
    """SELECT event_id, CASE WHEN value >= 40 THEN 'HPV POS' END AS flag FROM events"""
)
def flag_positive_result(spark, d):
    rule = FlagRule(branches=((("POS", "POSITIVE"), "HPV POS"),))
    value = F.col("value")
    result = F.when(value >= 60, "POSITIVE").when(value >= 40, "POS").when(value >= 1, "NEGATIVE")
    return _raw(spark, d, "events").select("event_id", p.flag(result, rule).alias("flag"))


@entry(
    """SELECT p_partkey, CASE WHEN nullif(p_type, 'PROMO') NOT IN ('SMALL', 'LARGE')
                         THEN 'Y' ELSE NULL END AS flag FROM part"""
)
def flag_not_in_null(spark, d):
    rule = FlagRule(branches=((("SMALL", "LARGE"), "Y"),), outside=True)
    kind = F.nullif("p_type", F.lit("PROMO"))
    return _raw(spark, d, "part").select("p_partkey", p.flag(kind, rule).alias("flag"))


@entry("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events")
def cast_event_date(spark, d):
    return _raw(spark, d, "events").select("event_id", x.day(F.col("ts")).alias("event_date"))


@entry(
    """SELECT o_orderkey, CAST(date_diff('year', o_orderdate, TIMESTAMP '2001-08-01 10:00:00')
              AS INTEGER) AS years FROM orders"""
)
def year_boundary_diff(spark, d):
    years = x.year_boundaries(F.col("o_orderdate"), x.moment(analogue.run().as_of))
    return _raw(spark, d, "orders").select("o_orderkey", years.alias("years"))


@entry(
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
              THEN CAST(30 + floor(c_acctbal / 200)
                        - date_diff('year', o_orderdate, TIMESTAMP '2001-08-01 10:00:00') AS INTEGER)
              END AS age_at_event
       FROM orders JOIN customer ON c_custkey = o_custkey"""
)
def age_at_event(spark, d):
    t = inputs(spark, d).tables
    rows = t["cytopathology"].join(t["patient"], ["PatientSID", "Sta3n"])
    age = x.age_at(F.col("Age"), F.col("DateTimeSpecimenTaken"), analogue.run().as_of)
    return rows.select(F.col("CytopathologyIEN").alias("o_orderkey"), age.alias("age_at_event"))


# --- ranks -----------------------------------------------------------------


@entry(
    """SELECT o_custkey, o_orderkey, o_orderdate,
              row_number() OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS recency
       FROM orders"""
)
def recency_rank(spark, d):
    rows = _raw(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    order = [ranking.newest_first("o_orderdate"), *ranking.ties(["o_orderkey"])]
    return ranking.row_numbers(rows, ["o_custkey"], order)


@entry(
    """SELECT event_type, day, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS recency
       FROM (SELECT event_type, CAST(ts AS DATE) AS day FROM events)"""
)
def recency_rank_hot(spark, d):
    """Five groups, each large enough to be cut into slices, with counted copies."""
    rows = _raw(spark, d, "events").select("event_type", F.col("ts").cast("date").alias("day"))
    counted = ranking.counted_copies(rows, rows.columns, F.count(F.lit(1)), "copies")
    order = [ranking.newest_first("day")]
    return ranking.row_numbers(counted, ["event_type"], order, hot_rows=100, copies="copies")


@entry(
    """SELECT text, day, row_number() OVER (PARTITION BY lower(text) ORDER BY day DESC, text) AS recency
       FROM (SELECT CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS text,
                    CAST(ts AS DATE) AS day FROM events)"""
)
def rank_caseless(spark, d):
    """Groups that ignore case, in two spellings; each spelling keeps its rows."""
    text = F.expr("CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END")
    rows = _raw(spark, d, "events").select(
        text.cast("string collate UTF8_LCASE").alias("text"), F.col("ts").cast("date").alias("day")
    )
    counted = ranking.counted_copies(rows, rows.columns, F.count(F.lit(1)), "copies")
    order = [ranking.newest_first("day")]
    numbered = ranking.row_numbers(counted, ["text"], order, hot_rows=100, copies="copies")
    return numbered.withColumn("text", F.col("text").cast("string"))


_LINE_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@entry(
    f"""SELECT {", ".join(_LINE_TIES)}, l_returnflag,
               row_number() OVER (PARTITION BY l_partkey, l_returnflag
                                  ORDER BY taken ASC NULLS FIRST, {", ".join(_LINE_TIES)}) AS recency
        FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS taken FROM lineitem)"""
)
def sequence_rank_asc(spark, d):
    taken = F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")).alias("taken")
    rows = _raw(spark, d, "lineitem").select(*_LINE_TIES, "l_returnflag", taken)
    order = [ranking.oldest_first("taken"), *ranking.ties(_LINE_TIES)]
    return ranking.row_numbers(rows, ["l_partkey", "l_returnflag"], order).drop("taken")


@entry(
    """SELECT o_custkey, o_orderpriority, o_orderkey, coalesce(taken, received) AS event_ts,
              row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                 ORDER BY taken DESC NULLS LAST, o_orderkey) AS recency
       FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS taken,
                    o_orderdate + INTERVAL 2 DAY AS received FROM orders)"""
)
def rank_raw_time_two_key(spark, d):
    taken = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    received = F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")
    rows = _raw(spark, d, "orders").select(
        "o_custkey",
        "o_orderpriority",
        "o_orderkey",
        x.first_known(taken, received, "timestamp_ntz").alias("event_ts"),
        taken.alias("taken"),
    )
    order = [ranking.newest_first("taken"), *ranking.ties(["o_orderkey"])]
    return ranking.row_numbers(rows, ["o_custkey", "o_orderpriority"], order).drop("taken")


@entry(
    """SELECT event_id, user_id, event_type, ts AS event_ts,
              row_number() OVER (PARTITION BY user_id, event_type
                                 ORDER BY completed DESC NULLS LAST, event_id) AS recency
       FROM (SELECT *, CASE WHEN value >= 40 THEN ts + INTERVAL 10 DAY ELSE ts END AS completed
             FROM events)"""
)
def rank_other_time(spark, d):
    late = F.col("ts") + F.expr("INTERVAL 10 DAYS")
    rows = _raw(spark, d, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").alias("event_ts"),
        F.when(F.col("value") >= 40, late).otherwise(F.col("ts")).alias("completed"),
    )
    order = [ranking.newest_first("completed"), *ranking.ties(["event_id"])]
    return ranking.row_numbers(rows, ["user_id", "event_type"], order).drop("completed")


@entry(
    """SELECT *, row_number() OVER (PARTITION BY c_name
                                    ORDER BY recency, event_type NULLS FIRST, event_id) AS person_rank
       FROM (SELECT c_name, event_type, event_id,
                    row_number() OVER (PARTITION BY user_id, event_type
                                       ORDER BY ts DESC NULLS LAST, event_id) AS recency
             FROM events JOIN customer ON c_custkey = user_id)"""
)
def rank_within_person(spark, d):
    names = _raw(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    events = _raw(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    order = [ranking.newest_first("ts"), *ranking.ties(["event_id"])]
    rows = ranking.row_numbers(events, ["user_id", "event_type"], order)
    rows = rows.join(names, "user_id").select("c_name", "event_type", "event_id", "recency")
    by_rank = ranking.ties(["recency", "event_type", "event_id"])
    return ranking.row_numbers(rows, ["c_name"], by_rank, "person_rank")


@entry(
    """SELECT o_custkey, o_orderkey, o_orderdate, CAST(1 AS BIGINT) AS recency FROM orders o
       WHERE NOT EXISTS (SELECT 1 FROM orders n WHERE n.o_custkey = o.o_custkey
                         AND (n.o_orderdate > o.o_orderdate
                              OR (n.o_orderdate = o.o_orderdate AND n.o_orderkey < o.o_orderkey)))"""
)
def latest_per_person(spark, d):
    rows = _raw(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    order = [ranking.newest_first("o_orderdate"), *ranking.ties(["o_orderkey"])]
    return ranking.first_rows(rows, ["o_custkey"], order, "recency")


# --- unions, distinct ------------------------------------------------------


def _entities(spark, d) -> list[DataFrame]:
    """Key and text of five tables, with unlike names and repeated rows."""
    nulled = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return [
        _raw(spark, d, "customer").select(
            F.col("c_nationkey").cast("long").alias("id"), nulled.alias("text")
        ),
        _raw(spark, d, "orders").select("o_custkey", "o_orderpriority"),
        _raw(spark, d, "events").select("user_id", "event_type"),
        _raw(spark, d, "lineitem").select("l_suppkey", "l_returnflag"),
        _raw(spark, d, "supplier").select(F.col("s_nationkey").cast("long"), F.lit("SUPPLIER")),
    ]


_CUSTOMER = """SELECT CAST(c_nationkey AS BIGINT) AS id, nullif(c_mktsegment, 'BUILDING') AS text
               FROM customer"""
_FOUR = f"""{_CUSTOMER} UNION SELECT o_custkey, o_orderpriority FROM orders
            UNION SELECT user_id, event_type FROM events
            UNION SELECT l_suppkey, l_returnflag FROM lineitem"""
_FIVE = f"{_FOUR} UNION SELECT CAST(s_nationkey AS BIGINT), 'SUPPLIER' FROM supplier"


@entry(_FOUR)
def union_four_streams(spark, d):
    return unions.united_by_position(_entities(spark, d)[:4])


@entry(_FIVE)
def union_five_streams(spark, d):
    return unions.united_by_position(_entities(spark, d))


@entry(
    f"""SELECT * FROM ({_CUSTOMER} UNION SELECT user_id, event_type FROM events)
        UNION SELECT * FROM ({_CUSTOMER} UNION SELECT o_custkey, o_orderpriority FROM orders)"""
)
def union_sections(spark, d):
    customer, orders, events, *_ = [df.toDF("id", "text") for df in _entities(spark, d)]
    return unions.united([unions.united([customer, events]), unions.united([customer, orders])])


@entry(
    """SELECT user_id AS person_id, event_type AS label, ts AS event_ts FROM events
       UNION SELECT o_custkey, o_orderpriority, o_orderdate FROM orders"""
)
def union_positional(spark, d):
    events = _raw(spark, d, "events").select(
        F.col("user_id").alias("person_id"),
        F.col("event_type").alias("label"),
        F.col("ts").alias("event_ts"),
    )
    orders = _raw(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    return unions.united_by_position([events, orders])


@entry(
    """SELECT DISTINCT c_nationkey AS site, c_name AS person_name, CAST(ts AS DATE) AS event_date,
              event_type AS label, nullif(event_type, 'click') AS flag
       FROM events JOIN customer ON c_custkey = user_id"""
)
def distinct_report_rows(spark, d):
    persons = _raw(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").alias("site"),
        F.col("c_name").alias("person_name"),
    )
    events = _raw(spark, d, "events").select(
        "user_id",
        F.col("ts").cast("date").alias("event_date"),
        F.col("event_type").alias("label"),
        F.nullif("event_type", F.lit("click")).alias("flag"),
    )
    return unions.united([events.join(persons, "user_id").drop("user_id")])


# --- bad source values -----------------------------------------------------


def _untyped_orders(spark: SparkSession, d: str) -> Tables:
    """Orders as enrollments of a station that stores text; some ids and times hold the priority."""
    status, price, other = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    rows = _raw(spark, d, "orders").select(
        F.when(status == "P", other).otherwise(F.col("o_custkey").cast("string")).alias("PatientSID"),
        (F.col("o_custkey") % 25).alias("Sta3n"),
        F.col("o_orderkey").alias("EnrollmentStatusSID"),
        F.when(price < 50000, other).otherwise(F.col("o_orderdate").cast("string")).alias("EnrollmentDateTime"),
    )
    return Tables(spark, {"enrollment": rows}, tolerant=True)


@entry(
    """SELECT o_custkey AS "PatientSID", CAST(o_custkey % 25 AS INT) AS "Sta3n",
              o_orderkey AS "EnrollmentStatusSID", o_orderdate AS "EnrollmentDateTime"
       FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice >= 50000"""
)
def scan_tolerant(spark, d):
    return _untyped_orders(spark, d)["enrollment"]


@entry(
    """SELECT 'enrollment' AS "table", 'PatientSID' AS "column", 'bigint' AS wanted, o_orderpriority AS value,
              count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_orderpriority
       UNION ALL
       SELECT 'enrollment', 'EnrollmentDateTime', 'timestamp_ntz', o_orderpriority, count(*)
       FROM orders WHERE o_totalprice < 50000 GROUP BY o_orderpriority"""
)
def scan_rejects(spark, d):
    reasons = _untyped_orders(spark, d).all_rejects().select("table", F.explode("reasons").alias("reason"))
    return reasons.groupBy("table", "reason.column", "reason.wanted", "reason.value").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: e.query for name, e in ENTRIES.items()}


def oracle() -> dict[str, str]:
    return {name: e.sql for name, e in ENTRIES.items()}
