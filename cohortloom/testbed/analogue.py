"""The 24 source tables as views over the test tables.

The test data has no clinical tables, so each source is a projection of the
table that plays its part: a customer is a person, the region of the
customer's nation is the site, an order is a visit or a case, a line item is a
procedure, diagnosis, exam or specimen. Every row takes part. NULLs, which the
test tables lack, are made where a source may have them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.staging import staged
from cohortloom.sources.loader import Tables
from cohortloom.spec import BREAST, CERVICAL, CodeSet, ReportSpec, Run, TextSet

AS_OF = "2001-08-01 10:00:00"

# The real sections with the code sets that meet test-table text exchanged.
SPEC = ReportSpec(
    sections=(
        replace(
            BREAST,
            procedures=CodeSet(
                exact=("PROMO",), guard=("ECONOMY", "SMALL"), patterns=("%ring", "blue%", "%anvil%")
            ),
            topography=TextSet(patterns=("%ring%",)),
            specimens=TextSet(patterns=("%plate%", "%hot%")),
        ),
        replace(
            CERVICAL,
            procedures=CodeSet(
                exact=("LARGE",), guard=("MEDIUM", "SMALL"), patterns=("%widget%", "hot %", "%rod")
            ),
            topography=TextSet(
                exact=("red rod", "hot anvil"), patterns=("cold bolt", "blue%", "%gear")
            ),
            specimens=TextSet(patterns=("%widget%", "%anvil%", "red%")),
        ),
    )
)

#: Factors since then are what the analogue's smaller table of factors holds.
RECENT = "2024-01-16 00:00:00"

_STATUS = """CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2
                  WHEN o_orderpriority = '1-URGENT' THEN 4 ELSE 3 END"""

EXAM_CODES = [
    (1, "BI-RADS CATEGORY 0"),
    (2, "BI-RADS CATEGORY 1"),
    (3, "MINOR ABNORMALITY"),
    (4, "Outside Report"),
    (5, "NEGATIVE"),
    (6, None),
    (7, "BI-RADS CATEGORY 4"),
]
MORPHOLOGIES = [
    (1, "NORMAL TISSUE MORPHOLOGY", "M-1"),
    (2, "DYSPLASIA", "M-2"),
    (3, None, "M-3"),
    (4, "CARCINOMA", None),
    (5, "NEGATIVE FOR MALIGNANT CELLS", "M-5"),
    (6, "UNSATISFACTORY SPECIMEN", "M-6"),
]  # 7 has no row
FACTOR_TYPES = [
    (1, "WH OUTSIDE MAMMOGRAM", "WH MAMMOGRAM"),
    (2, "HFT WH BILATERAL MASTECTOMY", "OUTSIDE RESULTS"),
    (3, "WH PAP SMEAR SCREEN FREQ - 6M", "WH PAP SMEAR"),
    (4, "BREAST AND PAP REMINDER", "REMINDER FACTORS"),
    (5, "OUTSIDE CERVICAL HPV TESTING POSITIVE", "OUTSIDE RESULTS"),
    (6, "COLONOSCOPY", "CANCER SCREENING"),
    (7, "WH HYSTERECTOMY W/CERVIX REMOVED", "PROCEDURES"),
    (8, "HFT WH OUTSIDE ABNL MAMMOGRAM", "BREAST CANCER"),
    (9, None, "VA-HPV"),
]  # 10 has no row
LAB_TESTS = [(1, "HPV DNA"), (2, "PREGNANCY TEST"), (3, "GLUCOSE"), (4, "HPV ORDER PANEL")]


def sql_values(rows: list[tuple]) -> str:
    """Rows as a VALUES list, in both dialects."""

    def cell(v) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


class Analogue:
    """Lazy source views over one folder of test tables.

    Real facts are stored with their site; here, orders and lines get it by joins. ``stored``
    writes orders and lines with it when a source first needs them, so that the views of one
    query do not shuffle them again each."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = False):
        self._spark, self._dir, self._stored = spark, sf_dir, stored
        self._raw: dict[str, DataFrame] = {}
        self._located: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:  # each read lists files and opens a footer
            self._raw[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._raw[name]

    def inline(self, rows: list[tuple], columns: str) -> DataFrame:
        return self._spark.sql(f"SELECT * FROM VALUES {sql_values(rows)} AS t({columns})")

    def _with_site(self, df: DataFrame, person: str) -> DataFrame:
        """``df`` with its person's key and site. Single tables are joined one
        after the other, so each join's right side is a scan of known size."""
        customer = self.raw("customer").selectExpr("c_custkey AS PatientSID", "c_nationkey")
        return self._with_region(
            df.withColumn("PatientSID", F.col(person)).join(customer, "PatientSID"), "c_nationkey"
        )

    def _with_region(self, df: DataFrame, nation: str) -> DataFrame:
        regions = self.raw("nation").selectExpr(f"n_nationkey AS {nation}", "n_regionkey AS Sta3n")
        return df.join(regions, nation)

    def persons(self) -> DataFrame:
        customer = self.raw("customer").withColumn("PatientSID", F.col("c_custkey"))
        return self._with_region(customer, "c_nationkey")

    def suppliers(self) -> DataFrame:
        return self._with_region(self.raw("supplier"), "s_nationkey")

    def orders(self) -> DataFrame:
        if "orders" not in self._located:
            orders = self._with_site(self.raw("orders"), "o_custkey").select(
                "o_orderkey", "Sta3n", "PatientSID", "o_orderstatus", "o_orderdate", "o_orderpriority"
            )
            stored = staged(orders, "orders-with-site") if self._stored else orders
            self._located["orders"] = stored.withColumn("o_custkey", F.col("PatientSID"))
        return self._located["orders"]

    def lines(self) -> DataFrame:
        """Lines of the orders that have a site: the few columns of orders are moved by person,
        the lines once, by order."""
        if "lines" not in self._located:
            orders = self.orders().select(
                F.col("o_orderkey").alias("l_orderkey"), "Sta3n", "PatientSID", "o_orderdate"
            )
            lines = self.raw("lineitem").select(
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
            )
            lines = lines.join(orders, "l_orderkey")
            stored = staged(lines, "lines-with-site") if self._stored else lines
            self._located["lines"] = stored.withColumns(
                {"o_orderkey": F.col("l_orderkey"), "o_custkey": F.col("PatientSID")}
            )
        return self._located["lines"]

    def specimen_lines(self) -> DataFrame:
        part = self.raw("part").withColumn("l_partkey", F.col("p_partkey"))
        return self.lines().join(part, "l_partkey")

    def events(self) -> DataFrame:
        kind = """CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                  WHEN 'signup' THEN 4 ELSE 5 END"""
        return self._with_site(self.raw("events"), "user_id").withColumn("kind", F.expr(kind))

    def per_site(self, df: DataFrame) -> DataFrame:
        """Each row once per region, as per-site dimensions have it."""
        return df.withColumn("Sta3n", F.expr("explode(sequence(0, 4))"))

    def parts_per_site(self) -> DataFrame:
        """Parts, once per region. Catalyst takes the result for no larger than the file: unless
        it was measured, it is to be sorted like a fact and not held whole by each task."""
        return self.per_site(self.raw("part")).hint("merge")

    def corrected(self, *names: str) -> Tables:
        """The sources, of which ``names`` have what corrections read: description versions, dated
        enrollments, a full history beside recent factors, addresses."""
        suppliers = self.suppliers()
        versions = suppliers.selectExpr(
            "s_suppkey AS ICD10SID", "Sta3n", "s_name AS ICD10Description",
            "TIMESTAMP_NTZ '1996-06-01 00:00:00' AS EffectiveDateTime",
        ).unionByName(
            suppliers.where("s_suppkey % 2 = 0").selectExpr(
                "s_suppkey AS ICD10SID", "Sta3n", "s_name || ' II' AS ICD10Description",
                "TIMESTAMP_NTZ '1999-01-01 08:00:00' AS EffectiveDateTime",
            )
        )
        plain = self.tables()
        places = {name: lambda name=name: plain[name] for name in plain}
        richer = {
            "icd10_description": versions,
            "enrollment": lambda: self.orders().selectExpr(
                "Sta3n", "PatientSID", f"{_STATUS} AS EnrollmentStatusSID", "o_orderdate AS EnrollmentDateTime"
            ),
            "health_factor_history": lambda: plain["health_factor"],
            "health_factor": lambda: plain["health_factor"].where(
                f"HealthFactorDateTime > TIMESTAMP_NTZ '{RECENT}'"
            ),
            "address": lambda: self.orders().selectExpr(
                "Sta3n", "PatientSID", "o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM') AS InRegion",
                "o_orderdate - INTERVAL 2 YEARS AS ChangedDateTime",
            ),
        }
        return Tables(self._spark, places | {name: richer[name] for name in names})

    def tables(self, **more) -> Tables:
        who = ["Sta3n", "PatientSID"]
        taken = "CASE WHEN o_orderstatus != 'P' THEN o_orderdate END AS DateTimeSpecimenTaken"
        cyto_case = ["o_orderkey AS CytopathologyIEN", "o_custkey AS LabDataIEN", "Sta3n"]
        surg_case = ["o_orderkey AS SurgicalPathologyIEN", "o_custkey AS LabDataIEN", "Sta3n"]
        places = {
            "icd10_description": lambda: self.suppliers().selectExpr(
                "s_suppkey AS ICD10SID", "Sta3n", "s_name AS ICD10Description"
            ),
            "icd9_description": lambda: self.raw("nation").selectExpr(
                "n_nationkey AS ICD9SID", "n_regionkey AS Sta3n", "n_name AS ICD9Description"
            ),
            "cpt": lambda: self.parts_per_site().selectExpr(
                "p_partkey AS CPTSID",
                "Sta3n",
                "p_brand AS CPTCode",
                "p_name AS CPTName",
                "p_type AS CPTCategory",
            ),
            "v_procedure": lambda: self.lines().selectExpr(
                *who,
                "l_linenumber AS VProcedureSID",
                "l_orderkey AS VisitSID",
                "o_orderdate AS VisitDateTime",
                "l_partkey AS CPTSID",
                "nullif(l_returnflag, 'N') AS Comments",
            ),
            "v_diagnosis": lambda: self.lines().selectExpr(
                *who,
                unmet("l_returnflag = 'A'", "l_orderkey", "VisitSID"),
                "l_suppkey AS ICD10SID",
                "l_linenumber AS ICD9SID",
            ),
            "radiology_exam": lambda: self.lines().selectExpr(
                "Sta3n",
                "l_orderkey AS VisitSID",
                "l_orderkey AS RadiologyRegisteredExamSID",
                "l_linenumber AS RadiologyDiagnosticCodeSID",
                """CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'R' THEN -1
                        WHEN l_linestatus = 'O' THEN 12 END AS RadiologyHoldCancelReasonSID""",
            ),
            "radiology_registered_exam": lambda: self.orders().selectExpr(
                "o_orderkey AS RadiologyRegisteredExamSID", "Sta3n", "o_orderdate AS ExamDateTime"
            ),
            "radiology_diagnostic_code": lambda: self.per_site(
                self.inline(EXAM_CODES, "RadiologyDiagnosticCodeSID, RadiologyDiagnosticCode")
            ),
            "health_factor": lambda: self.events().selectExpr(
                *who,
                "ts AS HealthFactorDateTime",
                """nullif(props, '{"k": 7}') AS Comments""",
                "kind + CASE WHEN value >= 40 THEN 5 ELSE 0 END AS HealthFactorTypeSID",
            ),
            "health_factor_type": lambda: self.inline(
                FACTOR_TYPES, "HealthFactorTypeSID, HealthFactorType, HealthFactorCategory"
            ),
            "cytopathology": lambda: self.orders().selectExpr(
                *cyto_case,
                "PatientSID",
                taken,
                "o_orderdate + INTERVAL 2 DAYS AS DateTimeSpecimenReceived",
            ),
            "cyto_organ_morphology": lambda: self.lines().selectExpr(
                unmet("l_returnflag = 'R'", "o_orderkey", "CytopathologyIEN"),
                *cyto_case[1:],
                "l_linenumber AS MorphologyFieldIEN",
            ),
            "morphology": lambda: self.per_site(
                self.inline(MORPHOLOGIES, "MorphologyIEN, Morphology, SnomedCode")
            ),
            "cyto_specimen": lambda: self.lines().selectExpr(
                unmet("l_linestatus = 'O'", "o_orderkey", "CytopathologyIEN"),
                *cyto_case[1:],
                """CASE l_returnflag WHEN 'A' THEN 'ASPIRATE' WHEN 'R' THEN 'SMEAR' END
                   AS CollectionSample""",
                "l_partkey AS TopographyFieldIEN",
            ),
            "topography": lambda: self.parts_per_site().selectExpr(
                "p_partkey AS TopographyIEN",
                "Sta3n",
                "p_name AS Topography",
                "p_brand AS SNOMEDCode",
            ),
            "surgical_pathology": lambda: self.orders().selectExpr(
                *surg_case,
                "PatientSID",
                "nullif(o_orderpriority, '5-LOW') AS SurgicalPathAccNumber",
                taken,
                "o_orderdate + INTERVAL 1 DAYS AS DateTimeSpecimenReceived",
            ),
            "surg_specimen": lambda: self.specimen_lines().selectExpr(
                unmet("l_returnflag != 'A'", "o_orderkey", "SurgicalPathologyIEN"),
                *surg_case[1:],
                "p_name AS Specimen",
            ),
            "surg_morphology": lambda: self.lines().selectExpr(
                unmet("l_linestatus = 'F'", "o_orderkey", "SurgicalPathologyIEN"),
                *surg_case[1:],
                "l_suppkey AS MorphologyFieldIEN",
                "'FIELD ' || l_linenumber AS MorphologyField",
            ),
            "surg_morphology_field": lambda: self.suppliers().selectExpr(
                "s_suppkey AS MorphologyFieldIEN", "Sta3n", "s_name AS SnomedCode"
            ),
            "lab_chem": lambda: self.events().selectExpr(
                *who,
                "kind AS LabChemTestSID",
                "ts AS LabChemSpecimenDateTime",
                """CASE WHEN value >= 40 THEN ts + INTERVAL 10 DAYS ELSE ts END
                   AS LabChemCompleteDateTime""",
                """CASE WHEN value >= 60 THEN 'POSITIVE' WHEN value >= 40 THEN 'POS'
                        WHEN value >= 1 THEN props END AS LabChemResultValue""",
            ),
            "lab_chem_test": lambda: self.inline(LAB_TESTS, "LabChemTestSID, LabChemTestName"),
            "patient": lambda: self.persons().selectExpr(
                *who,
                """CASE WHEN c_acctbal > 9500 THEN NULL WHEN c_acctbal > 9000 THEN 'ZZ' || c_name
                        ELSE 'Person ' || (c_custkey div 10) END AS PatientName""",  # shared also across sites
                "c_mktsegment || '-' || c_custkey AS PatientSSN",
                "30 + CAST(floor(c_acctbal / 200) AS INT) AS Age",
                """CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'M' ELSE 'F' END
                   AS Gender""",
                """CASE WHEN c_acctbal < 0 THEN 'Y' WHEN c_acctbal < 8500 THEN 'N' END
                   AS DeceasedFlag""",
            ),
            "enrollment": lambda: self.orders().selectExpr(
                *who,
                f"{_STATUS} AS EnrollmentStatusSID",
            ),
            "enrollment_status": lambda: self.per_site(
                self.inline(
                    [(1, "CANCELLED"), (2, "PENDING"), (3, "REJECTED"), (4, "ENROLLED")],
                    "EnrollmentStatusSID, EnrollmentCategory",
                )
            ),
        }
        return Tables(self._spark, places, **more)


def unmet(condition: str, key: str, name: str) -> str:
    """``key``, or where the condition fails a key that nothing else has: every row
    takes part, and some find no match."""
    return f"CASE WHEN {condition} THEN {key} ELSE -1 - {key} END AS {name}"


def run(**more) -> Run:
    return Run.at(AS_OF, **more)
