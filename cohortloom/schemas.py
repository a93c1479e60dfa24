"""Column contracts: the 24 source tables, the event shape and the report.

Source column names are fixed values: they are what existing stations already
have in their warehouses, so inputs are accepted under those names.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Logical table name -> columns, as Spark DDL.
SOURCES: dict[str, str] = {
    "icd10_description": "ICD10SID long, Sta3n int, ICD10Description string",
    "icd9_description": "ICD9SID long, Sta3n int, ICD9Description string",
    "cpt": "CPTSID long, Sta3n int, CPTCode string, CPTName string, CPTCategory string",
    "v_procedure": (
        "Sta3n int, PatientSID long, VProcedureSID long, VisitSID long, "
        "VisitDateTime timestamp_ntz, CPTSID long, Comments string"
    ),
    "v_diagnosis": "Sta3n int, PatientSID long, VisitSID long, ICD10SID long, ICD9SID long",
    "radiology_exam": (
        "Sta3n int, VisitSID long, RadiologyRegisteredExamSID long, "
        "RadiologyDiagnosticCodeSID long, RadiologyHoldCancelReasonSID long"
    ),
    "radiology_registered_exam": (
        "RadiologyRegisteredExamSID long, Sta3n int, ExamDateTime timestamp_ntz"
    ),
    "radiology_diagnostic_code": (
        "RadiologyDiagnosticCodeSID long, Sta3n int, RadiologyDiagnosticCode string"
    ),
    "health_factor": (
        "Sta3n int, PatientSID long, HealthFactorDateTime timestamp_ntz, "
        "Comments string, HealthFactorTypeSID long"
    ),
    "health_factor_type": (
        "HealthFactorTypeSID long, HealthFactorType string, HealthFactorCategory string"
    ),
    "cytopathology": (
        "Sta3n int, PatientSID long, CytopathologyIEN long, LabDataIEN long, "
        "DateTimeSpecimenTaken timestamp_ntz, DateTimeSpecimenReceived timestamp_ntz"
    ),
    "cyto_organ_morphology": (
        "CytopathologyIEN long, LabDataIEN long, Sta3n int, MorphologyFieldIEN long"
    ),
    "morphology": "MorphologyIEN long, Sta3n int, Morphology string, SnomedCode string",
    "cyto_specimen": (
        "CytopathologyIEN long, LabDataIEN long, Sta3n int, "
        "CollectionSample string, TopographyFieldIEN long"
    ),
    "topography": "TopographyIEN long, Sta3n int, Topography string, SNOMEDCode string",
    "surgical_pathology": (
        "Sta3n int, PatientSID long, SurgicalPathologyIEN long, LabDataIEN long, "
        "SurgicalPathAccNumber string, DateTimeSpecimenTaken timestamp_ntz, "
        "DateTimeSpecimenReceived timestamp_ntz"
    ),
    "surg_specimen": "SurgicalPathologyIEN long, LabDataIEN long, Sta3n int, Specimen string",
    "surg_morphology": (
        "SurgicalPathologyIEN long, LabDataIEN long, Sta3n int, "
        "MorphologyFieldIEN long, MorphologyField string"
    ),
    "surg_morphology_field": "MorphologyFieldIEN long, Sta3n int, SnomedCode string",
    "lab_chem": (
        "Sta3n int, PatientSID long, LabChemTestSID long, "
        "LabChemSpecimenDateTime timestamp_ntz, LabChemCompleteDateTime timestamp_ntz, "
        "LabChemResultValue string"
    ),
    "lab_chem_test": "LabChemTestSID long, LabChemTestName string",
    "patient": (
        "PatientSID long, Sta3n int, PatientName string, PatientSSN string, "
        "Age int, Gender string, DeceasedFlag string"
    ),
    "enrollment": "PatientSID long, Sta3n int, EnrollmentStatusSID long",
    "enrollment_status": "EnrollmentStatusSID long, Sta3n int, EnrollmentCategory string",
}

# Tables and columns of our own naming that corrections use where a station has them. A table
# that is not given is not read; a column a source lacks reads as NULL.
OPTIONAL_TABLES: dict[str, str] = {
    "health_factor_history": SOURCES["health_factor"],  # all years, where health_factor has some
    "address": "Sta3n int, PatientSID long, InRegion boolean, ChangedDateTime timestamp_ntz",
}
OPTIONAL_COLUMNS: dict[str, str] = {
    "icd10_description": "EffectiveDateTime timestamp_ntz",  # of a version of the description
    "icd9_description": "EffectiveDateTime timestamp_ntz",
    "enrollment": "EnrollmentDateTime timestamp_ntz",
}

# Tables small enough in practice to be join lookups; their size is still
# measured before any broadcast (operators/sizing.py).
DIMENSIONS: tuple[str, ...] = (
    "icd10_description",
    "icd9_description",
    "cpt",
    "radiology_diagnostic_code",
    "health_factor_type",
    "morphology",
    "topography",
    "surg_morphology_field",
    "lab_chem_test",
    "enrollment_status",
)

EVENT = (
    "site int, person_id long, event_ts timestamp_ntz, label string, detail string, "
    "code1 string, code2 string, flag string, recency long"
)
EVENT_COLUMNS: list[str] = [part.split()[0] for part in EVENT.split(", ")]

REPORT = (
    "site int, person_name string, person_national_id string, age_at_event int, "
    "event_date date, label string, detail string, code1 string, code2 string, flag string"
)
REPORT_COLUMNS: list[str] = [part.split()[0] for part in REPORT.split(", ")]

# The report's column names as existing report clients expect them.
CLIENT_NAMES: dict[str, str] = {
    "site": "Sta3n",
    "person_name": "PatientName",
    "person_national_id": "PatientSSN",
    "age_at_event": "AgeAtEvent",
    "event_date": "EventDate",
    "label": "ProcedureName",
    "detail": "Diagnosis",
    "code1": "Code1",
    "code2": "Code2",
    "flag": "Abnormal",
    "recency": "ProcedureRank",
    "person_rank": "PatientRank",
}


def struct(table: str) -> StructType:
    """The schema of one source table."""
    return StructType.fromDDL(SOURCES.get(table) or OPTIONAL_TABLES[table])


def optional(table: str) -> StructType:
    """The columns one source table may have besides."""
    return StructType.fromDDL(OPTIONAL_COLUMNS[table]) if table in OPTIONAL_COLUMNS else StructType()


def columns(table: str) -> list[str]:
    """The column names of one source table."""
    return struct(table).fieldNames()
