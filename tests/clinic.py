"""A small invented clinic in the 24 source tables, built up case by case."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql.types import StructType

from cohortloom import schemas
from cohortloom.plans.streams import FULL, Inputs
from cohortloom.sources.loader import Tables
from cohortloom.spec import DEFAULT, Run

SITE = 612
AS_OF = "2024-02-29 10:00:00"


def ts(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


class Clinic:
    """Rows per table, given as dicts; missing columns are NULL, site is 612."""

    def __init__(self):
        self.rows: dict[str, list[dict]] = {name: [] for name in schemas.SOURCES}

    def add(self, table: str, **values) -> Clinic:
        if "Sta3n" in schemas.columns(table):
            values.setdefault("Sta3n", SITE)
        self.rows[table].append(values)
        return self

    def person(self, sid: int = 1, enrolled: bool = True, **values) -> Clinic:
        given = {"PatientName": f"PERSON,{sid}", "PatientSSN": f"000-{sid}", "Age": 40}
        given |= {"Gender": "F", "DeceasedFlag": "N"} | values
        self.add("patient", PatientSID=sid, **given)
        if enrolled:
            self.enroll(sid, "ENROLLED", Sta3n=values.get("Sta3n", SITE))
        return self

    def enroll(self, sid: int, category: str, Sta3n: int = SITE) -> Clinic:
        key = len(self.rows["enrollment_status"]) + 1
        self.add("enrollment_status", EnrollmentStatusSID=key, EnrollmentCategory=category, Sta3n=Sta3n)
        return self.add("enrollment", PatientSID=sid, EnrollmentStatusSID=key, Sta3n=Sta3n)

    def code(self, sid: int, category: str | None, name: str | None) -> Clinic:
        return self.add("cpt", CPTSID=sid, CPTCode=str(sid), CPTCategory=category, CPTName=name)

    def procedure(self, code: int, visit: int = 1, when: str = "2023-05-01 08:00:00", sid: int = 1, **more):
        return self.add(
            "v_procedure", PatientSID=sid, VisitSID=visit, CPTSID=code, VisitDateTime=ts(when), **more
        )

    def diagnosis(self, icd10: int, visit: int = 1, sid: int = 1, icd9: int | None = None) -> Clinic:
        self.add("icd10_description", ICD10SID=icd10, ICD10Description=f"D{icd10}")
        return self.add("v_diagnosis", PatientSID=sid, VisitSID=visit, ICD10SID=icd10, ICD9SID=icd9)

    def exam(
        self,
        result: str | None,
        visit: int = 1,
        when: str | None = "2023-05-01 08:00:00",
        cancel: int | None = 0,
    ) -> Clinic:
        key = len(self.rows["radiology_exam"]) + 1
        self.add("radiology_registered_exam", RadiologyRegisteredExamSID=key, ExamDateTime=ts(when))
        self.add(
            "radiology_diagnostic_code",
            RadiologyDiagnosticCodeSID=key,
            RadiologyDiagnosticCode=result,
        )
        return self.add(
            "radiology_exam",
            VisitSID=visit,
            RadiologyRegisteredExamSID=key,
            RadiologyDiagnosticCodeSID=key,
            RadiologyHoldCancelReasonSID=cancel,
        )

    def factor(self, kind: str | None, category: str | None, when="2023-05-01 08:00:00", sid=1, **more):
        key = len(self.rows["health_factor_type"]) + 1
        self.add(
            "health_factor_type",
            HealthFactorTypeSID=key,
            HealthFactorType=kind,
            HealthFactorCategory=category,
        )
        return self.add(
            "health_factor",
            PatientSID=sid,
            HealthFactorTypeSID=key,
            HealthFactorDateTime=ts(when),
            **more,
        )

    def lab(self, test: str, result: str | None, taken="2023-05-01 08:00:00", done=None, sid=1):
        key = len(self.rows["lab_chem_test"]) + 1
        self.add("lab_chem_test", LabChemTestSID=key, LabChemTestName=test)
        return self.add(
            "lab_chem",
            PatientSID=sid,
            LabChemTestSID=key,
            LabChemSpecimenDateTime=ts(taken),
            LabChemCompleteDateTime=ts(done or taken),
            LabChemResultValue=result,
        )

    def cyto(self, topography, sample="SMEAR", findings=(), taken="2023-05-01 08:00:00", received=None, sid=1):
        case = len(self.rows["cytopathology"]) + 1
        self.add(
            "cytopathology",
            PatientSID=sid,
            CytopathologyIEN=case,
            LabDataIEN=case,
            DateTimeSpecimenTaken=ts(taken),
            DateTimeSpecimenReceived=ts(received),
        )
        place = len(self.rows["topography"]) + 1
        self.add("topography", TopographyIEN=place, Topography=topography, SNOMEDCode=f"T-{place}")
        self.add(
            "cyto_specimen",
            CytopathologyIEN=case,
            LabDataIEN=case,
            CollectionSample=sample,
            TopographyFieldIEN=place,
        )
        for finding in findings:
            key = len(self.rows["morphology"]) + 1
            self.add("morphology", MorphologyIEN=key, Morphology=finding, SnomedCode=f"M-{key}")
            self.add(
                "cyto_organ_morphology", CytopathologyIEN=case, LabDataIEN=case, MorphologyFieldIEN=key
            )
        return self

    def surgery(self, specimen, number="ACC1", findings=(), taken="2023-05-01 08:00:00", received=None, sid=1):
        case = len(self.rows["surgical_pathology"]) + 1
        keys = {"SurgicalPathologyIEN": case, "LabDataIEN": case}
        self.add(
            "surgical_pathology",
            PatientSID=sid,
            SurgicalPathAccNumber=number,
            DateTimeSpecimenTaken=ts(taken),
            DateTimeSpecimenReceived=ts(received),
            **keys,
        )
        self.add("surg_specimen", Specimen=specimen, **keys)
        for finding in findings:
            key = len(self.rows["surg_morphology_field"]) + 1
            self.add("surg_morphology_field", MorphologyFieldIEN=key, SnomedCode=f"S-{key}")
            self.add("surg_morphology", MorphologyFieldIEN=key, MorphologyField=finding, **keys)
        return self

    def frame(self, spark, name: str):
        fields = [*schemas.struct(name).fields, *schemas.optional(name).fields]
        given = {c for r in self.rows[name] for c in r}
        kind = StructType([f for f in fields if f in schemas.struct(name).fields or f.name in given])
        data = [tuple(r.get(c) for c in kind.fieldNames()) for r in self.rows[name]]
        return spark.createDataFrame(data, kind).coalesce(1)

    def inputs(self, spark, spec=DEFAULT, sites=(SITE,), caseless=False, grain=FULL, **run) -> Inputs:
        run.setdefault("hot_rows", None)  # small data: no staging, no counting
        places = {name: partial(self.frame, spark, name) for name in self.rows}
        tables = Tables(spark, places, sites=sites, caseless=caseless)
        return Inputs(tables, Run.at(AS_OF, sites, **run), spec, grain)
