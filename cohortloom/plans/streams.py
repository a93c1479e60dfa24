"""The event streams: coded procedures (with and without an exam result),
observations, cytology, surgical specimens and lab results.

Each builder reads its fact table once for all sections. Small dimensions are
classified first: a dimension row becomes one row per section that selects it,
already carrying label, code and flag, so a fact row only needs the lookup.

A stream can be built at several grains. The *thin* grain is for the report,
which is distinct and shows days: each side of a fan-out join is reduced to
its distinct values before the join. The joined size is then bounded by the
distinct report rows, also where one visit id holds a large part of both sides.
Ranks number every row of a fan-out. The *counted* grain joins distinct values
too, with the number of copies of each, and the rank spreads the copies out at
the very end. The *full* grain has one row per row of the joins.

A stream can also be limited to some persons. Their join comes before the
fan-out joins, on the few rows a code set selected, not on their products.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import expressions as x
from cohortloom.functions import predicates as p
from cohortloom.operators import ranking, skew
from cohortloom.operators.filters import KeyFilter, filter_of
from cohortloom.operators.joins import salted_join
from cohortloom.operators.staging import staged
from cohortloom.schemas import EVENT_COLUMNS
from cohortloom.sources.loader import Tables
from cohortloom.spec import ReportSpec, Run, Section

_PERSON = ["Sta3n", "PatientSID"]
_VISIT = ["Sta3n", "VisitSID"]
_PERSON_VISIT = [*_PERSON, "VisitSID"]
_CYTOLOGY_CASE = ["Sta3n", "CytopathologyIEN", "LabDataIEN"]
_SURGICAL_CASE = ["Sta3n", "SurgicalPathologyIEN", "LabDataIEN"]
_VALUES = ["event_ts", "label", "detail", "code1", "code2", "flag"]


@dataclass(frozen=True)
class Grain:
    thin: bool = False  # distinct values only
    counted: bool = False  # distinct values with their number of copies
    by_day: bool = False  # event times cut to dates

    def of(self, df: DataFrame, what: str) -> DataFrame:
        """One side, named ``what``, of a fan-out join at this grain."""
        if self.counted:
            return ranking.counted_copies(df, df.columns, F.count(F.lit(1)), f"{what}_copies")
        return df.distinct() if self.thin else df

    def when(self, ts: Column) -> Column:
        return x.day(ts) if self.by_day else ts


FULL = Grain()
COUNTED = Grain(counted=True)
THIN = Grain(thin=True)
REPORT = Grain(thin=True, by_day=True)


@dataclass(frozen=True)
class Inputs:
    tables: Tables
    run: Run
    spec: ReportSpec
    grain: Grain = FULL
    persons: DataFrame | None = None  # Sta3n, PatientSID and columns events then carry
    eligible: DataFrame | None = None  # the report's persons, if already computed
    selected: Mapping[str, DataFrame] = field(default_factory=dict)  # staged rows, see SELECTIONS
    keys: Mapping[str, DataFrame] = field(default_factory=dict)  # their keys by section, staged
    codes: Mapping[str, DataFrame] = field(default_factory=dict)  # staged rows of code dimensions, see CODES
    cases: Mapping[str, DataFrame] = field(default_factory=dict)  # staged case keys of the wanted persons
    heavy: Mapping[str, skew.Slices] | None = None  # see with_heavy_keys; None: not looked for
    large: frozenset[str] = frozenset()  # sides measured too large to broadcast
    filters: Mapping[str, KeyFilter] = field(default_factory=dict)  # of the keys of large sides, see with_filters

    @property
    def carried(self) -> list[str]:
        return [] if self.persons is None else self.persons.columns[len(_PERSON) :]

    def of_persons(self, df: DataFrame, stream: str, *spread_by: str) -> DataFrame:
        """``df``, rows of ``stream``, of the wanted persons. One person may hold much of ``df``;
        ``spread_by`` names the columns that tell that person's rows apart."""
        if self.persons is None:
            return df
        if "eligible" in self.run.broadcast:
            return df.join(F.broadcast(self.persons), _PERSON)
        df, persons = self.passing(df, "eligible"), self.lookup("eligible", self.persons)
        if self.heavy is not None:
            return skew.sliced_join(df, persons, _PERSON, self.slices(f"{stream}_persons"), spread_by)
        return salted_join(df, persons, _PERSON, self.run.person_salts, spread_by)

    def lookup(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, derived from dimension or staged side ``name``, as a join side: broadcast
        where that was measured small, sorted where it was measured large (Catalyst would go by its compressed
        file), else left to Catalyst and AQE."""
        if name in self.run.broadcast:
            return F.broadcast(df)
        return df.hint("merge") if name in self.large else df

    def passing(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` without most rows that meet none of side ``name``, where that has a filter."""
        return self.filters[name].passing(df) if name in self.filters else df

    def selection(self, stream: str, sections: Sequence[Section]) -> DataFrame:
        """What the code sets of ``sections`` select for ``stream``, as staged if it is."""
        if stream not in self.selected:
            return SELECTIONS[stream][0](self, sections)
        return self.selected[stream].where(F.col("section").isin([s.name for s in sections]))

    def coded(self, name: str, sections: Sequence[Section]) -> DataFrame:
        """Rows of dimension ``name`` in a code set of ``sections``, as a join side. Staged rows that are not
        broadcast are sorted, and read as the rows of these sections, as in ``met``."""
        if name not in self.codes:
            return self.lookup(name, CODES[name][0](self, sections))
        rows = self.codes[name].where(F.col("section").isin([s.name for s in sections]))
        return F.broadcast(rows) if name in self.run.broadcast else rows.hint("merge")

    def of_cases(self, df: DataFrame, stream: str) -> DataFrame:
        """``df`` of the wanted persons' cases, where those are staged; others are filtered out as in ``met``."""
        if stream not in self.cases:
            return df
        wanted = self.cases[stream].where(F.col("stream") == stream).drop("stream")
        df = self.passing(df, f"{stream}_of_persons")
        return df.join(self.lookup(f"{stream}_of_persons", wanted), SELECTIONS[stream][1], "left_semi")

    def slices(self, name: str) -> skew.Slices:
        """The heavy keys found under ``name``, if any were looked for."""
        return (self.heavy or {}).get(name, {})

    def heavy_persons(self) -> skew.Slices:
        """The persons that hold many rows of some stream, with slices for all streams together."""
        return skew.merged([s for name, s in (self.heavy or {}).items() if name.endswith("_persons")])

    def met(self, df: DataFrame, stream: str) -> DataFrame:
        """``df`` without rows that no selected row of ``stream`` can meet, where those are known
        ahead of the joins. Broadcast where the keys were measured small. Else ``df`` meets a
        Bloom filter of them, Catalyst's on its scan (sizing.filter_settings) or for many keys one of
        ``filters``, and only what passes is shuffled for the semi-join, which is exact. The keys are read as
        the rows of the sections wanted: Catalyst builds such filters only from a filtered scan."""
        if stream not in self.keys:
            return df
        keys = SELECTIONS[stream][1]
        names = [s.name for s in self.spec.sections if _NEEDS[stream](s)]
        wanted = self.keys[stream].where(F.col("section").isin(names)).select(*keys)
        df = self.passing(df, f"{stream}_keys")
        return df.join(self.lookup(f"{stream}_keys", wanted), keys, "left_semi")

    def of_visits(self, df: DataFrame) -> DataFrame:
        """``df`` of visits with a selected procedure, where those are known."""
        if self.spec.switches.drop_missing_ids:
            df = df.where(F.col("VisitSID") > 0)
        return self.met(df, "procedures")

    def recent(self, df: DataFrame, ts: Column) -> DataFrame:
        """The look-back on a stored time, where it applies to all streams."""
        if not self.spec.switches.lookback_all:
            return df
        return df.where(x.within_years(ts, self.run.as_of, self.spec.lookback_years))

    def rank_time(self, raw: Column, shown: Column) -> Column:
        return shown if self.spec.switches.rank_by_shown_time else raw


def classified(
    df: DataFrame,
    sections: Sequence[Section],
    selects: Callable[[Section], Column],
    **extra: Callable[[Section], Column],
) -> DataFrame:
    """One row per row of ``df`` and section selecting it, with column
    ``section`` and the ``extra`` columns as that section gives them."""
    hits = [
        F.when(
            selects(s),
            F.struct(F.lit(s.name).alias("section"), *[f(s).alias(n) for n, f in extra.items()]),
        )
        for s in sections
    ]
    kept = F.filter(F.array(*hits), lambda hit: hit.isNotNull())
    return (
        df.where(p.any_of([selects(s) for s in sections]))
        .withColumn("_hit", F.explode(kept))
        .select("*", "_hit.*")
        .drop("_hit")
    )


def by_section(sections: Sequence[Section], value: Callable[[Section], Column]) -> Column:
    """``value`` of the section each row belongs to."""
    if len(sections) == 1:
        return value(sections[0])
    result = F
    for s in sections:
        result = result.when(F.col("section") == s.name, value(s))
    return result


def _event(
    inputs: Inputs, df: DataFrame, rank_ts: Column, rank_key: Column | None = None
) -> DataFrame:
    def text(c: Column, name: str) -> Column:
        # One text type in all streams, also for columns that are always NULL.
        return c.cast(inputs.tables.text_type).alias(name)

    # Each row stands for all combinations of the copies of its sides; a side
    # a left join did not find counts once.
    counts = [F.coalesce(F.col(c), F.lit(1)) for c in df.columns if c.endswith("_copies")]
    copies = [reduce(lambda a, b: a * b, counts).cast("long").alias("copies")] if counts else []

    return df.select(
        "section",
        F.col("Sta3n").alias("site"),
        F.col("PatientSID").alias("person_id"),
        *inputs.carried,
        "event_ts",
        *[text(F.col(c), c) for c in ("label", "detail", "code1", "code2")],
        "flag",
        text(x.no_text() if rank_key is None else rank_key, "rank_key"),
        rank_ts.alias("rank_ts"),
        *copies,
    )


# --- coded procedures ------------------------------------------------------


def exam_results(inputs: Inputs) -> DataFrame:
    """Kept recent exams: site, visit and result text."""
    t, run, spec = inputs.tables, inputs.run, inputs.spec
    registered = (
        t["radiology_registered_exam"]
        .where(x.within_years(F.col("ExamDateTime"), run.as_of, spec.lookback_years))
        .select("RadiologyRegisteredExamSID", "Sta3n")
    )
    codes = inputs.lookup("radiology_diagnostic_code", t["radiology_diagnostic_code"])
    exams = (
        inputs.of_visits(t["radiology_exam"])
        .where(p.without_reason(F.col("RadiologyHoldCancelReasonSID")))
        .join(registered, ["RadiologyRegisteredExamSID", "Sta3n"])
        .join(codes, ["RadiologyDiagnosticCodeSID", "Sta3n"])
        .select("Sta3n", "VisitSID", F.col("RadiologyDiagnosticCode").alias("result"))
    )
    return inputs.grain.of(exams, "exam")


def diagnoses(inputs: Inputs) -> DataFrame:
    """Diagnosis ids per person and visit. Descriptions are looked up after the
    join with the few selected procedures, not for every diagnosis."""
    ids = inputs.tables["v_diagnosis"].select(
        "Sta3n", "PatientSID", "VisitSID", "ICD10SID", "ICD9SID"
    )
    return inputs.grain.of(inputs.of_visits(ids), "diagnosis")


def procedure_codes(inputs: Inputs, sections: Sequence[Section]) -> DataFrame:
    """Procedure ids in a section's code set, one row per section."""
    return classified(
        inputs.tables["cpt"],
        sections,
        lambda s: p.in_code_set(F.col("CPTCategory"), F.col("CPTName"), s.procedures),
        label=lambda s: x.labelled("CPT ", F.col("CPTName")),
        needs_exam=lambda s: F.lit(s.needs_exam),
    ).select("CPTSID", "Sta3n", "section", "label", "needs_exam")


def coded_procedures(inputs: Inputs, sections: Sequence[Section]) -> DataFrame:
    """Procedures in a section's code set, one row per section, with times as stored."""
    rows = inputs.recent(inputs.tables["v_procedure"], F.col("VisitDateTime"))
    return (
        inputs.passing(rows, "cpt")
        .join(inputs.coded("cpt", sections), ["CPTSID", "Sta3n"])
        .select(
            "section",
            "needs_exam",
            "Sta3n",
            "PatientSID",
            "VisitSID",
            F.col("VisitDateTime").alias("event_ts"),
            "label",
            # With an exam the result text is shown; comments would only keep
            # otherwise equal rows apart.
            F.when(~F.col("needs_exam"), F.col("Comments")).alias("comments"),
        )
    )


def selected_procedures(inputs: Inputs, sections: Sequence[Section]) -> DataFrame:
    """The coded procedures of the wanted persons."""
    rows = inputs.selection("procedures", sections)
    rows = rows.withColumn("event_ts", inputs.grain.when(F.col("event_ts")))
    rows = inputs.of_persons(rows, "procedures", "VisitSID", "event_ts", "label", "comments")
    return inputs.grain.of(rows, "procedure")


def described(inputs: Inputs, rows: DataFrame) -> DataFrame:
    """``rows`` of diagnosis ids with the descriptions, where there are any, as code1 and code2."""
    if inputs.spec.switches.newest_description:
        return _described_as_of(inputs, rows)
    icd10 = inputs.tables["icd10_description"].select("Sta3n", "ICD10SID", "ICD10Description")
    icd9 = inputs.tables["icd9_description"].select("Sta3n", "ICD9SID", "ICD9Description")
    return (
        rows.join(inputs.lookup("icd10_description", icd10), ["Sta3n", "ICD10SID"], "left")
        .join(inputs.lookup("icd9_description", icd9), ["Sta3n", "ICD9SID"], "left")
        .withColumn("code1", x.labelled("ICD10 ", F.col("ICD10Description")))
        .withColumn("code2", x.labelled("ICD9 ", F.col("ICD9Description")))
    )


def _described_as_of(inputs: Inputs, rows: DataFrame) -> DataFrame:
    """As ``described``, with one description per id: of its versions, the newest that was in effect
    on the day of the event; a version without a time always was. The versions of an id are one
    row, so the join keeps a row per row and is as broadcastable as the table was."""
    for name, key, text, code, prefix in (
        ("icd10_description", "ICD10SID", "ICD10Description", "code1", "ICD10 "),
        ("icd9_description", "ICD9SID", "ICD9Description", "code2", "ICD9 "),
    ):
        version = F.struct(x.day(F.col("EffectiveDateTime")).alias("since"), F.col(text).alias("text"))
        versions = inputs.tables[name].groupBy("Sta3n", key).agg(
            F.array_sort(F.collect_set(version)).alias("versions")  # those without a time first
        )
        day = x.day(F.col("event_ts"))
        known = F.filter("versions", lambda v: v["since"].isNull() | (v["since"] <= day))  # noqa: B023
        newest = F.get(known, F.size(known) - 1)["text"]
        rows = rows.join(inputs.lookup(name, versions), ["Sta3n", key], "left")
        rows = rows.withColumn(code, x.labelled(prefix, newest)).drop("versions")
    return rows


def procedures(inputs: Inputs) -> DataFrame:
    sections = [s for s in inputs.spec.sections if s.procedures]
    with_exam = [s for s in sections if s.needs_exam]
    rows = skew.sliced_join(
        selected_procedures(inputs, sections),
        diagnoses(inputs),
        _PERSON_VISIT,
        inputs.slices("procedures_person_visits"),
        ["event_ts", "label", "comments"],
        "left",
    )
    if with_exam:
        rows = _with_exam_results(inputs, rows, all_need=len(with_exam) == len(sections))
    else:
        rows = rows.withColumn("result", x.no_text())

    rows = (
        described(inputs, rows)
        .withColumn(
            "detail", F.when(F.col("needs_exam"), F.col("result")).otherwise(F.col("comments"))
        )
        .withColumn(
            "flag",
            by_section(
                sections,
                lambda s: p.flag(F.col("result"), s.exam_flags) if s.needs_exam else x.no_text(),
            ),
        )
    )
    return _event(inputs, rows, F.col("event_ts"))


def _with_exam_results(inputs: Inputs, rows: DataFrame, all_need: bool) -> DataFrame:
    """Exam results by visit. Rows that need none pass through the same join
    untouched, so procedures and diagnoses are read and joined once."""
    shown, results = rows.columns, exam_results(inputs)
    heavy, spread_by = inputs.slices("procedures_visits"), ["PatientSID", "event_ts", "label", "comments"]
    if all_need:
        return skew.sliced_join(rows, results, _VISIT, heavy, spread_by)
    found = [f"r.{c}" for c in results.columns if c not in _VISIT]
    rows, results, keys = skew.dealt(rows, results, _VISIT, heavy, spread_by)
    left, right = rows.alias("l"), results.withColumn("examined", F.lit(True)).alias("r")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    on = reduce(lambda a, b: a & b, same, F.col("l.needs_exam"))
    return (
        left.join(right, on, "left")
        .where(~F.col("l.needs_exam") | F.col("r.examined"))
        .select(*[f"l.{c}" for c in shown], *found)
    )


# --- observations and labs -------------------------------------------------


def observations(inputs: Inputs) -> DataFrame:
    """Coded observations, without those that are states, which are a stream of their own."""
    lasting = inputs.spec.switches.states
    types = _factor_types(inputs)
    if lasting:
        types = types.where(F.col("flag").isNull() | ~F.col("flag").isin(*lasting))
    rows = (
        inputs.recent(inputs.tables["health_factor"], F.col("HealthFactorDateTime"))
        .join(inputs.lookup("health_factor_type", types), "HealthFactorTypeSID")
        .withColumn("event_ts", inputs.grain.when(F.col("HealthFactorDateTime")))
        .withColumn("detail", F.col("Comments"))
        .withColumn("code2", x.no_text())
    )
    rows = inputs.of_persons(rows, "observations", "HealthFactorDateTime", "label", "detail")
    return _event(inputs, rows, F.col("HealthFactorDateTime"))


def states(inputs: Inputs) -> DataFrame:
    """A person's newest event of each lasting flag, over all years: from the full table where it is
    given, and whatever look-back the other streams have. Only the newest row of a person and
    state leaves a task, so a person with many costs no more."""
    t = inputs.tables
    types = _factor_types(inputs).where(F.col("flag").isin(*inputs.spec.switches.states))
    history = t["health_factor_history" if "health_factor_history" in t else "health_factor"]
    rows = history.join(inputs.lookup("health_factor_type", types), "HealthFactorTypeSID")
    shown = F.struct(F.col("HealthFactorDateTime").alias("at"), "label", F.col("Comments").alias("detail"), "code1")
    rows = (
        rows.groupBy("section", *_PERSON, "flag")
        .agg(F.max(shown).alias("newest"))
        .select("section", *_PERSON, "flag", "newest.*")
        .withColumn("event_ts", inputs.grain.when(F.col("at")))
        .withColumn("code2", x.no_text())
    )
    rows = inputs.of_persons(rows, "states", "at", "label", "detail")
    return _event(inputs, rows, F.col("at"), F.col("flag"))


def _factor_types(inputs: Inputs) -> DataFrame:
    """The observation types of each section: label, category and flag."""
    sections = [s for s in inputs.spec.sections if s.observations]
    kind, category = F.col("HealthFactorType"), F.col("HealthFactorCategory")
    label, code1 = x.labelled("HFT ", kind), x.labelled("HFC ", category)

    def selects(s: Section) -> Column:
        chosen = p.in_code_set(category, kind, s.observations)
        if inputs.spec.switches.prefixed_values:
            chosen = chosen | p.in_code_set(code1, kind, s.observations)
        return chosen

    def flagged(s: Section) -> Column:
        bare = p.flag(kind, s.observation_flags)
        if inputs.spec.switches.prefixed_values:
            return F.coalesce(bare, p.flag(label, s.observation_flags))
        return bare

    return classified(
        inputs.tables["health_factor_type"],
        sections,
        selects,
        label=lambda s: label,
        code1=lambda s: code1,
        flag=flagged,
    ).select("HealthFactorTypeSID", "section", "label", "code1", "flag")


def labs(inputs: Inputs) -> DataFrame:
    sections = [s for s in inputs.spec.sections if s.labs]
    name = F.col("LabChemTestName")
    flaggable = inputs.spec.switches.positive_only_for
    tests = classified(
        inputs.tables["lab_chem_test"],
        sections,
        lambda s: p.in_text_set(name, s.labs),
        label=lambda s: x.labelled("LAB ", name),
        flaggable=lambda s: p.like_any(name, flaggable) if flaggable else F.lit(True),
    )
    shown = F.col("LabChemSpecimenDateTime")
    rows = (
        inputs.recent(inputs.tables["lab_chem"], shown)
        .join(inputs.lookup("lab_chem_test", tests), "LabChemTestSID")
        .withColumn("event_ts", inputs.grain.when(shown))
        .withColumn("detail", F.col("LabChemResultValue"))
        .withColumn("code1", x.no_text())
        .withColumn("code2", x.no_text())
        .withColumn(
            "flag",
            F.when(
                F.col("flaggable"),
                by_section(sections, lambda s: p.flag(F.col("detail"), s.lab_flags)),
            ),
        )
    )
    raw = F.col("LabChemCompleteDateTime")
    rows = inputs.of_persons(rows, "labs", "LabChemSpecimenDateTime", "label", "detail")
    return _event(inputs, rows, inputs.rank_time(raw, shown), name)


# --- specimens -------------------------------------------------------------


def _taken_or_received() -> Column:
    return x.first_known(
        F.col("DateTimeSpecimenTaken"), F.col("DateTimeSpecimenReceived"), "timestamp_ntz"
    )


def _case_times(inputs: Inputs) -> list[Column]:
    """Shown time and rank time. The report needs no rank time, and without it
    more cases are equal."""
    shown = _taken_or_received()
    raw = inputs.rank_time(F.col("DateTimeSpecimenTaken"), shown)
    return [
        inputs.grain.when(shown).alias("event_ts"),
        (F.lit(None).cast("timestamp_ntz") if inputs.grain.by_day else raw).alias("rank_ts"),
    ]


def _of_case(
    inputs: Inputs, stream: str, cases: DataFrame, specimens: DataFrame, morphologies: DataFrame
) -> DataFrame:
    """Cases of the wanted persons with their specimens and morphologies. One unknown case
    may hold much of ``cases``."""
    keys, heavy = SELECTIONS[stream][1], inputs.slices(f"{stream}_cases")
    cases = inputs.met(cases, stream)
    rows = inputs.grain.of(inputs.of_persons(cases, stream, *keys[1:], "event_ts"), "case")
    rows = skew.sliced_join(rows, specimens, keys, heavy, ["PatientSID", "event_ts"])
    spread_by = ["PatientSID", "event_ts", *[c for c in specimens.columns if c not in keys]]
    return skew.sliced_join(rows, morphologies, keys, heavy, spread_by, "left")


def topographies(inputs: Inputs, sections: Sequence[Section]) -> DataFrame:
    """A section's topographies, one row per section."""
    return classified(
        inputs.tables["topography"],
        sections,
        lambda s: p.in_text_set(F.col("Topography"), s.topography),
        code1=lambda s: x.labelled("SNOMED ", F.col("SNOMEDCode")),
    ).select(F.col("TopographyIEN").alias("TopographyFieldIEN"), "Sta3n", "section", "Topography", "code1")


def cytology_specimens(inputs: Inputs, sections: Sequence[Section]) -> DataFrame:
    """Specimens taken from a section's topographies, one row per section."""
    partial = inputs.spec.switches.keep_partial_labels
    rows = inputs.passing(inputs.tables["cyto_specimen"], "topography")
    return (
        inputs.of_cases(rows, "cytology")
        .join(inputs.coded("topography", sections), ["TopographyFieldIEN", "Sta3n"])
        .select(
            *_CYTOLOGY_CASE,
            "section",
            "CollectionSample",
            x.pair(F.col("CollectionSample"), F.col("Topography"), partial).alias("label"),
            "code1",
        )
    )


def cytology(inputs: Inputs) -> DataFrame:
    t, spec, grain = inputs.tables, inputs.spec, inputs.grain
    sections = [s for s in spec.sections if s.topography]
    case = _CYTOLOGY_CASE

    specimens = grain.of(inputs.selection("cytology", sections), "specimen")
    found = t["morphology"].withColumnRenamed("MorphologyIEN", "MorphologyFieldIEN")
    morphologies = grain.of(
        inputs.met(t["cyto_organ_morphology"], "cytology")
        .join(inputs.lookup("morphology", found), ["MorphologyFieldIEN", "Sta3n"], "left")
        .select(
            *case,
            F.col("Morphology").alias("detail"),
            x.labelled("Morph ", F.col("SnomedCode")).alias("code2"),
        ),
        "morphology",
    )
    taken = inputs.recent(t["cytopathology"], _taken_or_received())
    cases = taken.select(*case, "PatientSID", *_case_times(inputs))
    rows = (
        _of_case(inputs, "cytology", cases, specimens, morphologies)
        .withColumn(
            "flag", by_section(sections, lambda s: p.flag(F.col("detail"), s.morphology_flags))
        )
    )
    return _event(inputs, rows, F.col("rank_ts"), F.col("CollectionSample"))


def surgical_specimens(inputs: Inputs, sections: Sequence[Section]) -> DataFrame:
    """Specimens with a section's names, one row per section."""
    return classified(
        inputs.of_cases(inputs.tables["surg_specimen"], "surgical"),
        sections,
        lambda s: p.in_text_set(F.col("Specimen"), s.specimens),
    )


def surgical(inputs: Inputs) -> DataFrame:
    t, spec, grain = inputs.tables, inputs.spec, inputs.grain
    sections = [s for s in spec.sections if s.specimens]
    case = _SURGICAL_CASE

    specimens = grain.of(inputs.selection("surgical", sections), "specimen")
    fields = t["surg_morphology_field"]
    morphologies = grain.of(
        inputs.met(t["surg_morphology"], "surgical")
        .join(
            inputs.lookup("surg_morphology_field", fields), ["MorphologyFieldIEN", "Sta3n"], "left"
        )
        .select(
            *case,
            F.col("MorphologyField").alias("detail"),
            x.labelled("SNOMED ", F.col("SnomedCode")).alias("code1"),
        ),
        "morphology",
    )
    taken = inputs.recent(t["surgical_pathology"], _taken_or_received())
    cases = taken.select(*case, "PatientSID", "SurgicalPathAccNumber", *_case_times(inputs))
    rows = (
        _of_case(inputs, "surgical", cases, specimens, morphologies)
        .withColumn(
            "label",
            x.pair(
                F.col("SurgicalPathAccNumber"),
                F.col("Specimen"),
                spec.switches.keep_partial_labels,
            ),
        )
        .withColumn("code2", x.no_text())
        .withColumn("flag", x.no_text())
    )
    return _event(inputs, rows, F.col("rank_ts"), F.col("Specimen"))


# --- ranks -----------------------------------------------------------------

BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {
    "procedures": procedures,
    "observations": observations,
    "labs": labs,
    "cytology": cytology,
    "surgical": surgical,
    "states": states,
}

_NEEDS: dict[str, Callable[[Section], object]] = {
    "procedures": lambda s: s.procedures,
    "observations": lambda s: s.observations,
    "labs": lambda s: s.labs,
    "cytology": lambda s: s.topography,
    "surgical": lambda s: s.specimens,
    "states": lambda s: s.observations,
}


#: Streams with fan-out joins: the rows their code sets select, and the keys other facts meet them by.
SELECTIONS: dict[str, tuple[Callable[[Inputs, Sequence[Section]], DataFrame], list[str]]] = {
    "procedures": (coded_procedures, _VISIT),
    "cytology": (cytology_specimens, _CYTOLOGY_CASE),
    "surgical": (surgical_specimens, _SURGICAL_CASE),
}

#: The facts that say whose a case is.
_CASES = {"cytology": "cytopathology", "surgical": "surgical_pathology"}

#: Dimensions that may be large, whose rows a code set selects, and the stream they are of.
CODES: dict[str, tuple[Callable[[Inputs, Sequence[Section]], DataFrame], str]] = {
    "cpt": (procedure_codes, "procedures"),
    "topography": (topographies, "cytology"),
}


#: Staged sides of joins, and the keys they are met by.
SIDES: dict[str, list[str]] = {
    "eligible": _PERSON,
    "cpt": ["CPTSID", "Sta3n"],
    "topography": ["TopographyFieldIEN", "Sta3n"],
    **{f"{stream}_keys": keys for stream, (_, keys) in SELECTIONS.items()},
    **{f"{stream}_of_persons": SELECTIONS[stream][1] for stream in _CASES},
}


def with_filters(inputs: Inputs, sides: Mapping[str, DataFrame], rows: Mapping[str, int]) -> Inputs:
    """The inputs with a filter of the keys of each of ``sides``, which have so many ``rows``."""
    found = {name: filter_of(side, SIDES[name], rows[name], f"filter-{name}") for name, side in sides.items()}
    return replace(inputs, filters={**inputs.filters, **{name: f for name, f in found.items() if f}})


def with_codes(inputs: Inputs) -> Inputs:
    """The inputs with the selected rows of dimensions staged that are not broadcast, and the case keys of
    the wanted persons."""
    codes, cases = {}, {}
    for name, (select, stream) in CODES.items():
        sections = [s for s in inputs.spec.sections if _NEEDS[stream](s)]
        if sections and name not in inputs.run.broadcast:
            codes[name] = staged(select(inputs, sections), f"codes-{name}")
    for stream, fact in _CASES.items():
        if inputs.persons is not None and stream in present(inputs.spec):
            keys = SELECTIONS[stream][1]
            held = inputs.tables[fact].select(*_PERSON, *keys[1:])
            held = inputs.of_persons(held, stream, *keys[1:]).select(*keys).distinct()
            cases[stream] = staged(held.withColumn("stream", F.lit(stream)), f"cases-{stream}")
    return replace(inputs, codes=codes, cases=cases)


def with_selections(inputs: Inputs) -> Inputs:
    """The inputs with the selected rows staged, and the distinct keys of them: their facts
    are read once, here. Where ``inputs`` are limited to some persons, so are the selected rows:
    procedures by their person, specimens by the cases of these persons."""
    found, met = {}, {}
    for stream, (select, keys) in SELECTIONS.items():
        sections = [s for s in inputs.spec.sections if _NEEDS[stream](s)]
        if sections:
            rows = select(inputs, sections)
            if stream not in _CASES:
                rows = inputs.of_persons(rows, stream, "VisitSID", "event_ts", "label", "comments")
            found[stream] = staged(rows, f"selected-{stream}")
            met[stream] = staged(found[stream].select("section", *keys).distinct(), f"keys-{stream}")
    return replace(inputs, selected=found, keys=met)


def with_heavy_keys(inputs: Inputs) -> Inputs:
    """The inputs with the visits, cases and persons that hold more than ``Run.heavy_rows`` rows
    of a fact. Reads only the key columns; persons are counted only if they join by shuffle."""
    rows_each = inputs.run.heavy_rows
    if rows_each is None:
        return inputs
    t, streams = inputs.tables, present(inputs.spec)
    kinds = {
        "procedures": (
            inputs.selected.get("procedures"),
            {"procedures_visits": _VISIT, "procedures_person_visits": _PERSON_VISIT},
        ),
        "observations": (t["health_factor"], {}),
        "labs": (t["lab_chem"], {}),
        "cytology": (t["cytopathology"], {"cytology_cases": _CYTOLOGY_CASE}),
        "surgical": (t["surgical_pathology"], {"surgical_cases": _SURGICAL_CASE}),
    }
    frames = []
    for stream, (df, keys) in kinds.items():
        if "eligible" not in inputs.run.broadcast:
            keys = {**keys, f"{stream}_persons": _PERSON}
        if stream in streams and keys and df is not None:
            frames.append((df, keys))
    return replace(inputs, heavy=skew.heavy_keys(frames, rows_each))


def present(spec: ReportSpec) -> list[str]:
    """Streams that at least one section of ``spec`` selects from."""
    found = [n for n, needs in _NEEDS.items() if any(needs(s) for s in spec.sections)]
    return found if spec.switches.states else [n for n in found if n != "states"]


def ranked(inputs: Inputs, stream: str, latest_only: bool = False) -> DataFrame:
    """One stream in the event shape, preceded by its section, with recency
    ranks per section, site, person and (where the stream has one) rank key."""
    group = ["section", "site", "person_id", "rank_key"]
    oldest = stream == "surgical" and not inputs.spec.switches.surgical_newest_first
    time = ranking.oldest_first("rank_ts") if oldest else ranking.newest_first("rank_ts")
    order = [time, *ranking.ties(_VALUES)]
    if latest_only:  # copies of the newest event do not matter
        events = BUILDERS[stream](replace(inputs, grain=THIN))
        numbered = ranking.first_rows(events, group, order, "recency")
    else:
        events = BUILDERS[stream](replace(inputs, grain=COUNTED))
        # The joins run once; counting and numbering read the staged rows.
        rows = events if inputs.run.hot_rows is None else staged(events, stream)
        copies = "copies" if "copies" in rows.columns else None
        numbered = ranking.row_numbers(rows, group, order, "recency", inputs.run.hot_rows, copies)
    return numbered.select("section", *EVENT_COLUMNS)
