"""The report: events of eligible persons, aged, dated and de-duplicated."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import expressions as x
from cohortloom.functions import predicates as p
from cohortloom.operators import ranking, sizing, skew
from cohortloom.operators.joins import salted_join
from cohortloom.operators.staging import staged
from cohortloom.operators.unions import stacked
from cohortloom.plans import sections, streams

_SHOWN = ["label", "detail", "code1", "code2", "flag"]


def enrolled(inputs: streams.Inputs) -> DataFrame:
    """Enrollment rows with the enrolled status: site and person, repeats kept."""
    t, spec = inputs.tables, inputs.spec
    if spec.switches.enrollment != "any":
        return _enrolled_by_rule(inputs)
    status = (
        t["enrollment_status"]
        .where(F.col("EnrollmentCategory") == spec.enrolled_category)
        .select("EnrollmentStatusSID", "Sta3n")
    )
    return (
        t["enrollment"]
        .join(inputs.lookup("enrollment_status", status), ["EnrollmentStatusSID", "Sta3n"])
        .select("Sta3n", "PatientSID")
    )


def _enrolled_by_rule(inputs: streams.Inputs) -> DataFrame:
    """Persons whose every, or whose newest, enrollment row has the enrolled status. Of
    rows with one time an enrolled one is the newer; without any time, any row decides."""
    t, spec, keys = inputs.tables, inputs.spec, ["Sta3n", "PatientSID"]
    status = t["enrollment_status"].select("EnrollmentStatusSID", "Sta3n", "EnrollmentCategory").distinct()
    rows = t["enrollment"].join(
        inputs.lookup("enrollment_status", status), ["EnrollmentStatusSID", "Sta3n"], "left"
    )
    held = F.coalesce(F.col("EnrollmentCategory") == spec.enrolled_category, F.lit(False))
    if spec.switches.enrollment == "every":
        decided = F.bool_and(held)
    else:
        decided = F.max(F.struct("EnrollmentDateTime", held.alias("held")))["held"]
    return rows.groupBy(*keys).agg(decided.alias("held")).where("held").select(*keys)


def _in_region(inputs: streams.Inputs, persons: DataFrame) -> DataFrame:
    """``persons`` without those whose newest address has been out of the region for longer
    than the rule allows. Of addresses with one time, one in the region is the newer."""
    years = inputs.spec.switches.region_years
    if years is None:
        return persons
    keys = ["Sta3n", "PatientSID"]
    inside = F.coalesce("InRegion", F.lit(True)).alias("inside")
    newest = inputs.tables["address"].groupBy(*keys).agg(
        F.max(F.struct("ChangedDateTime", inside)).alias("newest")
    )
    long_ago = F.col("newest.ChangedDateTime") < x.cutoff(inputs.run.as_of, years)
    gone = newest.where(~F.col("newest.inside") & long_ago).select(*keys)
    return persons.join(gone, keys, "left_anti")


def eligible_persons(inputs: streams.Inputs, repeats: bool = False) -> DataFrame:
    """Persons the report may show. ``repeats`` gives a person once per
    enrolled row, which only a rank over the joined rows can notice."""
    spec = inputs.spec
    persons = inputs.tables["patient"].where(
        F.col("PatientName").isNotNull()
        & p.unlike(F.col("PatientName"), spec.test_person_pattern)
        & (F.col("Gender") == spec.gender)
        & p.other_than(F.col("DeceasedFlag"), spec.deceased_flag)
    )
    persons = _in_region(inputs, persons)
    keys = ["Sta3n", "PatientSID"]
    rows = enrolled(inputs)
    # Distinct before a semi-join: its map-side half removes a person's repeats
    # ahead of the shuffle, and the join reuses its partitioning.
    kept = (
        persons.join(rows, keys, "inner")
        if repeats
        else persons.join(rows.distinct(), keys, "left_semi")
    )
    return kept.select(
        *keys,
        F.col("PatientName").alias("person_name"),
        F.col("PatientSSN").alias("person_national_id"),
        F.col("Age").alias("age"),
    )


def _eligible(inputs: streams.Inputs) -> DataFrame:
    return eligible_persons(inputs) if inputs.eligible is None else inputs.eligible


def report(
    inputs: streams.Inputs,
    show_rank: bool = False,
    person_rank: bool = False,
    latest_only: bool = False,
) -> DataFrame:
    """The report rows, unordered and unique.

    Plain, it never computes a rank: the rank is not shown and the rows are
    distinct, so the streams are stacked at the thin grain and made distinct
    once, at the end. ``latest_only`` keeps each stream's newest event per
    person; ``show_rank`` and ``person_rank`` add rank columns. A person rank counts
    within a site, so it does not depend on which sites are built together.
    """
    if show_rank or person_rank or latest_only:
        if inputs.eligible is None:  # every stream and the names read them
            inputs = replace(inputs, eligible=staged(eligible_persons(inputs), "eligible-persons"))
        rows = _ranked_rows(inputs, show_rank or person_rank, person_rank, latest_only)
    else:
        day = replace(inputs, grain=streams.REPORT, persons=_eligible(inputs))
        # A row selected by two sections is the same report row.
        rows = stacked([streams.BUILDERS[n](day) for n in streams.present(inputs.spec)])

    extra = [c for c in ("recency",) if c in rows.columns]
    rows = _shown(inputs, rows, extra)
    if person_rank:
        order = ranking.ties(["recency", *schemas.REPORT_COLUMNS])
        rows = rows if inputs.run.hot_rows is None else staged(rows, "report-rows")
        rows = ranking.row_numbers(rows, ["site", "person_name"], order, "person_rank", inputs.run.hot_rows)
    if not show_rank:
        rows = rows.drop("recency")
    return rows.distinct()


def _ranked_rows(
    inputs: streams.Inputs, numbered: bool, repeats: bool, latest_only: bool
) -> DataFrame:
    """Ranked events with their person's columns. Ranks are per person, so
    leaving out other persons first does not change them; names come after, as
    a person listed twice must not be ranked twice."""
    # Distinct on the keys the semi-join is partitioned by: no further shuffle.
    keys = _eligible(inputs).select("Sta3n", "PatientSID").distinct()
    wanted = replace(inputs, persons=keys)
    if repeats:  # the person rank numbers unique events
        events = sections.all_events(wanted)
    else:  # the report is distinct in the end
        events = sections.ranked_events(wanted, latest_only and not numbered)
    if latest_only:
        events = events.where(F.col("recency") == 1)
    events = events if numbered else events.drop("recency")
    persons = eligible_persons(inputs, repeats=True) if repeats else _eligible(inputs)
    persons = persons.withColumnsRenamed({"Sta3n": "site", "PatientSID": "person_id"})
    if "eligible" in inputs.run.broadcast and not repeats:
        return events.join(F.broadcast(persons), ["site", "person_id"])
    persons = persons.hint("merge") if "eligible" in inputs.large else persons
    keys, spread_by = ["site", "person_id"], ["event_ts", *_SHOWN]
    if inputs.heavy is not None:
        return skew.sliced_join(events, persons, keys, inputs.heavy_persons(), spread_by)
    return salted_join(events, persons, keys, inputs.run.person_salts, spread_by)


def _shown(inputs: streams.Inputs, rows: DataFrame, extra: list[str]) -> DataFrame:
    """Report columns of the rows whose label may be shown."""
    return (
        rows.where(p.unlike(F.col("label"), inputs.spec.dropped_label_pattern))
        .withColumn("event_date", x.day(F.col("event_ts")))
        .withColumn("age_at_event", x.age_at(F.col("age"), F.col("event_date"), inputs.run.as_of))
        .select(*schemas.REPORT_COLUMNS, *extra)
    )


def ordered(rows: DataFrame) -> DataFrame:
    """By person name, newest first. The remaining columns follow as
    tie-breakers: the order is total, and equal names can be split over tasks."""
    rest = [c for c in rows.columns if c not in ("person_name", "event_date")]
    return rows.orderBy(
        F.col("person_name").asc_nulls_first(),
        F.col("event_date").desc_nulls_last(),
        *ranking.ties(rest),
    )


def client_names(rows: DataFrame) -> DataFrame:
    """The report under the column names existing report clients expect."""
    return rows.withColumnsRenamed(schemas.CLIENT_NAMES)


def limited(inputs: streams.Inputs, *, mark_persons: bool = False) -> streams.Inputs:
    """The inputs of a report, with the eligible persons staged, and of the procedures and specimens those
    that code sets select for these persons. With ``mark_persons`` the persons are broadcast too, where they are few.

    Diagnoses, exams, cases and morphologies that meet none of them, most of these tables, are dropped
    first: by a broadcast semi-join where the visits or cases are few, else by a Bloom filter before the
    shuffle of the semi-join. So are rows of other persons, where the persons are many."""
    inputs = replace(inputs, eligible=staged(eligible_persons(inputs), "eligible-persons"))
    sizes = sizing.measured({"eligible": inputs.eligible})
    small = sizing.broadcastable({}, sizes=sizes)
    if mark_persons:
        inputs = _marked(inputs, small)
    else:  # their join repeats them per salt
        salts = max(inputs.run.person_salts, 1)
        small = sizing.broadcastable({}, sizes={n: (salts * rows, salts * size) for n, (rows, size) in sizes.items()})
    if not small:
        inputs = _with_large(inputs, {"eligible": inputs.eligible}, sizes, filtered=True)
    persons = inputs.eligible.select("Sta3n", "PatientSID").distinct()
    found = replace(selected(replace(inputs, persons=persons), sizes), persons=None)
    return found if mark_persons else replace(found, run=replace(found.run, broadcast=found.run.broadcast - {"eligible"}))


def selected(inputs: streams.Inputs, sizes: Mapping[str, tuple[int, int]] | None = None) -> streams.Inputs:
    """The inputs with what code sets select staged: first of large dimensions, by which the facts are
    filtered, then of the facts, whose keys filter those that meet them. Staged sides are marked that are
    small enough to broadcast, the last ones together with those of ``sizes``."""
    inputs = streams.with_codes(inputs)
    cases = {f"{stream}_of_persons": rows for stream, rows in inputs.cases.items()}
    found = streams.with_selections(_fitted(inputs, {**inputs.codes, **cases}))
    keys = {f"{stream}_keys": rows for stream, rows in found.keys.items()}
    # The sides of the selection are done with: they count no more.
    others = replace(inputs.run, broadcast=inputs.run.broadcast - set(sizes or ()))
    return _fitted(replace(found, run=others), keys, sizes)


def _fitted(
    inputs: streams.Inputs,
    sides: Mapping[str, DataFrame],
    more: Mapping[str, tuple[int, int]] | None = None,
) -> streams.Inputs:
    """``inputs`` with ``sides``, staged, marked that are small enough, together with those of sizes ``more``.
    The others are sorted and filter what meets them: the session's Bloom filters are fitted to them, or
    where these would be too large for the driver, filters are staged."""
    sizes = sizing.measured(sides)
    small = sizing.broadcastable(sides, sizes={**(more or {}), **sizes})
    large = {name: side for name, side in sides.items() if name not in small}
    if large:
        rows, size = (max(sizes[name][i] for name in large) for i in (0, 1))
        session = inputs.tables["patient"].sparkSession
        for name, value in sizing.filter_settings(rows, size).items():
            session.conf.set(name, value)
        inputs = _with_large(inputs, large, sizes, filtered=not sizing.filterable(rows))
    if "eligible" in (more or {}) and not {"eligible"} & (small | inputs.large):  # too large with the others
        inputs = _with_large(inputs, {"eligible": inputs.eligible}, more, filtered=True)
    return _marked(inputs, small)


def _with_large(
    inputs: streams.Inputs, sides: Mapping[str, DataFrame], sizes: Mapping[str, tuple[int, int]], filtered: bool
) -> streams.Inputs:
    """``inputs`` with ``sides``, staged, marked as too large to broadcast; ``filtered``: with filters of their keys."""
    inputs = replace(inputs, large=inputs.large | sides.keys())
    return streams.with_filters(inputs, sides, {name: sizes[name][0] for name in sides}) if filtered else inputs


def sized(inputs: streams.Inputs, of_persons: bool = False) -> streams.Inputs:
    """The inputs with join sides measured: every dimension in one job, the
    eligible persons, which every stream joins, from a staged copy. Sides within
    the broadcast bounds are marked; a single station's persons usually are.

    What code sets select is staged too, and limits the facts that meet it (``selected``). ``of_persons`` is for
    reports and takes only what eligible persons can meet (``limited``). Last, the keys that hold many rows
    are looked for, and only those are split over tasks."""
    held = {n: inputs.tables[n] for n in schemas.DIMENSIONS if n in inputs.tables}
    inputs = _marked(inputs, sizing.broadcastable(held))
    if of_persons:
        return streams.with_heavy_keys(limited(inputs, mark_persons=True))
    inputs = replace(inputs, eligible=staged(eligible_persons(inputs), "eligible-persons"))
    return streams.with_heavy_keys(selected(inputs, sizing.measured({"eligible": inputs.eligible})))


def _marked(inputs: streams.Inputs, small: frozenset[str]) -> streams.Inputs:
    return replace(inputs, run=replace(inputs.run, broadcast=inputs.run.broadcast | small))
