"""What a report selects and how it flags it, stated as data.

Code sets, flag rules and corrections live here so that a station changes a
report by editing values, never by editing a plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class CodeSet:
    """Category in ``exact``, or category in ``guard`` and name like a pattern."""

    exact: tuple[str, ...] = ()
    guard: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()


@dataclass(frozen=True)
class TextSet:
    """One text column equal to a value in ``exact`` or like a pattern."""

    exact: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()


@dataclass(frozen=True)
class FlagRule:
    """First branch whose values hold the text gives its flag, else ``default``.

    With ``outside`` the one branch fires for texts that are *not* among its
    values; a NULL text then gives ``default``, as three-valued logic has it.
    """

    branches: tuple[tuple[tuple[str, ...], str], ...] = ()
    default: str | None = None
    outside: bool = False


@dataclass(frozen=True)
class Section:
    """One screening area: which rows of each event source belong to it."""

    name: str
    procedures: CodeSet | None = None
    exam_flags: FlagRule | None = None  # set: procedures count only with an exam result
    observations: CodeSet | None = None
    observation_flags: FlagRule = FlagRule()
    labs: TextSet | None = None
    lab_flags: FlagRule = FlagRule()
    topography: TextSet | None = None
    morphology_flags: FlagRule = FlagRule()
    specimens: TextSet | None = None

    @property
    def needs_exam(self) -> bool:
        return self.exam_flags is not None


@dataclass(frozen=True)
class Switches:
    """Corrections to inherited behaviour. All off by default: off means the
    report equals the one stations have today."""

    prefixed_values: bool = False  # accept factor codes with or without HFT/HFC prefix
    positive_only_for: tuple[str, ...] = ()  # lab names (patterns) that may be flagged
    surgical_newest_first: bool = False  # rank surgical specimens like the other streams
    rank_by_shown_time: bool = False  # rank by the event time the row shows
    lookback_all: bool = False  # apply the look-back to the event time of every stream
    keep_partial_labels: bool = False  # a missing half does not void a two-part label
    drop_missing_ids: bool = False  # visit ids <= 0 mean "unknown" and never join
    newest_description: bool = False  # of a diagnosis's description versions, the newest at the event
    enrollment: str = "any"  # enrolled by any row, by "every" row, or by the "newest" dated row
    states: tuple[str, ...] = ()  # flags that last: a person's newest event of each, from all years
    region_years: int | None = None  # persons who left the region longer ago are not shown

    def __post_init__(self):
        if self.enrollment not in ("any", "every", "newest"):
            raise ValueError(f"unknown rule of enrollment: {self.enrollment}")


@dataclass(frozen=True)
class ReportSpec:
    sections: tuple[Section, ...]
    lookback_years: int = 3
    enrolled_category: str = "ENROLLED"
    gender: str = "F"
    deceased_flag: str = "Y"
    test_person_pattern: str = "ZZ%"
    dropped_label_pattern: str = "%ORDER%"
    switches: Switches = Switches()

    def section(self, name: str) -> Section:
        return next(s for s in self.sections if s.name == name)

    def only(self, *names: str) -> ReportSpec:
        """The same report restricted to some sections."""
        return replace(self, sections=tuple(self.section(n) for n in names))

    def switched(self, **switches) -> ReportSpec:
        return replace(self, switches=replace(self.switches, **switches))


@dataclass(frozen=True)
class Run:
    """Arguments of one build: the sites, the moment the report speaks of, and
    the dimensions found small enough to broadcast (operators/sizing.py)."""

    as_of: dt.datetime
    sites: tuple[int, ...] | None = None  # None: every site in the tables
    broadcast: frozenset[str] = field(default_factory=frozenset)
    person_salts: int = 4  # where heavy persons were not looked for
    heavy_rows: int | None = 1_000_000  # a key with more rows is dealt to tasks; None: none is
    hot_rows: int | None = 5_000_000

    @staticmethod
    def at(as_of: dt.datetime | str, sites: Iterable[int] | None = None, **more) -> Run:
        moment = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        return Run(moment, None if sites is None else tuple(sites), **more)


# ---------------------------------------------------------------------------
# The code sets of the two screening areas.
# ---------------------------------------------------------------------------

_MORPHOLOGY_FLAGS = FlagRule(
    branches=(
        (
            (
                "INSUFFICIENT TISSUE FOR DIAGNOSIS",
                "NEGATIVE FOR MALIGNANT CELLS",
                "NO EVIDENCE OF MALIGNANCY",
                "NORMAL TISSUE MORPHOLOGY",
                "SUBOPTIMAL SPECIMEN",
                "UNSATISFACTORY SPECIMEN",
            ),
            "Y",
        ),
    ),
    outside=True,
)

BREAST = Section(
    name="breast",
    procedures=CodeSet(
        exact=("BREAST MAMMOGRAPHY",),
        guard=(
            "*Missing*",
            "CMS HOSPITAL OUTPATIENT PAYMENT SYSTEM",
            "DIAGNOSTIC RADIOLOGY (DIAGNOSTIC IMAGING)",
            "DIAGNOSTIC RADIOLOGY (DIAGNOSTIC IMAGING) MISCELLANEOUS",
            "DIAGNOSTIC SCREENING PROCESSES OR RESULTS",
            "DIAGNOSTIC ULTRASOUND",
            "FOLLOW-UP OR OTHER OUTCOMES",
            "INTEGUMENTARY SYSTEM",
            "PATIENT",
        ),
        patterns=("%BREAST%", "%MAMMO%", "%MAST%"),
    ),
    exam_flags=FlagRule(
        branches=(
            (
                (
                    "BI-RADS CATEGORY 0",
                    "BI-RADS CATEGORY 3",
                    "BI-RADS CATEGORY 4",
                    "BI-RADS CATEGORY 5",
                    "BI-RADS CATEGORY 6",
                    "MINOR ABNORMALITY",
                    "ABNORMALITY, ATTN. NEEDED",
                    "MAJOR ABNORMALITY, NO ATTN. NEEDED",
                    "MAJOR ABNORMALITY, PHYSICIAN AWARE",
                    "POSSIBLE MALIGNANCY, FOLLOW-UP NEEDED",
                    "UNSATISFACTORY/INCOMPLETE EXAM",
                    "Admin see case completion",
                    "Outside Report",
                ),
                "Y",
            ),
        ),
        default="N",
    ),
    observations=CodeSet(
        exact=("BREAST CANCER", "WH MAMMOGRAM"),
        guard=("CANCER SCREENING", "OUTSIDE RESULTS", "REMINDER FACTORS"),
        patterns=("%MAMMO%", "%BREAST%", "%MAST%"),
    ),
    observation_flags=FlagRule(
        branches=(
            (("HFT WH OUTSIDE ABNL MAMMOGRAM", "HFT WH OUTSIDE INCOMPLETE MAMMOGRAM"), "Y"),
            (("HFT WH BILATERAL MASTECTOMY",), "MASTECTOMY"),
        ),
    ),
    topography=TextSet(patterns=("%BREAST%",)),
    morphology_flags=_MORPHOLOGY_FLAGS,
    specimens=TextSet(patterns=("%BREAST%", "%MASTECTOMY%")),
)

CERVICAL = Section(
    name="cervical",
    procedures=CodeSet(
        exact=(
            "DIAGNOSTIC RADIOLOGY GYNECOLOGICAL AND OBSTETRICAL",
            "FEMALE GENITAL SYSTEM",
            "LAPAROSCOPY/PERITONEOSCOPY/HYSTEROSCOPY",
            "MATERNITY CARE AND DELIVERY",
            "OBSTETRIC",
        ),
        guard=(
            "*Missing*",
            "ANATOMIC PATHOLOGY",
            "CYTOPATHOLOGY",
            "DIAGNOSTIC RADIOLOGY (DIAGNOSTIC IMAGING)",
            "DIAGNOSTIC ULTRASOUND",
            "LOWER ABDOMEN",
            "PATIENT",
            "PERINEUM",
            "URINARY SYSTEM",
        ),
        patterns=(
            "%CERVI%",
            "%C/V%",
            "%FETAL%",
            "%FETUS%",
            "%GYN%",
            "%HPV%",
            "%HYST%",
            "OB %",
            "%PAP%",
            "TRANSVAGINAL%",
            "%UMBILICAL%",
            "%VAG%",
        ),
    ),
    observations=CodeSet(
        exact=("PAP RESULTS", "VA-HPV", "WH PAP SMEAR", "HFC MATERNITY CARE"),
        guard=("OUTSIDE RESULTS", "PROCEDURES", "REMINDER FACTORS"),
        patterns=("%CERVI%", "%GYN%", "%HPV%", "%HYST%", "%PAP%", "%VAG%"),
    ),
    observation_flags=FlagRule(
        branches=(
            (("OUTSIDE CERVICAL HPV TESTING POSITIVE",), "HPV POS"),
            (("WH HYSTERECTOMY W/CERVIX REMOVED",), "HYSTERECTOMY"),
            (("WH OUTSIDE ABNORMAL (ASCUS) PAP", "WH PAP SMEAR SCREEN FREQ - 6M"), "Y"),
        ),
    ),
    labs=TextSet(patterns=("%HPV%", "%PREGNANCY%")),
    lab_flags=FlagRule(branches=((("POS", "POSITIVE"), "HPV POS"),)),
    topography=TextSet(
        exact=("CERVIX", "PELVIC CAVITY", "PERINEUM", "VAGINA", "VAGINA AND CERVIX, CS"),
        patterns=("CERVICAL CYTOLOGIC MATERIAL", "FEMALE BREAST%", "%OVARY"),
    ),
    morphology_flags=_MORPHOLOGY_FLAGS,
    specimens=TextSet(
        patterns=(
            "%CERVIX%",
            "%CERVICAL%",
            "%VAGINA%",
            "%OVARY%",
            "%OVARIAN%",
            "%HYSTERECTOMY%",
        )
    ),
)

DEFAULT = ReportSpec(sections=(BREAST, CERVICAL))
