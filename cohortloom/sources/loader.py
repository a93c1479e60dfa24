"""Reading the source tables by logical name."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField

from cohortloom import schemas

# Case-insensitive comparison, as databases with a CI collation have it.
# Trailing blanks are trimmed at load because LIKE has no collation for them.
_CASELESS = "string collate UTF8_LCASE"

_REJECT = "table string, reasons array<struct<column string, value string, wanted string>>, row string"

Place = DataFrame | Callable[[], DataFrame] | str


class Tables(Mapping[str, DataFrame]):
    """The source tables of one build: typed, narrowed and limited to its sites.

    ``places`` maps a logical name to a DataFrame, a function making one, a path
    or a catalog table. Nothing is read before an action, and then only the
    columns a plan uses.

    A stored value that cannot be cast to its column's type ends the build. If ``tolerant``,
    its row is left out instead, of every plan alike, and ``rejects`` has it. Only
    columns stored under another type are tested; where there is none, nothing is.
    """

    def __init__(
        self,
        spark: SparkSession,
        places: Mapping[str, Place],
        sites: tuple[int, ...] | None = None,
        caseless: bool = False,
        format: str = "parquet",
        options: Mapping[str, str] | None = None,
        tolerant: bool = False,
    ):
        unknown = set(places) - set(schemas.SOURCES) - set(schemas.OPTIONAL_TABLES)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self._spark = spark
        self._places = dict(places)
        self._sites = sites
        self._caseless = caseless
        self._format = format
        self._options = dict(options or {})
        self._tolerant = tolerant
        self._opened: dict[str, DataFrame] = {}  # each read lists files and opens a footer

    @property
    def text_type(self) -> str:
        """The type text columns are compared in."""
        return _CASELESS if self._caseless else "string"

    @staticmethod
    def places_under(folder: str) -> dict[str, Place]:
        """All 24 tables as ``folder/<name>``."""
        return {n: f"{folder.rstrip('/')}/{n}" for n in schemas.SOURCES}

    def __iter__(self) -> Iterator[str]:
        return iter(self._places)

    def __len__(self) -> int:
        return len(self._places)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._typed(name)
        return self._opened[name]

    def _typed(self, name: str) -> DataFrame:
        df = self._frame(self._places[name])
        found = {f.name: f.dataType for f in df.schema.fields}
        extra = schemas.optional(name).fields
        doubtful = self._doubtful(name, found)
        if self._sites is not None and "Sta3n" in schemas.columns(name):
            df = df.where(site_is(self._sites, _read("Sta3n", doubtful)))
        for wanted in doubtful.values():
            df = df.where(~_broken(wanted))
        return df.selectExpr(
            *[self._column(f, found.get(f.name)) for f in schemas.struct(name).fields],
            *[self._column(f, found[f.name]) if f.name in found else _unknown(f) for f in extra],
        )

    def rejects(self, name: str) -> DataFrame:
        """The rows of ``name`` that are left out: the table, each column with its stored value and
        the type it should have, and the row as JSON. Of the build's sites, and of no
        readable site."""
        df = self._frame(self._places[name])
        doubtful = self._doubtful(name, {f.name: f.dataType for f in df.schema.fields})
        if not doubtful:
            return self._spark.createDataFrame([], _REJECT)
        if self._sites is not None and "Sta3n" in schemas.columns(name):
            ours = site_is(self._sites, _read("Sta3n", doubtful))
            df = df.where((ours | _broken(doubtful["Sta3n"])) if "Sta3n" in doubtful else ours)
        reasons = [
            F.when(
                _broken(wanted),
                F.struct(
                    F.lit(column).alias("column"),
                    F.col(column).cast("string").alias("value"),
                    F.lit(wanted.dataType.simpleString()).alias("wanted"),
                ),
            )
            for column, wanted in doubtful.items()
        ]
        return df.select(
            F.lit(name).alias("table"),
            F.filter(F.array(*reasons), lambda r: r.isNotNull()).alias("reasons"),
            F.to_json(F.struct("*")).alias("row"),
        ).where(F.size("reasons") > 0)

    def all_rejects(self) -> DataFrame:
        """``rejects`` of all tables."""
        return reduce(DataFrame.unionByName, [self.rejects(n) for n in self])

    def _doubtful(self, name: str, found: Mapping[str, DataType]) -> dict[str, StructField]:
        """The columns whose stored values may not be of the type they should have."""
        wanted = [*schemas.struct(name).fields, *schemas.optional(name).fields] if self._tolerant else []
        return {
            f.name: f
            for f in wanted
            if f.name in found and found[f.name] != f.dataType and not isinstance(f.dataType, StringType)
        }

    def _frame(self, place: Place) -> DataFrame:
        if isinstance(place, DataFrame):
            return place
        if callable(place):
            return place()
        if "/" in place:
            return self._spark.read.format(self._format).options(**self._options).load(place)
        return self._spark.table(place)

    def _column(self, wanted, found) -> str:
        name = wanted.name
        if self._caseless and isinstance(wanted.dataType, StringType):
            return f"CAST(rtrim({name}) AS {self.text_type}) AS {name}"
        if found == wanted.dataType:
            return name
        cast = "TRY_CAST" if self._tolerant else "CAST"
        return f"{cast}({name} AS {wanted.dataType.simpleString()}) AS {name}"


def _read(column: str, doubtful: Mapping[str, StructField]) -> Column:
    """The column as its type, NULL where it cannot be; as stored if its type is right."""
    return F.col(column).try_cast(doubtful[column].dataType) if column in doubtful else F.col(column)


def _broken(wanted: StructField) -> Column:
    stored = F.col(wanted.name)
    return stored.isNotNull() & stored.try_cast(wanted.dataType).isNull()


def _unknown(wanted) -> str:
    return f"CAST(NULL AS {wanted.dataType.simpleString()}) AS {wanted.name}"


def site_is(sites: tuple[int, ...], site: Column | None = None) -> Column:
    """Site filter on the stored column, so that partitions are pruned."""
    site = F.col("Sta3n") if site is None else site
    return site == sites[0] if len(sites) == 1 else site.isin(*sites)


def site_dimension(
    tables: Mapping[str, DataFrame], name: str, description: str, key: str
) -> DataFrame:
    """Description, key and site of one per-site dimension."""
    return tables[name].select(description, key, "Sta3n")
