"""Row numbers within groups, also where one group is most of the table.

A plain window puts each group into one task. That is right for ordinary
groups, but a single person (or an unknown-person id) can hold a third of all
rows. ``row_numbers`` counts the groups first. Groups up to ``hot_rows`` take the plain
window. Larger ones are range-partitioned by their full sort key, which cuts a
group into slices, numbered slice by slice and shifted by the sizes of the
slices before. Both ways give exactly the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from cohortloom.operators.staging import staged

_COPIES_PER_TASK_ROW = 10_000


def newest_first(ts: str) -> Column:
    return F.col(ts).desc_nulls_last()


def oldest_first(ts: str) -> Column:
    return F.col(ts).asc_nulls_first()


def ties(names: Sequence[str]) -> list[Column]:
    """Tie-breakers: every remaining column, so numbers are reproducible."""
    return [F.col(n).asc_nulls_first() for n in names]


def _collated(df: DataFrame) -> dict[str, DataType]:
    """Text columns compared by another rule than their bytes, with their types."""
    return {
        f.name: f.dataType
        for f in df.schema.fields
        if isinstance(f.dataType, StringType) and f.dataType != StringType()
    }


def _as_written(df: DataFrame) -> list[Column]:
    """Sort keys that tell spellings apart which compare as equal."""
    return [F.col(c).cast("string").asc_nulls_first() for c in _collated(df)]


def counted_copies(df: DataFrame, columns: Sequence[str], number: Column, name: str) -> DataFrame:
    """Distinct values of ``columns`` with the ``number`` of their copies. Only rows of the same
    spelling are copies: values that a collation calls equal are still rows of their own."""
    collated = {c: kind for c, kind in _collated(df).items() if c in columns}
    plain = df.withColumns({c: F.col(c).cast("string") for c in collated}) if collated else df
    counted = plain.groupBy(*columns).agg(number.alias(name))
    return counted.withColumns({c: F.col(c).cast(t) for c, t in collated.items()}) if collated else counted


def plain_row_numbers(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order, *_as_written(df))
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """Only number 1 of each group. Spark limits groups before the shuffle
    (WindowGroupLimit), so a hot group sends one row per input task."""
    return plain_row_numbers(df, group, order, name).where(F.col(name) == 1)


def row_numbers(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "recency",
    hot_rows: int | None = 5_000_000,
    copies: str | None = None,
) -> DataFrame:
    """``row_number()`` as a long column ``name``, exact for any group size.

    With ``copies``, a row stands for that many equal rows; each gets its own
    number and a row of its own. ``df`` is read several times: pass a scan or a
    ``staged`` frame, not a tree of joins. ``hot_rows=None`` skips all counting.
    """
    if hot_rows is None:
        return _within_task(df, group, order, name, copies, deal_out=False)

    # One job says whether a group is hot and whether copies have to be dealt out.
    number = F.lit(1) if copies is None else F.col(copies)
    counted = df.groupBy(*group).agg(F.sum(number).alias("_rows"), F.max(number).alias("_most"))
    largest = counted.agg(F.max("_rows").alias("rows"), F.max("_most").alias("most")).first()
    deal_out = (largest["most"] or 0) > _COPIES_PER_TASK_ROW
    if (largest["rows"] or 0) <= hot_rows:
        return _within_task(df, group, order, name, copies, deal_out)

    # At most total / hot_rows groups, copies counted: a proven bound for the broadcasts below.
    hot = staged(counted.where(F.col("_rows") > hot_rows).select(*group), "hot-groups")
    same = _same_group(group)
    cold_rows = df.alias("l").join(F.broadcast(hot).alias("r"), same, "left_anti")
    hot_side = df.alias("l").join(F.broadcast(hot).alias("r"), same, "left_semi")
    return _within_task(cold_rows, group, order, name, copies, deal_out).unionByName(
        _over_slices(hot_side, group, order, name, copies)
    )


def _within_task(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str,
    copies: str | None,
    deal_out: bool,
) -> DataFrame:
    """Each group in one task."""
    if copies is None:
        return plain_row_numbers(df, group, order, name)
    before = _rows_before(group, [*order, *_as_written(df)], copies)
    numbered = df.withColumn("_first", before + 1).withColumnRenamed(copies, "_copies")
    return _spread_copies(numbered, name, deal_out).select(*_without(df, copies), name)


def _rows_before(group: Sequence[str], order: Sequence[Column], copies: str) -> Column:
    window = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.sum(copies).over(window) - F.col(copies)


def _without(df: DataFrame, copies: str | None) -> list[str]:
    return [c for c in df.columns if c != copies]


def _has_many_copies(df: DataFrame, copies: str) -> bool:
    return not df.where(F.col(copies) > _COPIES_PER_TASK_ROW).isEmpty()


def _same_group(group: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in group:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return condition


def _over_slices(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, copies: str | None
) -> DataFrame:
    """Each group cut into slices by its sort key, one task per slice."""
    columns = _without(df, copies)
    keys = [F.col(k).asc_nulls_first() for k in group]
    order = [*order, *ties([c for c in columns if c not in group])]

    # Copies have one sort key and could not be cut apart: count them instead.
    number = F.count(F.lit(1)) if copies is None else F.sum(copies)
    unique = counted_copies(df, columns, number, "_copies")
    order = [*order, *_as_written(unique)]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = unique.repartitionByRange(parts, *keys, *order).withColumn(
        "_slice", F.spark_partition_id()
    )
    sliced = staged(sliced, "ranked-slices")
    local = sliced.withColumn("_before", _rows_before([*group, "_slice"], order, "_copies"))

    # One row per group and slice it touches: at most groups + slices rows.
    shifts = (
        sliced.groupBy(*group, "_slice")
        .agg(F.sum("_copies").alias("_rows"))
        .withColumn("_shift", _rows_before(group, [F.col("_slice")], "_rows"))
        .drop("_rows")
    )
    numbered = (
        local.alias("l")
        .join(F.broadcast(shifts).alias("r"), _same_group([*group, "_slice"]))
        .select("l.*", (F.col("r._shift") + F.col("l._before") + 1).alias("_first"))
    )
    spread = _spread_copies(numbered, name, _has_many_copies(sliced, "_copies"))
    return spread.select(*columns, name)


def _spread_copies(df: DataFrame, name: str, deal_out: bool) -> DataFrame:
    """One row per copy again, numbered on from ``_first``. To ``deal_out``,
    large counts are cut into chunks and the chunks go to all tasks, so no task
    writes all copies of one row."""
    step = F.lit(_COPIES_PER_TASK_ROW).cast("long")
    none, last = F.lit(0).cast("long"), F.col("_copies") - 1
    few = df.where(F.col("_copies") <= step) if deal_out else df
    spread = few.withColumn("_at", F.explode(F.sequence(none, last)))
    if deal_out:
        chunks = (
            df.where(F.col("_copies") > step)
            .withColumn("_from", F.explode(F.sequence(none, last, step)))
            .repartition("_from", "_first")
            .withColumn("_to", F.least(last, F.col("_from") + step - 1))
        )
        at = F.explode(F.sequence("_from", "_to"))
        spread = spread.unionByName(chunks.withColumn("_at", at).drop("_from", "_to"))
    return spread.withColumn(name, (F.col("_first") + F.col("_at")).cast("long"))
