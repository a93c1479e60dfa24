"""Chat formatting: logged conversations that are snapshots of longer ones collapse.

Chat logs often store a conversation again after each turn. Every prefix of every
conversation gets a rolling hash; a conversation whose whole hash is the hash of
a proper prefix of another is dropped by an anti-join, of equal ones the smallest
id stays, and the rest is rendered: ``rendered_parts`` in texts of bounded size, of which an
ordinary conversation has one, ``rendered`` as one text each. One value holds at most 2 GB, so
a conversation beyond that has parts only.

The rolling hash of the first i turns is the exclusive or of 2 x 64-bit hashes of
(place, role, text): adding a turn changes it by that turn alone, so it is a
running aggregate. Conversations are cut into slices by a range partitioning,
hashed slice by slice and carried on from slice to slice, so that a
conversation with a third of all turns does not meet in one task.

Defined results: turns are ordered by turn, role and text digest, nulls first.
Rows equal in conv_id, turn, role and text are one turn. Null role and text count
as values of their own and render as ``unknown`` and nothing. Rows without conv_id
belong to no conversation and take no part. Only the four columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.staging import staged

_ORDER = ("turn", "role", "digest")


def _turns(chats: DataFrame) -> DataFrame:
    known = chats.where(F.col("conv_id").isNotNull())
    return known.select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest")).distinct()


def _xor(name: str, window) -> Column:
    return F.coalesce(F.bit_xor(name).over(window), F.lit(0).cast("long"))


def prefix_hashes(chats: DataFrame) -> DataFrame:
    """A row per turn: its place from 1, and the hash of the turns up to it (h1, h2)."""
    spark = chats.sparkSession
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = _turns(chats).repartitionByRange(parts, F.col("conv_id"), *order)
    sliced = staged(sliced.withColumn("slice", F.spark_partition_id()), "chat-turns")

    # Places first: the rows of a conversation in earlier slices, then those before in the slice.
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n"))
    shifts = sizes.select("conv_id", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    within = Window.partitionBy("conv_id", "slice").orderBy(*order)
    placed = sliced.withColumn("row", F.row_number().over(within)).join(shifts, ["conv_id", "slice"])
    placed = placed.withColumn("place", F.col("shift") + F.col("row"))
    for k in (1, 2):
        parts_of_turn = [F.lit(k), "place", F.coalesce("role", F.lit("\0")), F.coalesce("digest", F.lit("\0"))]
        placed = placed.withColumn(f"t{k}", F.xxhash64(*parts_of_turn))

    sums = placed.groupBy("conv_id", "slice").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    carried = sums.select("conv_id", "slice", _xor("x1", earlier).alias("c1"), _xor("x2", earlier).alias("c2"))
    running = Window.partitionBy("conv_id", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(carried, ["conv_id", "slice"]).select(
        "conv_id",
        "place",
        F.col("c1").bitwiseXOR(F.bit_xor("t1").over(running)).alias("h1"),
        F.col("c2").bitwiseXOR(F.bit_xor("t2").over(running)).alias("h2"),
    )


def maximal(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns and copies (equal conversations) of those that no longer one begins with."""
    prefixes = staged(prefix_hashes(chats), "chat-prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    marked = prefixes.join(lengths, "conv_id")
    whole = (
        marked.where("place = n_turns")
        .groupBy("n_turns", "h1", "h2")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    )
    # Distinct before the join: a very common first turn is one row here.
    shorter = marked.where("place < n_turns").select(F.col("place").alias("n_turns"), "h1", "h2").distinct()
    return whole.join(shorter, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns", "copies")


def rendered_parts(
    chats: DataFrame, opening: str = "<|", closing: str = "|>", end: str = "<|end|>", part_bytes: int = 16 << 20
) -> DataFrame:
    """conv_id, n_turns, copies, part (from 0) and rendered of the maximal conversations: every
    turn is its role in marks, a line end, its text, the end mark and a line end. A turn that
    begins within the first ``part_bytes`` of its conversation is in part 0, and so on."""
    kept = staged(maximal(chats), "chat-kept")
    turn = F.concat(
        F.lit(opening),
        F.coalesce("role", F.lit("unknown")),
        F.lit(closing + "\n"),
        F.coalesce("text", F.lit("")),
        F.lit(end + "\n"),
    )
    of_kept = chats.join(kept.select("conv_id"), "conv_id", "left_semi")
    lines = of_kept.select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), turn.alias("line"))
    sizes = lines.groupBy("conv_id").agg(F.sum(F.octet_length("line")).alias("bytes"))
    long = staged(sizes.where(F.col("bytes") > part_bytes).select("conv_id"), "chat-long")
    if long.isEmpty():
        runs = lines.distinct().withColumn("part", F.lit(0).cast("long"))
    else:
        short = lines.join(long, "conv_id", "left_anti").distinct().withColumn("part", F.lit(0).cast("long"))
        runs = short.unionByName(_in_parts(lines.join(long, "conv_id", "left_semi").distinct(), part_bytes))
    # Structs are compared field by field, nulls first: the order of the turns.
    ordered = F.array_sort(F.collect_list(F.struct(*_ORDER, "line")))
    texts = runs.groupBy("conv_id", "part").agg(F.concat_ws("", F.transform(ordered, lambda x: x["line"])).alias("rendered"))
    return kept.join(texts, "conv_id").select(
        "conv_id", F.col("n_turns").cast("long"), F.col("copies").cast("long"), "part", "rendered"
    )


def _in_parts(lines: DataFrame, part_bytes: int) -> DataFrame:
    """``lines`` with their part, by the bytes before them: added up slice by slice, as the hashes are."""
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = lines.repartitionByRange(parts, F.col("conv_id"), *order)
    sliced = staged(sliced.withColumn("slice", F.spark_partition_id()), "chat-lines")
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv_id", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("conv_id", "slice").agg(F.sum(F.octet_length("line")).alias("n"))
    shifts = sizes.select("conv_id", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    before = F.col("shift") + F.coalesce(F.sum(F.octet_length("line")).over(within), F.lit(0))
    raw = sliced.join(shifts, ["conv_id", "slice"]).withColumn("raw", F.floor(before / part_bytes).cast("long"))
    # A turn longer than a part leaves numbers out: the parts there are count from 0.
    present = raw.select("conv_id", "raw").distinct()
    numbers = present.withColumn("part", F.row_number().over(Window.partitionBy("conv_id").orderBy("raw")).cast("long") - 1)
    return raw.join(numbers, ["conv_id", "raw"]).select("conv_id", *_ORDER, "line", "part")


def rendered(chats: DataFrame, opening: str = "<|", closing: str = "|>", end: str = "<|end|>") -> DataFrame:
    """The maximal conversations as one text each, put together from their parts."""
    parts = rendered_parts(chats, opening, closing, end)
    ordered = F.array_sort(F.collect_list(F.struct("part", "rendered")))
    whole = F.concat_ws("", F.transform(ordered, lambda x: x["rendered"])).alias("rendered")
    return parts.groupBy("conv_id", "n_turns", "copies").agg(whole)
