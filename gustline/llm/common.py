"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run without blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, of: Callable[[Column], Column], join: Callable[[Column, Column], Column], block: int = 512) -> Column:
    """array<struct<item, before>>: each item of ``values`` with the join of ``of`` over all before it.

    ``of`` gives whole numbers from 0 on, ``join`` is associative with 0 as its neutral value (a sum, a
    maximum). A fold that appends copies what it has at every step; so blocks are folded first, then
    the items of each block, which keeps the work nearly in proportion to the length.
    """
    zero = F.lit(0)

    def fold(items: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.slice(F.array(start), 1, 0).alias("out"))
        return F.aggregate(
            items, begin,
            lambda s, x: F.struct(join(s["at"], of(x)).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )

    def spread(items: Column) -> Column:
        count = F.floor((F.size(items) + block - 1) / block).cast("int")
        numbers = F.sequence(F.lit(1), F.greatest(count, F.lit(1)))
        blocks = F.transform(numbers, lambda b: F.slice(items, (b - 1) * block + 1, F.lit(block)))
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: join(a, of(x))))
        begin = F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out"))
        starts = F.aggregate(
            sums, begin, lambda s, x: F.struct(join(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )
        placed = F.transform(
            F.arrays_zip(blocks.alias("items"), starts.alias("start")),
            lambda z: F.arrays_zip(z["items"].alias("item"), fold(z["items"], z["start"]).alias("before")),
        )
        return F.flatten(placed)

    return bind(values, spread)


def each_copy(rows: DataFrame, n: str, copy: str, most: int = 4096) -> DataFrame:
    """One row for each of ``n`` copies, numbered from 0 in ``copy``.

    A row with very many copies is cut into parts of ``most``, which are dealt to all tasks.
    """
    begin, (part,) = F.lit(0).cast("long"), fresh("part")
    parts = rows.withColumn(part, F.explode(F.sequence(begin, F.floor((F.col(n) - 1) / most))))
    spread = parts.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    first = F.col(part) * most
    return spread.withColumn(copy, F.explode(F.sequence(first, F.least(first + most, F.col(n)) - 1))).drop(part)


def fresh(*names: str) -> list[str]:
    """Column names no input table carries, so extra columns can't clash with them."""
    mark = uuid.uuid4().hex[:8]
    return [f"_{name}_{mark}" for name in names]
