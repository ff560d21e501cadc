"""Running state over ordered lines of a document, in two levels.

A document may be far larger than the rest, so its lines are cut into blocks. State is first run
inside each block, then over one summary row for each block, and the two are put together; no task
ever has to walk a whole document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hustings.operators.groups import attach

BLOCK = 4096


def with_block(df: DataFrame, line: str, size: int = BLOCK, out: str = "block") -> DataFrame:
    """Block number of a line in documents whose lines are numbered throughout."""
    return df.withColumn(out, F.floor(F.col(line) / F.lit(size)).cast("bigint"))


def running(df: DataFrame, doc: Sequence[str], block: str, line: str,
            last: Mapping[str, Column] | None = None,
            total: Mapping[str, Column] | None = None) -> DataFrame:
    """Adds running columns along ``(block, line)`` within each document.

    ``last``: the latest non-null value up to and including the row. ``total``: the sum up to and
    including the row.
    """
    last, total = dict(last or {}), dict(total or {})
    part = [*doc, block]
    named = {f"__last_{k}": c for k, c in last.items()} | {f"__sum_{k}": c for k, c in total.items()}
    base = df.withColumns(named)
    summary = base.groupBy(*part).agg(
        *[F.max_by(f"__last_{k}", F.when(F.col(f"__last_{k}").isNotNull(), F.col(line)))
          .alias(f"__b_{k}") for k in last],
        *[F.sum(f"__sum_{k}").alias(f"__b_{k}") for k in total])
    before = Window.partitionBy(*doc).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *part,
        *[F.last(f"__b_{k}", ignorenulls=True).over(before).alias(f"__c_{k}") for k in last],
        *[F.sum(f"__b_{k}").over(before).alias(f"__c_{k}") for k in total])
    inside = _first_in_block(part, line).rowsBetween(Window.unboundedPreceding, 0)
    local = _led_by(base, carried).withColumns(
        {f"__in_{k}": F.last(f"__last_{k}", ignorenulls=True).over(inside) for k in last}
        | {f"__in_{k}": F.sum(f"__sum_{k}").over(inside) for k in total}
        | {f"__c_{k}": F.last(f"__c_{k}", ignorenulls=True).over(inside) for k in [*last, *total]})
    done = local.filter("__line").withColumns(
        {k: F.coalesce(F.col(f"__in_{k}"), F.col(f"__c_{k}")) for k in last}
        | {k: F.coalesce(F.col(f"__in_{k}"), F.lit(0)) + F.coalesce(F.col(f"__c_{k}"), F.lit(0))
           for k in total})
    return done.select(*[c for c in df.columns if c not in last and c not in total], *last, *total)


def _led_by(lines: DataFrame, carried: DataFrame) -> DataFrame:
    """The lines, and for each block a row that leads it with what the blocks before bring. The lines
    travel once, with that row; a join would deal them out a second time. ``__line`` tells them apart."""
    return lines.withColumn("__line", F.lit(True)).unionByName(
        carried.withColumn("__line", F.lit(False)), allowMissingColumns=True)


def _first_in_block(part: Sequence[str], line: str) -> WindowSpec:
    return Window.partitionBy(*part).orderBy("__line", line)


def previous(df: DataFrame, doc: Sequence[str], block: str, line: str,
             columns: Mapping[str, str], around: bool = False) -> DataFrame:
    """Adds, under new names, the column values of the line before; null on a first line.

    With ``around`` the values of the document's last line stand where there are none. Lines travel
    with their own columns only; what the blocks before bring is in the row that leads a block.
    """
    part = [*doc, block]
    row = F.struct(*columns)
    last = [F.max_by(row, F.struct(line)).alias("__tail")] if around else []
    ends = df.groupBy(*part).agg(F.max_by(row, F.col(line)).alias("__end"), *last)
    before = Window.partitionBy(*doc).orderBy(block)
    whole = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tail = [F.last("__tail").over(whole).alias("__tail")] if around else []
    carried = ends.select(*part, F.lag("__end").over(before).alias("__row"), *tail)
    inside = _first_in_block(part, line)
    led = {"__was": F.lag("__line").over(inside), "__row": F.lag("__row").over(inside)} \
        | {f"__p_{c}": F.lag(c).over(inside) for c in columns}
    if around:
        led["__tail"] = F.first("__tail").over(inside.rowsBetween(Window.unboundedPreceding, 0))

    def value(c: str) -> Column:
        p = F.when(F.col("__was"), F.col(f"__p_{c}")).otherwise(F.col("__row")[c])
        return F.coalesce(p, F.col("__tail")[c]) if around else p
    return _led_by(df, carried).withColumns(led).filter("__line").select(
        *df.columns, *[value(c).alias(new) for c, new in columns.items()])


def following(df: DataFrame, doc: Sequence[str], seq: str, value: str, steps: Sequence[int],
              out: str = "next", size: int = 256) -> DataFrame:
    """Values of the lines 1, 2, ... places later, at most ``size``.

    ``seq`` numbers the lines of a document without gaps. Lines are cut into blocks of ``size``; what
    is not in a line's own block is among the first lines of the next, one row for each block.
    """
    most = max(steps)
    if most > size:
        raise ValueError("a step may not pass over a whole block")
    cut = df.withColumns({"__b": F.floor(F.col(seq) / size), "__o": (F.col(seq) % size).cast("int")})
    heads = cut.filter(F.col("__o") < most).groupBy(*doc, (F.col("__b") - 1).alias("__b")).agg(
        F.sort_array(F.collect_list(F.struct("__o", F.col(value).alias("v")))).alias("__heads"))
    inside = Window.partitionBy(*doc, "__b").orderBy(seq)
    led = cut.withColumns({f"__in_{k}": F.lead(value, k).over(inside) for k in steps})
    joined = attach(led, heads, [*doc, "__b"])
    return joined.select(*df.columns, *[
        F.when(F.col("__o") + k < size, F.col(f"__in_{k}"))
        .otherwise(F.get("__heads", F.col("__o") + (k - size))["v"]).alias(f"{out}_{k}") for k in steps])


def split_lines(df: DataFrame, doc: str, text: str, line: str = "line_no",
                out: str = "text") -> DataFrame:
    """One row for each line of each whole text, numbered from 0."""
    return df.select(doc, F.posexplode(F.split(F.col(text), "\n")).alias(line, out))
