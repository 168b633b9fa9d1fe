"""Row numbers within groups, without putting a whole group into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F


#: Steps that are summed together before sums of them are.
FAN = 1000


def numbered(df: DataFrame, keys: list[str], order: list[str], step: Column, number: str = "row_no", total: str | None = None, fan: int = FAN, lot: str | None = None) -> DataFrame:
    """Number the rows of each group from 0, and give the group's row count if `total` is named, a row's step if `lot` is.

    keys: the group (none: the whole table); nulls are a group. order: columns that order a group, unique in it. step: a whole
    number that never falls along that order, such as id div 10000: rows are numbered within (group, step) and shifted by the
    number of rows in the group's earlier steps, so that a group with a third of all rows is many small ones. Steps are summed
    the same way, within runs of `fan` steps first and then over the runs: a window sees fan steps, or one row for each fan steps.

    The rows move once: what a step is shifted by goes with them as a row of its own that heads the step.
    """
    at = df.withColumn("_step", step)
    heads = before(at.groupBy(*keys, "_step").agg(F.count("*").alias("_n")), keys, "_step", fan).withColumn("_head", F.lit(1))
    both = at.withColumn("_head", F.lit(0)).unionByName(heads, allowMissingColumns=True)
    ordered = W.partitionBy(*keys, "_step").orderBy(F.desc("_head"), *order)
    known = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = both.withColumns({"_row": F.row_number().over(ordered) - 2, "_shift": F.max("_before").over(known), "_all": F.max("_total").over(known)}).where("_head = 0")
    added = {number: F.col("_row") + F.col("_shift"), **({total: F.col("_all")} if total else {}), **({lot: F.col("_step")} if lot else {})}
    return inside.select(*df.columns, *(c.alias(n) for n, c in added.items()))


def before(steps: DataFrame, keys: list[str], step: str, fan: int = FAN) -> DataFrame:
    """keys, step, _before, _total: the rows of a group in its earlier steps and in all. steps: keys, step, _n, a row for each step of a group."""
    at = steps.withColumn("_run", F.floor(F.col(step) / fan))
    earlier = W.unboundedPreceding
    inner = W.partitionBy(*keys, "_run").orderBy(step).rowsBetween(earlier, -1)
    runs = at.groupBy(*keys, "_run").agg(F.sum("_n").alias("_n"))
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    summed = runs.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_run").alias("_r"),
        F.coalesce(F.sum("_n").over(group.orderBy("_run").rowsBetween(earlier, -1)), F.lit(0)).alias("_runs_before"), F.sum("_n").over(group).alias("_total"),
    )
    within = at.withColumn("_steps_before", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    placed = within.join(summed, same(within, summed, [*keys, "_run"], [*(f"_k{i}" for i in range(len(keys))), "_r"]))
    return placed.select(*keys, step, (F.col("_steps_before") + F.col("_runs_before")).alias("_before"), "_total")


def same(a: DataFrame, b: DataFrame, left: list[str], right: list[str]) -> Column:
    """Columns of a that equal columns of b; nulls are equal."""
    return reduce(Column.__and__, [a[x].eqNullSafe(b[y]) for x, y in zip(left, right, strict=True)])
