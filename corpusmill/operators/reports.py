"""Reports over logs of loaders, batches and stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from corpusmill.functions.text import percent
from corpusmill.operators.profile import LOADERS


def loader_stats(attempts: DataFrame) -> DataFrame:
    """A4: loader, success, failure, total, rate (text; N/A without attempts) from attempts (loader, ok). Null ok failed."""
    ok = F.coalesce("ok", F.lit(False))
    sums = attempts.groupBy("loader").agg(F.count_if(ok).alias("success"), F.count_if(~ok).alias("failure"), F.count("*").alias("total"))
    return sums.withColumn("rate", percent(F.col("success"), F.col("total")))


def batch_report(log: DataFrame) -> DataFrame:
    """A5: success, failed (any other status), total_chunks in one row; zeros for an empty log."""
    done = F.coalesce(F.col("status") == "success", F.lit(False))
    return log.agg(F.count_if(done).alias("success"), F.count_if(~done).alias("failed"), F.coalesce(F.sum("chunk_count"), F.lit(0)).cast("long").alias("total_chunks"))


def memory_heavy(log: DataFrame, limit_mb: float = 100.0) -> DataFrame:
    """A5: path, mem_delta_mb of the files whose memory grew by more than the limit."""
    return log.where(F.col("mem_delta_mb") > limit_mb).select("path", "mem_delta_mb")


#: Sums of decimals don't depend on the order of the rows; a value has 18 places and may go up to 1e20.
EXACT = "decimal(38,18)"


def sample_report(samples: DataFrame) -> DataFrame:
    """A10: run_id, peak, mean (1 place), net (last minus first by ts, 4 places). Null values don't count.

    The mean is that of the values as written in decimals, so a tie such as 54.35 goes up in any order of the rows. Runs with values
    that such decimals can't hold (not a number, infinite, too large) have the mean of the doubles.
    """
    exact, ts = F.col("value").try_cast(EXACT), F.when(F.col("value").isNotNull(), F.col("ts"))
    sums = samples.groupBy("run_id").agg(
        F.max("value").alias("peak"), F.try_sum(exact).alias("sum"), F.count(exact).alias("held"), F.count("value").alias("n"), F.avg("value").alias("avg"), (F.max_by("value", ts) - F.min_by("value", ts)).alias("net")
    )
    mean = F.when(F.col("held") == F.col("n"), F.round(F.try_divide(F.col("sum"), F.col("n").cast("decimal(20,0)")), 1).cast("double"))
    return sums.select("run_id", "peak", F.coalesce(mean, F.round("avg", 1)).alias("mean"), F.round("net", 4).alias("net"))


def stage_deltas(samples: DataFrame) -> DataFrame:
    """run_id, ts, value, delta (to the run's previous stage, null for the first), peak and net of the run.

    A run is a short series of stages, so a window over it is small.
    """
    run = W.partitionBy("run_id")
    ordered = run.orderBy("ts")
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return samples.select(
        "run_id", "ts", "value", F.round(F.col("value") - F.lag("value").over(ordered), 4).alias("delta"), F.max("value").over(run).alias("peak"),
        F.round(F.last("value").over(whole) - F.first("value").over(whole), 4).alias("net"),
    )


def first_success(attempts: DataFrame, recommended: DataFrame, loaders: tuple[str, ...] = LOADERS) -> DataFrame:
    """Path, loader_used, fallback_used, error_log from attempts (path, loader, ok, error) and the loader that each
    file is recommended (path, recommended_loader).

    The recommended loader comes first, then the others in their order. error_log: errors of loaders before the first
    success, or of all if none succeeded (then loader_used is null). Attempts are few for each file and loader.
    """
    others = F.array_remove(F.array(*map(F.lit, loaders)), F.col("recommended_loader"))
    order = recommended.select("path", "recommended_loader", F.concat(F.array("recommended_loader"), others).alias("order"))
    placed = attempts.join(order, "path").withColumn("place", F.array_position("order", F.col("loader"))).where("place > 0")
    once = placed.groupBy("path", "recommended_loader", "loader", "place").agg(F.bool_or(F.coalesce("ok", F.lit(False))).alias("ok"), F.min("error").alias("error"))
    sums = once.groupBy("path", "recommended_loader").agg(
        F.min(F.when(F.col("ok"), F.struct("place", "loader"))).alias("won"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("place", F.coalesce("error", F.lit("")).alias("error"))))).alias("lost")
    )
    errors = F.transform(F.filter("lost", lambda x: F.col("won").isNull() | (x["place"] < F.col("won.place"))), lambda x: x["error"])
    return sums.select("path", F.col("won.loader").alias("loader_used"), (F.coalesce(F.col("won.loader"), F.lit("")) != F.col("recommended_loader")).alias("fallback_used"), errors.alias("error_log"))
