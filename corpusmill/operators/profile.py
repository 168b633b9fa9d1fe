"""Profiles of files from sampled pages, and which loader suits them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions.scratch import written
from corpusmill.functions.text import TABLE_PIPES, TABLE_TABS, occurrences, stripped

SAMPLE_PAGES = 5
#: Loaders in the order that breaks ties.
LOADERS = ("pypdf", "plumber", "pymupdf", "pdfminer", "unstructured")
DENSITY_LOW, DENSITY_HIGH = 0.05, 2.5


def sample_pages(pages: DataFrame) -> DataFrame:
    """Up to five pages of a file, evenly spaced; all of a file with at most five.

    pages: path, page_no (from 0), text. The pages of a file are counted, not gathered; the other columns stay. The counts, a
    row a file, are written first: where they are known to be small, no page moves to meet them.
    """
    counts = written(pages.groupBy(F.col("path").alias("_path")).agg(F.count("*").alias("_n")))
    step = F.greatest(F.floor(F.col("_n") / SAMPLE_PAGES), F.lit(1))
    sampled = pages.join(counts, pages["path"].eqNullSafe(counts["_path"]))
    return sampled.where((F.col("page_no") % step == 0) & (F.col("page_no") / step < SAMPLE_PAGES)).select(*pages.columns)


def profile_files(sampled: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """A1: measures of each file over its sampled pages.

    Returns path, n_sampled, has_tables, has_images, text_density, scanned_ratio (unrounded), density_4 and scanned_4
    (rounded to 4 places). files (path) adds files without pages, with zeros. Null texts count as empty.
    """
    t = F.coalesce("text", F.lit(""))
    measured = sampled.select("path", F.length(t).alias("len"), occurrences(t, "|").alias("pipes"), occurrences(t, "\t").alias("tabs"), F.contains(F.lower(t), F.lit("table")).alias("word"), (F.length(stripped(t)) < 20).alias("scanned"))
    sums = measured.groupBy("path").agg(
        F.count("*").alias("n_sampled"), F.sum("len").alias("chars"), F.sum("pipes").alias("pipes"), F.sum("tabs").alias("tabs"), F.bool_or("word").alias("word"), F.avg(F.col("scanned").cast("int")).alias("ratio")
    )
    if files is not None:
        sums = files.select("path").distinct().join(sums, "path", "left")
    n = F.coalesce("n_sampled", F.lit(0))
    density = F.when(n > 0, (F.col("chars") + n - 1) / n / 1000).otherwise(0.0)
    ratio = F.coalesce("ratio", F.lit(0.0))
    tables = F.coalesce(F.col("word") | (F.col("pipes") > TABLE_PIPES) | (F.col("tabs") > TABLE_TABS), F.lit(False))
    return sums.select(
        "path", n.cast("long").alias("n_sampled"), tables.alias("has_tables"), (ratio > 0.3).alias("has_images"), density.alias("text_density"), ratio.alias("scanned_ratio"),
        F.round(density, 4).alias("density_4"), F.round(ratio, 4).alias("scanned_4"),
    )


def loader_scores(density: Column, tables: Column, images: Column, scanned: Column) -> dict[str, Column]:
    """A2: the score of each loader, a sum of what speaks for it."""
    def points(*given: tuple[Column, float], base: float = 0.0) -> Column:
        total = F.lit(base)
        for when, n in given:
            total = total + F.when(when, n).otherwise(0.0)
        return total

    scan, dense, sparse = scanned > 0.5, density > DENSITY_HIGH, density < DENSITY_LOW
    plain = ~tables & ~images & density.between(DENSITY_LOW, DENSITY_HIGH)
    return {
        "pypdf": points((plain, 1.5), base=1.0),
        "plumber": points((tables, 2.0)),
        "pymupdf": points((tables, 0.5), (images, 2.0), (scan, 1.0), (dense, 1.0), (sparse, 1.5)),
        "pdfminer": points((dense, 2.0)),
        "unstructured": points((images, 1.0), (scan, 3.0), (sparse, 1.5)),
    }


def recommend_loader(profile: DataFrame, encrypted: Column | None = None) -> DataFrame:
    """A2: the profile with loader_scores and recommended_loader.

    Ties go to the earlier of LOADERS; an encrypted file always goes to unstructured. Unrounded measures count.
    """
    scores = loader_scores(F.col("text_density"), F.col("has_tables"), F.col("has_images"), F.col("scanned_ratio"))
    best = F.array_max(F.array(*(F.struct(scores[x].alias("score"), F.lit(-i).alias("place"), F.lit(x).alias("loader")) for i, x in enumerate(LOADERS))))["loader"]
    locked = F.coalesce(encrypted, F.lit(False)) if encrypted is not None else F.lit(False)
    return profile.withColumn("loader_scores", F.map_from_arrays(F.array(*map(F.lit, LOADERS)), F.array(*(scores[x] for x in LOADERS)))).withColumn(
        "recommended_loader", F.when(locked, "unstructured").otherwise(best)
    )


def first_page_loader(pages: DataFrame) -> DataFrame:
    """Path, density, has_tables, recommended_loader from the first page alone."""
    t = F.coalesce("text", F.lit(""))
    first = pages.where("page_no = 0").select("path", (F.length(t) / 1000).alias("density"), (F.contains(F.lower(t), F.lit("table")) | (occurrences(t, "|") > 10)).alias("has_tables"))
    loader = F.when(F.col("density") < 0.1, "unstructured").when(F.col("density") > 2.0, "pymupdf").when(F.col("has_tables"), "plumber").otherwise("pypdf")
    return first.withColumn("recommended_loader", loader)


def chunk_size_by_length(pages: DataFrame, limits: list[tuple[float, int]], otherwise: int) -> DataFrame:
    """Mean text length and a chunk size for it, in one row; limits are (mean below this, size) in rising order.

    An empty table has a null mean and the size `otherwise`.
    """
    size = F.lit(otherwise)
    for below, n in reversed(limits):
        size = F.when(F.col("mean_length") < below, n).otherwise(size)
    return pages.agg(F.avg(F.length(F.coalesce("text", F.lit("")))).alias("mean_length")).withColumn("chunk_size", size)
