"""Chunks and what is known of their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Characters beyond which a chunk counts as too large.
OVERSIZED = 4000


def normalize_metadata(raw: DataFrame) -> DataFrame:
    """S3: path and seven trimmed strings from a map `meta`; missing keys, null and a null map give empty strings."""
    keys = {"title": "/Title", "author": "/Author", "subject": "/Subject", "creator": "/Creator", "producer": "/Producer", "creation_date": "/CreationDate", "modification_date": "/ModDate"}
    return raw.select("path", *(F.coalesce(F.btrim(F.col("meta")[key]), F.lit("")).alias(name) for name, key in keys.items()))


def join_metadata(chunks: DataFrame, meta: DataFrame) -> DataFrame:
    """Chunks with the metadata row of their file, nulls where there is none.

    Spark broadcasts the metadata where it is known to be small and else joins by shuffles, whose hot paths it can split.
    """
    return chunks.join(meta, "path", "left")


def stamp_metadata(chunks: DataFrame, meta: DataFrame) -> DataFrame:
    """Source, pdf_title, pdf_author, pdf_pages, pdf_file_size on every chunk; values that a chunk has win.

    meta: path, title, author, page_count, file_size_kb.
    """
    new = meta.select("path", F.col("path").alias("_source"), F.col("title").alias("_pdf_title"), F.col("author").alias("_pdf_author"), F.col("page_count").alias("_pdf_pages"), F.col("file_size_kb").alias("_pdf_file_size"))
    joined = join_metadata(chunks, new)
    empty = {"source": F.col("path"), "pdf_title": F.lit(""), "pdf_author": F.lit(""), "pdf_pages": F.lit(0), "pdf_file_size": F.lit(0.0)}
    own = [c for c in chunks.columns if c not in empty]
    return joined.select(*own, *(F.coalesce(*([chunks[c]] if c in chunks.columns else []), F.col(f"_{c}"), default).alias(c) for c, default in empty.items()))


def split_report(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """A3: path, result_count, avg_size (one place), min_size, max_size, oversized; zeros for files without chunks."""
    n = F.length("text")
    sums = chunks.groupBy("path").agg(F.count("*").alias("n"), F.avg(n).alias("avg"), F.min(n).alias("lo"), F.max(n).alias("hi"), F.count_if(n > OVERSIZED).alias("big"))
    zero = F.lit(0).cast("long")
    return files.select("path").distinct().join(sums, "path", "left").select(
        "path", F.coalesce("n", zero).alias("result_count"), F.coalesce(F.round("avg", 1), F.lit(0.0)).alias("avg_size"), F.coalesce(F.col("lo").cast("long"), zero).alias("min_size"),
        F.coalesce(F.col("hi").cast("long"), zero).alias("max_size"), F.coalesce("big", zero).alias("oversized"),
    )


def collect_chunks(results: DataFrame, chunks: DataFrame) -> DataFrame:
    """The chunks of the files whose status (path, status) is success."""
    done = results.where("status = 'success'").select("path").distinct()
    return chunks.join(done, "path", "left_semi")
