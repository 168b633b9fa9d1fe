"""Which chunking strategy a file takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values, for Java regular expressions with Python's meaning of ^, $, . and \s: headers, tables and code fences.
SECTION_PATTERNS = (r"(?Udm)^#{1,6}\s+.+$", r"(?Udm)^\d+\.\s+.+$", r"(?Udm)^[A-Z][A-Z\s]{2,}:$", r"(?Udm)^\s*\d+\.\d+[\s.]")
TABLE_PATTERN = r"(?d)\|.+\|\n[\|\-\s:]+\|\n(?:\|.+\|\n)++"
CODE_PATTERN = r"```[\s\S]*?```"
#: Strategies and the splitters that each runs.
STEPS = {
    "table_aware": ["table_aware"],
    "table_aware → semantic": ["table_aware", "semantic"],
    "semantic(scanned)": ["semantic"],
    "section_aware → semantic": ["section_aware", "semantic"],
    "code_aware": ["code_aware"],
    "section_aware": ["section_aware"],
    "semantic": ["semantic"],
}


def strategy_from_profile(profile: DataFrame) -> DataFrame:
    """Path, strategy; `auto` where the content decides. The rounded measures count."""
    strategy = (
        F.when(F.col("has_tables") & F.col("has_images"), "table_aware → semantic")
        .when(F.col("has_tables"), "table_aware")
        .when(F.col("scanned_4") > 0.5, "semantic(scanned)")
        .when(F.col("has_images"), "section_aware → semantic")
        .when(F.col("density_4") > 2.0, "section_aware → semantic")
        .otherwise("auto")
    )
    return profile.select("path", strategy.alias("strategy"))


def has_section(text: Column) -> Column:
    found = F.lit(False)
    for pattern in SECTION_PATTERNS:
        found = found | text.rlike(pattern)
    return found


def strategy_from_content(pages: DataFrame) -> DataFrame:
    """Path, strategy by the first five pages joined by newlines: table, code, sections, or none of them."""
    first = pages.where("page_no < 5").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text")))).alias("p"))
    sample = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
    by_content = F.when(F.col("s").rlike(TABLE_PATTERN), "table_aware").when(F.col("s").rlike(CODE_PATTERN), "code_aware").when(has_section(F.col("s")), "section_aware").otherwise("semantic")
    return first.select("path", sample.alias("s")).select("path", by_content.alias("strategy"))


def routed(profile: DataFrame, pages: DataFrame) -> DataFrame:
    """P7 and P8 together: path, strategy for each profiled file."""
    by_profile = strategy_from_profile(profile)
    undecided = by_profile.where("strategy = 'auto'").select("path")
    by_content = strategy_from_content(pages.where("page_no < 5").join(undecided, "path", "left_semi")).withColumnRenamed("strategy", "content_strategy")
    joined = by_profile.join(by_content, "path", "left")
    return joined.select("path", F.when(F.col("strategy") == "auto", F.coalesce("content_strategy", F.lit("semantic"))).otherwise(F.col("strategy")).alias("strategy"))
