"""The chunk store: counts, scopes, embedding each text once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions.models import BatchModel
from corpusmill.functions.numbering import numbered
from corpusmill.functions.scratch import let_go, written
from corpusmill.functions.text import store_key


def store_counts(store: DataFrame) -> DataFrame:
    """store_key, n for each (domain, content_type or general), and for each domain as a whole under domain_all."""
    typed = store.select("domain", F.coalesce("content_type", F.lit("general")).alias("content_type"))
    sums = typed.rollup("domain", "content_type").agg(F.count("*").alias("n"), F.grouping_id().alias("level")).where("level < 3")
    return sums.select(F.when(F.col("level") == 1, F.concat_ws("_", "domain", F.lit("all"))).otherwise(F.concat_ws("_", "domain", "content_type")).alias("store_key"), "n")


def with_store_keys(store: DataFrame) -> DataFrame:
    """Each row under the key of its type and under its domain's _all: an array `store_keys`, not copies."""
    return store.withColumn("store_keys", F.array(store_key(F.col("domain"), F.col("content_type")), F.concat_ws("_", "domain", F.lit("all"))))


def search_counts(log: DataFrame) -> DataFrame:
    """store_key, searches from a log with one row a search."""
    return log.groupBy("store_key").agg(F.count("*").alias("searches"))


def scope_by_keys(scope: DataFrame, keys: DataFrame) -> DataFrame:
    """query_id, store_key, weight of the scoped stores that exist; unknown ones go, weights stay as they are."""
    return scope.join(keys.select("store_key").distinct(), "store_key", "left_semi").select("query_id", "store_key", "weight")


def scope_by_domain(queries: DataFrame, keys: DataFrame, prefix: bool = False) -> DataFrame:
    """Every store of a query's domain, equally weighted: query_id, store_key, weight.

    queries: query_id, domain; keys: store_key, domain. With prefix a domain also takes the stores of domains that its
    name begins; keys are matched by every prefix that ends at an underscore, so this too is an equi-join.
    """
    distinct = keys.select("store_key", "domain").distinct()
    if prefix:
        parts = F.split("store_key", "_")
        starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "_"))
        distinct = distinct.select("store_key", F.explode(starts).alias("domain")).distinct()
    sized = distinct.groupBy("domain").agg(F.count("*").alias("n"))
    return queries.join(distinct, "domain").join(sized, "domain").select("query_id", "store_key", (1 / F.col("n")).alias("weight"))


#: Bits, and their words, in which texts that occur more than once are marked; all of them go to every task (half a megabyte).
MARKS, MARK_WORDS = 1 << 22, 1 << 16


def _marked(keyed: DataFrame, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """keyed with `_again`: false where a row's _key surely occurs once. Marks are bits at the hashes of the keys that occur again."""
    place = F.pmod(F.xxhash64("_key"), F.lit(MARKS))
    again = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count("*").alias("n")).where("n > 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_place") % 64).cast("int"))
    words = settle(again.withColumn("_place", place).groupBy(F.floor(F.col("_place") / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits")))  # MARK_WORDS rows at most
    placed = keyed.withColumn("_place", place).withColumn("_w", F.floor(F.col("_place") / 64))
    looked = placed.join(F.broadcast(words), placed["_w"] == words["_word"], "left")
    return looked.withColumn("_again", F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(bit) != 0).drop("_place", "_w", "_word", "_bits")


def embed_once(texts: DataFrame, embed: Callable[[Column], Column] = F.md5, in_steps: bool = False) -> DataFrame:
    """The rows of texts (with a column text) and a column vector; embed sees every distinct text once.

    Hashes of the texts are counted first, and no text moves for it. A text that occurs once is embedded where it stands.
    Those that may occur again (their marks fit into a table of fixed size; chance marks only send a text this way for nothing) meet
    by their hashes after each task has dropped its own copies, one of each is embedded and the vectors are joined back. Null
    texts have a null vector.

    in_steps: marks and the vectors of texts that may occur again are written first, so that texts that moved to be embedded
    are gone from the disk before their rows move to get the vectors.
    """
    def settle(df: DataFrame) -> DataFrame:
        if not in_steps:
            return df
        kept = written(df)
        let_go(df.sparkSession)
        return kept

    keyed = _marked(texts.withColumn("_key", F.md5("text")), settle)
    single = keyed.where(~F.col("_again") & F.col("_key").isNotNull()).select(*texts.columns, embed(F.col("text")).alias("vector"))
    several = keyed.where(F.col("_again") | F.col("_key").isNull()).select(*texts.columns, "_key")
    once = settle(several.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.first("text").alias("_t")).select("_key", embed(F.col("_t")).alias("vector")))
    return single.unionByName(several.join(once, "_key", "left").drop("_key"))


def embed_with_models(texts: DataFrame, domain: str, models: dict[str, Callable[[Column], Column]]) -> tuple[DataFrame, DataFrame]:
    """The texts once for each model, under store_key domain_model, and a status row for each model: model, ok, error, failed.

    A model whose expression can't be built is skipped and its status tells why. A BatchModel that raises in a task is
    skipped too: errors are kept with the texts that cause them (failed counts these rows, error is the least of them), and the
    results, which are written once, are taken only where a model has none. Column functions of other kinds can't
    be caught in a task. With no model left the rows are empty.
    """
    rows, broken = None, []
    for name, embed in models.items():
        try:
            if isinstance(embed, BatchModel):
                each = embed_once(texts, embed.guarded).withColumns({"_error": F.col("vector.error"), "vector": F.col("vector.value")})
            else:
                each = embed_once(texts, embed).withColumn("_error", F.lit(None).cast("string"))
        except Exception as error:  # whatever a caller's model raises is its status
            broken.append((name, False, str(error), None))
            continue
        each = each.withColumn("_model", F.lit(name))
        rows = each if rows is None else rows.unionByName(each)
    spark, kind = texts.sparkSession, "model string, ok boolean, error string, failed long"
    if rows is None:
        empty = texts.where("false").withColumns({"vector": F.lit(None).cast("string"), "store_key": F.lit(None).cast("string")})
        return empty, spark.createDataFrame(broken, kind)
    done = written(rows)
    seen = done.groupBy("_model").agg(F.min("_error").alias("error"), F.count("_error").alias("failed"))
    named = spark.createDataFrame([(m,) for m in models if m not in {b[0] for b in broken}], "model string")
    status = named.join(seen, named["model"] == seen["_model"], "left").select("model", F.col("error").isNull().alias("ok"), "error", F.coalesce("failed", F.lit(0).cast("long")).alias("failed"))
    kept = done.join(F.broadcast(status.where("ok").select(F.col("model").alias("_model"))), "_model", "left_semi")  # a row a model
    return kept.withColumn("store_key", F.concat(F.lit(f"{domain}_"), "_model")).drop("_model", "_error"), status.unionByName(spark.createDataFrame(broken, kind))


def batch_numbers(docs: DataFrame, order: str, batch_size: int = 50) -> DataFrame:
    """batch_no = row number in the global order div batch_size. order: a unique whole-number column.

    Rows are numbered in steps of 10,000, steps in runs of a thousand: no window sees more of the table than one of its rows in ten million.
    """
    rows = numbered(docs, [], [order], F.floor(F.col(order) / 10_000), "row_no")
    return rows.withColumn("batch_no", F.floor(F.col("row_no") / batch_size))
