"""Texts move once to be numbered, and not again once they are cut."""

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.numbering import numbered
from corpusmill.operators import routing, splitting
from corpusmill.operators.store import embed_once
from corpusmill.plans import inputs

TABLE = "| a | b |\n| - | - |\n| 1 | 2 |\n"
KOREAN = "한국어 문장입니다. " * 90


def shuffles_of(df, column):
    """How many exchanges of df's plan carry a column of this name."""
    def walk(node):
        node = node.initialPlan() if node.nodeName().startswith("AdaptiveSparkPlan") else node
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        children = [node.children().apply(i) for i in range(node.children().size())]
        return (node.nodeName() == "Exchange" and column in names) + sum(map(walk, children))

    return walk(df._jdf.queryExecution().executedPlan())


def test_numbered_rows_move_once(spark, tmp_path):
    spark.range(90).selectExpr("id", "id % 3 as g", "repeat('word ', 50) as text").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    out = numbered(rows, ["g"], ["id"], F.floor(F.col("id") / 7), "n", "total", lot="lot")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles_of(numbered(rows, ["g"], ["id"], F.floor(F.col("id") / 7), "n", "total"), "text") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.id, r.n, r.total, r.lot) for r in out.collect()) == [(k, k // 3, 30, k // 7) for k in range(90)]


def pages(spark):
    texts = {"t": f"before\n{TABLE}after " + "word " * 300, "c": "text " * 300 + "\n```\nx = 1\n```\n" + KOREAN, "s": "# A\n" + "more " * 300 + "\n1.1 b\n" + "less " * 40, "k": KOREAN, "e": "", None: "no path. " * 200}
    return spark.createDataFrame([(p, n, t if n % 4 else f"{n}? {t}") for p, t in texts.items() for n in range(23)], "path string, page_no int, text string")


STRATEGIES = {"t": "table_aware → semantic", "c": "code_aware", "s": "section_aware → semantic", "k": "semantic", "e": "semantic", None: "semantic(scanned)"}


@pytest.mark.parametrize("div", [1, 5, None])
def test_lots_change_nothing(spark, div):
    rows = pages(spark)
    strategies = spark.createDataFrame(list(STRATEGIES.items()), "path string, strategy string")
    given = rows.withColumn("lot", F.floor(F.col("page_no") / div)) if div else rows
    out = splitting.split_by_strategy(given, strategies, 400, "lot" if div else None)
    assert shuffles_of(out, "text") == 0
    columns = [c for c in out.columns if c != "place"]
    mine = [splitting.split_in_steps(splitting.as_chunks(rows.where(F.col("path").eqNullSafe(F.lit(p)))), routing.STEPS[s], 400) for p, s in STRATEGIES.items()]
    want = [r for d in mine for r in splitting.number_chunks(d).select(*columns).collect()]
    assert sorted(map(str, out.select(*columns).collect())) == sorted(map(str, want)) and len(want) > 100


def test_numbered_pages_are_cut_where_they_are(spark, monkeypatch):
    """From the table to the written chunks texts move once, for the numbers of pages."""
    seen = []
    put = splitting.written
    monkeypatch.setattr(splitting, "written", lambda df: seen.append((df.columns, shuffles_of(df, "text"))) or put(df))
    given = inputs.decorated_pages(spark, "/root/testdata/sf0.001", "lot")
    strategies = put(given.select("path").distinct().withColumn("strategy", F.lit("table_aware → semantic")))
    splitting.split_by_strategy(given, strategies, lot="lot")
    assert [n for columns, n in seen if "_at" in columns] == [1]


def test_equal_texts_are_embedded_before_rows_move(spark):
    """In steps a text moves at most once in any plan: to be embedded, or with its row to the vector."""
    rows = spark.createDataFrame([(k, f"text {k % 40}" if k % 7 else None) for k in range(100)], "id long, text string")
    want = sorted(map(str, embed_once(rows).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = embed_once(rows, in_steps=True)
        assert shuffles_of(out, "text") == 1 and shuffles_of(out, "_t") + shuffles_of(out, "first") == 0
        assert sorted(map(str, out.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
