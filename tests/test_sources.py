import pytest
from pyspark.sql import functions as F

from corpusmill.functions.models import hashing_embedding, text_model
from corpusmill.operators import splitting
from corpusmill.sources import files
from corpusmill.streaming import jobs


def test_files_and_pages(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"one\ftwo")
    (tmp_path / "b.txt").write_bytes(b"no")
    rows = files.file_inventory(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.size_kb) for r in rows] == [("a.PDF", 0.01)]
    assert sorted((r.page_no, r.text) for r in files.pages_of_files(spark, str(tmp_path), "plain").collect()) == [(0, "one"), (1, "two")]


def test_store_round_trip(spark, tmp_path):
    base = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "x/y", "text", "a"), (2, "x/y", None, "b"), (3, "z", "text", "a")], "chunk_id long, domain string, content_type string, text string")
    files.save_stores(rows, base)
    assert files.load_store(spark, base, "x/y")[1] == 2 and files.load_store(spark, base, "x/y", "general")[0].first().chunk_id == 2
    files.append_to_store(rows, base)
    assert files.load_store(spark, base, "z")[1] == 2
    files.append_to_store(rows.withColumn("text", F.concat("text", F.lit("!"))), base, skip_known=True)
    assert spark.read.parquet(base).count() == 8
    with pytest.raises(FileNotFoundError):
        files.load_store(spark, base, "nowhere")


def test_answer_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    answers = spark.createDataFrame([("k", "m", "r")], "key string, model string, response string")
    files.publish_answers(answers, path)
    files.publish_answers(answers, path)
    assert spark.read.parquet(path).count() == 2
    files.clear_answers(spark, path)
    assert spark.read.parquet(path).count() == 0


PAGES = [("f", 0, "word " * 500), ("f", 1, "tail"), ("f", 2, None), ("f", 3, "x. " * 700), ("g", 0, "other"), ("k", 0, ""), ("k", 1, "한국어 문장입니다. " * 200), ("h", 0, "한국어 문장입니다. " * 90), ("h", 1, "plain text? yes! " * 120), (None, 0, "no path")]


def ingested(spark, folder, lots, steps=None):
    """The chunks of pages that come in lots, each in a run of the stream of its own."""
    source, out, place = (str(folder / x) for x in ("pages", "store", "place"))
    for lot in lots:
        spark.createDataFrame(lot, "path string, page_no int, text string").coalesce(1).write.mode("append").parquet(source)
        jobs.ingest_pages(spark, source, out, place, "d", steps).awaitTermination()
    return spark.read.parquet(out)


@pytest.mark.parametrize("steps", [["table_aware", "semantic"], ["section_aware"]])
def test_a_file_over_three_batches_equals_one(spark, tmp_path, steps):
    pages = PAGES if steps != ["section_aware"] else [(p, n, f"# A{n}\n{t}\n1.1 b\n{t}") for p, n, t in PAGES if t]
    lots = [[r for r in pages if r[1] == 0], [r for r in pages if r[1] == 1], [r for r in pages if r[1] > 1]]
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    columns = ["path", "page_no", "text", "chunk_index", "split_strategy", "part_index", "section_index"]
    many, one = ingested(spark, tmp_path / "a", lots, steps), ingested(spark, tmp_path / "b", [pages], steps)
    batch = splitting.number_chunks(splitting.split_in_steps(splitting.as_chunks(spark.createDataFrame(pages, "path string, page_no int, text string")), steps))
    want = sorted(map(str, batch.select(*columns).collect()))
    assert sorted(map(str, many.select(*columns).collect())) == want == sorted(map(str, one.select(*columns).collect()))
    assert many.select("batch").distinct().count() == 3


def test_several_files_in_one_batch_and_a_run_without_any(spark, tmp_path):
    source, out, place = (str(tmp_path / x) for x in ("pages", "store", "place"))
    spark.createDataFrame([("f", n, f"page {n}") for n in range(9)], "path string, page_no int, text string").repartition(3).write.parquet(source)
    for _ in range(2):
        jobs.ingest_pages(spark, source, out, place, "d").awaitTermination()
    assert sorted((r.page_no, r.chunk_index) for r in spark.read.parquet(out).collect()) == [(n, n) for n in range(9)]


def test_appends_read_digests_alone(spark, tmp_path):
    """Known texts of any partition stay out, one of equal new ones comes in, and no scan of the store has its texts."""
    base = str(tmp_path / "store")
    old = [(k, f"d{k % 3}", "t" if k % 2 else None, f"text {k % 40}") for k in range(60)]
    schema = "chunk_id long, domain string, content_type string, text string"
    files.save_stores(spark.createDataFrame(old, schema), base)
    new = spark.createDataFrame([(100 + k, "d0", "t", f"text {k}") for k in range(30, 50)] + [(200, "new", None, "text 45"), (201, "new", None, None), (202, "new", None, None), (100 + 49, "d0", "t", "text 49")], schema)
    fresh = files.new_texts(new, base)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if base in line]
    assert scans and not [line for line in scans if "text" in line.split("ReadSchema")[-1]]
    assert sorted((r.chunk_id, r.text) for r in fresh.collect()) == [*((100 + k, f"text {k}") for k in range(40, 50)), (201, None), (202, None)]
    files.append_to_store(new, base, skip_known=True)
    assert spark.read.parquet(base).count() == 72
    files.append_to_store(new.where("text is not null"), base, skip_known=True)
    assert spark.read.parquet(base).count() == 72 and spark.read.parquet(f"{base}/_blooms").count() > 0


def test_filters_tell_partitions_apart(spark, tmp_path):
    base = str(tmp_path / "store")
    files.save_stores(spark.range(3000).selectExpr("id as chunk_id", "concat('d', id % 3) as domain", "'t' as content_type", "cast(id as string) as text"), base)
    asked = spark.range(0, 300).selectExpr("unhex(md5(cast(id * 3 as string))) as digest")
    found = {(r.domain, bytes(r.digest)) for r in files._may_hold(asked, spark.read.parquet(f"{base}/_blooms")).collect()}
    mine = {("d0", bytes(r.digest)) for r in asked.collect()}
    assert mine <= found and len(found) < 310


def test_models(spark):
    rows = spark.createDataFrame([("a b",), ("",), (None,)], "t string")
    vectors = [r[0] for r in rows.select(hashing_embedding(F.col("t"))).collect()]
    assert abs(sum(x * x for x in vectors[0]) - 1) < 1e-5 and not any(vectors[1]) and not any(vectors[2])
    shout = text_model(lambda s: s.fillna("").str.upper())
    assert [r[0] for r in rows.select(shout(F.col("t"))).collect()] == ["A B", "", ""]
