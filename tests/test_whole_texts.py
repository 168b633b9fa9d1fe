from corpusmill.plans import queries

DIR = "/root/testdata/sf0.001"


def test_questions_are_whole_documents(spark, monkeypatch):
    monkeypatch.setattr(queries.workloads, "questions_to_prompts", lambda store, questions, scope: questions)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    asked = queries.workload_b_questions_to_prompts(spark, DIR).select("query_id", "question").collect()
    assert asked and all(r.question == texts[r.query_id] for r in asked)
    assert any(len(r.question or "") > 80 for r in asked)
