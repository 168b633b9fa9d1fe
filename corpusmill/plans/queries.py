"""Registered queries of the library's own operators, each beside its SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from corpusmill.functions import text as tx
from corpusmill.functions.models import EMBEDDERS, BatchModel, embedder, text_model
from corpusmill.functions.scratch import let_go, shared_folder, written
from corpusmill.operators import answering, chunks, mmr, profile, reports, routing, search, splitting, store as stores
from corpusmill.plans import inputs as i, splitting_sql as sql, workloads
from corpusmill.sources import files
from corpusmill.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""
    def put(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return put


# Pages, profiles and routes


@query(f"""WITH {i.PAGES}, n AS (SELECT *, count(*) OVER (PARTITION BY path) AS n FROM pg)
SELECT doc_id, path, page_no FROM n WHERE page_no % greatest(n // 5, 1) = 0 AND page_no // greatest(n // 5, 1) < 5""")
def p1_page_sample(spark, sf_dir):
    return profile.sample_pages(i.file_pages(spark, sf_dir)).select("doc_id", "path", "page_no")


@query("""SELECT doc_id, contains(lower(text), 'table') OR length(text) - length(replace(text, '|', '')) > 8 OR length(text) - length(replace(text, chr(9), '')) > 20 AS hint FROM documents""")
def p2_table_hint(spark, sf_dir):
    return i.table(spark, sf_dir, "documents").select("doc_id", tx.table_hint(F.col("text")).alias("hint"))


@query(f"""WITH {i.DECORATED} SELECT doc_id, length(regexp_replace(text, '[^가-힣]', '', 'g')) / greatest(length(text), 1) > 0.1 AS korean FROM dp""")
def p3_is_korean(spark, sf_dir):
    return i.decorated_pages(spark, sf_dir).select("doc_id", tx.is_korean(F.col("text")).alias("korean"))


@query(f"""WITH {i.DECORATED} SELECT doc_id, CASE WHEN length(regexp_replace(text, '[^가-힣]', '', 'g')) / greatest(length(text), 1) > 0.1
  THEN array_to_string([chr(10) || chr(10), chr(10), '. ', '다. ', '요. ', '죠. ', ', ', ' ', ''], '<>') ELSE array_to_string([chr(10) || chr(10), chr(10), '. ', '? ', '! ', '; ', ', ', ' ', ''], '<>') END AS separators FROM dp""")
def p4_separators(spark, sf_dir):
    return i.decorated_pages(spark, sf_dir).select("doc_id", F.array_join(tx.separators(F.col("text")), "<>").alias("separators"))


@query("SELECT d.doc_id FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1 AND l.toxic IN (0) AND d.lang IN ('en', 'de')")
def p5_metadata_filter(spark, sf_dir):
    docs = i.table(spark, sf_dir, "documents").join(i.table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.where(search.metadata_filter({"quality": 1, "toxic": [0], "lang": ["en", "de"]})).select("doc_id")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE (l.quality IS NULL OR l.quality = 1) AND d.lang = 'en'")
def p6_lenient_filter(spark, sf_dir):
    docs = i.table(spark, sf_dir, "documents").join(i.table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.where(search.metadata_filter({"quality": 1, "lang": "en"}, lenient=True)).select("doc_id")


SAMPLE = f"""{i.PAGES}, n AS (SELECT *, count(*) OVER (PARTITION BY path) AS n FROM pg), sa AS (SELECT * FROM n WHERE page_no % greatest(n // 5, 1) = 0 AND page_no // greatest(n // 5, 1) < 5),
pr AS (SELECT path, count(*) AS n_sampled, bool_or(contains(lower(text), 'table')) OR sum(length(text) - length(replace(text, '|', ''))) > 8 OR sum(length(text) - length(replace(text, chr(9), ''))) > 20 AS has_tables,
  avg(CASE WHEN length(trim(text, {i.SPACES})) < 20 THEN 1.0 ELSE 0.0 END) AS ratio, (sum(length(text)) + count(*) - 1) / count(*) / 1000 AS density FROM sa GROUP BY path)"""


@query(f"WITH {SAMPLE} SELECT path, n_sampled, has_tables, ratio > 0.3 AS has_images, round(density, 4) AS density_4, round(ratio, 4) AS scanned_4 FROM pr")
def a1_file_profile(spark, sf_dir):
    return profile.profile_files(profile.sample_pages(i.file_pages(spark, sf_dir))).drop("text_density", "scanned_ratio")


SCORES = """sc AS (SELECT path, 1.0 + CASE WHEN NOT has_tables AND NOT ratio > 0.3 AND density BETWEEN 0.05 AND 2.5 THEN 1.5 ELSE 0 END AS pypdf, CASE WHEN has_tables THEN 2.0 ELSE 0 END AS plumber,
  CASE WHEN has_tables THEN 0.5 ELSE 0 END + CASE WHEN ratio > 0.3 THEN 2.0 ELSE 0 END + CASE WHEN ratio > 0.5 THEN 1.0 ELSE 0 END + CASE WHEN density > 2.5 THEN 1.0 ELSE 0 END + CASE WHEN density < 0.05 THEN 1.5 ELSE 0 END AS pymupdf,
  CASE WHEN density > 2.5 THEN 2.0 ELSE 0 END AS pdfminer, CASE WHEN ratio > 0.3 THEN 1.0 ELSE 0 END + CASE WHEN ratio > 0.5 THEN 3.0 ELSE 0 END + CASE WHEN density < 0.05 THEN 1.5 ELSE 0 END AS unstructured FROM pr)"""


@query(f"""WITH {SAMPLE}, {SCORES} SELECT path, CASE greatest(pypdf, plumber, pymupdf, pdfminer, unstructured) WHEN pypdf THEN 'pypdf' WHEN plumber THEN 'plumber' WHEN pymupdf THEN 'pymupdf' WHEN pdfminer THEN 'pdfminer' ELSE 'unstructured' END AS recommended_loader,
  CAST(pypdf AS DOUBLE) AS pypdf, CAST(plumber AS DOUBLE) AS plumber, CAST(pymupdf AS DOUBLE) AS pymupdf, CAST(pdfminer AS DOUBLE) AS pdfminer, CAST(unstructured AS DOUBLE) AS unstructured FROM sc""")
def a2_loader_scores(spark, sf_dir):
    rows = profile.recommend_loader(profile.profile_files(profile.sample_pages(i.file_pages(spark, sf_dir))))
    return rows.select("path", "recommended_loader", *(F.col("loader_scores")[x].alias(x) for x in profile.LOADERS))


#: The same measures of the decorated pages.
SAMPLE_DECORATED = SAMPLE.replace(i.PAGES, f"{i.DECORATED}, pg AS (SELECT * FROM dp)")

ROUTES = """ro AS (SELECT path, CASE WHEN has_tables AND ratio > 0.3 THEN 'table_aware → semantic' WHEN has_tables THEN 'table_aware' WHEN round(ratio, 4) > 0.5 THEN 'semantic(scanned)' WHEN ratio > 0.3 THEN 'section_aware → semantic'
  WHEN round(density, 4) > 2.0 THEN 'section_aware → semantic' ELSE 'auto' END AS strategy FROM pr)"""


@query(f"WITH {SAMPLE}, {ROUTES} SELECT path, strategy FROM ro")
def p7_strategy_from_profile(spark, sf_dir):
    return routing.strategy_from_profile(profile.profile_files(profile.sample_pages(i.file_pages(spark, sf_dir))))


CONTENT = r"""s AS (SELECT path, string_agg(text, chr(10) ORDER BY page_no) AS s FROM {pages} WHERE page_no < 5 GROUP BY path),
by_content AS (SELECT path, CASE WHEN regexp_matches(s, '\|.+\|\n[\|\-\s:]+\|\n(?:\|.+\|\n)+') THEN 'table_aware' WHEN regexp_matches(s, '```[\s\S]*?```') THEN 'code_aware'
  WHEN regexp_matches(s, '(?m)^#{{1,6}}\s+.+$') OR regexp_matches(s, '(?m)^\d+\.\s+.+$') OR regexp_matches(s, '(?m)^[A-Z][A-Z\s]{{2,}}:$') OR regexp_matches(s, '(?m)^\s*\d+\.\d+[\s.]') THEN 'section_aware' ELSE 'semantic' END AS strategy FROM s)"""


@query(f"WITH {i.DECORATED}, {CONTENT.format(pages='dp')} SELECT path, strategy FROM by_content")
def p8_strategy_from_content(spark, sf_dir):
    return routing.strategy_from_content(i.decorated_pages(spark, sf_dir))


@query(f"""WITH {i.PAGES} SELECT path, length(text) / 1000 AS density, contains(lower(text), 'table') OR length(text) - length(replace(text, '|', '')) > 10 AS has_tables,
  CASE WHEN length(text) / 1000 < 0.1 THEN 'unstructured' WHEN length(text) / 1000 > 2.0 THEN 'pymupdf' WHEN contains(lower(text), 'table') OR length(text) - length(replace(text, '|', '')) > 10 THEN 'plumber' ELSE 'pypdf' END AS recommended_loader
  FROM pg WHERE page_no = 0""")
def p13_first_page_loader(spark, sf_dir):
    return profile.first_page_loader(i.file_pages(spark, sf_dir))


@query("SELECT round(avg(length(text)), 6) AS mean_length, CASE WHEN avg(length(text)) < 500 THEN 300 WHEN avg(length(text)) < 3000 THEN 800 ELSE 1500 END AS chunk_size FROM documents")
def a11_chunk_size(spark, sf_dir):
    return profile.chunk_size_by_length(i.table(spark, sf_dir, "documents"), [(500, 300), (3000, 800)], 1500).withColumn("mean_length", F.round("mean_length", 6))


# Splitting


@query(rf"""WITH {i.DECORATED}, li AS (SELECT doc_id, n, line, regexp_matches(trim(line, {i.SPACES}), '^(#{{1,6}}\s+\S|\d+\.\s+\S|[A-Z][A-Z\s]{{2,}}:$|\d+\.\d+[\s.])') AS header FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM dp)),
se AS (SELECT *, sum(CASE WHEN header AND n > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS k FROM li),
ag AS (SELECT doc_id, k, trim(string_agg(line, chr(10) ORDER BY n), {i.SPACES}) AS text, CASE WHEN k = 0 THEN '' ELSE trim(arg_min(line, n), {i.SPACES}) END AS section_header FROM se GROUP BY doc_id, k)
SELECT doc_id, CAST(k AS INTEGER) AS section_index, section_header, text FROM ag WHERE length(text) >= 100""")
def t2_section_split(spark, sf_dir):
    pages = i.decorated_pages(spark, sf_dir)
    out = splitting.section_split(splitting.as_chunks(pages.withColumn("path", F.col("doc_id").cast("string"))))
    return out.select(F.col("path").cast("long").alias("doc_id"), "section_index", "section_header", "text")


TABLE_PARTS = rf"""{i.DECORATED}, pa AS (SELECT doc_id, path, page_no, text, string_split_regex(text, '\|.+\|\n[\|\-\s:]+\|\n(?:\|.+\|\n)+') AS gaps, regexp_extract_all(text, '\|.+\|\n[\|\-\s:]+\|\n(?:\|.+\|\n)+') AS tabs FROM dp),
ex AS (SELECT doc_id, path, page_no, 2 * n AS o, 'text' AS content_type, trim(gaps[n], {i.SPACES}) AS text FROM pa, LATERAL (SELECT unnest(range(1, len(gaps) + 1)) AS n)
  UNION ALL SELECT doc_id, path, page_no, 2 * n + 1, 'table', trim(tabs[n], {i.SPACES}) FROM pa, LATERAL (SELECT unnest(range(1, len(tabs) + 1)) AS n)),
tp AS (SELECT doc_id, path, page_no, content_type, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY o) - 1 AS INTEGER) AS part_index FROM ex WHERE text <> '')"""


@query(f"WITH {TABLE_PARTS} SELECT doc_id, part_index, content_type, text FROM tp")
def t3_table_split(spark, sf_dir):
    pages = i.decorated_pages(spark, sf_dir)
    out = splitting.table_split(splitting.as_chunks(pages.withColumn("path", F.col("doc_id").cast("string"))))
    return out.select(F.col("path").cast("long").alias("doc_id"), "part_index", "content_type", "text")


@query(sql.T1)
def t1_recursive_split(spark, sf_dir):
    return splitting.semantic_split(splitting.as_chunks(i.file_pages(spark, sf_dir))).drop("place")


@query(sql.T4)
def t4_code_split(spark, sf_dir):
    return splitting.code_split(splitting.as_chunks(i.decorated_pages(spark, sf_dir))).drop("place")


@query(sql.T5)
def t5_step_chain(spark, sf_dir):
    return splitting.split_in_steps(splitting.as_chunks(i.decorated_pages(spark, sf_dir)), ["table_aware", "section_aware", "semantic"]).drop("place")


#: P7 and P8 together on `pg`.
ROUTED = f"{ROUTES}, {CONTENT.format(pages='pg')}, routed AS (SELECT path, CASE WHEN ro.strategy = 'auto' THEN by_content.strategy ELSE ro.strategy END AS strategy FROM ro JOIN by_content USING (path))"


@query(f"WITH RECURSIVE {SAMPLE_DECORATED}, {ROUTED}, {sql.by_strategy('pg', 'routed')} SELECT {sql.NUMBERED} FROM nu")
def t6_split_by_strategy(spark, sf_dir):
    pages = i.decorated_pages(spark, sf_dir, "lot")
    strategies = written(routing.routed(profile.profile_files(profile.sample_pages(pages)), pages))
    let_go(spark)
    return splitting.split_by_strategy(pages, strategies, lot="lot").drop("place")


@query(f"""WITH {TABLE_PARTS} SELECT path, page_no, part_index, row_number() OVER (PARTITION BY path ORDER BY page_no, part_index) - 1 AS chunk_index, count(*) OVER (PARTITION BY path) AS chunk_total FROM tp""")
def w1_chunk_numbers(spark, sf_dir):
    out = splitting.number_chunks(splitting.table_split(splitting.as_chunks(i.decorated_pages(spark, sf_dir))))
    return out.select("path", F.col("page_no").cast("long").alias("page_no"), "part_index", "chunk_index", "chunk_total")


@query(f"""WITH {TABLE_PARTS}, fi AS (SELECT DISTINCT path FROM dp UNION SELECT 'empty.pdf')
SELECT fi.path, count(tp.text) AS result_count, coalesce(round(avg(length(tp.text)), 1), 0) AS avg_size, CAST(coalesce(min(length(tp.text)), 0) AS BIGINT) AS min_size, CAST(coalesce(max(length(tp.text)), 0) AS BIGINT) AS max_size,
  CAST(coalesce(sum(CASE WHEN length(tp.text) > 4000 THEN 1 ELSE 0 END), 0) AS BIGINT) AS oversized FROM fi LEFT JOIN tp USING (path) GROUP BY fi.path""")
def a3_split_report(spark, sf_dir):
    pages = i.decorated_pages(spark, sf_dir)
    empty = pages.select("path").limit(1).select(F.lit("empty.pdf").alias("path"))
    return chunks.split_report(splitting.table_split(splitting.as_chunks(pages)), pages.select("path").unionByName(empty))


@query("SELECT event_id, 'd' || user_id AS path, substr(event_type, 1, 3) AS title, '' AS author, trim(props) AS subject, '' AS creator, '' AS producer, CASE WHEN event_id % 2 = 0 THEN '2024' ELSE '' END AS creation_date, '' AS modification_date FROM events")
def s3_normalize_metadata(spark, sf_dir):
    events = i.table(spark, sf_dir, "events")
    date = F.when(F.col("event_id") % 2 == 0, F.lit(" 2024 "))
    meta = F.create_map(F.lit("/Title"), F.concat(F.lit("  "), F.substring("event_type", 1, 3)), F.lit("/Author"), F.lit("  "), F.lit("/Subject"), F.col("props"), F.lit("/CreationDate"), date)
    raw = events.select(F.concat(F.lit("d"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_id").cast("string")).alias("path"), meta.alias("meta"))
    out = chunks.normalize_metadata(raw)
    parts = F.split("path", "/")
    return out.select(parts[1].cast("long").alias("event_id"), parts[0].alias("path"), *out.columns[1:])


@query(f"""WITH {i.META} SELECT d.doc_id, d.source AS path, me.title, me.page_count FROM documents d LEFT JOIN me ON me.path = d.source""")
def j2_join_metadata(spark, sf_dir):
    docs = i.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"))
    return chunks.join_metadata(docs, i.file_metadata(spark, sf_dir)).select("doc_id", "path", "title", "page_count")


@query(f"""WITH {i.META} SELECT d.doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN 'own' END, d.source) AS source, coalesce(CASE WHEN doc_id % 5 = 0 THEN '' END, me.title, '') AS pdf_title, coalesce(me.author, '') AS pdf_author,
  coalesce(me.page_count, 0) AS pdf_pages, coalesce(me.file_size_kb, 0) AS pdf_file_size FROM documents d LEFT JOIN me ON me.path = d.source""")
def p11_stamp_metadata(spark, sf_dir):
    docs = i.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("path"), F.when(F.col("doc_id") % 3 == 0, "own").alias("source"), F.when(F.col("doc_id") % 5 == 0, "").alias("pdf_title")
    )
    return chunks.stamp_metadata(docs, i.file_metadata(spark, sf_dir)).drop("path")


@query(f"""WITH {i.PAGES} SELECT doc_id, path FROM pg WHERE path IN (SELECT source FROM documents GROUP BY source HAVING count(*) % 2 = 0)""")
def s7_collect_chunks(spark, sf_dir):
    pages = i.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"))
    status = pages.groupBy("path").agg(F.when(F.count("*") % 2 == 0, "success").otherwise("failed").alias("status"))
    return chunks.collect_chunks(status, pages)


# Store and search


@query(f"""WITH {i.STORE} SELECT domain || '_' || coalesce(content_type, 'general') AS store_key, count(*) AS n FROM st GROUP BY 1 UNION ALL SELECT domain || '_all', count(*) FROM st GROUP BY 1""")
def a7_store_counts(spark, sf_dir):
    return stores.store_counts(i.store(spark, sf_dir))


@query("SELECT event_type AS store_key, count(*) AS searches FROM events GROUP BY 1")
def a8_search_counts(spark, sf_dir):
    return stores.search_counts(i.table(spark, sf_dir, "events").select(F.col("event_type").alias("store_key")))


@query(f"""WITH {i.STORE} SELECT chunk_id, domain || '_' || coalesce(content_type, 'general') AS store_key FROM st""")
def f4_store_key(spark, sf_dir):
    return i.store(spark, sf_dir).select("chunk_id", tx.store_key(F.col("domain"), F.col("content_type")).alias("store_key"))


@query(f"""WITH {i.STORE}, k AS (SELECT DISTINCT domain || '_' || coalesce(content_type, 'general') AS store_key FROM st), sc AS (SELECT vec_id AS query_id, unnest(['d' || (vec_id % 4) || '_t1', 'd' || (vec_id % 2) || '_general', 'lost_t1']) AS store_key, 0.5 AS weight FROM embeddings)
SELECT query_id, store_key, CAST(weight AS DOUBLE) AS weight FROM sc WHERE store_key IN (SELECT store_key FROM k)""")
def j5_scope_by_keys(spark, sf_dir):
    rows = i.store(spark, sf_dir)
    keys = rows.select(tx.store_key(F.col("domain"), F.col("content_type")).alias("store_key"), "domain")
    n = F.col("chunk_id")
    asked = F.array(F.format_string("d%d_t1", n % 4), F.format_string("d%d_general", n % 2), F.lit("lost_t1"))
    return stores.scope_by_keys(rows.select(n.alias("query_id"), F.explode(asked).alias("store_key"), F.lit(0.5).alias("weight")), keys)


@query(f"""WITH {i.STORE}, k AS (SELECT DISTINCT domain, domain || '_' || coalesce(content_type, 'general') AS store_key FROM st), n AS (SELECT domain, count(*) AS n FROM k GROUP BY 1)
SELECT vec_id AS query_id, store_key, 1 / n AS weight FROM embeddings JOIN k ON k.domain = 'd' || (vec_id % 5) JOIN n ON n.domain = k.domain""")
def j5_scope_by_domain(spark, sf_dir):
    rows = i.store(spark, sf_dir)
    keys = rows.select(tx.store_key(F.col("domain"), F.col("content_type")).alias("store_key"), "domain")
    asked = rows.select(F.col("chunk_id").alias("query_id"), F.concat(F.lit("d"), (F.col("chunk_id") % 5).cast("string")).alias("domain"))
    return stores.scope_by_domain(asked, keys)


@query(f"""WITH {i.STORE}, {i.NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM near)
SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id, round(distance, 6) AS distance, round(1 / (1 + distance), 6) AS score FROM r WHERE rank <= 5""")
def k1_similarity_search(spark, sf_dir):
    found = search.similarity_search(i.store(spark, sf_dir), i.search_queries(spark, sf_dir))
    return found.select("query_id", "rank", "chunk_id", F.round("distance", 6).alias("distance"), F.round("score", 6).alias("score"))


@query(f"""WITH {i.STORE}, {i.NEAR}, r AS (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM near)
SELECT query_id, chunk_id FROM r WHERE rank <= 50""")
def j1_similarity_join(spark, sf_dir):
    return search.similarity_join(i.store(spark, sf_dir), i.search_queries(spark, sf_dir), 50).select("query_id", "chunk_id")


@query(f"""WITH {i.STORE}, near AS (SELECT q.vec_id AS query_id, chunk_id, pow(list_distance(CAST(q.embedding AS DOUBLE[]), st.e), 2) AS distance FROM embeddings q JOIN st ON q.vec_id <> chunk_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM near) SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id, round(distance, 6) AS distance FROM r WHERE rank <= 3""")
def j1_nearest_of_every_row(spark, sf_dir):
    """Every row is a query here; its own vector, which is the nearest to it, is left out after the join."""
    store = i.store(spark, sf_dir)
    found = search.similarity_join(store, store.select(F.col("chunk_id").alias("query_id"), "embedding"), 4).where("query_id <> chunk_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("rank"))
    return found.withColumn("rank", rank).where("rank <= 3").select("query_id", "rank", "chunk_id", F.round("distance", 6).alias("distance"))


@query(f"""WITH {i.STORE}, {i.NEAR}, ke AS (SELECT near.*, unnest([domain || '_' || coalesce(content_type, 'general'), domain || '_all']) AS store_key FROM near),
sc AS (SELECT vec_id AS query_id, unnest(['d0_all', 'd0_t1', 'd1_all']) AS store_key, unnest([NULL, 0.9, 0.2]) AS w FROM embeddings WHERE vec_id % 100 = 0),
r AS (SELECT ke.query_id, ke.chunk_id, ke.store_key, text, 1 / (1 + distance) * coalesce(w, 1 / 3) AS score, row_number() OVER (PARTITION BY ke.query_id, ke.store_key ORDER BY distance, chunk_id) AS rank FROM ke JOIN sc USING (query_id, store_key)),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id, coalesce(text, '') ORDER BY score DESC, store_key, chunk_id) AS c FROM r WHERE rank <= 15),
f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, store_key, chunk_id) AS final FROM o WHERE c = 1)
SELECT query_id, CAST(final AS INTEGER) AS rank, chunk_id, round(score, 4) AS score, store_key AS source_store FROM f WHERE final <= 5""")
def k2_hybrid_search(spark, sf_dir):
    queries = i.search_queries(spark, sf_dir)
    entry = F.array(*(F.struct(F.lit(k).alias("store_key"), F.lit(w).cast("double").alias("weight")) for k, w in (("d0_all", None), ("d0_t1", 0.9), ("d1_all", 0.2))))
    scope = queries.select("query_id", F.inline(entry))
    return search.hybrid_search(stores.with_store_keys(i.store(spark, sf_dir)), queries, scope)


@query(f"""WITH {i.STORE}, {i.NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS fetched FROM near),
f AS (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY fetched) AS rank FROM r WHERE fetched <= 20 AND label IN (1, 2, 3) AND domain = 'd1') SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id FROM f WHERE rank <= 5""")
def k3_filtered_search(spark, sf_dir):
    return search.filtered_search(i.store(spark, sf_dir), i.search_queries(spark, sf_dir), {"label": [1, 2, 3], "domain": "d1"}).select("query_id", "rank", "chunk_id")


@query(f"""WITH {i.STORE}, {i.NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM near),
f AS (SELECT query_id, chunk_id, rank FROM r WHERE rank <= 5 AND label IN (1, 2, 3)) SELECT query_id, CAST(count(*) AS INTEGER) AS among_five FROM f GROUP BY 1""")
def k3_filter_share(spark, sf_dir):
    found = search.filtered_search(i.store(spark, sf_dir), i.search_queries(spark, sf_dir), {"label": [1, 2, 3]}, k=5, fetch_k=5)
    return found.groupBy("query_id").agg(F.count("*").cast("int").alias("among_five"))


@query(f"""WITH {i.STORE}, {i.NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS fetched FROM near),
f AS (SELECT query_id, chunk_id, fetched, row_number() OVER (PARTITION BY query_id ORDER BY fetched) AS rank FROM r WHERE label = 4 AND domain = 'd1') SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id, CAST(CASE WHEN fetched <= 20 THEN fetched END AS INTEGER) AS fetched FROM f WHERE rank <= 5""")
def k3_widened_search(spark, sf_dir):
    found = search.filtered_search(i.store(spark, sf_dir), i.search_queries(spark, sf_dir), {"label": 4, "domain": "d1"}, widen=True)
    return found.select("query_id", "rank", "chunk_id", "fetched")


def _mmr_sql(picks: int, where: str = "true") -> str:
    """One step a pick: v is what it goes by, m the greatest likeness to those picked so far."""
    steps = f"""{i.STORE}, {i.NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM near WHERE {where}), f AS (SELECT * FROM r WHERE rank <= 20),
c AS (SELECT a.query_id, a.rank AS a, b.rank AS b, list_cosine_similarity(a.e, b.e) AS likeness FROM f a JOIN f b USING (query_id)),
m0 AS (SELECT query_id, f.rank, chunk_id, list_cosine_similarity(f.e, CAST(q.embedding AS DOUBLE[])) AS s, CAST(-1 AS DOUBLE) AS m, list_cosine_similarity(f.e, CAST(q.embedding AS DOUBLE[])) AS v FROM f JOIN embeddings q ON q.vec_id = query_id)"""
    for n in range(1, picks + 1):
        steps += f""", p{n} AS (SELECT query_id, rank, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY v DESC, rank) AS o FROM m{n - 1}) WHERE o = 1),
m{n} AS (SELECT x.query_id, x.rank, x.chunk_id, s, greatest(m, likeness) AS m, 0.5 * s - 0.5 * greatest(m, likeness) AS v FROM m{n - 1} x JOIN p{n} p ON p.query_id = x.query_id JOIN c ON c.query_id = x.query_id AND c.a = p.rank AND c.b = x.rank WHERE x.rank <> p.rank)"""
    union = " UNION ALL ".join(f"SELECT query_id, {n} AS rank, chunk_id, CAST(1 AS DOUBLE) AS score FROM p{n}" for n in range(1, picks + 1))
    return f"WITH {steps} {union}"


@query(_mmr_sql(5))
def k4_mmr_search(spark, sf_dir):
    return mmr.mmr_search(i.store(spark, sf_dir), i.search_queries(spark, sf_dir))


@query(_mmr_sql(5, "domain = 'd1'"))
def k5_retrieve_mmr(spark, sf_dir):
    return search.retrieve(i.store(spark, sf_dir), i.search_queries(spark, sf_dir), "mmr", domain="d1")


@query(f"""WITH {i.STORE}, {i.NEAR}, ke AS (SELECT near.*, unnest([domain || '_' || coalesce(content_type, 'general'), domain || '_all']) AS store_key FROM near),
r AS (SELECT query_id, chunk_id, store_key, text, 1 / (1 + distance) * 0.5 AS score, row_number() OVER (PARTITION BY query_id, store_key ORDER BY distance, chunk_id) AS rank FROM ke WHERE store_key IN ('d2_t1', 'd2_t2')),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id, coalesce(text, '') ORDER BY score DESC, store_key, chunk_id) AS c FROM r WHERE rank <= 15),
f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, store_key, chunk_id) AS final FROM o WHERE c = 1) SELECT query_id, CAST(final AS INTEGER) AS rank, chunk_id, round(score, 4) AS score FROM f WHERE final <= 5""")
def k5_retrieve_hybrid(spark, sf_dir):
    queries = i.search_queries(spark, sf_dir)
    scope = queries.select("query_id", F.explode(F.array(F.lit("d2_t1"), F.lit("d2_t2"))).alias("store_key"), F.lit(None).cast("double").alias("weight"))
    return search.retrieve(stores.with_store_keys(i.store(spark, sf_dir)), queries, "hybrid", domain="d2", scope=scope)


@query(f"""WITH {i.STORE}, {i.NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM near)
SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id, round(1 / (1 + distance), 6) AS score FROM r WHERE rank <= 5""")
def k5_retrieve_hybrid_without_domain(spark, sf_dir):
    """Hybrid search needs a domain; without one it is similarity search over the whole store."""
    queries = i.search_queries(spark, sf_dir)
    return search.retrieve(i.store(spark, sf_dir), queries, "hybrid").withColumn("score", F.round("score", 6))


@query(f"""WITH {i.STORE}, {i.NEAR}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM near WHERE domain = 'd2')
SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id, round(1 / (1 + distance), 6) AS score FROM r WHERE rank <= 5""")
def k5_retrieve(spark, sf_dir):
    return search.retrieve(i.store(spark, sf_dir), i.search_queries(spark, sf_dir), "similarity", domain="d2").withColumn("score", F.round("score", 6))


@query("SELECT doc_id, replace(substr(text, 1, 120), chr(10), ' ') || '…' AS preview FROM documents")
def p12_preview(spark, sf_dir):
    return i.table(spark, sf_dir, "documents").select("doc_id", tx.preview(F.col("text")).alias("preview"))


@query("SELECT event_id, round(1 / (1 + greatest(value - 50, 0)), 9) AS score FROM events")
def f2_distance_score(spark, sf_dir):
    return i.table(spark, sf_dir, "events").select("event_id", F.round(tx.distance_score(F.col("value") - 50), 9).alias("score"))


@query("SELECT doc_id, md5(text) AS vector FROM documents")
def d4_embed_once(spark, sf_dir):
    return stores.embed_once(i.table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "vector")


def _digests(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: hashlib.md5(t.encode()).hexdigest())


def _no_the(texts: pd.Series) -> pd.Series:
    """A model that fails on texts that begin with The, and so as a whole."""
    if texts.str.startswith("The").any():
        raise ValueError("text begins with The")
    return texts.str.upper()


MODELS = {"md5": BatchModel(_digests, "string"), "no_the": BatchModel(_no_the, "string"), "reversed": F.reverse}


@query("SELECT doc_id, 'docs_md5' AS store_key, md5(text) AS vector FROM documents UNION ALL SELECT doc_id, 'docs_reversed', reverse(text) FROM documents UNION ALL SELECT doc_id, 'docs_no_the', upper(text) FROM documents WHERE NOT (SELECT bool_or(starts_with(text, 'The')) FROM documents)")
def j4_embed_with_models(spark, sf_dir):
    rows, _ = stores.embed_with_models(i.table(spark, sf_dir, "documents").select("doc_id", "text"), "docs", MODELS)
    return rows.select("doc_id", "store_key", "vector")


@query("""SELECT unnest(['md5', 'no_the', 'reversed']) AS model, unnest([true, n = 0, true]) AS ok, unnest([NULL, CASE WHEN n > 0 THEN 'ValueError: text begins with The' END, NULL]) AS error, unnest([0, n, 0]) AS failed FROM (SELECT count(*) FILTER (WHERE starts_with(text, 'The')) AS n FROM documents)""")
def j4_model_status(spark, sf_dir):
    return stores.embed_with_models(i.table(spark, sf_dir, "documents").select("doc_id", "text"), "docs", MODELS)[1]


@embedder("vowels")
def vowel_counts(text):
    """How often a, e and i occur, as a vector; built-in functions alone."""
    return F.array(*(tx.occurrences(text, c).cast("float") for c in "aei"))


@query("SELECT doc_id, CAST(length(text) - length(replace(text, 'a', '')) AS DOUBLE) AS a, CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS e, CAST(length(text) - length(replace(text, 'i', '')) AS DOUBLE) AS i FROM documents")
def u2_embedder_registry(spark, sf_dir):
    rows = stores.embed_once(i.table(spark, sf_dir, "documents").select("doc_id", "text"), EMBEDDERS["vowels"])
    return rows.select("doc_id", *(F.col("vector")[n].cast("double").alias(c) for n, c in enumerate("aei")))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch_no FROM documents")
def w6_batch_numbers(spark, sf_dir):
    return stores.batch_numbers(i.table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "batch_no")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def d2_content_dedupe(spark, sf_dir):
    return search.first_of_equal_texts(i.table(spark, sf_dir, "documents"), "doc_id")


@query(f"""WITH {i.STORE} SELECT domain, coalesce(content_type, 'general') AS content_type, count(*) + count(*) FILTER (WHERE chunk_id % 2 = 0) AS n FROM st GROUP BY 1, 2""")
def s6_append_store(spark, sf_dir):
    base, rows = shared_folder(spark), i.store(spark, sf_dir)
    files.save_stores(rows, base)
    files.append_to_store(rows.where("chunk_id % 2 = 0"), base)
    return spark.read.parquet(base).groupBy("domain", "content_type").agg(F.count("*").alias("n"))


@query(f"""WITH {i.STORE}, old AS (SELECT * FROM st WHERE chunk_id % 2 = 0) SELECT chunk_id, domain FROM old UNION ALL SELECT chunk_id, domain FROM st WHERE text IS NULL
UNION ALL SELECT min(chunk_id), arg_min(domain, chunk_id) FROM st WHERE text IS NOT NULL AND text NOT IN (SELECT text FROM old WHERE text IS NOT NULL) GROUP BY text""")
def s6_append_new_texts(spark, sf_dir):
    base, rows = shared_folder(spark), i.store(spark, sf_dir)
    files.save_stores(rows.where("chunk_id % 2 = 0"), base)
    files.append_to_store(rows, base, skip_known=True)
    return spark.read.parquet(base).select("chunk_id", "domain")


@query(f"WITH {i.STORE} SELECT chunk_id, domain, coalesce(content_type, 'general') AS content_type, label, text, md5(text) AS digest FROM st")
def s4_save_stores(spark, sf_dir):
    base = shared_folder(spark)
    files.save_stores(i.store(spark, sf_dir), base)
    return spark.read.parquet(base).select("chunk_id", "domain", "content_type", "label", "text", F.lower(F.hex("digest")).alias("digest"))


@query(f"WITH {i.STORE} SELECT chunk_id, coalesce(content_type, 'general') AS content_type, text FROM st WHERE domain = 'd1'")
def s5_load_store(spark, sf_dir):
    base = shared_folder(spark)
    files.save_stores(i.store(spark, sf_dir), base)
    return files.load_store(spark, base, "d1")[0].select("chunk_id", "content_type", "text")


@query("SELECT source, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents WHERE text <> '' GROUP BY 1")
def s2_pages_of_files(spark, sf_dir):
    folder = shared_folder(spark)
    docs = i.table(spark, sf_dir, "documents").select("source", "text")
    docs.write.partitionBy("source").option("lineSep", "\f").option("maxRecordsPerFile", 500).text(folder)
    pages = files.pages_of_files(spark, folder, "plain", ".txt").where("text <> ''")
    return pages.groupBy(F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source")).agg(F.count("*").alias("pages"), F.sum(F.length("text")).alias("chars"))


@files.extractor("lines")
def lines_of_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every line of a UTF-8 file as a page, the empty one after a last newline left out. One file's lines are held at a time."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            lines = bytes(content).decode().split("\n")[:-1]
            yield pd.DataFrame({"path": path, "page_no": range(len(lines)), "text": lines})


#: Texts in a file that an extractor gets whole: some megabytes.
TEXTS_PER_FILE = 1000


def _source_files(spark: SparkSession, sf_dir: str, most: int | None = None) -> str:
    """A folder with each source's texts, each ended by a newline: a file a source, or files of at most so many texts."""
    folder = shared_folder(spark)
    docs = i.table(spark, sf_dir, "documents").select("source", F.coalesce("text", F.lit("")).alias("text"))
    dealt = docs if most else docs.repartition("source")
    dealt.write.partitionBy("source").option("maxRecordsPerFile", most or 0).text(folder)
    return folder


@query("SELECT source, round(sum(strlen(coalesce(text, '')) + 1) / 1024, 2) AS size_kb FROM documents GROUP BY 1")
def s1_file_inventory(spark, sf_dir):
    found = files.file_inventory(spark, _source_files(spark, sf_dir), ".txt")
    return found.select(F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source"), "size_kb")


@query("SELECT source, CAST(sum(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1) AS BIGINT) AS lines, CAST(sum(length(replace(coalesce(text, ''), chr(10), ''))) AS BIGINT) AS chars FROM documents GROUP BY 1")
def u3_extractor_registry(spark, sf_dir):
    pages = files.pages_of_files(spark, _source_files(spark, sf_dir, TEXTS_PER_FILE), "lines", ".txt")
    return pages.groupBy(F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source")).agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"))


# Questions, answers and sessions


@query("SELECT conv_id, turn, CASE turn % 4 WHEN 1 THEN 'summary' WHEN 2 THEN 'comparison' ELSE 'factual' END AS question_type FROM conversations")
def p9_question_type(spark, sf_dir):
    raw = F.when(F.col("turn") % 4 == 0, "FACTUAL").when(F.col("turn") % 4 == 1, " Summary\n").when(F.col("turn") % 4 == 2, "comparison ").otherwise(F.col("role"))
    return i.table(spark, sf_dir, "conversations").select("conv_id", "turn", answering.question_type(raw).alias("question_type"))


def _template_sql(name: str) -> str:
    return "'" + answering.TEMPLATES[name].replace("'", "''") + "'"


@query(f"""SELECT conv_id, turn, replace(replace(CASE turn % 3 WHEN 1 THEN {_template_sql('summary')} WHEN 2 THEN {_template_sql('procedural')} ELSE {_template_sql('factual')} END, '{{context}}', text), '{{question}}', role) AS prompt FROM conversations""")
def p10_render_prompt(spark, sf_dir):
    kind = F.when(F.col("turn") % 3 == 1, "summary").when(F.col("turn") % 3 == 2, "procedural").otherwise("factual")
    return i.table(spark, sf_dir, "conversations").select("conv_id", "turn", answering.render_prompt(kind, F.col("text"), F.col("role")).alias("prompt"))


@query(r"""SELECT conv_id, turn, array_to_string(list_concat([role], list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '')), '<>') AS queries FROM conversations""")
def f1_derived_queries(spark, sf_dir):
    return i.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(answering.derived_queries(F.col("role"), F.col("text")), "<>").alias("queries"))


@query("""WITH h AS (SELECT conv_id AS question_id, turn % 3 AS query_no, turn AS rank, turn AS chunk_id, role AS text FROM conversations), o AS (SELECT *, row_number() OVER (PARTITION BY question_id, text ORDER BY query_no, rank, chunk_id) AS c FROM h),
f AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY query_no, rank, chunk_id) AS place FROM o WHERE c = 1) SELECT question_id, CAST(place AS INTEGER) AS rank, chunk_id, text FROM f WHERE place <= 2""")
def d1_merge_query_hits(spark, sf_dir):
    c = i.table(spark, sf_dir, "conversations")
    return answering.merge_query_hits(c.select(F.col("conv_id").alias("question_id"), (F.col("turn") % 3).alias("query_no"), F.col("turn").alias("rank"), F.col("turn").alias("chunk_id"), F.col("role").alias("text")), 2)


@query("""WITH s AS (SELECT conv_id, turn, text, 1500 - coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM conversations),
o AS (SELECT *, min(CASE WHEN length(text) > rest THEN turn END) OVER (PARTITION BY conv_id) AS over FROM s),
p AS (SELECT conv_id, turn, over, CASE WHEN over IS NULL OR turn < over THEN text WHEN turn = over AND rest > 200 THEN substr(text, 1, CAST(rest AS BIGINT)) || chr(10) || '[... cut]' END AS part FROM o)
SELECT conv_id AS question_id, coalesce(string_agg(part, chr(10) || chr(10) ORDER BY turn), '') AS context, count(part) AS n_used, bool_or(over IS NOT NULL) AS truncated FROM p GROUP BY 1""")
def w2_context(spark, sf_dir):
    return answering.build_context(i.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("question_id"), F.col("turn").alias("rank"), "text"), 1500)


@query("""SELECT conv_id, turn, coalesce(string_agg(role || ':' || text, '|') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS history FROM conversations""")
def w3_history(spark, sf_dir):
    out = answering.history(i.table(spark, sf_dir, "conversations"), 2)
    return out.select("conv_id", "turn", F.array_join(F.transform("history", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "|").alias("history"))


@query("""WITH l AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role ELSE 's' || (turn % 3) END AS label FROM conversations WHERE turn <> 3), f AS (SELECT conv_id, label, min(turn) AS t FROM l GROUP BY 1, 2)
SELECT conv_id, string_agg(label, '|' ORDER BY t) AS citations FROM f GROUP BY 1""")
def d3_citations(spark, sf_dir):
    c = i.table(spark, sf_dir, "conversations")
    title, source = F.when(F.col("turn") % 2 == 0, F.col("role")), F.when(F.col("turn") != 3, F.concat(F.lit("s"), (F.col("turn") % 3).cast("string")))
    docs = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", title.alias("title"), source.alias("source")))).alias("docs"))
    return docs.select("conv_id", F.array_join(answering.citations("title", "source", "docs"), "|").alias("citations")).where("citations <> ''")


@query("""WITH g AS (SELECT conv_id, count(*) AS m, count(*) FILTER (WHERE turn % 3 <> 0) AS e FROM conversations GROUP BY 1), k AS (SELECT conv_id, m, CASE WHEN e = 0 THEN m ELSE e END AS n FROM g)
SELECT conv_id, m AS before, m - n AS removed, n || '/' || m || ' (' || CAST(round_even(n / m * 100, 0) AS INTEGER) || '%)' AS ratio FROM k""")
def f3_compression(spark, sf_dir):
    c = i.table(spark, sf_dir, "conversations")
    lists = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    chunk = F.transform("x", lambda r: r["text"])
    extract = F.transform("x", lambda r: F.when(r["turn"] % 3 != 0, F.substring(r["text"], 1, 20)).otherwise(""))
    out = lists.select("conv_id", answering.compression(chunk, extract).alias("c"))
    return out.select("conv_id", "c.before", "c.removed", "c.ratio")


@query(f"WITH {i.PROMPTS} SELECT prompt_id, min(response) AS response FROM pr JOIN ca ON sha256(pr.prompt) = ca.key AND pr.model = ca.model GROUP BY 1")
def j3_cache_hits(spark, sf_dir):
    return answering.cache_hits(i.prompts(spark, sf_dir), i.answer_cache(spark, sf_dir))


@query(f"WITH {i.PROMPTS} SELECT DISTINCT sha256(prompt) AS key, model FROM pr WHERE NOT EXISTS (SELECT 1 FROM ca WHERE ca.key = sha256(pr.prompt) AND ca.model = pr.model)")
def j3_cache_misses(spark, sf_dir):
    return answering.cache_misses(i.prompts(spark, sf_dir), i.answer_cache(spark, sf_dir)).select("key", "model")


@query("SELECT count(*) AS entries, CAST(sum(length(text)) AS BIGINT) AS total_chars, round(avg(length(text)), 0) AS avg_chars FROM conversations WHERE role = 'user' AND conv_id % 3 = 0")
def a9_cache_stats(spark, sf_dir):
    return answering.cache_stats(i.answer_cache(spark, sf_dir))


@query("SELECT count(*) AS entries, CAST(sum(length(text)) AS BIGINT) AS total_chars, round(avg(length(text)), 0) AS avg_chars FROM conversations WHERE role = 'user' AND conv_id % 3 = 0")
def s8_publish_answers(spark, sf_dir):
    path, answers = shared_folder(spark), i.answer_cache(spark, sf_dir)
    files.publish_answers(answers, path)
    files.clear_answers(spark, path)
    files.publish_answers(answers, path)
    return answering.cache_stats(spark.read.parquet(path))


@query("SELECT conv_id, turn, lower(text) AS answer FROM conversations")
def u4_text_model(spark, sf_dir):
    model = text_model(lambda texts: texts.fillna("").str.lower())
    return i.table(spark, sf_dir, "conversations").select("conv_id", "turn", model(F.col("text")).alias("answer"))


@query("""WITH t AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), d AS (SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS types FROM t GROUP BY 1)
SELECT user_id AS session_id, count(*) AS queries, round(sum(value), 3) AS total_elapsed, round(sum(value) / count(*), 3) AS avg_elapsed, any_value(types) AS types, count(*) FILTER (WHERE event_id % 3 = 0) AS hits, count(*) FILTER (WHERE event_id % 3 <> 0) AS misses,
  CAST(round_even(count(*) FILTER (WHERE event_id % 3 = 0) / count(*) * 100, 0) AS INTEGER) || '%' AS hit_rate, CAST(sum(CASE WHEN event_id % 7 > 0 THEN greatest(event_id % 7 - event_id % 5, 0) ELSE 0 END) AS BIGINT) AS removed FROM events JOIN d USING (user_id) GROUP BY 1""")
def a6_session_stats(spark, sf_dir):
    out = answering.session_stats(i.session_log(spark, sf_dir))
    types = F.array_join(F.transform(F.map_entries("type_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.withColumn("types", types).drop("type_distribution")


# Logs


@query("""SELECT event_type AS loader, count(*) FILTER (WHERE value >= 20) AS success, count(*) FILTER (WHERE value < 20) AS failure, count(*) AS total, CAST(round_even(count(*) FILTER (WHERE value >= 20) / count(*) * 100, 0) AS INTEGER) || '%' AS rate FROM events GROUP BY 1""")
def a4_loader_stats(spark, sf_dir):
    return reports.loader_stats(i.table(spark, sf_dir, "events").select(F.col("event_type").alias("loader"), (F.col("value") >= 20).alias("ok")))


def _batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "success").otherwise(F.col("event_type"))
    return i.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("path"), status.alias("status"), F.floor("value").alias("chunk_count"), F.col("value").alias("mem_delta_mb"))


@query("SELECT count(*) FILTER (WHERE event_type = 'purchase') AS success, count(*) FILTER (WHERE event_type <> 'purchase') AS failed, CAST(sum(floor(value)) AS BIGINT) AS total_chunks FROM events")
def a5_batch_report(spark, sf_dir):
    return reports.batch_report(_batch_log(spark, sf_dir))


@query("SELECT CAST(event_id AS VARCHAR) AS path, value AS mem_delta_mb FROM events WHERE value > 100")
def a5_memory_heavy(spark, sf_dir):
    return reports.memory_heavy(_batch_log(spark, sf_dir))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), "ts", "value")


@query("SELECT user_id AS run_id, max(value) AS peak, round(avg(value), 1) AS mean, round(arg_max(value, ts) - arg_min(value, ts), 4) AS net FROM events GROUP BY 1")
def a10_sample_report(spark, sf_dir):
    return reports.sample_report(_samples(spark, sf_dir))


@query("""SELECT user_id AS run_id, ts, value, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts), 4) AS delta, max(value) OVER (PARTITION BY user_id) AS peak,
  round(last_value(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) - first_value(value) OVER (PARTITION BY user_id ORDER BY ts), 4) AS net FROM events""")
def w4_stage_deltas(spark, sf_dir):
    return reports.stage_deltas(_samples(spark, sf_dir))


@query("""WITH a AS (SELECT event_id // 4 AS path, CAST(event_id % 5 AS INTEGER) AS l, CAST(event_id // 4 % 5 AS INTEGER) AS r, value > 60 AS ok, 'e' || event_id AS error FROM events),
o AS (SELECT path, l, r, CASE WHEN l = r THEN 1 WHEN l < r THEN l + 2 ELSE l + 1 END AS place, bool_or(ok) AS ok, min(error) AS error FROM a GROUP BY ALL),
w AS (SELECT path, any_value(r) AS r, min(place) FILTER (WHERE ok) AS p, arg_min(l, place) FILTER (WHERE ok) AS l FROM o GROUP BY 1)
SELECT w.path, ['pypdf', 'plumber', 'pymupdf', 'pdfminer', 'unstructured'][w.l + 1] AS loader_used, coalesce(w.l <> w.r, true) AS fallback_used, coalesce(string_agg(o.error, ',' ORDER BY o.place) FILTER (WHERE NOT o.ok AND (w.p IS NULL OR o.place < w.p)), '') AS errors
FROM w JOIN o USING (path) GROUP BY ALL""")
def w5_first_success(spark, sf_dir):
    names = F.array(*map(F.lit, profile.LOADERS))
    e = i.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 4).alias("path"), F.get(names, (F.col("event_id") % 5).cast("int")).alias("loader"), (F.col("value") > 60).alias("ok"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("error"))
    wanted = e.select("path", F.get(names, (F.col("path") % 5).cast("int")).alias("recommended_loader")).distinct()
    return reports.first_success(e, wanted).withColumn("errors", F.array_join("error_log", ",")).drop("error_log")


# Streams and whole workloads


@query("SELECT date_trunc('day', ts) AS window_start, user_id AS session_id, event_type AS question_type, count(*) AS queries, round(sum(value), 3) AS total_elapsed, count(*) FILTER (WHERE event_id % 3 = 0) AS hits FROM events GROUP BY 1, 2, 3")
def x2_running_session_stats(spark, sf_dir):
    events = i.table(spark, sf_dir, "events")
    source, out, place = shared_folder(spark), shared_folder(spark), shared_folder(spark)
    events.select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("session_id"), F.col("event_type").alias("question_type"), F.col("value").alias("elapsed_sec"), (F.col("event_id") % 3 == 0).alias("cache_hit")).write.parquet(source)
    stream = jobs.running_session_stats(spark.readStream.schema(spark.read.parquet(source).schema).parquet(source))
    run = stream.writeStream.outputMode("complete").option("checkpointLocation", place).trigger(availableNow=True).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).start()
    run.awaitTermination()
    return spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""WITH RECURSIVE {i.PAGES}, fl AS (SELECT path, arg_min({sql.is_korean('text')}, page_no) AS korean FROM pg GROUP BY 1), src AS (SELECT doc_id AS key, text, korean FROM pg JOIN fl USING (path)), {sql.recursive('src', 'ch')}
SELECT path, CAST(page_no AS INTEGER) AS page_no, chunk AS text, row_number() OVER (PARTITION BY path ORDER BY page_no, ord) - 1 AS chunk_index FROM ch JOIN pg ON doc_id = key""")
def x1_incremental_ingest(spark, sf_dir):
    """The pages of each file come in three lots, one after the other; the numbers go on from lot to lot."""
    source, out, place = shared_folder(spark), shared_folder(spark), shared_folder(spark)
    pages = written(i.file_pages(spark, sf_dir).select("path", F.col("page_no").cast("int").alias("page_no"), "text"))
    sizes = pages.groupBy(F.col("path").alias("_path")).agg(F.count("*").alias("_n"))
    lots = pages.join(sizes, F.col("path") == F.col("_path")).withColumn("_lot", F.floor(F.col("page_no") * 3 / F.col("_n")))
    for lot in range(3):
        lots.where(F.col("_lot") == lot).select(*pages.columns).write.mode("append").parquet(source)
        jobs.ingest_pages(spark, source, out, place, "docs").awaitTermination()
    return spark.read.parquet(out).select("path", "page_no", "text", "chunk_index")


@query(f"""WITH RECURSIVE {SAMPLE}, {ROUTED}, {sql.by_strategy('pg', 'routed')}, {i.META}
SELECT {sql.NUMBERED.replace('content_type', "coalesce(content_type, 'general') AS content_type")}, path AS source, coalesce(me.title, '') AS pdf_title, coalesce(me.author, '') AS pdf_author, coalesce(me.page_count, 0) AS pdf_pages, coalesce(me.file_size_kb, 0) AS pdf_file_size,
  md5(text) AS vector, 'docs' AS domain FROM nu LEFT JOIN me USING (path)""")
def workload_a_corpus_to_store(spark, sf_dir):
    return workloads.corpus_to_store(i.file_pages(spark, sf_dir, "lot"), i.file_metadata(spark, sf_dir), "docs", lot="lot").drop("place")


@query(f"""WITH {i.STORE}, {i.NEAR}, ke AS (SELECT near.*, domain || '_all' AS store_key FROM near WHERE domain IN ('d0', 'd1')),
r AS (SELECT query_id, chunk_id, store_key, text, 1 / (1 + distance) * 0.5 AS score, row_number() OVER (PARTITION BY query_id, store_key ORDER BY distance, chunk_id) AS rank FROM ke),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id, coalesce(text, '') ORDER BY score DESC, store_key, chunk_id) AS c FROM r WHERE rank <= 15),
h AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, store_key, chunk_id) AS rank, coalesce(text, '') AS text FROM o WHERE c = 1),
s AS (SELECT query_id, rank, text, 12000 - coalesce(sum(length(text)) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM h WHERE rank <= 5),
v AS (SELECT *, min(CASE WHEN length(text) > rest THEN rank END) OVER (PARTITION BY query_id) AS over FROM s),
p AS (SELECT query_id, rank, CASE WHEN over IS NULL OR rank < over THEN text WHEN rank = over AND rest > 200 THEN substr(text, 1, CAST(rest AS BIGINT)) || chr(10) || '[... cut]' END AS part FROM v),
x AS (SELECT query_id, coalesce(string_agg(part, chr(10) || chr(10) ORDER BY rank), '') AS context, count(part) AS n_used FROM p GROUP BY 1)
SELECT vec_id AS query_id, split_part(t, '{{context}}', 1) || coalesce(context, '') || replace(split_part(t, '{{context}}', 2), '{{question}}', d.text) AS prompt, coalesce(n_used, 0) AS n_used
FROM embeddings e JOIN documents d ON d.doc_id = vec_id LEFT JOIN x ON x.query_id = vec_id, (SELECT {_template_sql('factual')} AS t) WHERE vec_id % 100 = 0""")
def workload_b_questions_to_prompts(spark, sf_dir):
    queries = i.search_queries(spark, sf_dir)
    docs = i.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("query_id"), F.col("text").alias("question"))
    questions = queries.join(docs, "query_id").withColumn("question_type", F.lit("factual"))
    scope = queries.select("query_id", F.explode(F.array(F.lit("d0_all"), F.lit("d1_all"))).alias("store_key"), F.lit(None).cast("double").alias("weight"))
    return workloads.questions_to_prompts(stores.with_store_keys(i.store(spark, sf_dir)), questions, scope)


@query(f"""WITH {i.PROMPTS}, h AS (SELECT prompt_id, min(response) AS response FROM pr JOIN ca ON sha256(pr.prompt) = ca.key AND pr.model = ca.model GROUP BY 1)
SELECT pr.prompt_id, coalesce(h.response, md5(pr.prompt)) AS response, h.response IS NOT NULL AS cache_hit, 'prompts' AS citations FROM pr LEFT JOIN h USING (prompt_id)""")
def workload_c_answers(spark, sf_dir):
    prompts = i.prompts(spark, sf_dir)
    sources = prompts.select("prompt_id", F.array(F.struct(F.lit("").alias("title"), F.lit("prompts").alias("source"))).alias("docs"))
    out = workloads.prompts_to_answers(prompts, i.answer_cache(spark, sf_dir), F.md5, sources)
    return out.withColumn("citations", F.array_join("citations", "|"))
