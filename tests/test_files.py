"""No task holds more than a file, and no file more than so many texts."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.plans import queries
from corpusmill.sources import files

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("extract,end", [(queries.lines_of_files, "\n"), (files.plain_text, "")])
def test_extractors_hold_a_file_at_a_time(extract, end):
    batch = pd.DataFrame({"path": ["a", "b", "c"], "content": [("x\fy" + end).encode(), b"", ("z" + end).encode()]})
    frames = list(extract(iter([batch])))
    assert len(frames) == 3 and all(f["path"].nunique() <= 1 and list(f["page_no"]) == list(range(len(f))) for f in frames)


def test_extracted_files_are_bounded(spark, monkeypatch):
    """A source of many texts is several files; their lines are the source's."""
    whole = {r.source: (r.lines, r.chars) for r in queries.u3_extractor_registry(spark, DIR).collect()}
    monkeypatch.setattr(queries, "TEXTS_PER_FILE", 3)
    seen = []
    read = files.pages_of_files
    monkeypatch.setattr(queries.files, "pages_of_files", lambda s, folder, *more: seen.append(folder) or read(s, folder, *more))
    assert {r.source: (r.lines, r.chars) for r in queries.u3_extractor_registry(spark, DIR).collect()} == whole
    texts = spark.read.parquet(f"{DIR}/documents.parquet").select(F.length("text").alias("n"))
    most = 3 * (4 * texts.agg(F.max("n")).first()[0] + 1)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(seen[0]).select("path", "length").collect()
    assert len(found) >= texts.count() / 3 and max(r.length for r in found) <= most
