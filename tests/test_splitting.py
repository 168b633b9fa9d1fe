import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from corpusmill.functions.text import KOREAN_SEPARATORS, SEPARATORS
from corpusmill.operators import chunks, splitting
from corpusmill.operators.recursive import check_sizes, split_text

TABLE = "| a | b |\n| - | - |\n| 1 | 2 |\n"
# The header patterns of section splitting.
HEADER = re.compile(r"#{1,6}\s+.+$|\d+\.\s+.+$|[A-Z][A-Z\s]{2,}:$|\s*\d+\.\d+[\s.]", re.MULTILINE)


def pages(spark, texts):
    return splitting.as_chunks(spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "path string, page_no int, text string"))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .,\n다요", max_size=300), st.integers(2, 40), st.data())
def test_recursive_chunks_are_pieces_in_order(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    found = split_text(text, size, overlap, SEPARATORS)
    assert all(len(c) <= size and c in text and c == c.strip() and c for c in found)
    starts = [text.find(c) for c in found]
    assert all(a >= 0 for a in starts)
    kept = "".join(found)
    assert all(kept.count(ch) >= text.count(ch) for ch in "ab")


def test_recursive_literals():
    assert split_text("", 10, 2, SEPARATORS) == []
    assert split_text("a" * 10, 10, 0, SEPARATORS) == ["a" * 10]
    assert split_text("aaaa bbbb cccc", 9, 0, SEPARATORS) == ["aaaa bbbb", "cccc"]
    assert split_text("aaaa bbbb cccc", 10, 5, SEPARATORS) == ["aaaa bbbb", "bbbb cccc"]
    assert split_text("하나다. 둘이다. 셋", 6, 0, KOREAN_SEPARATORS) == ["하나다", ". 둘이다", ". 셋"]
    assert split_text("xx", 1, 0, ["-"]) == ["xx"]


@pytest.mark.parametrize("size,overlap", [(0, 0), (-1, 0), (5, 5), (5, -1)])
def test_wrong_sizes(size, overlap):
    with pytest.raises(ValueError):
        check_sizes(size, overlap)


def sections_by_loop(text, least):
    out, lines, header = [], [], ""
    for line in text.split("\n"):
        if lines and HEADER.match(line.strip()):
            out.append((header, "\n".join(lines).strip()))
            lines, header = [line], line.strip()
        else:
            lines.append(line)
    out.append((header, "\n".join(lines).strip()))
    return [(i, h, b) for i, (h, b) in enumerate(out) if len(b) >= least]


def test_sections_like_a_line_loop(spark):
    random.seed(3)
    bits = ["# T", "#", "1. x", "1.1", "1.1 y", "ABC:", "AB C :", "  ## q  ", "text", "", "\t", "2.3.4", "12.", "####### z"]
    texts = ["\n".join(random.choice(bits) for _ in range(random.randrange(1, 9))) for _ in range(300)] + ["", "# only", "\n\n", "1.1"]
    rows = splitting.section_split(pages(spark, texts), 1).select("page_no", "section_index", "section_header", "text").collect()
    want = [(p, *s) for p, t in enumerate(texts) for s in sections_by_loop(t, 1)]
    assert sorted(map(tuple, rows)) == sorted(want)


@pytest.mark.parametrize("text,want", [
    ("", [(None, None, "")]),
    ("  \n ", [(None, None, "  \n ")]),
    ("plain", [(0, "text", "plain")]),
    (TABLE, [(0, "table", TABLE.strip())]),
    ("a\n" + TABLE + "b", [(0, "text", "a"), (1, "table", TABLE.strip()), (2, "text", "b")]),
    (TABLE.strip(), [(0, "text", TABLE.strip())]),
    (TABLE + "\n" + TABLE, [(0, "table", TABLE.strip()), (1, "table", TABLE.strip())]),
])
def test_tables(spark, text, want):
    rows = splitting.table_split(pages(spark, [text])).orderBy("part_index").select("part_index", "content_type", "text").collect()
    assert list(map(tuple, rows)) == want


def test_long_table_and_code(spark):
    long = "| a |\n| - |\n" + "| x |\n" * 20_000
    assert splitting.table_split(pages(spark, ["t\n" + long])).count() == 2
    code = "before\n```\nx = 1\n\n# no header\n```\nafter ```open"
    rows = splitting.code_split(pages(spark, [code])).orderBy("place").select("content_type", "text").collect()
    assert list(map(tuple, rows)) == [("text", "before"), ("code", "```\nx = 1\n\n# no header\n```"), ("text", "after ```open")]


def test_chain_and_numbers(spark):
    text = "# A\n" + "word " * 60 + "\n1. B\n" + "more " * 60
    with pytest.raises(ValueError):
        splitting.split_in_steps(pages(spark, [text]), ["none"])
    out = splitting.number_chunks(splitting.split_in_steps(pages(spark, [text, text]), ["section_aware", "semantic"], 220)).orderBy("chunk_index").collect()
    assert [r.chunk_index for r in out] == list(range(len(out))) and {r.chunk_total for r in out} == {len(out)}
    assert {r.split_strategy for r in out} == {"section_aware"} and all(len(r.text) <= 220 for r in out)
    assert [r.page_no for r in out] == sorted(r.page_no for r in out)


def test_report_of_no_chunks(spark):
    empty = spark.createDataFrame([], "path string, text string")
    files = spark.createDataFrame([("f",)], "path string")
    assert tuple(chunks.split_report(empty, files).first()) == ("f", 0, 0.0, 0, 0, 0)
