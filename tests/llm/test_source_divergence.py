"""The audit against SQL over all groups and terms, and its parts against plain loops."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from corpusmill.llm import source_divergence as sd
from corpusmill.llm.queries import OP11_SQL, op11_source_divergence

DIR = "/root/testdata/sf0.001"


def by_sql(spark, docs):
    connection = duckdb.connect()
    documents = docs.select("text", "lang", "source").toPandas()  # noqa: F841  read by the SQL
    return sorted(connection.sql(f"SELECT lang, source, part, item, value, rank FROM ({OP11_SQL})").fetchall())


def texts(spark, seed=3):
    random.seed(seed)
    words = ["the", "of", "Ünï", "é", "zebra", "a", *(f"w{chr(97 + k)}" for k in range(20))]
    rows = []
    for lang in ("en", "de", None, ""):
        for source in ("s1", "s2", "S10", "é", None, ""):
            for _ in range(random.choice([3, 14])):
                rows.append((lang, source, " ".join(random.choices(words, [1 / (1 + (k * 7 + len(source or "")) % 11) for k in range(len(words))], k=random.choice([2, 30, 90])))))
    rows += [("en", "blank", None), ("en", "blank2", " 12 --- "), ("fr", "alone", "the words"), ("xx", "a", None), ("xx", "b", "1"), ("en", "s1", "The " * 9000 + "x" * 5000)]
    rows += rows[:20]
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], "lang string, source string, text string, item int, rank string")


@pytest.mark.parametrize("block, fan_in", [(400_000, 512), (40, 512), (25, 2)])
def test_same_as_sql(spark, monkeypatch, block, fan_in):
    """One run, many runs, and runs that are merged in several passes give the same rows."""
    docs = texts(spark).repartition(5)
    out = sd.audit(docs, block=block, fan_in=fan_in)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = sorted(map(tuple, out.collect()))
    assert found == by_sql(spark, docs)
    assert {r[2] for r in found} == {"pair", "term"}
    assert [r[4] for r in found if r[0] == "xx"] == [0, 0] and not [r for r in found if r[0] == "fr"]


def test_the_query_reads_whole_tables(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert sorted(map(tuple, op11_source_divergence(spark, DIR).collect())) == by_sql(spark, docs)


def test_frequencies_are_those_of_a_loop(spark):
    docs = texts(spark, 8).na.fill("")
    seen, total = defaultdict(set), defaultdict(Counter)
    for k, r in enumerate(docs.collect()):
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), r.text)):
            term = term.encode()
            seen[r.lang, term].add(k)
            total[r.lang, term][r.source] += 1
    for block, fan_in in ((10**6, 512), (7, 3)):
        out = {(r.lang, bytes(r.term)): dict(zip(r.source, r.n, strict=True)) for r in sd.frequencies(docs.repartition(7), 30, block, fan_in).collect()}
        assert out == {k: dict(v) for k, v in total.items() if len(seen[k]) >= 30}


def plain(block):
    table, groups = block.postings(), list(block.groups)
    of, n, docs = iter(table["of"].tolist()), iter(table["n"].tolist()), iter(table["docs"].tolist())
    assert sorted(table["key"].tolist()) == table["key"].tolist()
    return {(term, groups[next(of)]): (next(n), next(docs)) for term, k in zip(table["term"], table["postings"].tolist()) for _ in range(k)}


ROWS = [("en", "a", "Alpha beta,é9gamma alpha"), ("de", "a", ""), ("en", "b", "beta " + "q" * 40 + " " + "q" * 39 + "r " + "Q" * 40), ("en", "a", "alpha ünï abcdefgh abcdefghi ABCDEFGHIJKLMNOP abcdefghijklmnopq"), ("en", "", "12 3")]


def counted(rows):
    out = {}
    for lang, source, text in rows:
        for term, n in Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))).items():
            old = out.get((term.encode(), (lang, source)), (0, 0))
            out[term.encode(), (lang, source)] = (old[0] + n, old[1] + 1)
    return out


def test_postings_of_a_block(monkeypatch):
    block = sd.Block()
    block.add([(lang, source, t.encode()) for lang, source, t in ROWS[:2]])
    block.add([(lang, source, t.encode()) for lang, source, t in ROWS[2:]])
    assert plain(block) == counted(ROWS)


def test_terms_with_one_hash_are_told_apart(monkeypatch):
    """Constant hashes: every term still has its own postings, in a block and when runs are merged."""
    class Alike(sd.Terms):
        def __init__(self, texts):
            super().__init__(texts)
            self.key = self.key % 3

    monkeypatch.setattr(sd, "Terms", Alike)
    monkeypatch.setattr(sd, "SLAB", 3)
    blocks = []
    for k in range(3):
        block = sd.Block()
        block.add([(lang, source, t.encode()) for lang, source, t in ROWS[k:] + ROWS[:2]])
        blocks.append(block)
        assert plain(block) == counted(ROWS[k:] + ROWS[:2])
    slabs = [{n: v.as_py() if n in ("shard", "run_group", "lead") else v.as_py() if n in ("term", "lang", "source") else v.values.to_numpy() for n, v in zip(batch.schema.names, (c[i] for c in batch.columns))} for block in blocks for batch in [sd._slab_rows(block.postings(), list(block.groups), 0)] for i in range(batch.num_rows)]
    for most in (1, 5, 10**6):
        monkeypatch.setattr(sd, "MERGED", most)
        groups, found = {}, {}
        for table in sd._merged(iter(sorted(slabs, key=lambda s: s["lead"])), groups):
            at = 0
            for term, k in zip(table["term"], table["postings"].tolist()):
                for j in range(at, at + k):
                    assert (term, list(groups)[table["of"][j]]) not in found
                    found[term, list(groups)[table["of"][j]]] = (table["n"][j], table["docs"][j])
                at += k
        assert found == counted([r for k in range(3) for r in ROWS[k:] + ROWS[:2]])


def test_long_texts_are_taken_in_pieces(spark, monkeypatch):
    text = "Alpha beta,é9gamma " * 300 + "q" * 400 + " end"
    pieces = list(sd._in_pieces("en", "a", text))
    assert pieces == [("en", "a", text.encode())]
    monkeypatch.setattr(sd, "PIECE", 37)
    pieces = list(sd._in_pieces("en", "a", text))
    assert b"".join(p[2] for p in pieces) == text.encode() and len(pieces) > 100
    block = sd.Block()
    block.add([("en", "b", b"alpha"), pieces[0]])
    for p in pieces[1:]:
        block.add([p], follows=True)
    block.add([("en", "a", b"end")])
    assert plain(block) == counted([("en", "b", "alpha"), ("en", "a", text), ("en", "a", "end")])


@pytest.mark.parametrize("block", [1, 7, 60, 10**6])
def test_blocks_cut_long_texts(monkeypatch, block):
    """A text over several blocks is one document of each of its terms."""
    monkeypatch.setattr(sd, "PIECE", 29)
    random.seed(block)
    rows = [(random.choice(["en", "de"]), random.choice("ab"), " ".join(random.choice(["Ab", "c", "ünï", "x" * 40, "9"]) for _ in range(random.choice([0, 3, 90])))) for _ in range(25)]
    total = {}
    for held in sd.blocks(iter(rows), block):
        for key, (n, docs) in plain(held).items():
            old = total.get(key, (0, 0))
            total[key] = (old[0] + n, old[1] + docs)
    assert total == counted(rows)


def test_empty_table(spark):
    assert sd.audit(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_shares_are_exact_for_large_counts():
    import numpy as np

    for n, total in ((10**12 + 7, 3 * 10**13 + 1), (0, 10**14), (5 * 10**13, 10**14 + 13), (3, 9)):
        assert sd.shares(np.array([n]), total)[0] == 1 + 10**9 * (n + 5) // total
