"""The shingle join against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_pipeline import near_dedup
from corpusmill.llm import gram_join
from tests.llm.test_dedup import counted, groups_of, plain_fingerprint


def plain_set(text, shingle=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    return {tuple(words[k : k + shingle]) for k in range(len(words) - shingle + 1)} or ({tuple(words)} if words else set())


def linked(a, b, percent=85, shingle=4):
    x, y = plain_set(a, shingle), plain_set(b, shingle)
    return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)


@pytest.mark.parametrize("percent", [70, 80, 85, 95, 100])
def test_alike_sets_have_a_key_in_common(percent):
    """Whatever is frequent: sets of all sizes whose similarity is just high enough, rare, frequent and very frequent shingles in any mix."""
    rng = np.random.default_rng(percent)
    for round_ in range(400):
        n = int(rng.integers(1, [12, 60, 400][round_ % 3]))
        x = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        lost = int(rng.integers(0, (100 - percent) * n // 100 + 1))
        rest = rng.permutation(x)[lost:]
        gained = 0
        while 100 * len(rest) >= percent * (len(x) + gained + 1) and rng.random() < 0.9:
            gained += 1
        y = np.unique(np.concatenate([rest, rng.integers(-(2**63), 2**63 - 1, gained)]))
        if not len(rest) or not gram_join.alike(x, y, percent) or np.array_equal(x, y):
            continue
        both = np.union1d(x, y)
        share = [0.2, 0.8, 1.0][round_ // 3 % 3]
        frequent = np.sort(both[rng.random(len(both)) < share])
        table = (frequent, rng.choice([4, 5, 6, 10, 12], len(frequent)))
        assert np.intersect1d(gram_join.keys_of(x, table, percent), gram_join.keys_of(y, table, percent)).size
        assert (np.bitwise_count((gram_join.bitmap(x) ^ gram_join.bitmap(y)).view(np.uint64)).sum()) <= len(np.setxor1d(x, y))


def test_frequent_shingles_meet_by_combinations():
    """A text that shares one frequent shingle with others doesn't meet them; the keys stay few."""
    x = np.unique(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 400))
    table = (x, np.full(len(x), 5))
    assert not np.intersect1d(gram_join.keys_of(x, table), x).size and len(gram_join.keys_of(x, table)) < 3 * len(x)
    rare = gram_join.keys_of(x, (x[:100], np.full(100, 5)))
    assert len(rare) == 61 and not np.intersect1d(rare, x[:100]).size


def test_groups_of_all_pairs(spark):
    random.seed(5)
    rows = []
    for n in (1, 3, 4, 9, 10, 11, 40, 150, 600):
        for _ in range(3):
            words = [f"w{random.randrange(5000)}" for _ in range(n)]
            for part in (0, 0.01, 0.02, 0.03, 0.04):
                rows.append(" ".join(f"x{random.randrange(5000)}" if random.random() < part else w for w in words))
    crowd = [f"c{k}" for k in range(60)]
    rows += [" ".join([*crowd[:k], "new", *crowd[k + 1 :]]) for k in range(60)]
    passage = [f"p{k}" for k in range(90)]
    rows += [" ".join([*passage, *(f"u{random.randrange(10**6)}" for _ in range(random.choice([2, 5, 9, 14, 20, 60])))]) for _ in range(90)]
    rows += ["chain " + " ".join(f"k{j}" for j in range(i, i + 100)) for i in range(0, 60, 3)]
    rows += [" ".join(rows[30].split()).upper(), "", None, " \n\t", "É x", "é x", "a b c", "word " * 5000]
    ids = list(range(len(rows)))
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in zip(ids, rows)] + [(None, rows[0], "y", 2), (3, rows[3], "z", 3), (None, "nowhere else", None, None)], "doc_id long, text string, component_id string, n int")
    want = groups_of(ids, [(a, b) for a, b in combinations(ids, 2) if linked(rows[a], rows[b])])
    out = gram_join.join_grams(docs.repartition(2)).collect()
    assert len(out) == len(rows) + 3 and len(set(want.values())) < len(rows)
    for r in out:
        if r.doc_id is not None:
            assert (r.component_id, r.n_shingles) == (want[r.doc_id], len(plain_set(rows[r.doc_id])))
    assert sorted((r.n_shingles, str(r.component_id)) for r in out if r.doc_id is None) == [(1, "0"), (1, "None")]


def test_long_texts_with_a_passage_in_common_are_not_verified(spark, monkeypatch):
    """They meet by its shingles, and half of 256 bits are as many as alike sets of their size may differ in."""
    random.seed(12)
    passage = [f"p{k}" for k in range(300)]
    rows = [" ".join([*passage, *(f"u{random.randrange(10**6)}" for _ in range(1200))]) for _ in range(12)]
    rows.append(" ".join([*rows[3].split()[:-40], *(f"v{k}" for k in range(40))]))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    seen = counted(monkeypatch, gram_join)
    assert {r.doc_id: r.component_id for r in gram_join.join_grams(docs).collect()} == {k: 3 if k == 12 else k for k in range(13)}
    assert sum(seen) == 1


def test_equal_buckets_count_once(spark):
    rows = [(k, n) for k in range(40) for n in (3, 7, 9)] + [(k, n) for k in range(50, 55) for n in (3, 7)] + [(60, 5), (61, 5), (62, 9), (62, 5)]
    kept = {}
    for r in gram_join.different_buckets(spark.createDataFrame(rows, "key long, node long")).collect():
        kept.setdefault((r.key, r.first), set()).add(r.node)
    assert kept == {(0, 3): {3, 7, 9}, (50, 3): {3, 7}, (62, 5): {5, 9}}


def test_sets_that_meet_by_many_keys_are_paired_once(spark):
    """All pairs of different groups that meet, with few repeats: near copies have most of their keys in common."""
    random.seed(6)
    members = {(key, node) for key in range(-150, 150) for node in range(40) if random.random() < 0.9} | {(500 + node // 2, node) for node in range(90)}
    groups = [(node, node - node % 4) for node in range(80)]
    rest = gram_join.open_buckets(spark.createDataFrame(sorted(members), "key long, node long"), spark.createDataFrame(groups, "node long, component long"))
    bits = [F.lit(0).cast("long").alias(f"b{i}") for i in range(1, 5)]
    found = [(r.a, r.b) for r in gram_join.open_pairs(rest.select("*", F.lit(100).alias("n"), *bits, F.lit(None).cast("array<long>").alias("wide")), 85).collect()]
    of, held = dict(groups), {}
    for key, node in members:
        held.setdefault(key, set()).add(node)
    met = [p for nodes in held.values() for p in combinations(sorted(nodes), 2) if of.get(p[0], p[0]) != of.get(p[1], p[1])]
    assert set(found) == set(met) and len(met) > 100 * len(set(met)) and len(found) < 2 * len(set(found))


def test_empty_tables_and_bounds(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert gram_join.join_grams(docs).collect() == []
    with pytest.raises(ValueError):
        gram_join.join_grams(docs, percent=60)


def test_other_thresholds(spark):
    random.seed(9)
    base = [f"w{k}" for k in range(80)]
    rows = [" ".join(f"y{random.randrange(10**6)}" if random.random() < p else w for w in base) for p in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    want = groups_of(range(len(rows)), [(a, b) for a, b in combinations(range(len(rows)), 2) if linked(rows[a], rows[b], 80, 5)])
    assert {r.doc_id: r.component_id for r in gram_join.join_grams(docs, 80, 5).collect()} == want


def test_near_copies_of_documents_go(spark):
    """Every pair of five-word shingles at 0.8 and every pair of fingerprints, one document of each group; ids that are null or shared stay."""
    random.seed(8)
    rows = []
    for n in (1, 4, 5, 12, 40, 150, 600):
        for _ in range(3):
            words = [f"w{random.randrange(5000)}" for _ in range(n)]
            for part in (0, 0.01, 0.02, 0.03, 0.05):
                rows.append(" ".join(f"x{random.randrange(5000)}" if random.random() < part else w for w in words))
    crowd = [f"c{k}" for k in range(60)]
    rows += [" ".join([*crowd[:k], "new", *crowd[k + 1 :]]) for k in range(60)]
    rows += [f"this phrase is in every one {' '.join(random.choice('abcdefgh') + str(random.randrange(400)) for _ in range(20))}" for _ in range(80)]
    rows += [" ".join(rows[30].split()).upper(), "", None, " \n"]
    ids = list(range(len(rows)))
    docs = spark.createDataFrame([(k, t, "x") for k, t in zip(ids, rows)] + [(None, rows[0], "y"), (3, rows[3], "z")], "doc_id long, text string, component_id string")
    near = [(a, b) for a, b in combinations(ids, 2) if linked(rows[a], rows[b], 80, 5)]
    prints = [plain_fingerprint(t) for t in rows]
    same = [(a, b) for a, b in combinations(ids, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert len(set(groups_of(ids, near).values())) < len(set(groups_of(ids, same).values()))
    kept = near_dedup(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(groups_of(ids, near + same).values()) | {None}
