import glob
import math
import random
import time
from itertools import combinations

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import batches, fuzzy_lines, graph, simhash_pivots, suffix_automaton
from corpusmill.llm.queries import OP5_SQL


def groups_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("links", [[], [(1, 2)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)], [(5, 3), (3, 5), (3, 3), (9, 8), (8, 7), (1, 7)]])
def test_connected_groups(spark, links):
    found = {r.node: r.component for r in graph.connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    nodes = {x for pair in links for x in pair if pair[0] != pair[1]}
    assert found == groups_of(nodes, [p for p in links if p[0] != p[1]])


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_groups_of_fingerprints(spark):
    random.seed(4)
    words = [f"w{k}" for k in range(30)] + ["É", "Straße"]
    base = [" ".join(random.choice(words) for _ in range(200)) for _ in range(12)]
    near = [t.replace(" w1 ", " q ", 1) for t in base for _ in range(2)] + [t + " end" for t in base]
    rows = base + near + ["", None, " \n", "A b", "a B", "one", "a b c", "word " * 20_000]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(rows)] + [(None, "A b", 1, "x"), (3, rows[3], 2, "y")], "doc_id long, text string, fp int, component_id string")
    out = simhash_pivots.group_near_copies(docs).collect()
    prints = [plain_fingerprint(t) for t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = groups_of(range(len(rows)), links)
    assert len(out) == docs.count()
    for r in out:
        k = rows.index("A b") if r.doc_id is None else r.doc_id
        assert r.fingerprint == f"{prints[k]:016x}" and r.component_id == want[k]
    kept = simhash_pivots.keep_one_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(want.values()) | {None}
    assert simhash_pivots.group_near_copies(docs.where("false")).count() == 0


@pytest.mark.parametrize("distance,bucket", [(2, 64), (2, 3), (3, 4), (1, 2)])
def test_links_find_every_pair(spark, distance, bucket):
    """Small and crowded buckets together connect what brute force connects, and never more."""
    random.seed(distance)
    prints = set()
    for _ in range(12):
        f = random.getrandbits(64)
        prints |= {f} | {f ^ sum(1 << b for b in random.sample(range(64), random.randrange(1, 5))) for _ in range(25)}
    prints = sorted(prints)
    table = spark.createDataFrame([(k, f - (1 << 64) if f >> 63 else f) for k, f in enumerate(prints)], "node long, fp long")
    found = [(r.a, r.b) for r in simhash_pivots.links(table, distance, bucket=bucket).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= distance for a, b in found)
    want = [(a, b) for a, b in combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= distance]
    assert groups_of(range(len(prints)), found) == groups_of(range(len(prints)), want)


def test_pivot_tables_never_lose_a_near_pair(spark):
    random.seed(9)
    pairs = [(f := random.getrandbits(63), f ^ sum(1 << b for b in random.sample(range(63), 2))) for _ in range(200)] + [(random.getrandbits(63), random.getrandbits(63)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long")
    close = simhash_pivots.coordinates_close(simhash_pivots.pivot_table(F.col("a")), simhash_pivots.pivot_table(F.col("b")), 2)
    flags = [r[0] for r in df.select(close).collect()]
    assert all(flags[:200]) and sum(flags[200:]) < 20


def plain_blocks(words):
    """Keys of a line, by loops: SimHashes of the first four words of each class, or all words but one."""
    long = [w for w in words if len(w) >= fuzzy_lines.LONG_WORD]
    s = sorted({h - (h >> 63 << 64) for h in (xxhash.xxh64_intdigest(w.encode(), seed=42) for w in (words if len(long) < 3 else long))})
    every, keys = 0, set()
    for h in s:
        every ^= h
    for n in {len(s), math.ceil(len(s) * 0.8)}:
        if n < fuzzy_lines.SHORT:
            keys |= {every} | ({every ^ h for h in s} if len(s) > 2 else set())
            continue
        bits = int(math.log2(n / fuzzy_lines.PER_CLASS))
        classes = {}
        for h in s:
            classes.setdefault(h % 2**64 >> 64 - bits, []).append(h % 2**64)
        for block in classes.values():
            if len(block) >= 4:
                keys.add(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in block[:4]) > 2))
    return {k % 2**64 for k in keys}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lines_alike(a, b):
    """The edit similarity of two lists of words is 0.8, or that of the characters of lines of at most 20 words."""
    def near(x, y):
        allowed = int(max(len(x), len(y)) * 0.2 + 1e-9)
        return abs(len(x) - len(y)) <= allowed and edits(x, y) <= allowed

    if len(set(a) - set(b)) <= 0.2 * max(len(a), len(b)) + 1e-9 and near(a, b):
        return True
    return max(len(a), len(b)) <= fuzzy_lines.FEW_WORDS and near(" ".join(a), " ".join(b))


def first_lines(docs):
    first = {}
    for i, t in sorted((i, t) for i, t in docs if i is not None and t is not None):
        for n, line in enumerate(t.split("\n")):
            if key := tuple(line.lower().split()):
                first.setdefault(key, (i, n))
    return first


def deduped_by_loops(docs):
    """id -> text with the first line of each group, by comparing all lines that have a block in common."""
    first = first_lines(docs)
    holders = {}
    for key in first:
        for block in plain_blocks(list(key)):
            holders.setdefault(block, []).append(key)
    pairs = {tuple(sorted(p)) for keys in holders.values() for p in combinations(keys, 2)}
    group = groups_of(first.values(), [(first[a], first[b]) for a, b in pairs if lines_alike(a, b)])
    keep = {place for place in first.values() if group[place] == place}
    out = {}
    for i, t in docs:
        if i is not None and t is not None:
            lines = t.split("\n")
            keys = [tuple(line.lower().split()) for line in lines]
            out[i] = "\n".join(line for n, (line, key) in enumerate(zip(lines, keys)) if not key or (i, n) in keep and first[key] == (i, n))
    return out


@pytest.mark.parametrize("bucket", [50, 3])
def test_fuzzy_lines_like_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(fuzzy_lines, "candidates", lambda lines, f=fuzzy_lines.candidates: f(lines, bucket=bucket))
    random.seed(6)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "Épée", "longerword", "x"]
    long = [" ".join(random.choice(words) + str(random.randrange(99)) for _ in range(60)) for _ in range(8)]
    lines = long + [" ".join([*t.split()[:-1], "changed"]) for t in long] + [t.upper() for t in long] + ["short line", "Short  LINE", "", "  ", "a", "the the the", "\t"]
    lines += ["Subscribe to our newsletter!", "Subscribe to our newsletter.", "Subscribe to our newsleter"]
    docs = [(k, "\n".join(random.choice(lines) for _ in range(random.randrange(1, 6)))) for k in range(60)] + [(60, ""), (61, None), (None, long[0]), (62, "w " * 30_000)]
    frame = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id long, text string, id string, line int")
    out = fuzzy_lines.dedup_lines(frame).collect()
    want = deduped_by_loops(docs)
    assert len(out) == len(docs)
    for r in out:
        assert r.text == (want.get(r.doc_id) if r.doc_id is not None and r.doc_id != 61 else dict(docs)[r.doc_id]), r.doc_id
    kept = fuzzy_lines.keep_first_lines(frame)
    assert kept.columns == frame.columns
    stay = {i for i, t in docs if i is None or not (t or "").strip() or want[i].strip()}
    assert {r.doc_id for r in kept.collect()} == stay
    assert fuzzy_lines.dedup_lines(frame.where("false")).count() == 0


def crowd():
    """Lines that share one block with a hundred others, and are like one of these that isn't the first there."""
    random.seed(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    ends = ["".join(random.choice(letters) for _ in range(9)) for _ in range(60)]
    ends += [e[:-1] + ("z" if e[-1] != "z" else "a") for e in ends]
    opening = " ".join(f"opening{k}" for k in range(12))
    filler = [[f"filler{k}x{i}" for i in range(12)] for k in range(60)]
    long = [f"{opening} {' '.join(f)}" for f in filler] + [f"{opening} {' '.join([*f[:-1], 'changed'])}" for f in filler]
    return list(enumerate([f"alpha beta gamma {e}" for e in ends] + long))


def test_crowded_buckets_lose_no_links(spark):
    docs = crowd()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i: t for i, t in deduped_by_loops(docs).items() if t}
    assert 100 < len(want) <= len(docs) // 2
    assert {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(frame).collect() if r.text} == want


def test_line_dedup_stage_of_crowded_buckets(spark):
    docs = crowd()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i for i, t in deduped_by_loops(docs).items() if t}
    assert {r.doc_id for r in corpus_pipeline.line_dedup(spark, frame, "").collect()} == want


def counted(monkeypatch, module):
    """Numbers of pairs that a module verifies, one for each call."""
    seen, verify = [], module.verify
    monkeypatch.setattr(module, "verify", lambda pairs, *more: seen.append(pairs.count()) or verify(pairs, *more))
    return seen


@pytest.mark.parametrize("stage", [fuzzy_lines.dedup_lines, lambda docs: corpus_pipeline.line_dedup(docs.sparkSession, docs, "")], ids=["op6", "pipeline"])
def test_crowded_buckets_compare_few_pairs(spark, monkeypatch, stage):
    """Lines that share an opening and a block, all other words twice: only near copies are verified, not all pairs of the bucket."""
    random.seed(8)
    opening = [f"opening{k}" for k in range(60)]
    lines = []
    for k in range(120):
        words = [f"filler{k}x{i}" for i in range(12)] * 2
        lines += [" ".join([*opening, *words]), " ".join([*opening, *words[:-1], "changed"])]
    docs = list(enumerate(random.sample(lines, len(lines))))
    seen = counted(monkeypatch, fuzzy_lines)
    left = {r.doc_id: r.text for r in stage(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r.text}
    assert left == {i: t for i, t in deduped_by_loops(docs).items() if t} and len(left) == 120
    assert len(seen) == 3 and sum(seen) < 2000  # of 28,680 pairs


def test_lines_of_texts_with_any_white_space(spark):
    """Texts are made even once, before they are cut: lines and words are those of each line alone, and the stored table of hashes tries no dictionary."""
    texts = ["One\ttwo\r\n \x85\n\xa0three\x0bfour\x0cFIVE ", "plain line\n\n  \nΟΔΟΣ Σ\nΣ\tİx", "\r", "", "one two\nlast\t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    table, path = batches.stored(fuzzy_lines.keyed_lines(docs), dictionary=False)
    lines = [(k, i, line) for k, text in enumerate(texts) for i, line in enumerate(text.split("\n")) if line.strip()]
    each = spark.createDataFrame(lines, "id long, line int, body string").withColumn("words", fuzzy_lines.line_words(F.col("body"))).cache()
    assert [r.words for r in each.orderBy("id", "line").collect()] == [["one", "two"], ["three", "four", "five"], ["plain", "line"], ["οδος", "σ"], ["σ", "i̇x"], ["one", "two"], ["last"]]
    assert {tuple(r) for r in table.where("id is not null").select("id", "line", "h1").collect()} == {tuple(r) for r in each.select("id", "line", F.xxhash64("words")).collect()}
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet")]
    written = [file.row_group(i) for file in files for i in range(file.num_row_groups)]
    assert written and not any(group.column(i).has_dictionary_page for group in written for i in range(group.num_columns))


def test_blocks_of_lines_come_once(spark):
    """Lines of any number of words have the blocks of the loops; where both numbers of classes share a block it is one row, not two."""
    lines = [" ".join(f"word{n}x{k}" for k in range(n)) for n in range(1, 90)] + ["a b c", "a bb cc dddd", "same same same words words four"]
    keyed = fuzzy_lines.keyed_lines(spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "id long, text string")).collect()
    node = {r.h1: r.id for r in keyed if r.id is not None}
    keys = [(node[r.h1], r.key % 2**64) for r in keyed if r.key is not None]
    assert set(keys) == {(n, key) for n, line in enumerate(lines) for key in plain_blocks(line.split())}
    assert len(keys) == len(set(keys)) and len(node) == len(lines)


def test_edits_of_long_lines_by_pieces(spark):
    """Edits that are counted piece by piece first link the lines that the edits of whole lines link, those moved by a word too."""
    random.seed(5)
    pairs = []
    for n in (101, 150, 263):
        words = [f"w{random.randrange(60)}" for _ in range(n)]
        for share in (0.02, 0.19, 0.2, 0.21, 0.3):
            places = random.sample(range(n), int(n * share))
            pairs += [(words, [f"new{k}" if k in places else w for k, w in enumerate(words)]), (words, [w for k, w in enumerate(words) if k not in places]), (words, words[len(places) // 2 :] + words[: len(places) // 2])]
    rows = [(2 * k + i, words) for k, pair in enumerate(pairs) for i, words in enumerate(pair)]
    text = spark.createDataFrame(rows, "node long, words array<string>").select("node", fuzzy_lines.word_letters(F.col("words")).alias("letters"), F.lit(None).cast("string").alias("norm"))
    found = fuzzy_lines.verify(spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(pairs))], "a long, b long"), text)
    assert {r.a // 2 for r in found.collect()} == {k for k, (x, y) in enumerate(pairs) if edits(x, y) <= int(max(len(x), len(y)) * 0.2 + 1e-9)}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_first_of_equal_lines_by_id(spark, kind):
    """The first occurrence is that of the smallest id, then line, for ids of any range and of other types."""
    ids = [-(2**63), -7, 0, 5, 2**63 - 1]
    ids = ids if kind == "long" else sorted(str(i) for i in ids)
    docs = [(i, "same words here\nsame words here") for i in reversed(ids)]
    out = {r.doc_id: r.n_dropped for r in fuzzy_lines.dedup_lines(spark.createDataFrame(docs, f"doc_id {kind}, text string")).collect()}
    assert out == {i: 1 if i == ids[0] else 2 for i in ids}


def test_recall_of_like_lines_without_blocks(spark):
    """Of all pairs of lines of the table at the similarity, found by comparing every line with every other, nine tenths end in one group."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = sorted(first_lines([(r.doc_id, r.text) for r in docs.collect()]), key=len)
    size = np.array([len(w) for w in lines])
    words = {w: k for k, w in enumerate({w for line in lines for w in line})}
    sets = [np.unique([words[w] for w in line]) for line in lines]
    mark, found = np.zeros(len(words), bool), []
    starts, flat = np.cumsum([0, *(len(s) for s in sets)]), np.concatenate(sets)
    for i in range(len(lines) - 1):
        end = int(np.searchsorted(size, size[i] / 0.8 + 1e-9, side="right"))
        if end > i + 1:
            mark[sets[i]] = True
            shared = np.add.reduceat(mark[flat[starts[i + 1] : starts[end]]], starts[i + 1 : end] - starts[i + 1])
            mark[sets[i]] = False
            # every distinct word that only one of them has is an edit at least
            alone = np.maximum(len(sets[i]), np.diff(starts)[i + 1 : end]) - shared
            found += [(i, i + 1 + int(k)) for k in np.flatnonzero(alone <= 0.2 * size[i + 1 : end] + 1e-9) if lines_alike(list(lines[i]), list(lines[i + 1 + k]))]
    assert len(found) > 250
    kept = fuzzy_lines.dedup_lines(docs).collect()
    left = {tuple(line.lower().split()) for r in kept for line in r.text.split("\n")}
    groups = groups_of(range(len(lines)), found)
    members = {}
    for k, g in groups.items():
        members.setdefault(g, []).append(k)
    lost = sum(len(m) - 1 for m in members.values())
    extra = sum(sum(lines[k] in left for k in m) - 1 for m in members.values())
    assert 0 <= extra <= 0.1 * lost, (extra, lost)


def windows_by_loops(docs, items, size=10):
    split = suffix_automaton.words_of
    out = {}
    for i, t in docs:
        words = split(t or "")
        hit, found = set(), set()
        for item, text in items:
            w = split(text or "")
            n = min(size, len(w))
            windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
            for k in range(len(words) - n + 1):
                if n and tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(item)
        out[i] = (len(words), len(hit), len(found), suffix_automaton.items_digest(found), bool(hit))
    return out


@pytest.mark.parametrize("block_words", [100_000, 30])
def test_contamination_like_loops_and_sql(spark, block_words):
    random.seed(7)
    letters = "abcdé"
    items = [(k, " ".join(random.choice(letters) for _ in range(random.choice([1, 3, 9, 10, 11, 25])))) for k in range(25)] + [(90, ""), (91, None), (92, "?!"), (93, "A-b c, D"), (94, "a b c d")]
    docs = [(k, random.choice([" ", ", ", "\n"]).join(random.choice(letters + "XYZ") for _ in range(random.randrange(0, 60)))) for k in range(60)]
    docs += [(k + 100, f"Zz {t} zZ {t}") for k, (_, t) in enumerate(items)] + [(200, None), (201, "")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_hit int, spans string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    rows = {r.doc_id: tuple(r)[1:] for r in suffix_automaton.contamination(frame, tests, block_words=block_words).collect()}
    assert rows == windows_by_loops(docs, items)
    duck = duckdb.connect()
    duck.register("d", frame.select("doc_id", "text").toPandas())
    duck.register("b", tests.toPandas())
    duck.sql("CREATE VIEW documents AS SELECT * FROM d; CREATE VIEW benchmark AS SELECT * FROM b")
    assert {r[0]: r[1:] for r in duck.sql(OP5_SQL).fetchall()} == rows
    assert suffix_automaton.contamination(frame.where("false"), tests).count() == 0
    assert {r.n_hit for r in suffix_automaton.contamination(frame, tests.where("false")).collect()} == {0}


def test_passages_are_cut_out(spark):
    passage = " ".join(f"q{k}" for k in range(15))
    docs = spark.createDataFrame([(1, "clean words stay, as they are.", "en"), (2, f"Before it: {passage.upper()}! After " + "w " * 40, "en"), (3, passage, None), (4, None, "de"), (5, "", "de")], "doc_id long, text string, lang string")
    tests = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = suffix_automaton.decontaminate(docs, tests)
    rows = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and rows == {1: "clean words stay, as they are.", 2: "Before it: ! After " + "w " * 40, 4: None, 5: ""}
    # what is left on both sides of a cut can be a window again
    nested = " ".join(passage.split()[:7]) + " " + passage + " " + " ".join(passage.split()[7:]) + " x" * 60
    left = suffix_automaton.decontaminate(spark.createDataFrame([(1, nested)], "doc_id long, text string"), tests).first().text
    assert left.split() == ["x"] * 60
    assert np.array_equal(suffix_automaton.joined([[5, 6], [0, 2], [2, 4]]), [[0, 4], [5, 6]])


def test_repeated_words_take_linear_time():
    """An item of one word over and over has a state for each length; the windows of all are found in one step."""
    item = "again " * 4000
    began = time.process_time()
    automaton = suffix_automaton.ItemAutomaton([(1, item), (2, "again and")])
    spans, items = automaton.scan(suffix_automaton.words_of("again " * 400_000 + "and"))
    assert spans == [[0, 400_001]] and items == {1, 2} and time.process_time() - began < 10
