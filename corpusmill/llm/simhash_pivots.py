"""SimHash near-duplicates with pivot distance tables.

Each distinct fingerprint has a row of Hamming distances to fixed reference fingerprints. Fingerprints that agree
in enough blocks of bits meet in a bucket; of the pairs in a bucket those go whose rows differ by more than the
allowed distance in any coordinate (the triangle inequality), and the rest are verified bit by bit.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows, settled
from corpusmill.llm.graph import connected

BITS = 64
SHINGLE = 3
SEED = 42
MAX_DISTANCE = 2
#: Blocks of bits; two fingerprints within MAX_DISTANCE agree in at least BLOCKS - MAX_DISTANCE of them.
BLOCKS = 5
#: Reference fingerprints: a multiple of eight, eight distances to a word.
PIVOTS = 16
#: Fingerprints in a bucket of which all pairs are compared; fuller buckets go by way of shared neighbours.
BUCKET = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    count = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), "<u8", count)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Fingerprint of each text: id, fp bigint."""
    return map_rows(docs.select(F.col(id_col), F.col(text_col).alias("_body")), [id_col, "_body"], 1, [T.StructField("fp", T.LongType())], lambda: lambda texts: [[fingerprint(t, shingle) for t in texts]])


def pivots(n: int = PIVOTS) -> list[int]:
    """The reference fingerprints, as signed numbers."""
    return [xxhash.xxh64_intdigest(f"reference {i}".encode()) - (1 << 63) for i in range(n)]


def pivot_table(fp: Column, n: int = PIVOTS) -> list[Column]:
    """Distances of a fingerprint to the reference fingerprints, eight packed into a word."""
    distances = [F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long") for p in pivots(n)]
    return [reduce(Column.bitwiseOR, [F.shiftleft(d, 8 * i) for i, d in enumerate(distances[w : w + 8])]) for w in range(0, n, 8)]


def coordinates_close(left: list[Column], right: list[Column], limit: int) -> Column:
    """No two distances of the same coordinate differ by more than the limit."""
    def at(word: Column, i: int) -> Column:
        return F.shiftright(word, 8 * i).bitwiseAND(F.lit(127))

    return reduce(Column.__and__, [F.abs(at(x, i) - at(y, i)) <= limit for x, y in zip(left, right, strict=True) for i in range(8)])


def masks(blocks: int, keep: int) -> list[int]:
    """Bit masks (signed) of all choices of `keep` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    single = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    chosen = [sum(c) for c in combinations(single, keep)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in chosen]


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints differ in at most max_distance bits.

    prints: node, fp, both unique. In buckets of at most `bucket` fingerprints every pair passes the pivot tables and
    the bit count. In fuller ones a fingerprint goes to each fingerprint that differs from it in half the allowed
    distance; two within max_distance meet at one, where few can meet, and each is linked to the first that came
    there, again only if pivot tables and bit count agree. No link is lost: who meets is within max_distance.
    """
    words = [f"t{i}" for i in range(PIVOTS // 8)]
    table = settled(prints.select("node", "fp", *(c.alias(w) for w, c in zip(words, pivot_table(F.col("fp")), strict=True))))
    every = F.array(*(F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks(blocks, blocks - max_distance))))
    keyed = table.select("node", F.explode(every).alias("key")).select("node", F.xxhash64("key.k", "key.v").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b")).where("n > 1")
    buckets = settled(buckets)

    def verified(pairs: DataFrame) -> DataFrame:
        left = table.select(F.col("node").alias("a"), F.col("fp").alias("fa"), *(F.col(w).alias(f"a{w}") for w in words))
        right = table.select(F.col("node").alias("b"), F.col("fp").alias("fb"), *(F.col(w).alias(f"b{w}") for w in words))
        return pairs.join(left, "a").join(right, "b").where(_near([f"a{w}" for w in words], [f"b{w}" for w in words], "fa", "fb", max_distance)).select("a", "b")

    twos = verified(buckets.where("n = 2").select("a", "b").distinct())
    members = keyed.join(buckets.where(f"n > 2 and n <= {bucket}").select("key"), "key").join(table, "node")
    left = members.select("key", F.col("node").alias("a"), F.col("fp").alias("fa"), *(F.col(w).alias(f"a{w}") for w in words))
    right = members.select("key", F.col("node").alias("b"), F.col("fp").alias("fb"), *(F.col(w).alias(f"b{w}") for w in words))
    near = _near([f"a{w}" for w in words], [f"b{w}" for w in words], "fa", "fb", max_distance)
    some = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & near).select("a", "b")

    crowded = keyed.join(buckets.where(f"n > {bucket}").select("key"), "key").select("node").distinct().join(table, "node")
    reach = max_distance - max_distance // 2
    flips = [sum(1 << i for i in c) for r in range(reach + 1) for c in combinations(range(BITS), r)]
    signed = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    met = crowded.select("node", F.explode(F.transform(F.array(*map(F.lit, signed)), lambda f: f.bitwiseXOR(F.col("fp")))).alias("place"))
    first = met.groupBy("place").agg(F.min("node").alias("a"), F.collect_set("node").alias("all")).where(F.size("all") > 1)
    if max_distance % 2 == 0:
        hub = first.select("a", F.explode("all").alias("b")).where("a < b")
    else:  # two that meet can be one bit too far apart: all of the few that meet are paired
        hub = first.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b")).where("a < b")
    return twos.unionByName(some).unionByName(verified(hub.distinct()))


def _near(left: list[str], right: list[str], fa: str, fb: str, max_distance: int) -> Column:
    close = coordinates_close([F.col(c) for c in left], [F.col(c) for c in right], max_distance)
    return close & (F.bit_count(F.col(fa).bitwiseXOR(F.col(fb))) <= max_distance)


def group_near_copies(docs: DataFrame, max_distance: int = MAX_DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and group of each document: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that can be reached over fingerprints that differ in at most max_distance bits.
    Null, empty and blank texts have fingerprint 0 and are linked like others. Rows without an id get the component
    of the documents with the same fingerprint, null if there are none. Texts of any length are taken whole. Repeated rows give repeated results, an empty
    table none; other columns are ignored.
    """
    prints = settled(fingerprints(docs, id_col, text_col).toDF("_id", "fp"))
    distinct = settled(prints.groupBy("fp").agg(F.min("_id").alias("node")))
    groups = connected(links(distinct.where("node is not null"), max_distance), "a", "b")
    component = distinct.join(groups, "node", "left").select(F.col("fp").alias("_fp"), F.coalesce("component", "node").alias("component_id"))
    joined = prints.join(component, prints["fp"] == component["_fp"], "left")
    return joined.select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, max_distance: int = MAX_DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is the smallest of its group, unchanged and with all their columns.

    Rows without an id stay, and so do all rows that share a kept id.
    """
    groups = group_near_copies(docs, max_distance, id_col, text_col)
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
