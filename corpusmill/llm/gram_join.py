"""Set-similarity join of whole texts on word shingles: every pair whose Jaccard similarity is high enough, none below it.

Shingles have one order for all texts: rare ones first, then frequent ones by how frequent they are. Of two alike sets, the one
whose prefix ends first lacks at most `missing` of its shingles in the other, so a prefix that can lose so many and still
hold a whole combination leaves one that both have. Rare shingles are combinations of one; frequent ones are dealt to classes by
their hash and count by pairs, very frequent ones by triples, and the prefix is extended until that many combinations are sure to
be left. Texts meet by a common combination, only sets of fitting sizes and bitmaps are compared, and all that is linked is
verified on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusmill.llm.batches import discard, map_rows, settled, slices, stored, tidy
from corpusmill.llm.graph import connected
from corpusmill.llm.simhash_pivots import group_near_copies

#: Words of a shingle, and percent of the union that the intersection of linked sets makes up at least.
SHINGLE, PERCENT = 4, 85
#: The same for near copies of documents.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
#: Sets of fewer shingles take single ones only.
SMALL = 8
#: Repeats within tasks from which on a shingle is frequent (counts by pairs) and very frequent (by triples).
FREQUENT, VERY_FREQUENT = 16, 1 << 10
#: Frequent shingles that go to every task at most (9 bytes each), the most frequent ones. Others count as rare ones: more texts
#: meet for it, and the same are linked.
MOST_FREQUENT = 1 << 19
#: Shingles that a task counts at once.
COUNTED = 1 << 22
#: Bits of a set's bitmap, and of the wider one that sets of more than LONG_SET shingles also have: 256 bits of disjoint long sets
#: differ in no more than about half, as those of alike ones may.
BITS, WIDE_BITS, LONG_SET = 256, 2048, 256
#: Smallest keys of a set by which the last comparison tells that two sets also meet elsewhere.
TOLD = 4
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; with fewer words the whole sequence is one, without words there is none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        found = np.full(n, size, np.uint64)
        for i in range(size):
            found = (found ^ each[i : i + n]) * _MIX[0]
            found ^= found >> np.uint64(29)
            found *= _MIX[1]
            found ^= found >> np.uint64(32)
    return np.unique(found.view(np.int64))


def alike(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether sorted sets have the similarity."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both) and both > 0


def bitmap(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whether an odd number of shingles falls to each bit. Sets differ in as many shingles as bits, at least."""
    odd = np.bincount((x.view(np.uint64) >> np.uint64(8)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def scan(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One read of the texts: id, n (shingles), h1, h2 (of the set), b1 to b4 (bitmap), wide (the wider one, null for a set that has none)
    of each; and rows without these for shingles that a task met repeatedly: key, times. docs: id, text."""
    sized = docs.select("id", "text")
    kinds = dict.fromkeys(("n", "h1", "h2", "b1", "b2", "b3", "b4", "wide", "key", "times"), T.LongType()) | {"wide": T.ArrayType(T.LongType())}
    schema = T.StructType([sized.schema["id"], *(T.StructField(c, t) for c, t in kinds.items())])
    kind = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        held, size = [], 0

        def repeated() -> Iterator[pa.RecordBatch]:
            if held:
                keys, times = np.unique(np.concatenate(held), return_counts=True)
                keys, times = keys[times > 1], times[times > 1]
                none = [pa.nulls(len(keys), arrow.field(i).type) for i in range(9)]
                yield pa.RecordBatch.from_arrays([*none, pa.array(keys, kind), pa.array(times, kind)], schema=arrow)

        for batch in batches:
            for piece in slices(batch, 1):
                rows, wide = np.zeros((7, piece.num_rows), np.int64), []
                for i, text in enumerate(piece.column(1).to_pylist()):
                    x = shingles(text, shingle)
                    digest = xxhash.xxh3_128_intdigest(x.tobytes())
                    rows[:3, i] = len(x), (digest & (2**64 - 1)) - 2**63, (digest >> 64) - 2**63
                    rows[3:, i] = bitmap(x)
                    wide.append(bitmap(x, WIDE_BITS) if len(x) > LONG_SET else None)
                    held.append(x)
                    size += len(x)
                columns = [piece.column(0), *(pa.array(r, kind) for r in rows), pa.array(wide, pa.list_(kind)), *(pa.nulls(piece.num_rows, kind) for _ in range(2))]
                arrow = arrow or pa.schema([piece.schema.field(0), *(pa.field(c, pa.list_(kind) if c == "wide" else kind) for c in kinds)])
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                if size >= COUNTED:
                    yield from repeated()
                    held, size = [], 0
        yield from repeated()

    return sized.mapInArrow(run, schema)


def frequent_shingles(scanned: DataFrame, least: int = FREQUENT, most: int = MOST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent shingles and the logarithm of each one's count, at least 1; the highest powers of two, as many as fit into `most`."""
    counts = scanned.where("times is not null").groupBy("key").agg(F.sum("times").alias("n")).where(F.col("n") >= least)
    levels = settled(counts.select("key", F.greatest(F.lit(1), F.floor(F.log2("n"))).cast("int").alias("level")))
    taken, floor = 0, None
    for level, n in sorted(levels.groupBy("level").count().collect(), reverse=True):
        if (taken := taken + n) > most:
            break
        floor = level
    if floor is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    table = levels.where(F.col("level") >= floor).toArrow()
    keys = table.column("key").to_numpy()
    order = np.argsort(keys)
    return keys[order], table.column("level").to_numpy()[order].astype(np.int64)


def classes_of(n: int, percent: int) -> int:
    """Logarithm of the number of classes that pairs are dealt to in a set of n; -1: no classes, single shingles only."""
    return -1 if n < SMALL else max(0, ((100 - percent) * n // 200).bit_length() - 1)


def keys_of(x: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int = PERCENT, very: int = VERY_FREQUENT) -> np.ndarray:
    """Hashes of the combinations by which a set meets alike ones, for every number of classes that these can have."""
    n = len(x)
    missing = (100 - percent) * n // 100
    if 100 * n < percent * (n + 1):  # alike sets are equal
        return np.empty(0, np.int64)
    level = np.zeros(n, np.int64)
    if len(frequent[0]):
        at = np.minimum(np.searchsorted(frequent[0], x), len(frequent[0]) - 1)
        level = np.where(frequent[0][at] == x, frequent[1][at], 0)
    x, level = (v[np.lexsort((x, level))] for v in (x, level))
    rare = int((level == 0).sum())
    if rare > missing:
        return x[: missing + 1]
    found = [x[:rare]]
    for classes in {classes_of(n, percent), classes_of(-(-percent * n // 100), percent)}:
        if classes < 0:
            found.append(x[: missing + 1])
            continue
        often, many = x[rare:], level[rare:] >= very.bit_length() - 1
        size = np.where(many, 3, 2)
        group = (often.view(np.uint64) >> np.uint64(1)).astype(np.int64) & ((1 << np.where(many, max(0, classes - 1), classes)) - 1)
        group = 2 * group + many
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        rank = np.empty(len(often), np.int64)  # how many of its class come before a shingle
        rank[order] = np.arange(len(often)) - np.repeat(starts, np.diff(starts, append=len(often)))
        sure = np.cumsum(rank >= size - 1)
        end = int(np.searchsorted(sure, missing + 1 - rare)) + 1
        for g in np.unique(group[:end]).tolist():
            mine = often[:end][group[:end] == g].tolist()
            found.append(np.array([_mixed(c) for c in combinations(mine, 3 if g & 1 else 2)], np.int64))
    return np.unique(np.concatenate(found))


def _mixed(keys: tuple[int, ...]) -> int:
    return xxhash.xxh64_intdigest(b"".join(k.to_bytes(8, "little", signed=True) for k in keys)) - 2**63


def meeting_keys(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """key, id: where each text meets others; of equal sets in a slice of texts one is enough. docs: id, text."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    fields = [T.StructField("key", T.LongType()), docs.schema["id"]]

    def helper(ids, texts):
        keys, owners, seen = [np.empty(0, np.int64)], [], set()
        for i, text in zip(ids, texts, strict=True):
            x = shingles(text, shingle)
            digest = xxhash.xxh3_128_digest(x.tobytes())
            if digest not in seen:
                seen.add(digest)
                keys.append(keys_of(x, shared.value, percent))
                owners += [i] * len(keys[-1])
        return [np.concatenate(keys), owners]

    return map_rows(docs, ["id", "text"], 0, fields, lambda: helper)


def verify(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of ids whose texts have the similarity. docs: id, text. Only the texts in question are moved."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts, path = stored(docs.join(asked, "id").select("id", "text"))
    tidy(docs.sparkSession)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def helper(left, right):
        sets: dict[str, np.ndarray] = {}  # the first of a bucket is in many pairs

        def of(text: str | None) -> np.ndarray:
            if text not in sets:
                sets[text] = shingles(text, shingle)
            return sets[text]

        return [[alike(of(s), of(t), percent) for s, t in zip(left, right, strict=True)]]

    near = map_rows(both, ["a", "b", "ta", "tb"], 2, [T.StructField("near", T.BooleanType())], lambda: helper)
    links = settled(near.where("near").select("a", "b").distinct())
    discard(docs.sparkSession, path)
    tidy(docs.sparkSession)
    return links


def possible(a: str, b: str, percent: int) -> Column:
    """Sets can have the similarity by their sizes and bitmaps: columns n, b1 to b4, wide with the suffixes a and b."""
    x, y = F.col(f"n{a}"), F.col(f"n{b}")
    allowed = (100 - percent) * (x + y)
    apart = sum(F.bit_count(F.col(f"b{i}{a}").bitwiseXOR(F.col(f"b{i}{b}"))) for i in range(1, 5))
    each = F.zip_with(f"wide{a}", f"wide{b}", lambda v, w: F.bit_count(v.bitwiseXOR(w)))
    far = F.aggregate(each, F.lit(0), lambda total, v: total + v)  # null where one of them has no wide bitmap
    return (100 * F.least(x, y) >= percent * F.greatest(x, y)) & (apart * (100 + percent) <= allowed) & F.coalesce(far * (100 + percent) <= allowed, F.lit(True))


def different_buckets(members: DataFrame) -> DataFrame:
    """key, node, first (the smallest node there) of buckets of two and more: of those that hold the same nodes, one.

    members: key, node, distinct. Near copies have many keys in common, and so many buckets are the same; these are told by their number of
    nodes, the first one and 128 bits of all.
    """
    marks = [F.bit_xor(F.xxhash64(*more, "node")).alias(c) for c, more in (("s", []), ("t", [F.lit(1)]))]
    sums = members.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n"), *marks).where("n > 1")
    return members.join(sums.groupBy("first", "n", "s", "t").agg(F.min("key").alias("key")).select("key", "first"), "key")


def open_buckets(members: DataFrame, groups: DataFrame) -> DataFrame:
    """key, node, group, below of the buckets whose nodes aren't all in one group. members: key, node; groups: node, component.

    below: of the TOLD smallest such keys of the node, those smaller than the row's own.
    """
    placed = members.join(groups.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("key", "node", F.coalesce("component", "node").alias("group"))
    apart = placed.groupBy("key").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x <> y").select("key")
    rest = settled(placed.join(apart, "key"))
    least = rest.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("key")), 1, TOLD).alias("least"))
    return rest.join(least, "node").select("key", "node", "group", F.filter("least", lambda k: k < F.col("key")).alias("below"))


def open_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), few of them repeated, of nodes in different groups that meet and can have the similarity. rest: open_buckets with sizes and bitmaps.

    Near copies meet by many keys. A pair with a smaller key in common that both know of is left to that one; by its smallest key it always counts.
    """
    facts = ["n", "b1", "b2", "b3", "b4", "wide"]
    left, right = (rest.select("key", *(F.col(c).alias(c + s) for c in ("node", "group", "below", *facts))) for s in "ab")
    met = (left["key"] == right["key"]) & (F.col("groupa") < F.col("groupb")) & possible("a", "b", percent) & ~F.arrays_overlap("belowa", "belowb")
    return left.join(right, met).select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b"))


def links(docs: DataFrame, scanned: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Links (a, b) that connect all sets of the similarity, and none below it. docs: id, text; scanned: scan(docs), stored.

    Sets that meet are first compared with the one of the smallest id there, then with each other, but only where they are in
    different groups still. No bucket is left out and none is cut.
    """
    spark = docs.sparkSession
    prints = scanned.where("times is null and n > 0 and id is not null")
    facts = ["n", "b1", "b2", "b3", "b4", "wide"]
    of_set = settled(prints.groupBy("h1", "h2").agg(F.min("id").alias("node"), *(F.first(c).alias(c) for c in facts)))
    placed = settled(prints.join(of_set.select("h1", "h2", "node"), ["h1", "h2"]).select("id", "node"))
    same = placed.where("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b")).distinct()
    keys, path = stored(meeting_keys(docs.where("id is not null"), frequent_shingles(scanned), percent, shingle))
    tidy(spark)
    buckets = settled(keys.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("key"))
    tidy(spark)
    held = settled(keys.join(buckets, "key").join(placed, "id").select("key", "node").distinct())
    discard(spark, path)
    tidy(spark)
    members = settled(different_buckets(held))
    led = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    one, two = (of_set.select(F.col("node").alias(s), *(F.col(c).alias(c + s) for c in facts)) for s in "ab")
    asked = settled(led.join(one, "a").join(two, "b").where(possible("a", "b", percent)).select("a", "b"))
    found = settled(same.unionByName(verify(asked, docs, percent, shingle)))
    groups = settled(connected(found, "a", "b"))
    rest = settled(open_buckets(members, groups).join(of_set.drop("h1", "h2"), "node"))
    tidy(spark)
    tried = asked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    new = settled(open_pairs(rest, percent).distinct().join(tried, ["a", "b"], "left_anti"))
    return found.unionByName(verify(new, docs, percent, shingle))


def join_grams(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Size of each text's shingle set and its group: id, n_shingles, component_id (the smallest id that links reach).

    percent: 100 * intersection >= percent * union links two sets; at least 70. Words are parted by ASCII white space, A-Z are lower-cased.
    Null, empty and blank texts have no shingles and are linked with nothing. Rows without an id have the component of
    texts with the same set, null if there are none; rows with the same id are one node of links, and each has its
    own size. Equal texts are linked; repeated rows give repeated results. Texts of any length are taken whole. An
    empty table gives an empty one; other columns are ignored, whatever their names.
    """
    if not 70 <= percent <= 100:
        raise ValueError("percent must be from 70 to 100")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scanned, path = stored(scan(plain, shingle))
    groups = settled(connected(links(plain, scanned, percent, shingle), "a", "b"))
    rows = scanned.where("times is null")
    of_set = rows.where("n > 0 and id is not null").groupBy("h1", "h2").agg(F.min("id").alias("node"))
    out = rows.join(of_set, ["h1", "h2"], "left").withColumn("_node", F.coalesce(F.when(F.col("n") > 0, F.col("node")), "id")).drop("node")
    joined = out.join(groups, out["_node"] == groups["node"], "left")
    result = settled(joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "_node").alias("component_id")))
    discard(docs.sparkSession, path)
    return result


def keep_one_of_each(docs: DataFrame, percent: int = NEAR_PERCENT, shingle: int = NEAR_SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is the smallest of its group, unchanged and with all their columns.

    Groups are joined by SimHash fingerprints as in simhash_pivots and by shingle sets of the similarity: a radius of bits that held nearly all
    pairs of it would leave blocks of 3 or 4 bits. Rows without an id stay, and so do all rows that share a kept id; texts without words
    are one group. Texts of any length are taken whole, an empty table gives an empty one, and other columns stay as they
    are, whatever their names.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = settled(group_near_copies(plain, id_col="id").where("id <> component_id").select(F.col("component_id").alias("a"), F.col("id").alias("b")))
    tidy(docs.sparkSession)
    scanned, path = stored(scan(plain, shingle))
    groups = settled(connected(prints.unionByName(links(plain, scanned, percent, shingle)), "a", "b"))
    discard(docs.sparkSession, path)
    gone = groups.where("node <> component").select(F.col("node").alias("_gone"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
