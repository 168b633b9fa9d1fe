"""Importance resampling: draw the documents whose n-grams are likely under a target text, by hashed n-gram buckets.

In a batch the n-grams of all texts are interned in an open-addressed NumPy table: the key is the n-gram's XXH64, and an n-gram
that meets its key in a slot is compared with the slot's bytes before it counts as the same. A slot holds the n-gram's bucket
and how often it occurred, each occurrence knows its slot; so buckets are hashed once for each distinct n-gram, counts are added
up by slot, and the gains of a document's n-grams are gathered through its slots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows, settled

#: N-grams of 1 to so many words, buckets, words of a document that can be drawn, percent of these that are drawn, seed.
WORDS, BUCKETS, MIN_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
#: Bytes of texts that are interned at once, so that a table stays in the processor's cache; a longer text is taken in pieces.
TOGETHER = 1 << 19
#: Bytes that belong to words: digits, small letters (after lower-casing) and all of UTF-8 beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPACE = 0x20


class Interned:
    """The distinct n-grams of a batch of texts.

    slot, text: for each occurrence the slot of its n-gram and the number of its text. bucket, count: by slot. n_words,
    per_text: words and occurrences of each text. carried: of each text so many first words are the last ones of the piece
    before it; they and what lies within them have been counted there.
    """

    def __init__(self, texts: list[bytes], words: int = WORDS, buckets: int = BUCKETS, carried: list[int] | None = None):
        self.buffer, starts, ends, n_words = _split(texts)
        n, of = len(starts), np.repeat(np.arange(len(texts)), n_words)
        listed = self.buffer[:-8].split(b" ")[:n]
        known = np.array(carried or [0] * len(texts), np.int64)
        self.n_words = n_words - known
        at = np.arange(n) - np.repeat(np.cumsum(n_words) - n_words, n_words)  # a word's number in its text
        grams, start, end, text = [], [], [], []
        for k in range(words):
            runs = map(b" ".join, zip(*(listed[i:] for i in range(k + 1)), strict=False)) if k else listed
            whole = (of[: max(0, n - k)] == of[k:]) & (at[k:] >= known[of[k:]])  # not from one text into the next
            grams += compress(runs, whole.tolist())
            start.append(starts[: max(0, n - k)][whole])
            end.append(ends[k:][whole])
            text.append(of[k:][whole])
        self._start, self.text = np.concatenate(start), np.concatenate(text)
        self.per_text = np.bincount(self.text, minlength=len(texts))
        self._length = np.concatenate(end) - self._start
        self._keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, len(grams))
        # eight bytes at every place; the last places read the padding
        self._eights = np.ndarray(len(self.buffer) - 7, "<u8", self.buffer, strides=(1,))
        self.slot, owner = self._insert()
        self.count = np.bincount(self.slot, minlength=len(owner))
        taken = np.flatnonzero(owner >= 0)
        self.bucket = np.zeros(len(owner), np.int64)
        self.bucket[taken] = [crc32(grams[i]) % buckets for i in owner[taken].tolist()]

    def _insert(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots of all occurrences, and for each slot the occurrence that owns it (-1: none); linear probing, all at once."""
        n = len(self._keys)
        size = 1 << max(4, (2 * n).bit_length())
        owner = np.full(size, -1, np.int64)
        slot = (self._keys & np.uint64(size - 1)).astype(np.int64)
        todo = np.arange(n)
        while len(todo):
            at = slot[todo]
            free = owner[at] < 0
            owner[at[free]] = todo[free]  # of several that want a slot one gets it
            other = todo[~self._same(todo, owner[at])]
            slot[other] = (slot[other] + 1) & (size - 1)
            todo = other
        return slot, owner

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which n-grams a have the key and the bytes of b."""
        same = (self._keys[a] == self._keys[b]) & (self._length[a] == self._length[b])
        at = np.flatnonzero(same & (a != b))
        place, step = 0, 8
        while len(at):
            left = self._length[a[at]] - place
            mask = np.where(left >= step, np.uint64(2**64 - 1), (np.uint64(1) << (8 * np.minimum(left, 7)).astype(np.uint64)) - np.uint64(1))
            x, y = (self._eights[self._start[c[at]] + place] & mask for c in (a, b))
            same[at[x != y]] = False
            at = at[(x == y) & (left > step)]
            place += step
        return same

    def by_bucket(self, buckets: int = BUCKETS) -> np.ndarray:
        return np.bincount(self.bucket, self.count, buckets).astype(np.int64)

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """For each text the sum of its n-grams' gains. gains: whole numbers by bucket; sums below 2 ** 53 are exact."""
        return np.bincount(self.text, gains[self.bucket][self.slot], len(self.per_text)).astype(np.int64)


def _split(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words, lower-cased, each followed by one space; their starts and ends; words of each text."""
    raw = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    inside = _WORD[raw]
    last = np.flatnonzero(inside[:-1] & ~inside[1:])  # the last byte of each word
    kept = inside.copy()
    kept[last + 1] = True
    buffer = np.where(inside, raw, _SPACE)[kept].astype(np.uint8)
    ends = np.flatnonzero(buffer == _SPACE)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    limits = np.cumsum([len(t) + 1 for t in texts])
    n_words = np.diff(np.searchsorted(last, limits), prepend=0)
    return buffer.tobytes() + bytes(8), starts, ends, n_words


def _pieces(text: bytes, words: int) -> Iterator[tuple[bytes, int]]:
    """A text in pieces that end between words, each with the last words - 1 words of the one before, and their number."""
    at, carried = 0, b""
    while at < len(text) or not at:
        end = min(len(text), at + TOGETHER)
        while end < len(text):  # to the end of a word
            outside = np.flatnonzero(~_WORD[np.frombuffer(text[end : end + TOGETHER].lower(), np.uint8)])
            end += int(outside[0]) if len(outside) else len(text[end : end + TOGETHER])
            if len(outside):
                break
        piece = carried + b" " + text[at:end] if carried else text[at:end]
        yield piece, len(carried.split())
        at = max(end, 1)
        if at < len(text) and words > 1:
            raw = np.frombuffer(piece.lower(), np.uint8)
            carried = b" ".join(np.where(_WORD[raw], raw, _SPACE).astype(np.uint8).tobytes().split()[1 - words :])


def _together(texts: list[str | None], words: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Pieces of the texts in runs of about TOGETHER bytes: the pieces, how many words of each are carried, whose they are."""
    run, carried, owner, size = [], [], [], 0
    for i, text in enumerate(texts):
        for piece, n in _pieces((text or "").encode(), words):
            run.append(piece)
            carried.append(n)
            owner.append(i)
            size += len(piece) + 1
            if size >= TOGETHER:
                yield run, carried, owner
                run, carried, owner, size = [], [], [], 0
    if run:
        yield run, carried, owner


def bucket_counts(docs: DataFrame, text_col: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many n-grams of all texts are in each bucket; empty buckets have no row. A task gives one row a bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts, carried, _ in _together(batch.column(0).to_pylist(), words):
                total += Interned(texts, words, buckets, carried).by_bucket(buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": total[some]})

    return docs.select(text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """By bucket: floor(1000 * ln of the smoothed share in the target over that in docs). At most one number a bucket reaches the driver."""
    def dense(table: DataFrame) -> list[int]:
        found = dict(map(tuple, bucket_counts(table, text_col, words, buckets).collect()))
        return [found.get(b, 0) for b in range(buckets)]

    s, t = dense(docs), dense(target)
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log(float(t[b] + 1) * float(all_s + buckets) / (float(s[b] + 1) * float(all_t + buckets)))) for b in range(buckets)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """id, n_words, n_features, weight: the floored mean gain of a text's n-grams, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    fields = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]

    def helper(texts):
        n_words, n, total = np.zeros((3, len(texts)), np.int64)
        for run, carried, owner in _together(texts, words):
            table = Interned(run, words, len(shared.value), carried)
            for sums, found in ((n_words, table.n_words), (n, table.per_text), (total, table.sums(shared.value))):
                np.add.at(sums, owner, found)
        return [n_words, n, np.where(n > 0, total // np.maximum(n, 1), 0)]

    return map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], 1, fields, lambda: helper)


def with_noise(weighted: DataFrame, seed: int = SEED) -> DataFrame:
    """score: the weight and Gumbel noise from the id alone, so that any run draws the same; null without an id."""
    hashed = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    return weighted.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((hashed + 0.5) / 4294967296))))


def ranked(rows: DataFrame, order: list, number: str) -> DataFrame:
    """rows numbered from 1 along the order, all of them, without one task that sees them all.

    Rows are dealt by ranges of the order and sorted within them; a range is then numbered from the number of rows in the
    ranges before it, of which there are as many as partitions.
    """
    place = F.monotonically_increasing_id()  # the partition's number in the upper bits, the row's in the lower 33
    sorted_rows = settled(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place))
    part = F.shiftright("_place", 33)
    before, starts = 0, []
    for p, n in sorted(sorted_rows.groupBy(part).count().collect()):
        starts.append((p, before))
        before += n
    first = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    return sorted_rows.withColumn("_part", part).join(F.broadcast(first), "_part").withColumn(number, F.col("_before") + inside + 1).select(*rows.columns, number)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, words: int = WORDS, buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document with its score, and the rank of those that are drawn: id, n_features, weight, score, rank.

    Of the N documents with at least min_words words the floor(percent * N / 100) highest scores are drawn, ties to the smaller
    id. Null and empty texts have no n-grams, weight 0 and no rank. Rows without an id have no score and are never drawn
    nor counted in N; rows with the same id are documents of their own, with ranks of their own. Texts of any length are
    taken whole, in pieces of bounded size. An empty table gives an empty one, an empty target counts as one with no n-grams;
    other columns are ignored, whatever their names.
    """
    weighted = settled(with_noise(weights(docs, gains(docs, target, text_col, words, buckets), id_col, text_col, words), seed))
    fit = (F.col("n_words") >= min_words) & F.col("id").isNotNull()
    drawn = weighted.where(fit).count() * percent // 100
    placed = ranked(weighted.where(fit), [F.desc("score"), "id", "n_features"], "rank")
    kept = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = weighted.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return kept.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
