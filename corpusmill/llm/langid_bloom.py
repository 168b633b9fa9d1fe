"""Language identification with bit-sliced Bloom filters.

Every language has a Bloom filter of its frequent character n-grams. The filters are stored by slices: at each
position one word with a bit for each language, so that a single lookup and AND of a few words tells all the
languages that contain an n-gram. The share of a text's n-grams that a language holds, corrected for its
filter's false positives, decides.
"""


import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows, slices

SIZES = (3, 4, 5)
#: An n-gram enters a filter if it makes up this share of its size's n-grams in the language, so a filter holds at most len(SIZES) / SHARE.
SHARE = 5e-5
#: Positions of a filter and lookups for an n-gram.
POSITIONS, LOOKUPS = 1 << 20, 3
#: Bound on the documents of a language that the filters are fitted on (expected number, chosen by a hash of the id).
SAMPLE = 3000
UNKNOWN = "und"
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def gram_hashes(text: str) -> np.ndarray:
    """Hashes of the n-grams of a text's lower-case letters, words set apart by single marks; empty without letters."""
    letters = "".join([c if c.isalpha() else " " for c in text.lower()]).split() if not text.isascii() else _ASCII_WORDS(text)
    if not letters:
        return np.empty(0, np.uint64)
    points = np.frombuffer(f" {' '.join(letters)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for n in SIZES:
            m = len(points) - n + 1
            if m < 1:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h ^ points[k : k + m]) * np.uint64(_MIX[0])
                h ^= h >> np.uint64(29)
            out.append(h)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


_ASCII = "".join(chr(c).lower() if chr(c).isalpha() else " " for c in range(128))


def _ASCII_WORDS(text: str) -> list[str]:
    return text.translate(_ASCII).split()


def positions(hashes: np.ndarray) -> list[np.ndarray]:
    """The places of n-grams in a filter, one array for each lookup."""
    with np.errstate(over="ignore"):
        return [((hashes * np.uint64(m)) >> np.uint64(64 - int(math.log2(POSITIONS)))).astype(np.int64) for m in _MIX]


class SlicedFilters:
    """Bloom filters of all languages, a bit each."""

    def __init__(self, languages: list[str], grams: list[np.ndarray]):
        self.languages = languages
        self.words = max(1, -(-len(languages) // 64))
        self.slices = np.zeros((self.words, POSITIONS), np.uint64)
        fill = []
        for i, hashes in enumerate(grams):
            bit = np.uint64(1) << np.uint64(i % 64)
            for at in positions(hashes):
                self.slices[i // 64, at] |= bit
            fill.append(np.count_nonzero(self.slices[i // 64] & bit) / POSITIONS)
        self.false = np.array(fill) ** LOOKUPS

    def shares(self, hashes: np.ndarray) -> np.ndarray:
        """Corrected share of the n-grams that each language holds."""
        at = positions(hashes)
        found = np.empty(len(self.languages))
        for w in range(self.words):
            masks = self.slices[w, at[0]] & self.slices[w, at[1]] & self.slices[w, at[2]]
            for i in range(64 * w, min(len(self.languages), 64 * w + 64)):
                found[i] = np.count_nonzero(masks & (np.uint64(1) << np.uint64(i % 64)))
        return np.clip((found / len(hashes) - self.false) / (1 - self.false), 0.0, 1.0)

    def decide(self, text: str | None) -> tuple[str, float]:
        """The language with the greatest share, the first by name of equals; UNKNOWN without letters or languages."""
        hashes = gram_hashes(text or "")
        if not len(hashes) or not self.languages:
            return UNKNOWN, 0.0
        shares = self.shares(hashes)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def held_out(id_col: str):
    """Documents whose language is never learned from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> SlicedFilters:
    """Filters from texts with a language. About `sample` documents of each language are used, by a hash of the id.

    The driver gets the n-grams above SHARE only, at most len(SIZES) / SHARE for each language.
    """
    known = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")).where(
        F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~F.coalesce(held_out("_id"), F.lit(False))
    )
    sizes = known.groupBy("_lang").count().orderBy("_lang").collect()
    if not sizes:
        return SlicedFilters([], [])
    size_of = F.create_map(*(F.lit(x) for row in sizes for x in (row[0], float(row[1]))))
    unit = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(unit < F.lit(float(sample)) / size_of[F.col("_lang")]).select("_lang", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1, 2_000_000):
                grams: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    grams.setdefault(lang, []).append(gram_hashes(text))
                for lang, found in grams.items():
                    hashes, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hashes)), pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counted.join(F.broadcast(totals), "lang").where(F.col("n") >= F.col("total") * SHARE / len(SIZES)).select("lang", "gram").toArrow()
    langs = frequent["lang"].to_pandas().to_numpy()
    grams = frequent["gram"].to_numpy().view(np.uint64)
    names = sorted(set(langs))
    return SlicedFilters(names, [grams[langs == x] for x in names])


def identify(docs: DataFrame, filters: SlicedFilters, id_cols: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Language of each text: the id columns, lang_pred, score (0 to 1).

    A text that is null or without letters is `und` with score 0; so is every text if nothing was learned. Texts of any length
    are taken whole; of equal shares the first language by name stands. Repeated rows give repeated results, an empty table none; other
    columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    ids = id_cols or ["doc_id"]

    def make():
        mine = shared.value

        def run(texts):
            rows = [mine.decide(t) for t in texts]
            return [[a for a, _ in rows], [b for _, b in rows]]

        return run

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_rows(docs.select(*ids, F.col(text_col).alias("_body")), [*ids, "_body"], len(ids), fields, make)


def keep_identified(docs: DataFrame, filters: SlicedFilters, min_score: float, text_col: str = "text") -> DataFrame:
    """Documents whose language is known with at least min_score, unchanged and with all their columns.

    Null texts and those without letters go. Whole texts of any length decide; repeated rows stay or go alike, ids may be
    null, and an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: (lambda x: x[0] != UNKNOWN and x[1] >= min_score)(shared.value.decide(t))).astype(bool)

    return docs.where(known(F.col(text_col)))
