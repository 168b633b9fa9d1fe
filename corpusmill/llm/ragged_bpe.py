"""Token counts by rank-synchronous merging of ragged numpy arrays.

The pre-tokens of a slice of texts that were not seen before lie behind one another in one symbol array. A
round looks up the rank of every neighbouring pair, finds the lowest rank of each sequence and merges all
occurrences of that pair in all sequences at once. Sequences without a known pair leave; the number of symbols
they leave with is their token count.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows
from corpusmill.llm.tokenizer_files import byte_alphabet, parse, read_on_driver

#: The pattern of byte-level pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose counts a worker remembers; beyond it the memory is emptied, results stay the same.
REMEMBERED = 400_000
NO_RANK = np.iinfo(np.int64).max


class RaggedCounter:
    """Counts tokens of texts under a byte-level BPE vocabulary."""

    def __init__(self, spec: dict):
        vocab = spec["vocab"]
        self.size = max(vocab.values()) + 1
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], np.int64)
        left = np.array([vocab[a] for a, _ in spec["merges"]], np.int64)
        right = np.array([vocab[b] for _, b in spec["merges"]], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in spec["merges"]], np.int64)[order]
        self.words = regex.compile(PRE_TOKEN)
        self.special = regex.compile("|".join(map(regex.escape, spec["special"]))) if spec["special"] else None
        self.known: dict[str, int] = {}

    def count_sequences(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that remain of each byte string; no string is empty."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        counts = lengths.copy()
        active = lengths > 1
        keep = active[owner]
        symbols, owner = symbols[keep], owner[keep]
        while len(symbols):
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[at], NO_RANK), NO_RANK)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.minimum.reduceat(rank, starts)
            counts[owner[starts]] = sizes
            chosen = (rank == np.repeat(lowest, sizes)) & (rank < NO_RANK)
            place = np.flatnonzero(chosen)
            if not len(place):
                break
            # in runs such as aaaa the pairs overlap: from the left, take every second one
            new_run = np.append(True, np.diff(place) > 1)
            run_start = np.maximum.accumulate(np.where(new_run, place, 0))
            place = place[(place - run_start) % 2 == 0]
            symbols[place] = self.merged[at[place]]
            keep = np.repeat(lowest < NO_RANK, sizes)
            keep[place + 1] = False
            np.subtract.at(counts, owner[place], 1)
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def learn(self, words: set[str]) -> None:
        """Count the pre-tokens not yet remembered."""
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(words)
            self.known.update(zip(new, self.count_sequences([w.encode() for w in new]).tolist(), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special string inside a text is one token."""
        split, extra = [], []
        for text in texts:
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                extra.append(len(parts) - 1)
                split.append([w for part in parts for w in self.words.findall(part)])
            else:
                extra.append(0)
                split.append(self.words.findall(text))
        self.learn(set().union(*split))
        get = self.known.__getitem__
        return [n + sum(map(get, words)) for n, words in zip(extra, split, strict=True)]


@lru_cache(maxsize=2)
def counter_of(text: str) -> RaggedCounter:
    """One counter for each worker process and vocabulary."""
    return RaggedCounter(parse(text))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of each text under the byte-level vocabulary at `path`.

    Returns id, n_bytes, n_tokens, over_limit. A null or empty text has 0 bytes and 0 tokens. Texts of any
    length are taken whole. Repeated rows give repeated results, an empty table none; ids may be null; other columns are ignored, whatever
    their names.
    """
    vocabulary = read_on_driver(docs.sparkSession, path)

    def make():
        counter = counter_of(vocabulary.value)
        return lambda texts: [counter.counts([t or "" for t in texts])]

    found = map_rows(
        docs.select(id_col, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("body")),
        [id_col, "n_bytes", "body"], 2, [T.StructField("n_tokens", T.LongType())], make,
    )
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
