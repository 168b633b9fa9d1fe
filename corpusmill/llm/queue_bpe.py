"""BPE encoding with a priority queue over a doubly linked symbol list, and decoding from vocabulary strings."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows
from corpusmill.llm.tokenizer_files import byte_alphabet, parse, read_on_driver

#: The pattern of words and the mark that ends one.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: Words whose encoding a worker remembers; beyond it the memory is emptied, results stay the same.
REMEMBERED = 250_000


#: Code points that the library is asked about at once.
BLOCK = 4096


@lru_cache(maxsize=1)
def unicode_differences() -> dict:
    """Where the tokenizer library's Unicode tables differ from Python's and from the regex module's, which are of other versions.

    lower: code points that it lower-cases or composes otherwise, and to what; L, N: characters that are letters or numbers for
    one side only. They are found by asking the library's own normalizers and expressions about every code point.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers

    lower, compose = normalizers.Lowercase(), normalizers.NFC()
    split = {kind: pre_tokenizers.Split(Regex(rf"\p{{{kind}}}"), "isolated") for kind in "LN"}
    out: dict = {"lower": {}, "L": set(), "N": set()}
    for first in range(0, 0x110000, BLOCK):  # in blocks, as the library lists every piece
        every = [chr(c) for c in range(max(first, 0x80), first + BLOCK) if not 0xD800 <= c < 0xE000 and chr(c) not in "\x85\u2028\u2029"]
        joined = "\n".join(every)
        theirs = lower.normalize_str(compose.normalize_str(joined)).split("\n") if every else []
        out["lower"].update({ord(c): x for c, x in zip(every, theirs, strict=True) if x != lowered(c)})
        for kind in "LN":
            pieces = {p for p, _ in split[kind].pre_tokenize_str(joined) if len(p) == 1 and p != "\n"}
            out[kind] |= pieces ^ set(regex.findall(rf"\p{{{kind}}}", joined))
    return out


def ranges(characters) -> str:
    """Characters as ranges of a regular expression's class."""
    out: list[list[int]] = []
    for c in sorted(map(ord, characters)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join([f"\\U{a:08x}-\\U{b:08x}" for a, b in out])


def lowered(text: str) -> str:
    """Composed and lower-case; lower case goes character by character, so a capital sigma never becomes the final form."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _word_pattern(differences: dict) -> regex.Pattern:
    """WORD with the characters that the two sides class otherwise on the library's side."""
    def swapped(kind: str) -> str:
        odd = ranges(differences[kind])
        return rf"[\p{{{kind}}}~~[{odd}]]" if odd else rf"\p{{{kind}}}"

    letters, numbers = swapped("L"), swapped("N")
    return regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{letters}+|{numbers}|[^\s{letters}{numbers}]+", regex.V1)


class QueueCodec:
    """Encoder and decoder of a lower-casing BPE vocabulary with word ends.

    differences: what unicode_differences() found.
    """

    def __init__(self, spec: dict, differences: dict | None = None):
        differences = differences or unicode_differences()
        self.lower = differences["lower"]
        odd = {*map(chr, self.lower), *differences["L"], *differences["N"]}
        self.odd = re.compile(f"[{min(odd)}-\U0010ffff]") if odd else None  # what may be odd: a range is found fastest
        self.odd_words = _word_pattern(differences)
        vocab = spec["vocab"]
        self.bytes = byte_alphabet()
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in spec["special"].items()}
        self.inner = [vocab[c] for c in self.bytes]
        self.final = [vocab[c + WORD_END] for c in self.bytes]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(spec["merges"])))}
        self.special = spec["special"]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, spec["special"])) + ")") if spec["special"] else None
        self.words = regex.compile(WORD)
        self.known: dict[str, tuple[int, str, str]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the queue gives the lowest rank, leftmost first; entries whose pair is gone are skipped."""
        symbols = [self.inner[b] for b in word]
        symbols[-1] = self.final[word[-1]]
        n, merges = len(symbols), self.merges
        queue = [(m[0], i, m[1]) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
        if not queue:
            return symbols
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            rank, i, made = heappop(queue)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            now = merges.get((symbols[i], symbols[j]))
            if now is None or now[0] != rank:
                continue
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((made, symbols[k])):
                    heappush(queue, (m[0], i, m[1]))
            h = before[i]
            if h >= 0 and (m := merges.get((symbols[h], made))):
                heappush(queue, (m[0], h, m[1]))
        return [s for s in symbols if s >= 0]

    def of_word(self, word: str) -> tuple[int, str, str]:
        """Number of ids, the ids as text, and their vocabulary strings joined by spaces."""
        ids = self.merge(word.encode())
        found = self.known[word] = (len(ids), " ".join(map(str, ids)), " ".join([self.strings[i] for i in ids]))
        return found

    def parts(self, text: str) -> list[tuple[int, str, str]]:
        """An entry for each word or special string of a text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out = []
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.special:
                out.append((1, str(self.special[piece]), piece))
            elif piece:
                words, known = self.words, self.known
                if self.odd and not piece.isascii() and self.odd.search(piece):
                    words, piece = self.odd_words, piece.translate(self.lower)
                out += [known.get(w) or self.of_word(w) for w in words.findall(lowered(piece))]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings in order, a space between them, as a vocabulary file without a decoder is read."""
        return " ".join([self.strings[i] for i in ids])


@lru_cache(maxsize=2)
def codec_of(text: str, differences: str) -> QueueCodec:
    """One codec for each worker process and vocabulary."""
    return QueueCodec(parse(text), {k: set(v) if isinstance(v, list) else {int(c): x for c, x in v.items()} for k, v in json.loads(differences).items()})


def _told_differences() -> str:
    """unicode_differences() as text, found once on the driver: some thousand characters, whatever the corpus holds."""
    return json.dumps({k: sorted(v) if isinstance(v, set) else v for k, v in unicode_differences().items()})


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of each text: id, ids array<int>.

    A null or empty text has no ids, a text of any length is taken whole. Repeated rows give repeated results, an empty
    table none; ids may be null; other columns are ignored, whatever their names.
    """
    vocabulary, differences = read_on_driver(docs.sparkSession, path), _told_differences()

    def make():
        codec = codec_of(vocabulary.value, differences)
        return lambda texts: [[codec.encode(t or "") for t in texts]]

    return map_rows(docs, [id_col, text_col], 1, [T.StructField("ids", T.ArrayType(T.IntegerType()))], make)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of arrays of token ids: id, decoded.

    Null or empty ids give an empty text; an unknown id is an error. Lists of any length are taken whole, repeated rows give
    repeated results, an empty table none; other columns are ignored, whatever their names.
    """
    vocabulary, differences = read_on_driver(encoded.sparkSession, path), _told_differences()

    def make():
        codec = codec_of(vocabulary.value, differences)
        return lambda rows: [[codec.decode(ids or []) for ids in rows]]

    return map_rows(encoded, [id_col, ids_col], 1, [T.StructField("decoded", T.StringType())], make)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, decode it again and return digests of both in one pass.

    Returns id, n_tokens, ids_sha256, decoded_sha256. A null or empty text has no tokens and the digests of the
    empty string. Texts of any length are taken whole. Of pairs with equal rank the leftmost is merged first. Repeated rows give repeated
    results, an empty table none; ids may be null; other columns are ignored, whatever their names.
    """
    vocabulary, differences = read_on_driver(docs.sparkSession, path), _told_differences()

    def make():
        codec = codec_of(vocabulary.value, differences)

        def run(texts):
            counts, ids, decoded = [], [], []
            for text in texts:
                parts = codec.parts(text or "")
                counts.append(sum([p[0] for p in parts]))
                ids.append(hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join([p[2] for p in parts]).encode()).hexdigest())
            return [counts, ids, decoded]

        return run

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_rows(docs.select(id_col, F.col(text_col).alias("body")), [id_col, "body"], 1, fields, make)
