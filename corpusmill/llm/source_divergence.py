"""Divergence audit: how far the term distributions of a language's sources are apart, and which terms make it so.

Documents are indexed in a single pass. A task gathers occurrences in memory until there are BLOCK, sums them up by term and group (lang,
source) and spills the postings (occurrences, documents) as a run: sorted by the term's hash, cut into shards by its first bits and packed
into slabs. Spark's shuffle brings the slabs of a shard together in the order of their first terms; there a heap holds the open slabs by
the next term of each, and all terms below what is still to come are taken from it at once and added up into one row of
frequencies a term. Terms are told apart by their bytes wherever hashes meet. The distances of all pairs of sources start from
the value that terms have which neither source holds, and every term corrects the pairs of its sources as it streams by.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import batched, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusmill.llm.batches import discard, settled, slices, stored, tidy

#: Documents of a language that a kept term is in at least; terms that a group is told of; what is added to each count.
MIN_DOCS, TOP, SMOOTH = 30, 50, 5
#: Probabilities are whole parts of so many.
SCALE = 1_000_000_000
#: Occurrences in memory before a run is spilled, terms of a slab, runs that are merged at once, postings that are added up at once.
BLOCK, SLAB, FAN_IN, MERGED = 1 << 18, 2048, 512, 1 << 18
#: Characters of texts that are split into terms at once; a longer text is taken in pieces that end between terms.
PIECE = 1 << 20
#: Cells of pair corrections that a task holds before it passes them on.
CELLS = 4_000_000

#: Bytes that belong to terms: small letters (after lower-casing) and all of UTF-8 beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MIX = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)))
_KINDS = {
    "shard": pa.int32(), "run_group": pa.int64(), "lead": pa.int64(), "key": pa.list_(pa.int64()), "term": pa.list_(pa.binary()), "postings": pa.list_(pa.int64()),
    "lang": pa.list_(pa.string()), "source": pa.list_(pa.string()), "of": pa.list_(pa.int64()), "n": pa.list_(pa.int64()), "docs": pa.list_(pa.int64()),
}
_SLABS = "shard int, run_group long, lead long, key array<long>, term array<binary>, postings array<long>, lang array<string>, source array<string>, of array<long>, n array<long>, docs array<long>"
_PARTIAL = "lang string, source string, other string, term binary, n long"


class Terms:
    """The terms of some texts: where each stands in `raw`, its text, and a hash that is the same for the same bytes.

    A term of up to 16 bytes is its length, its first eight bytes and its last eight; a longer one is compared as a whole.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts).lower() + b"\n" + bytes(8)
        code = np.frombuffer(self.raw, np.uint8)[:-8]
        inside = np.concatenate([[False], _TERM[code]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])  # the text ends outside a term
        self.start, self.length = edge[::2], edge[1::2] - edge[::2]
        ends = np.cumsum([len(t) + 1 for t in texts])
        per_text = np.diff(np.searchsorted(self.start, ends), prepend=0)
        self.text = np.repeat(np.arange(len(texts)), per_text)
        eights = np.ndarray(len(self.raw) - 7, "<u8", self.raw, strides=(1,))
        with np.errstate(over="ignore"):
            short = np.uint64(2**64 - 1) >> (8 * np.maximum(8 - self.length, 0)).astype(np.uint64)
            self.head = eights[self.start] & short
            self.tail = np.where(self.length > 8, eights[np.maximum(self.start + self.length - 8, 0)], np.uint64(0))
            key = (self.head * _MIX[0]) ^ (self.tail ^ self.length.astype(np.uint64) * _MIX[2]) * _MIX[1]
            key = (key ^ (key >> np.uint64(31))) * _MIX[0]
            key ^= key >> np.uint64(29)
        for i in np.flatnonzero(self.length > 16).tolist():
            key[i] = xxhash.xxh64_intdigest(self.bytes(i))
        self.key = key

    def bytes(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.start[i] + self.length[i]]


class Block:
    """Occurrences of terms in memory, until they are summed up.

    begun: a document (lang, source) that an earlier block has the first pieces of, and its terms there, which aren't counted as of
    one more document.
    """

    def __init__(self, begun: tuple[str, str, set[bytes]] | None = None):
        self.pieces: list[tuple[Terms, np.ndarray]] = []
        self.groups: dict[tuple[str, str], int] = {}
        self.group_of: list[int] = []  # by document
        self.size = 0
        self.seen: set[bytes] = set()
        if begun:
            self.groups[begun[:2]] = 0
            self.group_of.append(0)
            self.seen = begun[2]

    def last(self) -> tuple[str, str, set[bytes]]:
        """The last document as one that goes on in another block."""
        doc = len(self.group_of) - 1
        terms = {t.bytes(i) for t, docs in self.pieces for i in np.flatnonzero(docs == doc).tolist()}
        lang, source = list(self.groups)[self.group_of[-1]]
        return lang, source, terms | (self.seen if doc == 0 else set())

    def add(self, rows: list[tuple[str, str, bytes]], follows: bool = False) -> None:
        """Texts (lang, source, text); with `follows` the first goes on with the last document of before."""
        for lang, source, _ in rows[1:] if follows else rows:
            self.group_of.append(self.groups.setdefault((lang, source), len(self.groups)))
        terms = Terms([t for _, _, t in rows])
        self.pieces.append((terms, terms.text + (len(self.group_of) - len(rows))))
        self.size += len(terms.key)

    def postings(self) -> dict[str, np.ndarray]:
        """key and term of each term, sorted by key, with the number of its postings; of, n, docs of all postings in that order."""
        key, head, tail, length = (np.concatenate([getattr(t, name) for t, _ in self.pieces]) for name in ("key", "head", "tail", "length"))
        doc = np.concatenate([d for _, d in self.pieces])
        base = np.cumsum([0, *(len(t.raw) for t, _ in self.pieces)])
        start = np.concatenate([t.start + at for (t, _), at in zip(self.pieces, base.tolist(), strict=False)])
        raw = b"".join(t.raw for t, _ in self.pieces)
        code, keys = pd.factorize(key)
        first = np.empty(len(keys), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]

        def spelled(i: int) -> bytes:
            return raw[start[i] : start[i] + length[i]]

        mine = first[code]
        other = (head != head[mine]) | (tail != tail[mine]) | (length != length[mine])
        long = np.flatnonzero((length > 16) & ~other & (mine != np.arange(len(mine))))
        other[[i for i in long.tolist() if spelled(i) != spelled(mine[i])]] = True
        more: dict[bytes, int] = {}  # terms whose hash another one has too
        firsts = first.tolist()
        for i in np.flatnonzero(other).tolist():
            name = spelled(i)
            if name not in more:
                more[name] = len(firsts)
                firsts.append(i)
            code[i] = more[name]
        first, terms = np.array(firsts, np.int64), len(firsts)
        pairs, times = np.unique(doc * terms + code, return_counts=True)
        at, term = np.divmod(pairs, terms)
        rank = np.empty(terms, np.int64)
        order = np.argsort(key[first], kind="stable")
        rank[order] = np.arange(terms)
        group = np.array(self.group_of, np.int64)[at]
        code, posts = pd.factorize(rank[term] * len(self.groups) + group)
        new = np.ones(len(pairs), np.int64)
        if self.seen:
            again = np.flatnonzero(at == 0)
            new[again] = [spelled(i) not in self.seen for i in first[term[again]].tolist()]
        n, docs = np.bincount(code, times).astype(np.int64), np.bincount(code, new).astype(np.int64)
        by = np.argsort(posts)
        place, of = np.divmod(posts[by], len(self.groups))
        names = np.empty(terms, object)
        begin = start[first[order]]
        names[:] = [raw[a:b] for a, b in zip(begin.tolist(), (begin + length[first[order]]).tolist(), strict=True)]
        return {"key": _signed(key[first[order]]), "term": names, "postings": np.bincount(place, minlength=terms), "of": of, "n": n[by], "docs": docs[by]}


def _signed(key: np.ndarray) -> np.ndarray:
    """Unsigned hashes as signed numbers in the same order."""
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def shard_bits(partitions: int) -> int:
    """Logarithm of the number of shards: as many as shuffle partitions, so that they grow with the cluster, and 256 at least."""
    return min(16, max(8, (partitions - 1).bit_length()))


def _slab_rows(table: dict[str, np.ndarray], groups: list[tuple[str, str]], run_group: int, bits: int = 8) -> pa.RecordBatch:
    """Slabs of a sorted run: a shard's terms together, at most SLAB in a row, with the names of the groups that it has."""
    shard = (table["key"] >> (64 - bits)) + (1 << (bits - 1))
    edges = np.flatnonzero(np.diff(shard, prepend=-1)).tolist() + [len(shard)]
    cuts = [at for a, b in zip(edges, edges[1:], strict=False) for at in range(a, b, SLAB)] + [len(shard)]
    ends = np.concatenate([[0], np.cumsum(table["postings"])])
    rows: dict[str, list] = {name: [] for name in _KINDS}
    for a, b in zip(cuts, cuts[1:], strict=False):
        x, y = ends[a], ends[b]
        used, of = np.unique(table["of"][x:y], return_inverse=True)
        rows["shard"].append(int(shard[a]))
        rows["run_group"].append(run_group)
        rows["lead"].append(int(table["key"][a]))
        for name in ("key", "postings"):
            rows[name].append(table[name][a:b])
        rows["term"].append(table["term"][a:b].tolist())
        rows["lang"].append([groups[g][0] for g in used.tolist()])
        rows["source"].append([groups[g][1] for g in used.tolist()])
        rows["of"].append(of.astype(np.int64))
        for name in ("n", "docs"):
            rows[name].append(table[name][x:y])
    return pa.RecordBatch.from_arrays([pa.array(rows[name], kind) for name, kind in _KINDS.items()], schema=pa.schema(list(_KINDS.items())))


def _in_pieces(lang: str, source: str, text: str) -> Iterator[tuple[str, str, bytes]]:
    """A text as bytes, a long one in pieces that end between terms."""
    raw = text.encode()
    at = 0
    while len(raw) - at > PIECE:
        part = np.frombuffer(raw, np.uint8, min(PIECE, len(raw) - at), at) | 0x20
        outside = np.flatnonzero(~_TERM[part])
        if not len(outside):  # a term as long as a piece
            break
        yield lang, source, raw[at : at + int(outside[-1]) + 1]
        at += int(outside[-1]) + 1
    yield lang, source, raw[at:]


def runs(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slabs of sorted runs. docs: text, lang, source without nulls."""
    bits = shard_bits(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId()
        rows = (row for batch in batches for piece in slices(batch, 2) for row in zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True))
        for held in blocks(rows, block):
            slabs = _slab_rows(held.postings(), list(held.groups), group, bits)
            del held  # before the next block grows
            yield slabs
            del slabs
            pa.default_memory_pool().release_unused()

    return docs.select("lang", "source", "text").mapInArrow(index, _SLABS)


def blocks(rows: Iterator[tuple[str, str, str]], block: int) -> Iterator[Block]:
    """Full blocks of documents (lang, source, text). A block holds about `block` occurrences and a piece of a text."""
    held, waiting, size = Block(), [], 0
    for lang, source, text in rows:
        for k, piece in enumerate(_in_pieces(lang, source, text)):
            if k == 0:
                waiting.append(piece)
                size += len(piece[2])
                continue
            if waiting:
                held.add(waiting)
                waiting, size = [], 0
            if held.size >= block:
                full, held = held, Block(held.last())
                yield full
                del full
            held.add([piece], follows=True)
        if size >= PIECE:
            held.add(waiting)
            waiting, size = [], 0
        if held.size >= block:
            full, held = held, Block()
            yield full
            del full
    if waiting:
        held.add(waiting)
    if held.size:
        yield held


class _Slab:
    """An open slab: terms and postings that aren't taken yet. of: numbers of groups in `groups`, which all slabs share."""

    def __init__(self, row: dict, groups: dict[tuple[str, str], int]):
        self.key, postings = row["key"], row["postings"]
        self.ends = np.concatenate([[0], np.cumsum(postings)])
        self.term, self.n, self.docs = row["term"], row["n"], row["docs"]
        names = np.array([groups.setdefault(g, len(groups)) for g in zip(row["lang"], row["source"], strict=True)], np.int64)
        self.of = names[row["of"]]
        self.at = 0

    def below(self, limit: int | None) -> tuple[np.ndarray, list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Take the terms below the limit (none: all): key, term, postings of each, of, n, docs."""
        a, b = self.at, len(self.key) if limit is None else int(np.searchsorted(self.key, limit))
        self.at = b
        x, y = self.ends[a], self.ends[b]
        return self.key[a:b], self.term[a:b], np.diff(self.ends[a : b + 1]), self.of[x:y], self.n[x:y], self.docs[x:y]


def _merged(rows: Iterator[dict], groups: dict[tuple[str, str], int]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted postings as of Block.postings(), added up over all slabs, from slabs in order of their leads."""
    heap: list[tuple[int, int, _Slab]] = []
    opened = held = 0
    coming = next(rows, None)
    while heap or coming is not None:
        while coming is not None and (held < MERGED or heap[0][0] >= coming["lead"]):
            slab = _Slab(coming, groups)
            heapq.heappush(heap, (coming["lead"], opened, slab))
            opened, held = opened + 1, held + len(slab.of)
            coming = next(rows, None)
        limit, parts = coming["lead"] if coming is not None else None, []
        while heap and (limit is None or heap[0][0] < limit):
            _, number, slab = heapq.heappop(heap)
            parts.append(slab.below(limit))
            if slab.at < len(slab.key):
                heapq.heappush(heap, (int(slab.key[slab.at]), number, slab))
        held -= sum(len(p[3]) for p in parts)
        yield _added_up(parts, max(1, len(groups)))


def _added_up(parts: list[tuple], groups: int) -> dict[str, np.ndarray]:
    key, times, of, n, docs = (np.concatenate([p[i] for p in parts]) for i in (0, 2, 3, 4, 5))
    term = np.empty(len(key), object)
    term[:] = [t for p in parts for t in p[1]]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if (same & (term[order][1:] != term[order][:-1])).any():  # different terms with one hash
        order = np.array(sorted(range(len(key)), key=lambda i: (key[i], term[i])), np.int64)
        same = (key[order][1:] == key[order][:-1]) & (term[order][1:] == term[order][:-1])
    new = np.concatenate([[True], ~same])
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    code, posts = pd.factorize(np.repeat(number, times) * groups + of)
    n, docs = (np.bincount(code, x).astype(np.int64) for x in (n, docs))
    by = np.argsort(posts)
    place, of = np.divmod(posts[by], groups)
    first = order[new]
    return {"key": key[first], "term": term[first], "postings": np.bincount(place, minlength=len(first)), "of": of, "n": n[by], "docs": docs[by]}


def _by_shard(slabs: DataFrame, *keys: str) -> DataFrame:
    return slabs.repartition(*keys).sortWithinPartitions(*keys, "lead")


def _of_one_key(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Runs of rows with the same key columns; each must be read to its end before the next."""
    def rows() -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in _KINDS}
                yield {
                    name: x.values.to_pylist() if name in ("term", "lang", "source") else x.values.to_numpy() if pa.types.is_list(x.type) else x.as_py() for name, x in row.items()
                }

    return groupby(rows(), key=lambda r: tuple(r[n] for n in names))


def merge_runs(slabs: DataFrame, fan_in: int) -> DataFrame:
    """One run for every fan_in groups of runs, in slabs again."""
    bits = shard_bits(int(slabs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, group), rows in _of_one_key(batches, ("shard", "run_group")):
            groups: dict[tuple[str, str], int] = {}
            for table in _merged(rows, groups):
                yield _slab_rows(table, list(groups), group, bits)

    grouped = slabs.withColumn("run_group", F.floor(F.col("run_group") / fan_in))
    return _by_shard(grouped, "shard", "run_group").mapInArrow(merge, _SLABS)


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """lang, term, source and n (arrays) of the terms in at least min_docs documents of the language, from merged runs."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("source", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])
        for _, slabs in _of_one_key(batches, ("shard",)):
            groups: dict[tuple[str, str], int] = {}
            for table in _merged(slabs, groups):
                yield _table(list(_kept(table, list(groups), min_docs)), schema)

    spilled, paths = runs(docs, block), []
    several = docs.rdd.getNumPartitions()  # a task's runs are a group
    while several > fan_in:
        spilled, path = stored(merge_runs(spilled, fan_in) if paths else spilled)
        several = -(-several // fan_in) if paths else several
        paths.append(path)
    out = settled(_by_shard(spilled, "shard").mapInArrow(merge, "lang string, term binary, source array<string>, n array<long>"))
    for p in paths:
        discard(docs.sparkSession, p)
    tidy(docs.sparkSession)
    return out


def _kept(table: dict[str, np.ndarray], groups: list[tuple[str, str]], min_docs: int) -> Iterator[dict]:
    """Rows of frequencies of the terms that are in enough documents of a language."""
    if not len(table["of"]):
        return
    langs = sorted({lang for lang, _ in groups})
    lang_of = np.array([langs.index(lang) for lang, _ in groups])
    place = np.repeat(np.arange(len(table["key"])), table["postings"]) * len(langs) + lang_of[table["of"]]
    many = np.bincount(place, table["docs"]) >= min_docs
    chosen = np.flatnonzero(many[place])
    chosen = chosen[np.argsort(place[chosen], kind="stable")]
    for at, own in groupby(chosen.tolist(), key=lambda i: place[i]):
        own = list(own)
        term, lang = divmod(int(at), len(langs))
        yield {"lang": langs[lang], "term": table["term"][term], "source": [groups[table["of"][i]][1] for i in own], "n": [int(table["n"][i]) for i in own]}


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def shares(n: np.ndarray, total: int | np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + SMOOTH) / total), exact in 64 bits up to totals of 2e14: the division is done in two steps."""
    first, second = 31_250, SCALE // 31_250
    q, r = np.divmod((n + SMOOTH) * first, total)
    return 1 + q * second + r * second // total


class _Language:
    """The groups of one language: names, smoothed totals, the share of a term that a group doesn't hold."""

    def __init__(self, groups: list[tuple[str, int]], terms: int):
        groups = sorted(groups, key=lambda g: g[0].encode())
        self.names = [g[0] for g in groups]
        self.at = {s: i for i, s in enumerate(self.names)}
        self.totals = np.array([g[1] for g in groups], np.int64) + SMOOTH * terms
        self.total = int(sum(g[1] for g in groups)) + SMOOTH * terms
        self.base = shares(np.zeros(len(groups), np.int64), np.maximum(self.totals, 1))


class _Corrections:
    """Doubled corrections of pairs (row, column): what terms of the row's group change in its distance to the column's."""

    def __init__(self, language: _Language):
        self.language = language
        self.rows: dict[int, np.ndarray] = {}

    def add(self, at: np.ndarray, p: np.ndarray) -> None:
        """A term that the groups `at` hold with the shares p. Pairs that both hold it are met from both sides."""
        base = self.language.base
        every = base.copy()
        every[at] = p
        change = np.abs(p[:, None] - every) - np.abs(base[at][:, None] - base)
        change *= 2
        change[:, at] //= 2
        for i, row in zip(at.tolist(), change, strict=True):
            if i in self.rows:
                self.rows[i] += row
            else:
                self.rows[i] = row

    def flush(self, lang: str) -> Iterator[dict]:
        names = self.language.names
        for i, row in self.rows.items():
            for j in np.flatnonzero(row).tolist():
                yield {"lang": lang, "source": names[i], "other": names[j], "term": None, "n": int(row[j])}
        self.rows.clear()


def _corrected(frequent: DataFrame, languages: dict[str, tuple[list[tuple[str, int]], int]], top: int) -> DataFrame:
    """Rows of pair corrections (with other) and of terms that a group uses more than its language (with term), the `top`
    best of each task."""
    shared = frequent.sparkSession.sparkContext.broadcast(languages)
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("term", pa.binary()), ("n", pa.int64())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: _Language(*x) for lang, x in shared.value.items()}
        pairs = {lang: _Corrections(x) for lang, x in known.items()}
        best: dict[tuple[str, int], list] = defaultdict(list)  # the least of a group's best is at the head
        for batch in batches:
            for lang, term, source, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                language, counts = known[lang], np.array(n, np.int64)
                at = np.array([language.at[s] for s in source])
                p = shares(counts, language.totals[at])
                pairs[lang].add(at, p)
                over = p - shares(counts.sum(), language.total)
                for i, f in zip(at.tolist(), over.tolist(), strict=True):
                    if f > 0:
                        entry, group = (f, _Backwards(term)), best[lang, i]
                        if len(group) < top:
                            heapq.heappush(group, entry)
                        elif group[0] < entry:
                            heapq.heapreplace(group, entry)
            if sum(len(c.rows) * len(c.language.names) for c in pairs.values()) > CELLS:
                yield from _in_tables((row for lang, c in pairs.items() for row in c.flush(lang)), schema)
        yield from _in_tables((row for lang, c in pairs.items() for row in c.flush(lang)), schema)
        terms = ({"lang": lang, "source": known[lang].names[i], "other": None, "term": t.term, "n": f} for (lang, i), group in best.items() for f, t in group)
        yield from _in_tables(terms, schema)

    return frequent.mapInArrow(stream, _PARTIAL)


class _Backwards:
    """A term that sorts after those with smaller bytes, so that a heap drops the greatest of equal values first."""

    __slots__ = ("term",)

    def __init__(self, term: bytes):
        self.term = term

    def __lt__(self, other: _Backwards) -> bool:
        return self.term > other.term

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Backwards) and self.term == other.term


def _in_tables(rows: Iterator[dict], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    for part in batched(rows, size):
        yield _table(list(part), schema)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """lang, source, part, item, value, rank for every group (lang, source) of docs.

    Part `pair`: item is each other source of the language, value the sum over the language's kept terms of the difference of the
    two groups' shares. Part `term`: the `top` kept terms that the group uses more than its language, value the difference. Shares
    are whole parts of a billion, smoothed by 5; ranks go by value, descending, then by the item's UTF-8 bytes.

    Null text, lang and source are ''. A group without terms has the smoothed shares; a language without kept terms has pairs of value 0.
    Repeated rows count as documents of their own. Texts of any length are taken whole, in pieces. An empty table gives an
    empty one; other columns are ignored, whatever their names. The groups, of whose number the result holds the square, go to every task
    with their totals; a task holds BLOCK occurrences, MERGED postings and a slab of each open run, and CELLS corrections.
    """
    spark = docs.sparkSession
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    frequent = frequencies(plain, min_docs, block, fan_in)
    totals = frequent.select("lang", F.explode(F.arrays_zip("source", "n")).alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("n"))
    groups = settled(plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")))
    kept = {r["lang"]: r["count"] for r in frequent.groupBy("lang").count().collect()}
    languages: dict[str, tuple[list, int]] = {}
    for r in groups.collect():
        languages.setdefault(r["lang"], ([], kept.get(r["lang"], 0)))[0].append((r["source"], r["n"]))
    found = settled(_corrected(frequent, languages, top))
    terms_of = spark.createDataFrame([(lang, v) for lang, (_, v) in languages.items()], "lang string, v long")
    based = groups.join(terms_of, "lang").select("lang", "source", "v", F.expr(f"if(v = 0, 0, 1 + {SMOOTH}L * {SCALE} div (n + {SMOOTH} * v))").alias("base"))
    both = based.alias("a").join(based.alias("b"), "lang").where("a.source <> b.source")
    plainly = both.select("lang", F.col("a.source").alias("source"), F.col("b.source").alias("other"), (2 * F.col("a.v") * F.abs(F.col("a.base") - F.col("b.base"))).alias("n"))
    changes = found.where("other is not null and other <> source").select("lang", "source", "other", "n")
    mirrored = changes.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "n")
    pairs = plainly.unionByName(changes).unionByName(mirrored).groupBy("lang", "source", "other").agg(F.expr("sum(n) div 2").alias("value"))
    terms = found.where("term is not null").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), F.col("n").alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    listed = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value").withColumn("rank", rank)
    return listed.unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))
