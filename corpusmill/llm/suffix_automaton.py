"""Benchmark decontamination with a generalised suffix automaton of the normalised test items."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows, settled

#: Consecutive item words that make a window; a shorter item is one window.
WINDOW = 10
#: Item words that one automaton holds; a larger benchmark is taken in several passes of this size.
BLOCK_WORDS = 100_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
#: Bytes below 128 that belong to no word become spaces; letters become lower case.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8."""
    return text.encode().translate(_FOLDED).split()


class ItemAutomaton:
    """Suffix automaton of many items, which knows the windows that end in each state."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: state -> items with a full window there; state -> {length: items that are wholly that string}
        self.windows: dict[int, set[int]] = {}
        self.whole: dict[int, dict[int, set[int]]] = {}
        tokens = [(item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]) for item, text in items]
        for _, ids in tokens:
            state = 0
            for c in ids:
                state = self._extend(state, c)
        self.by_length = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.at_window = self._of_window()
        for item, ids in tokens:
            self._mark(item, ids)
        self.shortest = min([window, *(n for at in self.whole.values() for n in at)])
        self.whole_above = self._nearest_whole()

    def _new(self, transitions: dict[int, int], link: int, length: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """Give the strings that p reaches by c a state of their own."""
        clone = self._new(dict(self.next[q]), self.link[q], self.length[p] + 1)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        state, p = self._new({}, 0, self.length[last] + 1), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return state

    def _of_window(self) -> list[int]:
        """For each state the one of its last `window` words (or of all, if these are fewer): a step for each state."""
        at = list(range(len(self.next)))
        for s in self.by_length[1:]:
            if self.length[self.link[s]] >= self.window:
                at[s] = at[self.link[s]]
        return at

    def _of_length(self, state: int, n: int) -> int:
        """The state of the last n words of what leads to a state; for short items, whose words are few."""
        while self.length[self.link[state]] >= n and self.link[state] >= 0:
            state = self.link[state]
        return state

    def _mark(self, item: int, ids: list[int]) -> None:
        n, state = min(len(ids), self.window), 0
        for i, c in enumerate(ids):
            state = self.next[state][c]
            if n == self.window and i + 1 >= n:
                self.windows.setdefault(self.at_window[state], set()).add(item)
        if 0 < n < self.window:
            self.whole.setdefault(self._of_length(state, n), {}).setdefault(n, set()).add(item)

    def _nearest_whole(self) -> list[int]:
        """For each state itself or the nearest state above it that is a whole short item; -1 if none."""
        above = [-1] * len(self.next)
        for s in self.by_length:
            above[s] = s if s in self.whole else above[self.link[s]] if s else -1
        return above

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Spans [first, end) of hit words, joined and in order, and the items whose windows occur."""
        spans: list[list[int]] = []
        items: set[int] = set()
        nxt, link, length, window, shortest = self.next, self.link, self.length, self.window, self.shortest
        windows, at_window = self.windows, self.at_window
        state = n = 0
        for i, c in enumerate(map(self.vocabulary.get, words)):
            if c is None:
                state = n = 0
                continue
            to = nxt[state].get(c)
            while to is None:
                state = link[state]
                n = length[state]
                to = nxt[state].get(c)
            state, n = to, n + 1
            if n < shortest:
                continue
            reach = 0
            if n >= window:
                reach = n
                items |= windows[at_window[state]]
            at = self.whole_above[state]
            while at > 0:
                for m, found in self.whole[at].items():
                    if m <= n:
                        reach = max(reach, m)
                        items |= found
                at = self.whole_above[link[at]]
            if reach:
                first = i + 1 - reach
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, i + 1])
        return spans, items


@lru_cache(maxsize=1)
def _automaton(items: tuple[tuple[int, str], ...], window: int) -> ItemAutomaton:
    return ItemAutomaton(list(items), window)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int):
    """Items in blocks of so many words (or one item), one block at a time on the driver."""
    block, size = [], 0
    for row in items.select(id_col, text_col).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).distinct().toLocalIterator():
        n = len(words_of(row[1]))
        if block and size + n > block_words:
            yield tuple(sorted(block))
            block, size = [], 0
        if n:
            block.append((row[0], row[1]))
            size += n
    if block:
        yield tuple(sorted(block))


SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))
ITEMS = T.ArrayType(T.LongType())


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, id_cols: list[str] | None = None, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Spans of hit words and items found for each document: the id columns, text, n_words, spans, items.

    Each pass streams every document through the automaton of one block of items. A null text has no words; an
    item without words has no window; empty tables give no hits. Rows may repeat.
    """
    ids = id_cols or ["doc_id"]
    found = docs.select(*ids, F.lit(None).cast(SPANS).alias("_spans"), F.lit(None).cast(ITEMS).alias("_items"), F.col(text_col).alias("_text"))
    sc = docs.sparkSession.sparkContext

    def scan_with(shared):
        def make():
            automaton = _automaton(shared.value, window)

            def run(spans, known, texts):
                out = [[], [], []]
                for old, seen, text in zip(spans, known, texts, strict=True):
                    words = words_of(text or "")
                    new, hit = automaton.scan(words)
                    out[0].append(len(words))
                    out[1].append(joined([*(old or []), *new]))
                    out[2].append(sorted(hit.union(seen or [])))
                return out

            return run

        return make

    fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", ITEMS)]
    n = len(ids)

    def one_pass(frame: DataFrame, block) -> DataFrame:
        plain = frame.withColumn("_body", F.col("_text"))
        return map_rows(plain.select(*ids, "_body", "_spans", "_items", "_text"), [*ids, "_body", "_spans", "_items", "_text"], n + 1, fields, scan_with(sc.broadcast(block)))

    result = None
    for block in item_blocks(items, item_col, item_text_col, block_words):
        if result is not None:  # a benchmark beyond one block: settle, so that one automaton at a time is in memory
            found = settled(result).select(*ids, F.col("spans").alias("_spans"), F.col("items").alias("_items"), F.col("_body").alias("_text"))
        result = one_pass(found, block)
    if result is None:
        result = one_pass(found, ())
    return result.withColumnRenamed("_body", "text")


def joined(spans: list[list[int]]) -> list[list[int]]:
    """Spans in order, overlapping or touching ones made one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Hit words and occurring items of each document.

    Returns id, n_words, n_hit, n_items, items_sha256 (of the ids sorted as strings, comma-joined), contaminated.

    Null texts have no words. Texts of any length are taken whole, in time that grows with their words. Repeated rows give
    repeated results, repeated items are one; an empty table gives an empty one, an empty benchmark no hits; other columns are ignored,
    whatever their names.
    """
    hits = find_hits(docs, items, id_cols=[id_col], **options)
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    return hits.select(
        id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


def without_spans(text: str, spans: list[list[int]]) -> str:
    """The text without the given words and what stands between them."""
    places = [m.span() for m in WORD.finditer(text.translate(_UPPER))]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5, text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Documents without benchmark passages, in the columns and order of columns of docs.

    Spans of at least a window are cut out of a text, again until no window is left; a document of which more than
    max_coverage of the words is hit goes as a whole. Others stay unchanged, null and empty texts too. Texts of any length are
    taken whole, repeated rows are treated alike, and an empty table gives an empty one.
    """
    others = [c for c in docs.columns if c != text_col]
    keys = [f"c{i}" for i in range(len(others))]
    sc = docs.sparkSession.sparkContext

    def clean_with(shared):
        def make():
            automaton = _automaton(shared.value, window)

            def one(text, n_before, hit_before):
                words = words_of(text or "")
                n, hit = n_before if n_before is not None else len(words), hit_before or 0
                while (spans := automaton.scan(words)[0]) and hit <= n * max_coverage:
                    hit += sum(b - a for a, b in spans)
                    text = without_spans(text, spans)
                    words = words_of(text)
                return text, n, hit

            def run(n_words, n_hit, texts):
                rows = [one(*x) for x in zip(texts, n_words, n_hit, strict=True)]
                return [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]

            return run

        return make

    fields = [T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType())]
    now = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(others, keys, strict=True)), F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("long").alias("n_hit"), F.col(text_col).alias("text"))
    for k, block in enumerate(item_blocks(items, item_col, item_text_col, block_words)):
        if k:  # one automaton at a time is in memory
            now = settled(now)
        now = map_rows(now.select(*keys, "n_words", "n_hit", "text"), [*keys, "n_words", "n_hit", "text"], len(keys), fields, clean_with(sc.broadcast(block)))
        now = now.where(F.col("n_hit") <= F.col("n_words") * max_coverage)
    return now.select(*(F.col("text").alias(c) if c == text_col else F.col(keys[others.index(c)]).alias(c) for c in docs.columns))


def items_digest(items: list[int]) -> str:
    """The digest that contamination() gives for a set of items."""
    return hashlib.sha256(",".join(sorted(map(str, set(items)))).encode()).hexdigest()
