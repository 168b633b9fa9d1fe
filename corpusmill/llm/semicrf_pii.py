"""Personal data by a semi-Markov conditional random field beside fixed base patterns.

Base patterns find spans of four kinds. Around digits and at-signs short windows are cut out of a text; the model
scores whole candidate segments of a window by features of the span, and a dynamic programme over segments of
bounded length chooses boundaries and kinds together. Spans that the model is sure of and that no base span
touches are added to the base spans.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import batched

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows

#: Kinds in their order, and their base patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: The same matches, looked for once in each run of digits only.
IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: The characters that an e-mail address can hold before its at-sign.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

#: Atoms in an entity at most, and characters in a window at most.
MAX_ATOMS, MAX_WINDOW = 20, 160
#: Documents and windows that the model is fitted on at most (expected number of documents, by a hash of the text).
FIT_DOCS, FIT_WINDOWS = 20_000, 500
#: Updates of the weights, in rounds over all windows, with a falling rate.
UPDATES, RATE, DECAY = 6000, 0.3, 1e-4
#: Score by which an added segment must beat the same atoms left outside.
MARGIN = 2.0
#: Where a window begins and how it goes on.
AT = "(at)"
TRIGGER = re.compile(r"(?:[0-9@]|\(at\))[A-Za-z0-9._%+@()/\-]{0,120}(?: (?=[0-9+(])[0-9().+/\-]{1,40}){0,6}")
BEFORE = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+@()/-")
ATOM = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    """Whether all parts are at most 255; parts can have any number of digits."""
    return all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in text.split("."))


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of EMAIL, found from the at-signs; a scan from every letter would give the same ones."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if re.search(r"[0-9]", text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in IP_RUNS.finditer(text) if _is_ip(m[0])]
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def windows(text: str) -> list[tuple[int, int]]:
    """Pieces of a text that may hold an entity: around digits and at-signs."""
    out, at = [], 0
    while m := TRIGGER.search(text, at):
        start = m.start()
        while start > at and m.start() - start < 64 and text[start - 1] in BEFORE:
            start -= 1
        out.append((start, min(m.end(), start + MAX_WINDOW)))
        at = out[-1][1]
    return out


#: Names of the whole-span features; a segment has those that hold for it.
FEATURES = (
    "bias", "one_at", "at_inside", "dot_after_at", "starts_plus", "luhn_14_19", "digits_10_15", "digits_14_19", "digits_under_7", "digits_over_19",
    "four_groups", "groups_to_255", "three_dots_only", "has_letter", "letters_only", "digits_only", "has_space", "has_bracket", "has_dash", "edge_mark",
    "cut_digit", "cut_letter", "cut_local", "one_atom", "up_to_5_atoms", "up_to_10_atoms", "over_10_atoms", "hex_mix", "short_top", "starts_zero",
    "closed_bracket", "ten_or_more_digits", "has_slash", "starts_00",
)


@dataclass
class Segments:
    """All candidate segments of some windows: atom bounds and a row of features each, by window and end, the longest first."""

    atoms: list[tuple[int, int]]
    begin: np.ndarray
    end: np.ndarray
    rows: np.ndarray
    bare: np.ndarray  # segments without a digit or an at-sign, which are never an entity
    firsts: np.ndarray  # the first atom of each window, and the number of atoms


class _Counts:
    """How often something holds up to each place, so that its number in any span is one difference."""

    def __init__(self, holds: np.ndarray):
        self.sums = np.concatenate([[0], np.cumsum(holds)])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.sums[np.maximum(a, b)] - self.sums[a]


def segments(*texts: str) -> Segments:
    """Segments of windows, which hold ASCII only. Features are of the segment as a whole, with the characters that it is cut from.

    All of them come from counts up to a place, and from the next or last place of a sign; so the time goes by the number of segments,
    not by their lengths.
    """
    joined = "\n" + "\n".join(texts) + "\n\n"
    code = np.frombuffer(joined.encode("ascii", "replace"), np.uint8)
    offsets = 1 + np.cumsum([0, *(len(t) + 1 for t in texts)])
    atoms = [(m.start() + at, m.end() + at) for t, at in zip(texts, offsets.tolist(), strict=False) for m in ATOM.finditer(t)]
    first, last = np.array(atoms, np.int64).reshape(-1, 2).T
    firsts = np.searchsorted(first, offsets)
    firsts[-1] = len(atoms)
    window = np.repeat(firsts[:-1], np.diff(firsts))
    back = np.arange(MAX_ATOMS - 1, -1, -1)
    j = np.repeat(np.arange(len(atoms)), MAX_ATOMS)
    i = j - np.tile(back, len(atoms))
    spaces = code[first] == 32 if len(atoms) else np.zeros(0, bool)
    keep = i >= window[j]
    keep &= (i == j) | ~(spaces[np.maximum(i, 0)] | spaces[j])
    i, j = i[keep], j[keep]
    a, b, n = first[i], last[j], j - i + 1
    size = b - a

    def sign(c: str) -> np.ndarray:
        return code == ord(c)

    digit = (code >= 48) & (code <= 57)
    letter = (code | 32) - np.uint8(97) < 26
    place = np.arange(len(code))
    digits, letters, dots = _Counts(digit)(a, b), _Counts(letter)(a, b), _Counts(sign("."))(a, b)
    numeric = (digits + dots == size) & (code[a] != 46) & (code[b - 1] != 46) & (_Counts(sign(".") & np.append(sign(".")[1:], False))(a, b - 1) == 0)
    marks = np.zeros(len(code), bool)
    marks[[m.start() for m in re.finditer(re.escape(AT), joined)]] = True
    found = []
    for where, width in ((sign("@"), 1), (marks, len(AT))):
        ahead = np.minimum.accumulate(np.where(where, place, len(code))[::-1])[::-1][a]
        found.append(np.where(ahead + width <= b, ahead - a, -1))
    at = np.maximum(*found)
    ats = _Counts(sign("@"))(a, b) + _Counts(marks)(a, b - len(AT) + 1)
    # the checksum by the parity of a digit's number among all digits
    value = code[digit].astype(np.int64) - 48
    twice = value * 2 - 9 * (value > 4)
    even = np.arange(len(value)) % 2 == 0
    g0, g1 = _Counts(digit).sums[a], _Counts(digit).sums[b]
    luhn_sum = np.where((g1 - 1) % 2 == 0, _Counts(np.where(even, value, twice))(g0, g1), _Counts(np.where(even, twice, value))(g0, g1))
    over_255 = _Counts(np.array([len(x) > 3 and len(x.lstrip("0")) > 3 or int(x.lstrip("0") or 0) > 255 if (x := joined[p:q]) and x[0].isdigit() else False for p, q in atoms], bool))(i, j + 1)
    top = b - np.maximum(a, np.maximum.accumulate(np.where(sign("."), place, -1))[b - 1] + 1)
    alnum, before, after = digit | letter, code[a - 1], code[b]
    holds = {
        "bias": np.ones(len(a), bool),
        "one_at": ats == 1,
        "at_inside": (at > 0) & (at < size - 1),
        "dot_after_at": (at > 0) & (_Counts(sign("."))(np.minimum(a + at + 2, b), b - 1) > 0),
        "starts_plus": (code[a] == 43) & (size > 1) & digit[a + 1],
        "luhn_14_19": (digits >= 14) & (digits <= 19) & (luhn_sum % 10 == 0),
        "digits_10_15": (digits >= 10) & (digits <= 15),
        "digits_14_19": (digits >= 14) & (digits <= 19),
        "digits_under_7": digits < 7,
        "digits_over_19": digits > 19,
        "four_groups": (dots == 3) & numeric,
        "groups_to_255": (dots == 3) & numeric & (over_255 == 0),
        "three_dots_only": (dots == 3) & numeric,
        "has_letter": letters > 0,
        "letters_only": letters == size,
        "digits_only": digits == size,
        "has_space": _Counts(sign(" "))(a, b) > 0,
        "has_bracket": _Counts(sign("(") | sign(")"))(a, b) > 0,
        "closed_bracket": _Counts(sign("("))(a, b) == _Counts(sign(")"))(a, b),
        "ten_or_more_digits": digits >= 10,
        "has_slash": _Counts(sign("/") | sign("_"))(a, b) > 0,
        "starts_00": (code[a] == 48) & (size > 1) & (code[a + 1] == 48),
        "has_dash": _Counts(sign("-"))(a, b) > 0,
        "edge_mark": ~alnum[b - 1] | ~(alnum[a] | (code[a] == 43) | (code[a] == 40)),
        "cut_digit": digit[a - 1] & digit[a] | digit[b] & digit[b - 1],
        "cut_letter": letter[a - 1] & letter[a] | letter[b] & letter[b - 1],
        "cut_local": np.isin(before, list(b"._%+-@")) | (after == 64) | np.isin(after, list(b".-")) & alnum[b + 1],
        "one_atom": n == 1,
        "up_to_5_atoms": (n > 1) & (n <= 5),
        "up_to_10_atoms": (n > 5) & (n <= 10),
        "over_10_atoms": n > 10,
        "hex_mix": (digits > 0) & (letters > 0) & (at < 0),
        "short_top": (at > 0) & (top > 1) & (top <= 6) & (_Counts(letter)(b - top, b) == top),
        "starts_zero": code[a] == 48,
    }
    rows = np.stack([holds[f] for f in FEATURES], axis=1).astype(np.float64)
    origin = np.repeat(offsets[:-1], np.diff(firsts))
    return Segments([(p - o, q - o) for (p, q), o in zip(atoms, origin.tolist(), strict=True)], i, j + 1, rows, (ats == 0) & (digits == 0), firsts)


OUTSIDE = len(KINDS)
LABELS = OUTSIDE + 1


class SemiCrf:
    """Linear scores of (segment, label) and of neighbouring labels. A segment outside of entities is one atom."""

    def __init__(self):
        self.weights = np.zeros((LABELS, len(FEATURES)))
        self.steps = np.zeros((LABELS, LABELS))

    def _scores(self, s: Segments) -> np.ndarray:
        score = s.rows @ self.weights.T
        score[s.end - s.begin > 1, OUTSIDE] = -np.inf
        score[s.bare, :OUTSIDE] = -np.inf
        return score

    def gradient(self, s: Segments, truth: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Observed minus expected features of a window, by forward and backward sums over segmentations."""
        n, score = len(s.atoms), self._scores(s)
        forward = np.full((n + 1, LABELS), -np.inf)
        backward = np.full((n + 1, LABELS), -np.inf)
        backward[n] = 0
        enter = np.full((n + 1, LABELS), -np.inf)  # best sums of all that ends here, by the label that comes next
        enter[0] = 0
        ending = [np.flatnonzero(s.end == j) for j in range(n + 1)]
        starting = [np.flatnonzero(s.begin == i) for i in range(n + 1)]
        for j in range(1, n + 1):
            k = ending[j]
            forward[j] = np.logaddexp.reduce(enter[s.begin[k]] + score[k], axis=0)
            enter[j] = np.logaddexp.reduce(forward[j][:, None] + self.steps, axis=0)
        leave = np.full((n + 1, LABELS), -np.inf)
        for i in range(n - 1, -1, -1):
            k = starting[i]
            leave[i] = np.logaddexp.reduce(score[k] + backward[s.end[k]], axis=0)
            backward[i] = np.logaddexp.reduce(self.steps + leave[i][None, :], axis=1)
        total = np.logaddexp.reduce(forward[n])
        share = np.exp(enter[s.begin] + score + backward[s.end] - total)
        gold = np.zeros_like(share)
        step = np.zeros_like(self.steps)
        place = {(a, b): k for k, (a, b) in enumerate(zip(s.begin.tolist(), s.end.tolist(), strict=True))}
        at, last = 0, None
        for a, b, label in [*truth, (n, n, -1)]:
            for i in range(at, a):
                gold[place[i, i + 1], OUTSIDE] = 1
            labels = [OUTSIDE] * (a - at) + [label] * (label >= 0)
            for x in labels:
                if last is not None:
                    step[last, x] += 1
                last = x
            if label >= 0:
                gold[place[a, b], label] = 1
            at = b
        for i in range(1, n):
            step -= np.exp(forward[i][:, None] + self.steps + leave[i][None, :] - total)
        return (gold - share).T @ s.rows, step

    def best(self, s: Segments) -> list[tuple[int, int, int]]:
        """Entities (first atom, end atom, kind) of the best segmentation of each window that beat the outside by MARGIN.

        The windows go side by side: a step takes the segments that end at the same place of each. Of equal scores the longer segment stands.
        """
        n_of = np.diff(s.firsts)
        windows, longest = len(n_of), int(n_of.max(initial=0))
        of = np.searchsorted(s.firsts, s.begin, "right") - 1
        score = self._scores(s)
        table = np.full((windows, longest + 1, MAX_ATOMS, LABELS), -np.inf)
        table[of, s.end - s.firsts[of], MAX_ATOMS - (s.end - s.begin)] = score
        enter = np.full((windows, longest + MAX_ATOMS, LABELS), -np.inf)  # by begin + MAX_ATOMS - 1: places before a window hold nothing
        enter[:, MAX_ATOMS - 1] = 0
        source = np.full((windows, longest + 1, LABELS), -1)
        came = np.zeros((windows, longest + 1, LABELS), np.int64)
        value = np.full((windows, longest + 1, LABELS), -np.inf)
        for j in range(1, longest + 1):
            new = enter[:, j - 1 : j - 1 + MAX_ATOMS] + table[:, j]
            came[:, j] = new.argmax(axis=1)
            value[:, j] = np.take_along_axis(new, came[:, j][:, None], axis=1)[:, 0]
            both = value[:, j, :, None] + self.steps
            source[:, j] = both.argmax(axis=1)
            if j < longest:
                enter[:, j - 1 + MAX_ATOMS] = np.take_along_axis(both, source[:, j][:, None], axis=1)[:, 0]
        out = []
        for w in range(windows):
            j, found = int(n_of[w]), []
            y = int(value[w, j].argmax())
            while j > 0:
                size = MAX_ATOMS - int(came[w, j, y])
                i = j - size
                if y != OUTSIDE and table[w, j, MAX_ATOMS - size, y] - table[w, i + 1 : j + 1, MAX_ATOMS - 1, OUTSIDE].sum() >= MARGIN:
                    found.append((int(s.firsts[w]) + i, int(s.firsts[w]) + j, y))
                j, y = i, int(source[w, i, y])
            out += found[::-1]
        return out


def labelled(text: str) -> tuple[Segments, list[tuple[int, int, int]]] | None:
    """Candidate segments of a window and the base entities among them; None if an entity isn't made of atoms."""
    s = segments(text)
    firsts = {a: i for i, (a, _) in enumerate(s.atoms)}
    lasts = {b: i + 1 for i, (_, b) in enumerate(s.atoms)}
    truth, at = [], 0
    for start, kind, end in base_spans(text):
        a, b = firsts.get(start), lasts.get(end)
        if a is None or b is None or b - a > MAX_ATOMS:
            return None
        if a >= at:
            truth.append((a, b, kind))
            at = b
    return s, truth


def disguised(text: str, spans: list[tuple[int, int, int]]) -> tuple[Segments, list[tuple[int, int, int]]] | None:
    """As labelled(), with the given (start, kind, end) as the entities."""
    s = segments(text)
    begin, end = {x[0]: i for i, x in enumerate(s.atoms)}, {x[1]: i + 1 for i, x in enumerate(s.atoms)}
    truth = [(begin.get(a), end.get(b), kind) for a, kind, b in spans]
    return (s, truth) if all(a is not None and b is not None and b - a <= MAX_ATOMS for a, b, _ in truth) else None


def disguises(kind: int, entity: str) -> list[str]:
    """Forms of an entity that the base patterns don't take."""
    digits = _digits(entity)
    if kind == 0:
        return [entity.replace("@", AT)]
    if kind == 2:
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(groups), "/".join(groups)]
    if kind == 3:
        plain = entity.lstrip("+")
        forms = ["00" + plain, *("00" + re.sub(r"[ ().-]+", mark, plain) for mark in "/. ")]
        local = re.match(r"\+[0-9]+[ .-]+\(?([0-9].*)", entity)
        return forms + (["0" + local[1]] if local and len(_digits(local[1])) >= 9 else [])
    return []


#: What a phone number begins with: a plus sign, a bracket, or the zeros that are dialled before a code.
DIALLED = re.compile(r"\+|\(|00?[1-9]")
#: Dates, and four parts of an address that is none, are no phone numbers.
SHORT_PARTS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
DATE = re.compile(r"(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2}(?![0-9])")
#: Numbers that are no personal data, by the side of those in the texts: dates, times, versions, amounts, counters, books, parts.
DECOYS = ("isbn 978-3-16-148410-0 in", "isbn 978-0-306-40615-7 or", "doi 10.1000/182.5 of", "doi 10.1038/1234.56789 and", "sum 1234.5678.9012 net", "part 12345-67890-12345 is", "part 9876-5432-1098 or", "id 00-1234-567890 to", "on 2024-05-06 12:30 and", "from 12/31/1999 to", "version 10.15.7 of", "item 1234567890 in", "cost 1,250,000.00 net", "code 4929 1234 5678 9012 3 or", "range 1990-2024 of", "see 10.1000/182 and", "call f(at) once", "at 192.168.001.300 or", "user bob@localhost said")


#: What stands behind a phone number, so that its base pattern runs on and takes too many digits.
BEHIND = "190.137.223.20"


def variants(window: str) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The window with its only base entity disguised, and what then stands where: (start, kind, end), the disguised one first."""
    base = base_spans(window)
    if len(base) != 1:
        return []
    a, kind, b = base[0]
    out = [(window[:a] + form + window[b:], [(a, kind, a + len(form))]) for form in disguises(kind, window[a:b])]
    if kind == 3:
        end = b + 1 + len(BEHIND)
        out.append((f"{window[:b]} {BEHIND} {window[b:].lstrip()}", [(a, 3, b), (b + 1, 1, end)]))
    return out


def valid(kind: int, text: str) -> bool:
    """What an added span must hold besides the model's score."""
    digits = _digits(text)
    if kind == 0:
        return bool(EMAIL.fullmatch(text.replace(AT, "@")))
    if kind == 1:
        return bool(IP.fullmatch(text)) and _is_ip(text)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and DIALLED.match(text) is not None and not SHORT_PARTS.fullmatch(text) and not DATE.match(text)


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS, text_col: str = "text") -> SemiCrf:
    """A model of the windows of a bounded sample of texts.

    Labels are the base patterns, and entities in forms that those don't take (disguises), made from the sample's own.

    Both bounds are by hashes of texts, so a sample doesn't depend on partitions or on the order of rows; half of the
    windows hold an entity, half hold none. Without windows the model is empty and adds nothing.
    """
    texts = docs.select(F.col(text_col).alias("_text"))
    n = texts.count()
    unit = F.pmod(F.xxhash64("_text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = texts.where(unit < F.lit(min(1.0, fit_docs / max(1, n))))
    kind = T.ArrayType(T.StructType([T.StructField("window", T.StringType()), T.StructField("entity", T.BooleanType())]))

    def pieces(text: str | None) -> list[dict]:
        return [{"window": w, "entity": bool(base_spans(w))} for a, b in windows(text or "") if (w := text[a:b])]

    listed = map_rows(chosen, ["_text"], 0, [T.StructField("found", kind)], lambda: lambda column: [[pieces(t) for t in column]])
    each = listed.selectExpr("inline(found)").distinct()
    rows = [r[0] for entity in (True, False) for r in each.where(F.col("entity") == entity).orderBy(F.xxhash64("window"), "window").limit(fit_windows // 2).collect()]
    rows = sorted(rows)
    examples = [x for w in [*rows, *DECOYS * (8 * bool(rows))] if (x := labelled(w))] + [x for w in rows for v in variants(w) if (x := disguised(*v))]
    model, random = SemiCrf(), np.random.default_rng(0)
    for epoch in range(-(-UPDATES // len(examples)) if examples else 0):
        for k in random.permutation(len(examples)):
            grad, step = model.gradient(*examples[k])
            rate = RATE / (1 + epoch)
            model.weights += rate * (grad - DECAY * model.weights)
            model.steps += rate * (step - DECAY * model.steps)
    return model


#: Windows that are scored together.
TOGETHER = 64


def spans_of(text: str, model: SemiCrf) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: base ones and those that the model adds outside of them."""
    base = base_spans(text)
    starts = np.array([x for x, _, _ in base], np.int64)
    ends = np.maximum.accumulate(np.array([y for _, _, y in base], np.int64))
    added, asked, k = [], [], 0
    for a, b in windows(text):
        while k < len(base) and base[k][2] <= a:
            k += 1
        piece = text[a:b]
        if not (k < len(base) and base[k][0] <= a and base[k][2] >= b) and ("@" in piece or AT in piece or len(_digits(piece)) >= 7 or piece.count(".") >= 3):
            asked.append((a, piece))
    for some in batched(asked, TOGETHER):
        s = segments(*(piece for _, piece in some))
        for i, j, kind in model.best(s):
            at = some[int(np.searchsorted(s.firsts, i, "right")) - 1][0]
            start, end = at + s.atoms[i][0], at + s.atoms[j - 1][1]
            before = int(np.searchsorted(starts, end))  # base spans that begin before the end
            if valid(kind, text[start:end]) and not (before and ends[before - 1] > start):
                added.append((start, kind, end))
    return base, sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, model: SemiCrf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of each text.

    Returns id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added ones as
    kind:start:end). A null or empty text has none, a text of any length is taken whole, in time that grows with its length.
    Of equal scores the segmentation found first stands. An empty table gives an empty one. Repeated rows give repeated results; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]

    def make():
        mine = shared.value

        def one(text: str) -> tuple:
            base, every = spans_of(text, mine)
            counts = [sum(k == x for _, x, _ in base) for k in range(len(KINDS))]
            return *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every)

        def run(texts):
            rows = [one(t or "") for t in texts]
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in fields]

        return run

    return map_rows(docs.select(F.col(id_col), F.col(text_col).alias("_body")), [id_col, "_body"], 1, fields, make)
