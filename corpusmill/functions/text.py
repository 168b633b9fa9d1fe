"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Every character that Python's str.strip removes.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

#: Separators of the recursive splitter, general and for Korean text.
SEPARATORS = ["\n\n", "\n", ". ", "? ", "! ", "; ", ", ", " ", ""]
KOREAN_SEPARATORS = ["\n\n", "\n", ". ", "다. ", "요. ", "죠. ", ", ", " ", ""]
KOREAN_SHARE = 0.1
TABLE_PIPES, TABLE_TABS = 8, 20


def stripped(text: Column) -> Column:
    """The text without white space at its ends, by Python's meaning of white space."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def occurrences(text: Column, character: str) -> Column:
    """How often a character occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def table_hint(text: Column) -> Column:
    """The word table in any case, more than 8 pipes or more than 20 tabs. Null counts as no text."""
    t = F.coalesce(text, F.lit(""))
    return F.contains(F.lower(t), F.lit("table")) | (occurrences(t, "|") > TABLE_PIPES) | (occurrences(t, "\t") > TABLE_TABS)


def is_korean(text: Column) -> Column:
    """More than a tenth of the characters are Hangul syllables. Null and empty texts are not Korean."""
    t = F.coalesce(text, F.lit(""))
    return F.length(F.regexp_replace(t, "[^가-힣]", "")) / F.greatest(F.length(t), F.lit(1)) > KOREAN_SHARE


def separators(text: Column) -> Column:
    """The splitter's separators for a text's language, as an array."""
    return F.when(is_korean(text), F.array(*map(F.lit, KOREAN_SEPARATORS))).otherwise(F.array(*map(F.lit, SEPARATORS)))


def preview(text: Column, n: int = 120) -> Column:
    """The first n characters with newlines as spaces, and an ellipsis."""
    return F.concat(F.replace(F.substring(text, 1, n), F.lit("\n"), F.lit(" ")), F.lit("…"))


def store_key(domain: Column, content_type: Column) -> Column:
    """domain_type, with general for a missing type."""
    return F.concat_ws("_", domain, F.coalesce(content_type, F.lit("general")))


def distance_score(distance: Column) -> Column:
    """1 / (1 + distance), a negative distance counts as 0."""
    return 1 / (1 + F.greatest(distance, F.lit(0.0)))


def percent(part: Column, whole: Column, empty: str = "N/A") -> Column:
    """A share as text, such as 67%; `empty` for nothing at all."""
    return F.when(whole == 0, F.lit(empty)).otherwise(F.concat(F.bround(part / whole * 100, 0).cast("int").cast("string"), F.lit("%")))
