"""Splitters of page texts into chunks.

A splitter takes and gives the chunk columns of `as_chunks`; `place` orders the chunks of a file and grows by one
number at every step, so that steps can be chained without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from corpusmill.functions.numbering import before, numbered, same
from corpusmill.functions.scratch import let_go, written
from corpusmill.functions.text import KOREAN_SEPARATORS, SEPARATORS, is_korean, separators, stripped
from corpusmill.operators.recursive import OVERLAP, SIZE, check_sizes, split_column, split_text
from corpusmill.operators.routing import CODE_PATTERN, STEPS, TABLE_PATTERN

#: A newline before a line that reads as a header once stripped.
HEADER_SPLIT = r"(?Ud)\n(?=[^\S\n]*(?:#{1,6}[^\S\n]+\S|\d+\.[^\S\n]+\S|[A-Z][A-Z[^\S\n]]{2,}:[^\S\n]*(?:\n|\z)|\d+\.\d+(?:\.|[^\S\n]+\S)))"
MIN_SECTION = 100


def as_chunks(pages: DataFrame, *more: str) -> DataFrame:
    """Pages (path, page_no, text) as chunks that no splitter has seen, with more columns if named; a null text is empty."""
    missing = {"split_strategy": "string", "content_type": "string", "part_index": "int", "section_index": "int", "section_header": "string", "section_type": "string"}
    return pages.select(
        "path", F.col("page_no").cast("int").alias("page_no"), F.array(F.col("page_no").cast("int")).alias("place"), F.coalesce("text", F.lit("")).alias("text"), *(F.lit(None).cast(t).alias(c) for c, t in missing.items()), *more
    )


def _with(chunks: DataFrame, **new: Column) -> DataFrame:
    """The chunk columns and those that a caller added, some of them replaced; helper columns begin with _ and go."""
    return chunks.select(*(new[c].alias(c) if c in new else F.col(c) for c in chunks.columns if not c.startswith("_")))


def _first_strategy(name: str) -> Column:
    return F.coalesce("split_strategy", F.lit(name))


def semantic_split(chunks: DataFrame, size: int | None = None, overlap: int | None = None, korean: Column | None = None) -> DataFrame:
    """Recursive splitting, with the separators of the first chunk of each file. None means 1000 and 200.

    korean: whether to take the Korean separators, where that is known already.
    """
    size, overlap = SIZE if size is None else size, OVERLAP if overlap is None else overlap
    check_sizes(size, overlap)
    if korean is None:
        first = chunks.groupBy(F.col("path").alias("_path")).agg(F.min_by(is_korean(F.col("text")), F.col("place")).alias("_korean"))
        chunks, own = chunks.join(first, chunks["path"].eqNullSafe(first["_path"])), chunks.columns
        korean = F.col("_korean")
    else:
        own = chunks.columns
    seps = F.when(korean, F.array(*map(F.lit, KOREAN_SEPARATORS))).otherwise(F.array(*map(F.lit, SEPARATORS)))
    parts = chunks.select(*own, F.posexplode(split_column(F.col("text"), seps, size, overlap)).alias("_i", "_chunk"))
    return _with(parts, text=F.col("_chunk"), place=F.concat("place", F.array("_i")), split_strategy=_first_strategy("semantic"))


def _sections(text: Column, min_length: int = MIN_SECTION) -> Column:
    """Array of structs (i, type, part, header): the sections of a text from min_length on, numbered before short ones go."""
    parts = F.transform(F.split(text, HEADER_SPLIT, -1), lambda part, i: F.struct(
        i.alias("i"), F.lit(None).cast("string").alias("type"), stripped(part).alias("part"), F.when(i == 0, F.lit("")).otherwise(stripped(F.substring_index(part, "\n", 1))).alias("header"),
    ))
    return F.filter(parts, lambda p: F.length(p["part"]) >= min_length)


def section_split(chunks: DataFrame, min_length: int = MIN_SECTION) -> DataFrame:
    """One chunk a section. Sections below min_length go but keep their number; the first has no header."""
    parts = chunks.select(*chunks.columns, F.explode(_sections(F.col("text"), min_length)).alias("_p"))
    return _with(
        parts, text=F.col("_p.part"), place=F.concat("place", F.array("_p.i")), section_index=F.col("_p.i"), section_header=F.col("_p.header"), section_type=F.lit("content"),
        split_strategy=F.lit("section_aware"),
    )


def _gaps_and_matches(text: Column, pattern: str, kind: str) -> Column:
    """Array of structs (type, part): text gaps and matches of a pattern in order, stripped; empty ones are left out."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.flatten(F.transform(F.split(text, pattern, -1), lambda gap, i: F.array(
        F.struct(F.lit("text").alias("type"), stripped(gap).alias("part")), F.struct(F.lit(kind).alias("type"), stripped(F.coalesce(F.get(found, i), F.lit(""))).alias("part")),
    )))
    return F.filter(both, lambda p: p["part"] != "")


def _interleaved(chunks: DataFrame, pattern: str, kind: str) -> DataFrame:
    """Text gaps and matches of a pattern in order: the chunk columns and _i, _type, _part; blank texts have one part without a type."""
    own = chunks.columns
    listed = chunks.select(*own, F.posexplode_outer(_gaps_and_matches(F.col("text"), pattern, kind)).alias("_i", "_p"))
    return listed.select(*own, "_i", F.col("_p.type").alias("_type"), F.col("_p.part").alias("_part"))


def _typed(parts: DataFrame, name: str, place: Column, text: Column) -> DataFrame:
    blank = F.col("_i").isNull()
    return _with(
        parts, text=F.when(blank, F.col("text")).otherwise(text), place=F.when(blank, F.concat("place", F.array(F.lit(0)))).otherwise(place),
        content_type=F.coalesce("_type", "content_type"), part_index=F.coalesce("_i", "part_index"), split_strategy=F.when(blank, _first_strategy(name)).otherwise(F.lit(name)),
    )


def table_split(chunks: DataFrame) -> DataFrame:
    """Pipe tables and the text between them, in order; a blank text passes unchanged and without a type."""
    return _typed(_interleaved(chunks, TABLE_PATTERN, "table"), "table_aware", F.concat("place", F.array("_i")), F.col("_part"))


def code_split(chunks: DataFrame) -> DataFrame:
    """T4: fenced blocks whole, the text between them split recursively with default sizes and its own separators."""
    parts = _interleaved(chunks, CODE_PATTERN, "code")
    split = F.when(F.col("_type") == "text", split_column(F.col("_part"), separators(F.col("_part")))).otherwise(F.array("_part"))
    pieces = parts.select(*chunks.columns, "_i", "_type", F.posexplode(split).alias("_j", "_piece"))
    return _typed(pieces, "code_aware", F.concat("place", F.array("_i", "_j")), F.col("_piece"))


def split_in_steps(chunks: DataFrame, steps: list[str], size: int | None = None, korean: Column | None = None) -> DataFrame:
    """T5: the named splitters one after the other; an unknown name is an error before anything runs.

    The strategy that a chunk got first stays, but for splitters that set their own. korean: as for semantic_split.
    """
    known = {"semantic": lambda d: semantic_split(d, size, korean=korean), "section_aware": section_split, "table_aware": table_split, "code_aware": code_split}
    if unknown := [s for s in steps if s not in known]:
        raise ValueError(f"unknown splitting steps {unknown}; known are {list(known)}")
    return reduce(lambda d, s: d.transform(known[s]), steps, chunks)


def _first_parts(text: Column, steps: Column) -> Column:
    """Array of structs (i, type, part, header): what the first step of a strategy makes of a text; null where it passes whole."""
    def typed(pattern: str, kind: str) -> Column:
        return F.transform(_gaps_and_matches(text, pattern, kind), lambda p, i: F.struct(i.alias("i"), p["type"].alias("type"), p["part"].alias("part"), F.lit(None).cast("string").alias("header")))

    first = F.get(steps, F.lit(0))
    # an array without parts is a blank text, which tables and code pass on and sections drop
    return F.when(first == "section_aware", _sections(text)).when(first == "table_aware", _or_null(typed(TABLE_PATTERN, "table"))).when(first == "code_aware", _or_null(typed(CODE_PATTERN, "code")))


def _or_null(parts: Column) -> Column:
    return F.when(F.size(parts) > 0, parts)


def split_by_strategy(pages: DataFrame, strategies: DataFrame, size: int | None = None, lot: str | None = None) -> DataFrame:
    """Each file through the steps of its strategy (path, strategy), numbered as chunks; files without one are left out.

    One expression makes the parts of the first step, whichever it is; one recursive pass then cuts the parts that a second step or the
    text of code files asks for. The language that a file's separators go by is found first, in a reading of its own, so that no part
    needs to be kept. Chunks are numbered within lots of a file's pages as they are cut and written; what the chunks of the earlier lots
    add is a row a lot. lot: a whole-number column of pages that never falls along page_no in a file (None: page_no div 1000); pages
    that `numbered` gave with their lots don't move again.
    """
    size = SIZE if size is None else size
    check_sizes(size, OVERLAP)
    listed = F.create_map(*(x for name, steps in STEPS.items() for x in (F.lit(name), F.array(*map(F.lit, steps)))))
    plan = strategies.select(F.col("path").alias("_path"), listed[F.col("strategy")].alias("_steps"))
    lots = pages.withColumn("_lot", (F.col(lot) if lot else F.floor(F.col("page_no") / 1000)).cast("long"))
    tagged = lots.join(plan, lots["path"].eqNullSafe(F.col("_path")))
    chunks = as_chunks(tagged, "_steps", "_lot").withColumn("_parts", _first_parts(F.col("text"), F.col("_steps")))
    whole = F.col("_parts").isNull()
    own = [c for c in chunks.columns if not c.startswith("_")]
    # the outer form keeps Spark from computing the parts once more to filter by their number; pages whose sections are all short go
    parts = chunks.select(*own, "_steps", "_lot", F.explode_outer(F.when(whole, F.array(F.struct(F.lit(None).cast("int").alias("i"), F.lit(None).cast("string").alias("type"), F.col("text").alias("part"), F.lit(None).cast("string").alias("header")))).otherwise(F.col("_parts"))).alias("_p")).where("_p is not null")
    first, last = F.get("_steps", F.lit(0)), F.element_at("_steps", -1)
    sections, alone = first == "section_aware", F.col("_p.i").isNull()
    step_place = F.when(first == "semantic", F.col("place")).otherwise(F.concat("place", F.array(F.coalesce("_p.i", F.lit(0)))))
    once = parts.select(
        "path", "page_no", step_place.alias("place"), F.col("_p.part").alias("text"), F.when(first != "semantic", first).alias("split_strategy"), F.col("_p.type").alias("content_type"),
        F.when(~sections & ~alone, F.col("_p.i")).alias("part_index"), F.when(sections, F.col("_p.i")).alias("section_index"), F.when(sections, F.col("_p.header")).alias("section_header"),
        F.when(sections, F.lit("content")).alias("section_type"), (last == "semantic").alias("_semantic"), F.coalesce((first == "code_aware") & (F.col("_p.type") == "text"), F.lit(False)).alias("_code_text"), "_lot",
    )
    of_file = written(once.where("_semantic").groupBy(F.col("path").alias("_path")).agg(F.min_by(is_korean(F.col("text")), "place").alias("_file_korean")))
    let_go(pages.sparkSession)
    marked = once.join(of_file, once["path"].eqNullSafe(F.col("_path")), "left").drop("_path")
    korean = F.when(F.col("_code_text"), is_korean(F.col("text"))).otherwise(F.col("_file_korean"))
    # the window brings the parts of a lot into one task, in order
    ordered = marked.withColumns({"_korean": korean, "_part": F.row_number().over(W.partitionBy("path", "_lot").orderBy("place"))}).drop("_file_korean")
    cut = ordered.mapInArrow(_cut_and_counted(size), T.StructType([*ordered.schema.fields, T.StructField("_j", T.IntegerType()), T.StructField("_at", T.LongType())]))
    place = F.when(F.col("_semantic") | F.col("_code_text") | (F.col("split_strategy") == "code_aware"), F.concat("place", F.array("_j"))).otherwise(F.col("place"))
    strategy = F.when(F.col("_semantic"), F.coalesce("split_strategy", F.lit("semantic"))).otherwise(F.col("split_strategy"))
    new = {"place": place, "split_strategy": strategy}
    found = written(cut.select(*(new.get(c, F.col(c)).alias(c) for c in own), "_lot", "_at"))
    let_go(pages.sparkSession)
    earlier = before(found.groupBy("path", "_lot").agg(F.count("*").alias("_n")), ["path"], "_lot")
    shifts = written(earlier.select(F.col("path").alias("_path"), F.col("_lot").alias("_l"), "_before", "_total"))
    placed = found.join(shifts, same(found, shifts, ["path", "_lot"], ["_path", "_l"]))
    return placed.select(*own, (F.col("_at") + F.col("_before")).alias("chunk_index"), F.col("_total").alias("chunk_total"))


def _cut_and_counted(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of batches of parts, those of a file's lot one after the other: their chunks, with the place in the part (_j) and in the lot (_at)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, n = None, 0
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                rows, texts, js, ats = [], [], [], []
                columns = (batch.column(c).to_pylist() for c in ("path", "_lot", "text", "_semantic", "_code_text", "_korean"))
                for row, (path, number, text, semantic, code, korean) in enumerate(zip(*columns, strict=True)):
                    if lot != (path, number):
                        lot, n = (path, number), 0
                    pieces = [text]
                    if semantic or code:
                        pieces = split_text(text, SIZE if code else size, OVERLAP, KOREAN_SEPARATORS if korean else SEPARATORS) if text else []
                    rows += [row] * len(pieces)
                    texts += pieces
                    js += range(len(pieces))
                    ats += range(n, n + len(pieces))
                    n += len(pieces)
                taken = batch.take(pa.array(rows, pa.int64()))
                made = {"text": pa.array(texts, pa.string()), "_j": pa.array(js, pa.int32()), "_at": pa.array(ats, pa.int64())}
                kept = {c: taken.column(c) for c in batch.schema.names}
                yield pa.RecordBatch.from_pydict(kept | made)

    return cut


def number_chunks(chunks: DataFrame) -> DataFrame:
    """chunk_index (from 0, in reading order) and chunk_total of each file."""
    return numbered(chunks, ["path"], ["place"], F.floor(F.col("page_no") / 100), "chunk_index", "chunk_total")
