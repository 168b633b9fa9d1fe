"""Fuzzy line deduplication in DataFrame functions only.

A normalised line's longer words are dealt to classes by their hashes, four to eight to a class, and each class with four
words has a SimHash of the first four: the line's fingerprint is one block for each class. A changed word touches the blocks of
two classes at most, so near copies agree in another one (the pigeonhole); lines that agree in a block are candidates, their
edit similarity decides, and of each connected group of lines the first occurrence in the corpus stays.

One SimHash of a whole line can't do this: at a similarity of 0.8 it differs in 11 bits of 64 or more, and blocks of so many
fewer bits hold too many lines.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusmill.llm.batches import discard, settled, stored, tidy
from corpusmill.llm.graph import connected

#: Edit similarity (1 - edits / length of the longer) that linked lines have at least, in words or, where both lines have
#: at most FEW_WORDS, in characters.
SIMILARITY, FEW_WORDS = 0.8, 20
#: Characters of a word that the blocks take; a line with fewer than three such words gives all its words.
LONG_WORD = 4
#: A line of n words has 2 ** floor(log2(n / PER_CLASS)) classes.
PER_CLASS = 4
#: Lines of fewer words have, in place of blocks, all their words but one.
SHORT = 10
#: Lines in a bucket of which all pairs are compared at once; those of fuller ones where pairs with the first leave several groups.
BUCKET = 50
#: Words of lines whose edits are counted without a look at the words that only one of them has.
COUNTED = 100
#: Pieces in which edits of longer lines are counted first: all edits of a piece take an eighth of the line's time.
PIECES = 8
#: Slots that words of open crowded buckets are counted by; a byte of each goes to every task.
SLOTS = 1 << 18
#: White space that isn't a space.
BLANKS = "\t\r\v\f\x85\xa0"


def spaced(text: Column) -> Column:
    """A line, or lines, with spaces for other white space. Literal replacements: expressions take five times as long. Most texts need none."""
    return F.when(text.rlike(f"[{BLANKS}]"), reduce(lambda c, blank: F.replace(c, F.lit(blank), F.lit(" ")), BLANKS, text)).otherwise(text)


def spaced_words(line: Column) -> Column:
    """Words of a line without other white space than spaces in lower case; an empty array for a blank one."""
    return F.array_remove(F.split(F.lower(line), " "), "")


def line_words(line: Column) -> Column:
    """Words of a line in lower case; an empty array for a blank one."""
    return spaced_words(spaced(line))


def word_letters(words: Column) -> Column:
    """One letter for each word, so that an edit distance of letters counts words.

    The letter is a hash of the word among the code points 0x100 to 0xD7FF, so of 50,000 pairs of different words about one
    counts as equal.
    """
    points = F.transform(words, lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(0xD700)) + 0x100), 4, "0"))
    return F.decode(F.unhex(F.array_join(points, "")), "UTF-16BE")


def _classes(n: Column) -> Column:
    """Logarithm of the number of classes for n words; -1 for a short line."""
    return F.when(n < SHORT, F.lit(-1)).otherwise(F.floor(F.log2(n / PER_CLASS)).cast("int"))


def keyed_lines(docs: DataFrame) -> DataFrame:
    """All lines that aren't blank, with their blocks: id, line, h1, h2 (together they identify the normalised line), key.

    docs: id, text. A row with an id is the occurrence itself, its key a hash of all words of a short line, else null; the
    others are blocks and have only h1 and key. A line whose number of words is near a change of the number of classes has the blocks of both.
    """
    texts = docs.where("id is not null and text is not null").select("id", spaced(F.col("text")).alias("text"))
    lines = texts.select("id", F.posexplode_outer(F.split("text", "\n")).alias("line", "body"))
    words = lines.where(F.ltrim("body") != "").select("id", "line", spaced_words(F.col("body")).alias("words"))
    # one pass of a lambda over the words, 0 for a short one; the arrays hold no nulls, so that they are sorted as plain numbers
    long = F.transform("words", lambda w: F.when(F.length(w) >= LONG_WORD, F.xxhash64(w)).otherwise(F.lit(0).cast("long")))
    marked = words.withColumn("long", F.array_remove(long, F.lit(0).cast("long")))
    telling = F.when(F.size("long") < 3, F.transform("words", lambda w: F.xxhash64(w))).otherwise(F.col("long"))
    hashes = F.sort_array(F.array_distinct(telling))
    spelled = marked.select("id", "line", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit("second"), "words").alias("h2"), hashes.alias("s")).withColumn("n", F.size("s"))
    every = F.aggregate("s", F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(h))
    fewer = _classes(F.ceil(F.col("n") * SIMILARITY))
    levels = spelled.select("*", _classes(F.col("n")).alias("mode"), fewer.alias("fewer"), F.when(fewer < 0, every).alias("whole"))
    # the hashes after a 0 for the line itself, and once more where a line has both blocks of classes and all words but one
    places = F.concat(F.array(F.lit(0).cast("long")), F.col("s"), F.when((F.col("mode") >= 0) & (F.col("fewer") < 0), F.col("s")).otherwise(F.array().cast("array<long>")))
    # no array here is empty: the outer form of explode keeps Spark from computing them once more to filter by their size
    each = levels.select("*", F.posexplode_outer(places).alias("at", "x"))
    a, (b, c, d) = F.col("x"), (F.get("s", F.col("at") + i) for i in range(3))  # s counts from 0, at from 1
    before = F.get("s", F.col("at") - 2)

    def opens(mode: Column) -> Column:
        """The word is the first of a class that has four."""
        return ((F.col("at") == 1) | (_class(before, mode) != _class(a, mode))) & (_class(d, mode) == _class(a, mode))

    simhash = a.bitwiseAND(b).bitwiseAND(c.bitwiseOR(d)).bitwiseOR(c.bitwiseAND(d).bitwiseAND(a.bitwiseOR(b)))  # bits of more than half
    key = (
        F.when(F.col("at") == 0, F.col("whole"))
        .when((F.col("mode") < 0) | (F.col("at") > F.col("n")), F.when(F.col("n") > 2, F.col("whole").bitwiseXOR(a)))
        .when(opens(F.col("mode")) | ((F.col("fewer") >= 0) & (F.col("fewer") != F.col("mode")) & opens(F.col("fewer"))), simhash)
    )
    own = [F.when(F.col("at") == 0, F.col(c)).alias(c) for c in ("id", "line", "h2")]
    return each.select(*own, "h1", "at", key.alias("key")).where("at = 0 or key is not null").drop("at")


def _class(h: Column, mode: Column) -> Column:
    """The class of a hash: its first bits, as many as `mode` says."""
    return F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", h, F.lit(1)), 63 - mode)


def _looked_up(rows: DataFrame) -> DataFrame:
    """The smaller, hashed side of a join, so that neither texts nor keys of all lines are sorted for it."""
    return rows.hint("shuffle_hash")


def candidates(keyed: DataFrame, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of lines with a block in common, and the members (key, node) of crowded buckets.

    keyed: key, node, with repeats. A bucket of more than `bucket` lines is crowded and gives the pairs with its first line
    only: its other pairs are compared where these links leave it in several groups.
    """
    found = settled(keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("n")).where("first <> last"))
    tidy(keyed.sparkSession)
    members = settled(keyed.join(_looked_up(found.where("n > 2").select("key", "first")), "key").distinct())
    full = members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("key")
    many = settled(members.join(full, "key", "left_semi"))
    few = members.join(full, "key", "left_anti")
    left, right = few.select("key", F.col("node").alias("a")), few.select("key", F.col("node").alias("b"))
    pairs = [
        found.where("n = 2").select(F.col("first").alias("a"), F.col("last").alias("b")),
        left.join(right, "key").where("a < b").select("a", "b"),
        many.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")),
    ]
    return settled(reduce(DataFrame.unionByName, pairs).distinct()), many.select("key", "node")


def spelled_lines(nodes: DataFrame, place: DataFrame, docs: DataFrame, line: Column) -> DataFrame:
    """node, letters (one for each word), norm (the words of a line with at most FEW_WORDS, else null) of the distinct nodes.

    place: node, id, first (where to find its text; `line` gives the line from first); docs: id, text. Only the lines in question leave their documents.
    """
    wanted = place.join(_looked_up(nodes), "node").select("node", "id", line.alias("line")).groupBy("id").agg(F.collect_list(F.struct("line", "node")).alias("want"))
    found = docs.join(_looked_up(wanted), "id").select(F.split("text", "\n").alias("all"), F.explode("want").alias("w"))
    words = found.select(F.col("w.node").alias("node"), line_words(F.get("all", F.col("w.line"))).alias("words"))
    short = F.when(F.size("words") <= FEW_WORDS, F.array_join("words", " "))
    return words.select("node", word_letters(F.col("words")).alias("letters"), short.alias("norm")).dropDuplicates(["node"])


def _allowed(longer: Column, similarity: float) -> Column:
    """Edits that lines may have of which the longer has so many words or characters."""
    return F.floor(longer * (1 - similarity) + 1e-9).cast("int")


def word_facts(text: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """node, n (words), size (characters, of a short line), bits, telling: what lines of the similarity in words have in common.

    text: spelled_lines of the nodes. The k-th occurrence of a word is an element. bits (of 512) say whether an odd number of
    elements falls to each, so lines differ in as many elements as bits, at least. telling are the rarest elements of a line, one
    more than a line of the similarity can lack: two such lines share a telling element. How rare they are is counted by slots of their hashes;
    any order that is the same for all lines would do.
    """
    sized = text.select("node", F.length("letters").alias("n"), F.length("norm").alias("size"), F.explode(F.split("letters", "")).alias("word"))
    times = sized.groupBy("node", "n", "size", "word").agg(F.count("*").alias("times"))
    each = times.select("node", "n", "size", F.explode(F.transform(F.sequence(F.lit(1), F.col("times").cast("int")), lambda k: F.xxhash64("word", k))).alias("h"))
    each = settled(each)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(63).cast("int"))
    part = F.shiftright("h", 6).bitwiseAND(7)
    bits = F.array(*(F.bit_xor(F.when(part == i, bit).otherwise(F.lit(0).cast("long"))) for i in range(8)))
    slot = F.col("h").bitwiseAND(SLOTS - 1).cast("int")
    held = each.groupBy(slot.alias("slot")).agg(F.least(F.lit(255), F.floor(8 * F.log2(F.count("*")))).cast("int").alias("level")).toArrow()
    levels = bytearray(SLOTS)
    for at, level in zip(held.column("slot").to_pylist(), held.column("level").to_pylist(), strict=True):
        levels[at] = level
    rarity = F.substring(F.lit(levels), slot + 1, F.lit(1))
    facts = each.groupBy("node", "n", "size").agg(bits.alias("bits"), F.sort_array(F.collect_list(F.struct(rarity.alias("held"), "h"))).alias("order"))
    return facts.select("node", "n", "size", "bits", F.slice(F.col("order.h"), F.lit(1), _allowed(F.col("n"), similarity) + 1).alias("telling"))


def _fits(similarity: float) -> Column:
    """Lines with n, bits of the suffixes a and b can have the similarity in words: of two lines one has (bits + difference of
    n) / 2 elements that the other lacks, and each is an edit."""
    apart = sum(F.bit_count(F.get("bitsa", F.lit(i)).bitwiseXOR(F.get("bitsb", F.lit(i)))) for i in range(8))
    fewer = F.abs(F.col("na") - F.col("nb"))
    allowed = _allowed(F.greatest("na", "nb"), similarity)
    return (fewer <= allowed) & (apart + fewer <= 2 * allowed)


def _telling(rest: DataFrame, facts: DataFrame) -> DataFrame:
    """at (a telling element), node, component, keys (its crowded buckets), n, bits."""
    held = rest.groupBy("node", "component").agg(F.collect_set("key").alias("keys"))
    return settled(held.join(facts, "node").select(F.explode("telling").alias("at"), "node", "component", "keys", "n", "bits"))


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    left, right = (rows.select("at", *(F.col(c).alias(c + x) for c in ("node", "component", "keys", "n", "bits"))) for x in "ab")
    return left, right


def led_pairs(known: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of lines with the first and the last line that share a telling element and a bucket with them, in other groups. known: as _telling gives it."""
    leaders = known.groupBy("at").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("at", F.explode(F.array("x", "y")).alias("node"))
    left, right = _sides(known.join(leaders, ["at", "node"]))[0], _sides(known)[1]
    return _met(left, right, F.col("componenta") != F.col("componentb"), similarity)


def all_pairs(known: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """All pairs (a, b) of lines that share a telling element and a bucket, in different groups. known: as _telling gives it."""
    left, right = _sides(known)
    return _met(left, right, F.col("componenta") < F.col("componentb"), similarity)


def _met(left: DataFrame, right: DataFrame, apart: Column, similarity: float) -> DataFrame:
    met = left.join(right, (left["at"] == right["at"]) & apart & _fits(similarity) & F.arrays_overlap("keysa", "keysb"))
    return settled(met.select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")).distinct())


def short_pairs(rest: DataFrame, facts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of short lines in different groups of a bucket whose lengths allow the similarity in characters."""
    known = rest.join(facts.where("n <= %d" % FEW_WORDS).select("node", "size"), "node")
    left, right = (known.select("key", *(F.col(c).alias(c + x) for c in ("node", "component", "size"))) for x in "ab")
    near = F.abs(F.col("sizea") - F.col("sizeb")) <= _allowed(F.greatest("sizea", "sizeb"), similarity)
    met = left.join(right, (left["key"] == right["key"]) & (F.col("componenta") < F.col("componentb")) & near)
    return met.select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")).distinct()


def verify(pairs: DataFrame, text: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose lines have the edit similarity.

    text: spelled_lines of the nodes. Edits of long lines are counted only where few enough words are in the longer one
    alone: every such word is an edit at least.
    """
    one, two = (text.select(F.col("node").alias(x), F.col("letters").alias(f"l{x}"), F.col("norm").alias(f"n{x}")) for x in "ab")

    def close(x: str, y: str, bound: Column = F.lit(True)) -> Column:
        longer = F.greatest(F.length(x), F.length(y))
        allowed = _allowed(longer, similarity)
        near = F.call_function("levenshtein", F.col(x), F.col(y), allowed) >= 0  # -1: more edits than allowed
        return F.when((longer - F.least(F.length(x), F.length(y)) <= allowed) & bound, near).otherwise(F.lit(False))

    def pieces(x: str, y: str) -> Column:
        """Edits of a long line piece by piece are enough to tell that there are few; they may be more than those of the whole."""
        longer = F.greatest(F.length(x), F.length(y))
        step = F.floor(longer / PIECES).cast("int") + 1
        each = (F.levenshtein(*(F.substring(F.col(c), step * k + 1, step) for c in (x, y))) for k in range(PIECES))
        return F.when(longer > COUNTED, sum(each) <= _allowed(longer, similarity)).otherwise(F.lit(False))

    def alone(x: str, y: str) -> Column:
        more = F.length(x) >= F.length(y)
        longer, other = F.when(more, F.col(x)).otherwise(F.col(y)), F.when(more, F.col(y)).otherwise(F.col(x))
        return (F.length(longer) <= COUNTED) | (F.size(F.array_except(F.split(longer, ""), F.split(other, ""))) <= _allowed(F.length(longer), similarity))

    return settled(pairs.join(one, "a").join(two, "b").where(pieces("la", "lb") | close("la", "lb", alone("la", "lb")) | F.coalesce(close("na", "nb"), F.lit(False))).select("a", "b"))


def regrouped(groups: DataFrame, links: DataFrame) -> DataFrame:
    """groups (node, component) joined by links (a, b) of their lines or of lines without a group."""
    ends = links
    for x in "ab":
        of = groups.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
        ends = ends.join(of, x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
    joined = settled(connected(ends, "ca", "cb"))
    single = joined.select("node", F.col("node").alias("component")).join(groups, "node", "left_anti")
    new = joined.select(F.col("node").alias("component"), F.col("component").alias("new"))
    return settled(groups.unionByName(single).join(new, "component", "left").select("node", F.coalesce("new", "component").alias("component")))


def open_members(crowded: DataFrame, groups: DataFrame) -> DataFrame:
    """key, node, component of the crowded buckets whose lines aren't all in one group."""
    placed = crowded.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keys = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    return settled(placed.join(keys, "key").select("key", "node", "component"))


def sorted_out(crowded: DataFrame, groups: DataFrame, text: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """groups after all lines of crowded buckets that are in different groups are compared, but for pairs that can't have the
    similarity. Groups are joined by way of the leaders first, so that few lines of one group are left to be compared."""
    rest = open_members(crowded, groups)
    if rest.isEmpty():
        return groups
    facts = settled(word_facts(text.join(rest.select("node").distinct(), "node"), similarity))

    groups = regrouped(groups, verify(led_pairs(_telling(rest, facts), similarity), text, similarity))
    rest = open_members(rest.select("key", "node"), groups)
    left = all_pairs(_telling(rest, facts), similarity).unionByName(short_pairs(rest, facts, similarity)).distinct()
    return regrouped(groups, verify(left, text, similarity))


def _occurrence(kind: T.DataType) -> tuple[Column, Column]:
    """id and line of a row as one value that is ordered as they are, and the line of such a value `first`.

    Whole numbers make one number, of which Spark hashes minima; it sorts rows for those of a struct.
    """
    if not isinstance(kind, T.IntegralType):
        return F.struct("id", "line"), F.col("first.line")
    lines = F.lit(Decimal(1 << 32))
    return F.col("id").cast("decimal(20,0)") * lines + F.col("line"), F.pmod("first", lines).cast("int")


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The lines to drop: id, drop (array of line numbers from 0). docs: id, text."""
    spark = docs.sparkSession
    table, path = stored(keyed_lines(docs), dictionary=False)
    seen = settled(table.where("id is not null").select("id", "line", "h1", "h2"))
    at, line = _occurrence(docs.schema["id"].dataType)
    exact = seen.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.min("id").alias("id"), F.count("*").alias("n"))
    lines = settled(exact.select(F.col("h1").alias("node"), "h2", "first", "id", "n"))
    pairs, crowded = candidates(table.where("key is not null").select("key", F.col("h1").alias("node")))
    discard(spark, path)
    tidy(spark)
    place = lines.select("node", "id", "first")
    text, path = stored(spelled_lines(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), place, docs, line))
    groups = settled(connected(verify(pairs, text, similarity), "a", "b"))
    tidy(spark)
    groups = sorted_out(crowded, groups, text, similarity)
    discard(spark, path)
    members = lines.select("node", "first").join(_looked_up(groups), "node")
    kept = members.groupBy("component").agg(F.min_by("node", "first").alias("node")).select("node")
    lost = groups.select("node").join(kept, "node", "left_anti").withColumn("lost", F.lit(True))
    judged = lines.join(_looked_up(lost), "node", "left").where("n > 1 or lost").select(F.col("node").alias("h1"), "h2", "first", "lost")
    dropped = seen.join(_looked_up(judged), ["h1", "h2"]).where(F.col("lost").isNotNull() | (at != F.col("first")))
    drop = settled(dropped.groupBy("id").agg(F.collect_set("line").alias("drop")))
    tidy(spark)
    return drop


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with the first occurrence of each group of like lines only: id, text, n_lines, n_dropped.

    The first occurrence is that with the smallest (id, line number). Lines end at \\n; blank lines are never dropped.
    A null text stays null with 0 lines; rows without an id stay as they are; rows with the same id are one document
    and keep or lose their lines alike. Texts and lines of any length go whole through all steps. An empty table gives an
    empty one; other columns are ignored.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lines = F.split("text", "\n")
    cut = plain.join(_looked_up(repeated_lines(plain, similarity)), "id", "left").select("id", "text", lines.alias("all"), "drop")
    keep = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("drop"))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(keep, lambda i: F.get("all", i)), "\n"))
    return cut.select(
        F.col("id").alias(id_col), text.alias(text_col), F.coalesce(F.size("all"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped")
    )


def keep_first_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with their columns, repeated lines cut out of the text; documents that lose all their words go.

    Nulls, repeated ids, long texts, ties and empty tables are as in dedup_lines.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), F.col(id_col).alias("id"))
    text = F.col(names[text_col])
    cut = renamed.join(_looked_up(repeated_lines(plain, similarity)), "id", "left").withColumn("lines", F.split(text, "\n"))
    told = F.size(F.filter("lines", lambda line: line.rlike(r"\S")))
    left = cut.where(F.col("drop").isNull() | (told > F.size("drop")))
    keep = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    new = F.when(F.col("drop").isNull(), text).otherwise(F.array_join(F.transform(keep, lambda i: F.get("lines", i)), "\n"))
    return left.select(*((new if c == text_col else F.col(n)).alias(c) for c, n in names.items()))
