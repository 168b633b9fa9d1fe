"""URL filter: the ratio of two character language models, calibrated on URLs that rules decide.

Rules label URLs. Each label trains a variable-order Markov model over the characters of host and path: counts of
every order from 0 to ORDER over all labelled URLs, kept exactly, smoothed by handing each order's mass down to the next shorter
context. URLs without a rule are judged by the difference of the two log-likelihoods per character, against a
threshold that is calibrated on a fold of the labelled URLs that the models did not see.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusmill.llm.batches import map_rows, settled

ORDER = 4
#: Weight of the shorter context when a longer one is consulted.
WEIGHT = 2.0
#: Characters of the models: a-z, one digit class, -._~/%?=& and one class for all others, with a mark for the ends.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0-._~/%?=&*"
#: Bins of the calibration histogram, and the range of scores that they cover.
BINS, RANGE = 2000, 10.0
#: Fixed values: (action, host suffix, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty for null or without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits a host and path, as text and action; null if none fits."""
    rule = action = None
    for act, suffix, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        name, does = F.lit(suffix + prefix), F.lit(act)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        action = F.when(fits, does) if action is None else action.when(fits, does)
    return rule, action


def codes(url: str) -> np.ndarray:
    """Character classes of a URL, after ORDER marks for its start and before one for its end."""
    raw = np.frombuffer(url.lower().encode("ascii", "replace"), np.uint8)
    return np.concatenate([np.zeros(ORDER, np.int64), _CLASS[raw], np.zeros(1, np.int64)])


def _classes() -> np.ndarray:
    table = np.full(256, len(ALPHABET), np.int64)
    for i, c in enumerate(ALPHABET):
        table[ord(c)] = i + 1
    table[48:58] = table[48]
    return table


_CLASS = _classes()
SYMBOLS = len(ALPHABET) + 1


def grams(url: str) -> list[int]:
    """For each character to predict the number that its context of ORDER characters and itself spell, exactly."""
    code = codes(url)
    n = len(code) - ORDER
    number = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        number = number * SYMBOLS + code[k : k + n]
    return number.tolist()


def train(labelled: DataFrame) -> DataFrame | None:
    """Exact counts over all labelled URLs (columns action, grams): gram, allow, block; None unless both labels occur.

    One row for each distinct context of ORDER characters with its character, however many there are; none leaves Spark.
    """
    each = labelled.select((F.col("action") == "allow").cast("long").alias("allow"), F.explode("grams").alias("gram"))
    counts = settled(each.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum(1 - F.col("allow")).alias("block")))
    allow, block = counts.agg(F.max("allow"), F.max("block")).first()
    return counts if allow and block else None


def log_ratios(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """Difference of the log-probabilities that the two models give to a character after its context: gram, ratio.

    asked: gram, distinct. Each order's counts are sums of those of the longest; the longer context is smoothed by the shorter.
    """
    out = asked.select("gram", *(F.lit(1.0 / SYMBOLS).alias(f"p_{m}") for m in ("allow", "block")))
    for k in range(ORDER + 1):
        gram = F.col("gram") % SYMBOLS ** (k + 1)
        context = F.floor(gram / SYMBOLS).cast("long")
        seen = counts.groupBy(gram.alias("_g")).agg(F.sum("allow").alias("g_allow"), F.sum("block").alias("g_block"))
        before = counts.groupBy(context.alias("_c")).agg(F.sum("allow").alias("c_allow"), F.sum("block").alias("c_block"))
        joined = out.withColumns({"_g": gram, "_c": context}).join(seen, "_g", "left").join(before, "_c", "left").fillna(0)
        out = joined.select("gram", *(((F.col(f"g_{m}") + WEIGHT * F.col(f"p_{m}")) / (F.col(f"c_{m}") + WEIGHT)).alias(f"p_{m}") for m in ("allow", "block")))
    return out.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def scores(spelled: DataFrame, counts: DataFrame) -> DataFrame:
    """Difference of the log-likelihoods per character: h1, h2, score. spelled: h1, h2 (of a distinct URL), grams.

    Grams that most URLs have make hot keys of the last join; Spark splits them.
    """
    each = spelled.select("h1", "h2", F.explode("grams").alias("gram"))
    ratios = settled(log_ratios(each.select("gram").distinct(), counts))
    return each.join(ratios, "gram").groupBy("h1", "h2").agg(F.avg("ratio").alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score that separates best, from a histogram of all calibrating URLs (columns action, score).

    Both labels count alike. Of equally good thresholds the middle one is taken; 0 without calibrating URLs of both.
    """
    bin_of = F.least(F.greatest(F.floor((F.col("score") + RANGE) / (2 * RANGE) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    rows = scored.groupBy("action", bin_of.alias("bin")).count().collect()
    allow, block = np.zeros(BINS), np.zeros(BINS)
    for action, at, n in rows:
        (allow if action == "allow" else block)[at] += n
    if not allow.any() or not block.any():
        return 0.0
    right = np.append(0, np.cumsum(block / block.sum())) + np.append(np.cumsum((allow / allow.sum())[::-1])[::-1], 0)
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(best[len(best) // 2] / BINS * 2 * RANGE - RANGE)


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, rule and verdict of each URL: id, host, path, rule, verdict, score.

    verdict: the rule's action, or else allow if the score reaches the calibrated threshold and block below it.
    score: difference of the log-likelihoods per character. A null URL or one without :// has empty host and path
    and is judged by the models as an empty string. Where the table does not hold URLs of both actions there is no
    model: the score is 0 and URLs without a rule are allowed. Equal scores have equal verdicts, repeated rows give
    repeated results, an empty table none; URLs of any length are taken whole; other columns are ignored, whatever their names.
    """
    urls = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    parts = urls.select("_id", host.alias("host"), path.alias("path"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("_id", "host", "path", rule.alias("rule"), action.alias("action"), F.concat("host", "path").alias("full"))
    named = ruled.select("*", F.xxhash64("full").alias("h1"), F.xxhash64(F.lit("second"), "full").alias("h2"), (F.pmod(F.crc32("full"), F.lit(4)) == 0).alias("calibrating"))
    spelled = settled(map_rows(named.dropDuplicates(["h1", "h2"]), ["h1", "h2", "full"], 2, [T.StructField("grams", T.ArrayType(T.LongType()))], lambda: lambda texts: [[grams(t) for t in texts]]))
    pair = train(named.where(F.col("action").isNotNull() & ~F.col("calibrating")).select("action", "h1", "h2").join(spelled, ["h1", "h2"]))
    if pair is None:
        return ruled.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("action", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    scored = settled(named.join(scores(spelled, pair), ["h1", "h2"]))
    limit = threshold(scored.where(F.col("calibrating") & F.col("action").isNotNull()).select("action", "score"))
    verdict = F.coalesce("action", F.when(F.col("score") >= limit, "allow").otherwise("block"))
    return scored.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
