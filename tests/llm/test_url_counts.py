import math
import zlib
from collections import Counter

import pytest

from corpusmill.llm import url_markov

DIR = "/root/testdata/sf0.001"


def test_scores_from_exact_counts(spark):
    """Contexts never share a count: scores are those of counts in dictionaries."""
    pages = spark.read.parquet(f"{DIR}/pages.parquet").select("page_id", "url")
    pages = pages.unionByName(spark.createDataFrame([(-1, None), (-2, "no scheme"), (-3, "http://é.example/" + "q" * 3000)], "page_id long, url string"))
    rows = url_markov.judge(pages).collect()
    grams, contexts = (Counter() for _ in range(2))
    for r in rows:
        full = r.host + r.path
        if r.rule and zlib.crc32(full.encode()) % 4:
            code = url_markov.codes(full).tolist()
            for at in range(url_markov.ORDER, len(code)):
                for k in range(url_markov.ORDER + 1):
                    grams[r.verdict, tuple(code[at - k : at + 1])] += 1
                    contexts[r.verdict, k, tuple(code[at - k : at])] += 1
    for r in rows:
        code, logs = url_markov.codes(r.host + r.path).tolist(), {}
        for m in ("allow", "block"):
            logs[m] = 0
            for at in range(url_markov.ORDER, len(code)):
                p = 1 / url_markov.SYMBOLS
                for k in range(url_markov.ORDER + 1):
                    p = (grams[m, tuple(code[at - k : at + 1])] + url_markov.WEIGHT * p) / (contexts[m, k, tuple(code[at - k : at])] + url_markov.WEIGHT)
                logs[m] += math.log(p)
        assert r.score == pytest.approx((logs["allow"] - logs["block"]) / (len(code) - url_markov.ORDER), abs=1e-9)
