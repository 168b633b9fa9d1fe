"""What the two byte-pair encoders read from a tokenizer file."""

from __future__ import annotations

import json
from functools import lru_cache

from pyspark.sql import SparkSession


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def read_on_driver(spark: SparkSession, path: str):
    """Broadcast the text of a vocabulary file: a fixed file of a few MB, whatever the corpus holds."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


@lru_cache(maxsize=2)
def parse(text: str) -> dict:
    """vocab, merges as pairs, and special strings with their ids, longest first."""
    spec = json.loads(text)
    model = spec["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    special = {x["content"]: x["id"] for x in spec["added_tokens"] if x["special"]}
    return {"vocab": model["vocab"], "merges": merges, "special": dict(sorted(special.items(), key=lambda x: -len(x[0])))}
