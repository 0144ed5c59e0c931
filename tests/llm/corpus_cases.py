"""Small corpora with the awkward rows every operator must stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns with names that the operators use inside.
CLASHES = ("text_hash", "node", "n", "t", "key", "a", "b", "count", "digest", "size", "label", "kind",
           "copies", "start", "end", "word", "host", "rule", "score", "class", "component", "start_", "h", "wid")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple], clashes: bool = True) -> DataFrame:
    """rows: (doc_id, text, lang, source)."""
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOC_SCHEMA)
    if clashes:
        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def as_set(df: DataFrame, *columns: str) -> list[tuple]:
    """All rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def components(nodes: list[int], edges: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest reachable node of each, by plain relaxation."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root
