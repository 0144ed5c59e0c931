"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised and projected on Gaussian directions; a table's key is
the quantised value of several projections, and vectors that share a key in
any table are compared exactly by cosine. Equal vectors are one class and are
never expanded into pairs; a bucket is cut into blocks, and each pair of blocks
is compared in its own group, so no task holds a whole hot bucket. A pair that
meets in several tables counts only in the first of them, so links are counted
without writing the pairs down.

At cosine 0.98 the distance on the sphere is 0.2: with width 1.6 one projection
agrees with probability 0.90, twelve with 0.28, and a pair is missed by all 48
tables with probability 1.4e-7; above the threshold the odds only fall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import require, stage
from stratus.llm.components import connected_components

MIN_COSINE = 0.98
TABLES, PROJECTIONS, WIDTH = 48, 12, 1.6
#: Classes compared in one group: two blocks of so many.
BLOCK = 512


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows brought to components of at most 1 by powers of two: squares neither overflow
    nor vanish, and cosines keep every bit."""
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1))[1][:, None])


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = _scaled(matrix)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]


def _keys(dim: int, seed: int, tables: int, projections: int, width: float):
    """Function from unit vectors to (n, tables) bucket keys of 32 bits. (Cells
    that share a key by chance are one bucket more to compare, nothing else.)"""
    rng = np.random.default_rng([seed, dim])
    directions = rng.standard_normal((dim, tables * projections))
    offsets = rng.uniform(0, width, tables * projections)
    mix = rng.integers(1, 2 ** 63 - 1, projections, dtype=np.int64) | 1

    def keys(unit):
        cells = np.floor((unit @ directions + offsets) / width).astype(np.int64)
        with np.errstate(over="ignore"):
            return ((cells.reshape(len(unit), tables, projections) * mix).sum(axis=2) >> 32).astype(np.int32)
    return keys


def _hasher(seed, tables, projections, width):
    def run(batches):
        made = {}
        for pdf in batches:
            pdf = pdf.assign(dim=pdf["v"].map(len))
            for dim, part in pdf.groupby("dim"):
                if dim not in made:
                    made[dim] = _keys(dim, seed, tables, projections, width)
                keys = made[dim](_unit(np.vstack(part["v"].to_numpy()).astype(np.float64)))
                yield part.drop(columns="dim").assign(keys=list(keys))
    return run


def _linked(part: pd.DataFrame, starts: np.ndarray, min_cosine: float) -> pd.DataFrame:
    """Links within the groups of ``part`` (rows of one dimension), counted where a pair first meets."""
    v = _scaled(np.vstack(part["v"].to_numpy()).astype(np.float64))
    unit, keys = _unit(v), np.vstack(part["keys"].to_numpy())
    side, whole = part["side"].to_numpy(), (part["lo"] == part["hi"]).to_numpy()
    first, second = [], []
    for a, b in zip(starts, [*starts[1:], len(part)]):
        i = np.arange(a, b)
        left, right = (i, i) if whole[a] else (i[side[a:b] == 0], i[side[a:b] == 1])
        near = unit[left] @ unit[right].T >= min_cosine - 1e-9
        x, y = np.nonzero(np.triu(near, 1) if whole[a] else near)
        first.append(left[x])
        second.append(right[y])
    i, j = np.concatenate(first), np.concatenate(second)
    # the exact cosine of the few that are left, in the first table that has both
    norm = np.sqrt((v * v).sum(axis=1))
    cosine = (v[i] * v[j]).sum(axis=1) / (norm[i] * norm[j])
    keep = (cosine >= min_cosine) & ((keys[i] == keys[j]).argmax(axis=1) == part["t"].to_numpy()[i])
    i, j = i[keep], j[keep]
    ids, n = part["class"].to_numpy(), part["n"].to_numpy()
    ends, counts = np.concatenate([ids[i], ids[j]]), np.concatenate([n[j], n[i]])
    seen, at = np.unique(ends, return_inverse=True)
    rows = [(int(x), int(c), False, 0) for x, c in zip(seen, np.bincount(at, counts, len(seen)))]
    root: dict[int, int] = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for x, y in zip(ids[i].tolist(), ids[j].tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:  # a spanning forest of these links is enough for components
            root[max(rx, ry)] = min(rx, ry)
            rows.append((x, 0, True, y))
    return pd.DataFrame(rows, columns=["class", "links", "edge", "other"])


_GROUP = ["dim", "label", "t", "key", "lo", "hi"]


def _compare(min_cosine: float):
    """Over rows sorted by group: what :func:`_linked` finds. Holds a batch and one group."""
    def done(pdf: pd.DataFrame, starts: np.ndarray) -> Iterator[pd.DataFrame]:
        for dim in pdf["dim"].unique():
            rows = np.flatnonzero((pdf["dim"] == dim).to_numpy())
            own = starts[(starts >= rows[0]) & (starts <= rows[-1])] - rows[0]
            yield _linked(pdf.iloc[rows], own, min_cosine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            change = (held[_GROUP] != held[_GROUP].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(change)
            if len(starts) > 1:
                yield from done(held.iloc[:starts[-1]], starts[:-1])
                held = held.iloc[starts[-1]:].reset_index(drop=True)
        if held is not None and len(held):
            yield from done(held, np.array([0]))
    return run


def link(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding",
         label_column: str = "label", min_cosine: float = MIN_COSINE, tables: int = TABLES,
         projections: int = PROJECTIONS, width: float = WIDTH, block: int = BLOCK,
         seed: int = 11) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Vectors with a null label, that are null, zero or empty or hold a null or a
    value that is not finite, link with nothing and stay; so do vectors of
    different lengths or labels. Rows that repeat an id count as vectors of
    their own. A null id gets a null component.
    """
    require(vectors, id_column, vector_column, label_column)
    # Single-precision vectors stay so on disk and in shuffles; all arithmetic is in double precision.
    kind = "array<float>" if dict(vectors.dtypes)[vector_column] == "array<float>" else "array<double>"
    v = F.col(vector_column).cast(kind)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                          F.col(label_column).cast("string").alias("label"), v.alias("v"))
    sound = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("v") > 0)
                       & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists("v", lambda x: x != 0.0), F.lit(False))
    # -0.0 becomes 0.0, so that equal vectors are equal keys.
    rows = stage(rows.withColumn("sound", sound)
                 .withColumn("v", F.when(F.col("sound"), F.transform("v", lambda x: x + F.lit(0.0).cast("float" if kind == "array<float>" else "double")))), "vectors")
    members = rows.where("sound")
    classes = stage(members.groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
                    .withColumn("class", F.xxhash64("label", "v")),
                    "vector-classes")
    keyed = stage(classes.select("label", "v", "class", "n").mapInPandas(
        _hasher(seed, tables, projections, width),
        f"label string, v {kind}, class long, n long, keys array<int>"),
                  "vector-keys")
    buckets = stage(keyed.select("label", "class", F.size("v").alias("dim"), F.posexplode("keys").alias("t", "key")),
                    "vector-buckets")
    sizes = (buckets.groupBy("label", "dim", "t", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
             .withColumn("blocks", F.ceil(F.col("m") / F.lit(block))))
    sizes = stage(sizes, "vector-bucket-sizes")
    met = buckets.join(sizes, ["label", "dim", "t", "key"]).withColumn(
        "own", F.pmod(F.xxhash64("class", F.lit(seed)), F.col("blocks")))
    # Each member goes to the groups of its block with every block of the bucket.
    met = met.withColumn("with", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "t", "key", "label", "dim", "class", F.least("own", "with").alias("lo"),
        F.greatest("own", "with").alias("hi"), (F.col("own") > F.col("with")).cast("int").alias("side"))
    met = met.join(keyed.select("class", "v", "n", "keys"), "class").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    found = met.mapInPandas(_compare(min_cosine), "class long, links long, edge boolean, other long")
    found = stage(found, "vector-links")
    links = found.where("not edge").groupBy("class").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("edge").select(F.col("class").alias("a"), F.col("other").alias("b")))
    by_class = stage(classes.join(links, "class", "left")
                     .join(component, classes["class"] == component["node"], "left")
                     .select("label", "v", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                             F.coalesce("component", "class").alias("root")), "vector-roots")
    least = stage(by_class.groupBy("root").agg(F.min("first").alias("component_id")), "vector-least")
    by_class = stage(by_class.join(least, "root").select("label", "v", "n_links", "component_id"),
                     "vector-result").withColumnsRenamed({"label": "l", "v": "w"})
    return (rows.join(by_class, (rows["label"] == by_class["l"]) & (rows["v"] == by_class["w"]) & rows["sound"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))


ORACLE = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.r AS a, b.r AS b, a.vec_id AS ia, b.vec_id AS ib FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r
    AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT DISTINCT ia, ib FROM p UNION SELECT reach.x, p.ib FROM reach JOIN p ON reach.y = p.ia),
c AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.y, e.vec_id)) AS component_id,
    e.vec_id = least(e.vec_id, coalesce(c.y, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN v ON v.vec_id = e.vec_id LEFT JOIN n ON n.a = v.r LEFT JOIN c ON c.x = e.vec_id
"""
