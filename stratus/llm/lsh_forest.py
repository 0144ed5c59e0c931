"""Near-duplicates by an LSH forest over MinHash signatures.

A document's set holds its distinct word shingles. Documents with equal sets
form a class and are handled once. Each of the forest's trees orders the
classes by its own sequence of MinHash values; classes that share a tree's
first ``DEPTH`` values form a region. Candidates come in three turns, each
confirmed on the full sets, and each looking only at classes that are not yet
connected:

1. every class with the neighbour of longest common prefix over all trees (the
   depth adapts to how dense the region is);
2. all neighbours in any tree;
3. what is left of each region: the pairs between its components, compared in
   blocks; only as many links are written as join components.

So every pair that shares a region is confirmed, or already connected. A pair
of similarity 0.8 shares a region in one tree with probability 0.41 and in none
of 32 with probability 5e-8. Before a pair is confirmed, its whole signatures
must agree in 77 of 128 places; at similarity 0.8 they fail to with
probability below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import bounded, require, stage
from stratus.llm.components import connected_components

TREES, DEPTH = 32, 4
HASHES = TREES * DEPTH
MIN_AGREE = 77
SHINGLE, MIN_PERCENT = 5, 80
CHUNK_BYTES = 2_000_000
#: Classes of one component that meet another's in one group.
BLOCK = 512

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(101)
_WORD_FACTORS = _RNG.integers(1, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RNG.integers(1, 2 ** 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RNG.integers(0, 2 ** 63, HASHES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word shingles.

    Words are runs of bytes other than blank and TAB..CR, A-Z lower-cased. A
    text of fewer words has one shingle, one of none an empty set. A word's hash
    is a difference of two prefix sums over the whole buffer, brought to the
    same power; no loop runs over words.
    """
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    white = _WHITE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], white]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
        (data.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(data)), dtype=np.uint64)])
    word = _mix((prefix[end] - prefix[start]) * _powers(_P_INVERSE, len(data) + 1)[start])
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(start, bounds)
    if len(word) >= k:
        n = len(word) - k + 1
        rolled = sum((word[j:j + n] * _WORD_FACTORS[j] for j in range(k)), np.zeros(n, np.uint64))
        rolled = _mix(rolled)
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            sets.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            own = (word[a:b] * _WORD_FACTORS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(_mix(np.array([own], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, HASHES) MinHash values as int32; zeros for empty sets."""
    out = np.zeros((len(sets), HASHES), dtype=np.int32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        values = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0, *(len(sets[i]) for i in full[:-1])])
        for j in range(HASHES):
            least = np.minimum.reduceat(values * _FACTORS[j] + _OFFSETS[j], starts)
            out[full, j] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _chunks(texts: pd.Series) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes, CHUNK_BYTES at a time or one longer text, with the number of the first."""
    held, size, at = [], 0, 0
    for i, t in enumerate(texts):
        b = b"" if t is None else t.encode("utf-8", "surrogatepass")
        if held and size + len(b) > CHUNK_BYTES:
            yield at, held
            held, size, at = [], 0, i
        held.append(b)
        size += len(b)
    if held:
        yield at, held


def _signer(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at, texts in _chunks(pdf["text"]):
                sets = shingle_sets(texts, k)
                part = pdf.iloc[at:at + len(texts)].drop(columns="text")
                digest = [np.array([len(s), s.sum(dtype=np.uint64), _mix(s).sum(dtype=np.uint64)], dtype=np.uint64) for s in sets]
                node = _mix((_mix(np.vstack(digest)) * _WORD_FACTORS[:3]).sum(axis=1, dtype=np.uint64)).view(np.int64)
                yield part.assign(n=[len(s) for s in sets], node=node, sig=list(signatures(sets)))
    return run


def _set_maker(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at, texts in _chunks(pdf["text"]):
                part = pdf.iloc[at:at + len(texts)]
                yield pd.DataFrame({"node": part["node"].to_numpy(), "items": [s.tobytes() for s in shingle_sets(texts, k)]})
    return run


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows sorted by (t, key, rest): those of regions with more than one
    row, each with its neighbour before and the length of their common prefix.

    A region cut by the end of the partition counts as having more rows.
    """
    last, first_key, begun = None, None, False
    for pdf in batches:
        if pdf.empty:
            continue
        held = pdf if last is None else pd.concat([last, pdf], ignore_index=True)
        t, key, node = held["t"].to_numpy(), held["key"].to_numpy(), held["node"].to_numpy()
        rest = np.vstack(held["rest"].to_numpy())
        same = np.concatenate([[False], (t[1:] == t[:-1]) & (key[1:] == key[:-1])])
        equal = np.concatenate([[[False] * rest.shape[1]], rest[1:] == rest[:-1]])
        lcp = DEPTH + np.cumprod(equal, axis=1).sum(axis=1)
        follows = np.concatenate([same[1:], [True]])
        if first_key is None:
            first_key = (t[0], key[0])
        edge = (t == first_key[0]) & (key == first_key[1])
        busy = same | follows | edge
        out = pd.DataFrame({"t": t, "key": key, "node": node, "prev": np.where(same, np.roll(node, 1), 0),
                            "lcp": np.where(same, lcp, 0)})
        # the row carried over was given out with the batch before
        yield out[busy].iloc[int(begun and busy[0]):]
        last, begun = held.iloc[-1:], True


def _confirm(min_percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = np.zeros(len(pdf), dtype=bool)
            for i, (x, y) in enumerate(zip(pdf["x"], pdf["y"])):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= min_percent * (len(x) + len(y) - both)
            yield pdf.loc[keep, ["a", "b"]]
    return run


_GROUP = ["t", "key", "left", "right"]


def _met(min_percent: int | None):
    """Over rows sorted by group: links between the components of each group.

    Two classes of different components whose signatures agree enough are
    alike; with ``min_percent`` they must also link on their full sets. Of
    these, as many are given out, as (a, b) of components, as join what the
    group holds: never more than it has components. Holds a batch and one group.
    """
    def linked(i: int, j: int, items) -> bool:
        if min_percent is None:
            return True
        x, y = (np.frombuffer(items[k], dtype=np.uint64) for k in (i, j))
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= min_percent * (len(x) + len(y) - both)

    def joined(held: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        sig, comp, side = np.vstack(held["sig"].to_numpy()), held["comp"].to_numpy(), held["side"].to_numpy()
        items = held["items"].to_numpy() if min_percent is not None else None
        out = []
        for a, b in zip(starts, [*starts[1:], len(held)]):
            root, right = {}, np.arange(a, b)[side[a:b] == 1]

            def find(x):
                while root.get(x, x) != x:
                    root[x] = root.get(root[x], root[x])
                    x = root[x]
                return x
            for i in range(a, b):
                if side[i] == 1:
                    continue
                # the other side; within one block, each pair once
                j = right if len(right) else np.arange(i + 1, b)
                j = j[comp[j] != comp[i]]
                for k in j[(sig[j] == sig[i]).sum(axis=1) >= MIN_AGREE] if len(j) else ():
                    one, two = find(int(comp[i])), find(int(comp[k]))
                    if one != two and linked(i, k, items):
                        root[max(one, two)] = min(one, two)
                        out.append((int(comp[i]), int(comp[k])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            starts = np.flatnonzero((held[_GROUP] != held[_GROUP].shift()).any(axis=1).to_numpy())
            if len(starts) > 1:
                yield joined(held.iloc[:starts[-1]], starts[:-1])
                held = held.iloc[starts[-1]:].reset_index(drop=True)
        if held is not None and len(held):
            yield joined(held, np.array([0]))
    return run


def _region_groups(members: DataFrame) -> DataFrame:
    """Rows (t, key, left, right, side, node, comp) of groups to compare.

    ``members`` (t, key, node, comp) of regions with several components. A
    region's largest component meets the others; the others meet among
    themselves; both are cut into blocks, and the largest never meets itself.
    """
    by = members.groupBy("t", "key", "comp").agg(F.count(F.lit(1)).alias("m"))
    region = by.groupBy("t", "key").agg(F.sum("m").alias("all"), F.max(F.struct("m", "comp")).alias("top"),
                                        F.count(F.lit(1)).alias("comps")).where("comps > 1")
    region = region.select("t", "key", F.col("top.comp").alias("top"),
                           F.ceil(F.col("top.m") / BLOCK).alias("wide"),
                           F.ceil((F.col("all") - F.col("top.m")) / BLOCK).alias("blocks"))
    m = members.join(stage(region, "forest-regions"), ["t", "key"]).withColumn("is_top", F.col("comp") == F.col("top"))
    own = F.when(F.col("is_top"), -1 - F.pmod(F.xxhash64("node"), F.col("wide"))).otherwise(
        F.pmod(F.xxhash64("node"), F.col("blocks")))
    # Blocks of the top are negative: -1, -2, ...; those of the others 0, 1, ...
    m = m.withColumn("own", own).withColumn("with", F.explode(F.expr(
        "if(is_top, sequence(0L, blocks - 1), concat(sequence(-wide, -1L), sequence(0L, blocks - 1)))")))
    return m.select("t", "key", F.least("own", "with").alias("left"), F.greatest("own", "with").alias("right"),
                    (F.col("own") > F.col("with")).cast("int").alias("side"), "node", "comp")


def link(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
         shingle: int = SHINGLE, min_percent: int = MIN_PERCENT) -> DataFrame:
    """One row per row: doc_id, text_hash, n_shingles, component_id, kept.

    Documents link when 100 * intersection >= min_percent * union of their sets;
    component_id is the smallest doc_id reachable. Null texts and texts without
    words have an empty set and link with nothing, nor do rows with a null id.
    Rows that repeat an id are documents of their own. Equal sets are found by
    a 64-bit digest.
    """
    require(docs, id_column, text_column)
    rows = docs.select(F.col(id_column).cast("long").isNull().alias("no_id"),
                       F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("doc_id"),
                       F.xxhash64(F.col(text_column)).alias("text_hash"), F.col(text_column).alias("text"))
    signed = stage(rows.mapInPandas(_signer(shingle), "no_id boolean, doc_id long, text_hash long, n long, "
                                                      "node long, sig array<int>"), "forest-signed")
    alive = signed.where("n > 0 and not no_id")
    classes = stage(alive.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.first("sig").alias("sig"))
                    .select("node", "rep.doc_id", "rep.text_hash", "sig"), "forest-classes")

    t = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t")
    forest = classes.select("node", "sig", t).select(
        "t", F.xxhash64(F.slice("sig", F.col("t") * DEPTH + 1, DEPTH)).alias("key"),
        F.slice("sig", F.pmod(F.col("t") + 1, F.lit(TREES)) * DEPTH + 1, DEPTH).alias("rest"), "node")
    order = ["t", "key", "rest", "node"]
    busy = stage(forest.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _walk, "t int, key long, node long, prev long, lcp int"), "forest-busy")

    # The sets of all classes that any candidate can name.
    wanted = stage(busy.select("node").distinct().join(classes.select("node", "doc_id", "text_hash"), "node"), "forest-wanted")
    wanted_key = bounded(wanted.select("node", F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash")))
    texts = rows.where("not no_id").join(wanted_key, (F.col("doc_id") == F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))
    sets = stage(texts.select("node", "text").mapInPandas(_set_maker(shingle), "node long, items binary")
                 , "forest-sets", "uncompressed")

    def with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        one = table.select(F.col("node").alias("a"), F.col(column).alias("x"))
        two = table.select(F.col("node").alias("b"), F.col(column).alias("y"))
        return pairs.join(one, "a").join(two, "b")

    def alike(pairs: DataFrame) -> DataFrame:
        agree = F.size(F.filter(F.zip_with("x", "y", lambda x, y: x == y), lambda e: e))
        return with_both(pairs, classes, "sig").where(agree >= MIN_AGREE).select("a", "b")

    # A row with a repeated id and text has its set twice; one is enough.
    one_set = sets.dropDuplicates(["node"]) if sets.count() > wanted.count() else sets

    def confirmed(pairs: DataFrame) -> DataFrame:
        return stage(with_both(stage(pairs, "forest-pairs"), one_set, "items")
                     .mapInPandas(_confirm(min_percent), "a long, b long"), "forest-links")

    def merged(found: DataFrame, links: DataFrame) -> DataFrame:
        """``found`` after links (a, b) between its components, or nodes it does
        not have; only what the links touch is walked again."""
        again = bounded(stage(connected_components(links), "forest-again")).withColumnsRenamed(
            {"node": "__old", "component": "__new"})
        moved = found.join(again, F.col("component") == F.col("__old"), "left").select(
            "node", F.coalesce("__new", "component").alias("component"))
        fresh = again.join(found, F.col("__old") == F.col("node"), "left_anti").select(
            F.col("__old").alias("node"), F.col("__new").alias("component"))
        return bounded(stage(moved.unionByName(fresh), "forest-components"))

    def component(nodes: DataFrame, found: DataFrame, column: str, name: str) -> DataFrame:
        c = found.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
        return nodes.join(c, F.col(column) == F.col("__n"), "left").withColumn(
            name, F.coalesce("__c", column)).drop("__n", "__c")

    near = busy.where("lcp > 0 and prev <> node")
    # 1. the neighbour of longest common prefix
    ways = near.select("node", F.col("prev").alias("other"), "lcp").unionByName(
        near.select(F.col("prev").alias("node"), F.col("node").alias("other"), "lcp"))
    best = ways.groupBy("node").agg(F.max(F.struct("lcp", F.xxhash64("other").alias("h"), "other")).alias("best"))
    pairs = best.select(F.least("node", "best.other").alias("a"), F.greatest("node", "best.other").alias("b")).distinct()
    found = bounded(stage(connected_components(confirmed(pairs)), "forest-components"))
    # 2. other neighbours, where they are not connected yet
    pairs = near.select(F.least("node", "prev").alias("a"), F.greatest("node", "prev").alias("b")).distinct()
    open_ = component(component(pairs, found, "a", "ca"), found, "b", "cb").where("ca <> cb").select("a", "b")
    links = confirmed(alike(stage(open_, "forest-open")))
    found = merged(found, component(component(links, found, "a", "ca"), found, "b", "cb").select(
        F.col("ca").alias("a"), F.col("cb").alias("b")))
    # 3. regions that still hold several components: which of these are alike
    # anywhere (a spanning forest of that), then the members of each such
    # cluster against each other on their sets
    def in_groups(groups: DataFrame, min_percent: int | None) -> DataFrame:
        dealt = groups.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
        return stage(dealt.mapInPandas(_met(min_percent), "a long, b long").distinct(), "forest-met")

    members = stage(component(busy.select("t", "key", "node").distinct(), found, "node", "comp"), "forest-members")
    near_comps = in_groups(_region_groups(members).join(classes.select("node", "sig"), "node"), None)
    clusters = bounded(stage(connected_components(near_comps), "forest-clusters"))
    clusters = clusters.select(F.col("node").alias("comp"), F.lit(0).alias("t"), F.col("component").alias("key"))
    members = stage(members.select("node", "comp").distinct().join(clusters, "comp"), "forest-cluster-members")
    groups = _region_groups(members).join(classes.select("node", "sig"), "node").join(one_set, "node")
    found = merged(found, in_groups(groups, min_percent))

    roots = stage(component(classes.select("node", "doc_id"), found, "node", "root"), "forest-roots")
    least = stage(roots.groupBy("root").agg(F.min("doc_id").alias("component_id")), "forest-least")
    by_node = stage(roots.join(bounded(least), "root").select(F.col("node").alias("__node"), "component_id"), "forest-result")
    linked = signed.drop("sig").join(by_node, (F.col("node") == F.col("__node")) & (F.col("n") > 0) & ~F.col("no_id"), "left")
    doc_id = F.when(~F.col("no_id"), F.col("doc_id"))
    return linked.select(doc_id.alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"),
                         F.coalesce("component_id", doc_id).alias("component_id"),
                         F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the documents another of their group stands for.

    Rows that repeat both id and text stay or go together. Columns as they are.
    """
    gone = stage(link(docs, id_column=id_column, text_column=text_column, **options).where("not kept")
                 .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "forest-gone")
    same = (docs[id_column].cast("long") == F.col("__id")) & (F.xxhash64(docs[text_column]) == F.col("__hash"))
    return docs.join(bounded(gone), same, "left_anti")


ORACLE = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, w[p + 1:p + least(len(w), 4)] AS g FROM (
        SELECT doc_id, w, unnest(range(len(w) - least(len(w), 4) + 1)) AS p FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach(x, y) AS (SELECT a, b FROM e UNION SELECT reach.x, e.b FROM reach JOIN e ON reach.y = e.a),
c AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(c.y, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.x = d.doc_id
"""
