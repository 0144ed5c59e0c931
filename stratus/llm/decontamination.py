"""Benchmark decontamination: word windows of the test items looked up in the documents.

Every document word starts a window; its 64-bit hash probes a broadcast hash
set of the items' windows, and what hits is verified word by word. The probe
runs in the scan's own stage: a document is read once, and only its header and
its verified hits are shuffled. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import ascii_lower, require, stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: A document is contaminated when a twentieth of its words is hit.
MIN_PART = 20
#: Windows that may be broadcast, about 300 bytes each; more are joined by a shuffle.
MAX_BROADCAST_WINDOWS = 1_000_000


def words(text):
    """Lower-cased words of a text; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """(item_id as text, len, gram): all windows of all items; a shorter item is one window."""
    w = items.select(F.col(id_column).cast("string").alias("item_id"),
                     words(F.col(text_column)).alias("w")).where("size(w) > 0")
    w = w.withColumn("len", F.least(F.size("w"), F.lit(window)))
    w = w.withColumn("at", F.explode(F.expr("sequence(1, size(w) - len + 1)")))
    return w.select("item_id", "len", F.expr("slice(w, at, len)").alias("gram"))


def _bounded(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MAX_BROADCAST_WINDOWS else df


def find(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
         item_id_column: str = "item_id", item_text_column: str = "text",
         window: int = WINDOW, min_part: int = MIN_PART) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, n_hit, spans (word
    ranges hit, from 0, end exclusive, may overlap), items (ids as text, sorted),
    contaminated.

    A null text has no words, and neither a document nor an item without words
    takes part in a hit. An item with a null id marks words but is not listed.
    Repeated rows get a row each. No items: nothing is hit.
    """
    require(docs, id_column, text_column)
    require(items, item_id_column, item_text_column)
    found = stage(item_windows(items, item_id_column, item_text_column, window).distinct()
                  .withColumn("wid", F.md5(F.array_join("gram", " "))), "windows")
    grams = found.select("len", "gram", "wid").distinct().withColumn("h", F.xxhash64("gram"))
    n = found.count()
    lengths = sorted(r[0] for r in found.select("len").distinct().collect())  # at most `window`

    d = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_hash"),
                    words(F.col(text_column)).alias("w"))
    # One array of probes: a header (null), then for each length the hash of the
    # window that starts at each word. Windows cut off by the end fail verification.
    probes = ", ".join(["array(cast(null as bigint))"] + [
        f"transform(w, (x, i) -> xxhash64(slice(w, i + 1, {k})))" for k in lengths])
    d = d.withColumn("n_words", F.size("w")).withColumn("probes", F.expr(f"concat({probes})"))
    d = d.select("doc_id", "text_hash", "w", "n_words", F.posexplode_outer("probes").alias("nth", "h"))
    # (The outer form keeps the optimizer from testing each array before it is made.)
    at = F.pmod(F.col("nth") - 1, F.col("n_words"))
    of = (f"element_at(array({', '.join(map(str, lengths))}), cast((nth - 1) div n_words as int) + 1)"
          if lengths else "0")
    hit = (d.join(_bounded(grams, n), "h", "left")
           .where((F.col("nth") == 0) | F.col("wid").isNotNull())
           .where((F.col("nth") == 0) | ((F.expr(of) == F.col("len"))
                                         & (F.slice("w", at + 1, F.col("len")) == F.col("gram"))))
           .select("doc_id", "text_hash", "n_words", (F.col("nth") == 0).cast("int").alias("header"),
                   F.when(F.col("nth") > 0, F.struct(at.alias("start"), (at + F.col("len")).alias("end"))).alias("span"),
                   F.when(F.col("nth") > 0, F.col("wid")).alias("wid")))
    doc = hit.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.sum("header").alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("wid").alias("wids"))
    n_hit = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["end"]))).alias("n"),
        F.greatest(a["end"], s["end"]).alias("end")), lambda a: a["n"])
    # The documents stay dealt by (doc_id, text_hash): no further exchange.
    listed = (doc.withColumn("n_hit", n_hit).withColumn("wid", F.explode_outer("wids")).drop("wids")
              .join(_bounded(found.select("wid", "item_id"), n), "wid", "left")
              .groupBy("doc_id", "text_hash")
              .agg(*[F.first(c).alias(c) for c in ("n_words", "n_hit", "copies", "spans")],
                   F.array_sort(F.collect_set("item_id")).alias("items")))
    contaminated = (F.col("n_hit") > 0) & (min_part * F.col("n_hit") >= F.col("n_words"))
    return (listed.withColumn("contaminated", contaminated)
            .withColumn("copy", F.explode(F.expr("sequence(1, cast(copies as int))"))).drop("copy", "copies"))


def remove_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated documents; columns as they are."""
    key, text = options.get("id_column", "doc_id"), options.get("text_column", "text")
    bad = (find(docs, items, **options).where("contaminated")
           .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    same = docs[key].eqNullSafe(bad["__id"]) & (F.xxhash64(docs[text]) == bad["__hash"])
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` with the words that are hit cut out of the text, each with what
    stands before it; columns as they are, all documents stay."""
    key, text = options.get("id_column", "doc_id"), options.get("text_column", "text")
    hit = (find(docs, items, **options).where("n_hit > 0")
           .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
           .dropDuplicates(["__id", "__hash"]))
    same = docs[key].eqNullSafe(hit["__id"]) & (F.xxhash64(docs[text]) == hit["__hash"])
    wide = docs.join(hit, same, "left")
    inside = WORD[2:-2]
    pieces = F.regexp_extract_all(F.col(text), F.lit(rf"[{inside}]*[^{inside}]+".replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")), F.lit(0))
    kept = F.filter(F.transform(F.col("__pieces"), lambda p, i: F.struct(p.alias("p"), F.exists(
        F.col("__spans"), lambda s: (s["start"] <= i) & (i < s["end"])).alias("hit"))), lambda x: ~x["hit"])
    tail = F.substr(F.col(text), F.length(F.array_join("__pieces", "")) + 1)
    cut = F.concat(F.array_join(F.transform(kept, lambda x: x["p"]), ""), tail)
    wide = wide.withColumn("__pieces", F.when(F.col("__spans").isNotNull(), pieces))
    return wide.select(*[F.when(F.col("__spans").isNotNull(), cut).otherwise(docs[c]).alias(c)
                         if c == text else docs[c] for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, w[p + 1:p + n] AS g, n FROM (
    SELECT item_id, w, least(len(w), 13) AS n, unnest(range(len(w) - least(len(w), 13) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT r, p, n, w[p + 1:p + n] AS g FROM (
    SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT r, p, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
hw AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM hits)) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (
    SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
