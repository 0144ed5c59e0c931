"""URL filter: rules first, then segmented host and path words under naive Bayes.

Hosts write words together. Each part of a host is split into words by a
Viterbi search under unigram counts of all the pages' text, by hosts that use a
word and are not named by it; a multinomial naive Bayes over the words of host and path, learned from the urls that a rule
decides, judges the rest. Scores are worked out per distinct host and per
distinct set of path words, so a host with a third of all pages is scored once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import ascii_lower, require, stage

#: (verdict, host, path): a rule fits its host and all subdomains, and paths that start with its own.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MAX_WORD = 20
_WORD = r"[^\x00-\x60\x7B-\x7F]+"
#: Scripts and styles whole, tags, entities; every match begins with < or &, which is looked for first.
_MARKUP = r"(?is)[<&](?:(?<=<)(?:(?:script|style)\b.*?</(?:script|style)>|[^>]*+>)|(?<=&)#?\w++;)"
_TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def parse(url):
    """(host, path) columns; both empty for null or without ://."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substr(whole, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host, path, rules=RULES):
    """Column struct(rule, verdict) of the longest rule that fits, or null."""
    fits = [(F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                    F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))))
            for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))]
    return F.coalesce(*fits)


def word_counts(pages: DataFrame, html_column: str = "html", url_column: str = "url") -> DataFrame:
    """(word, n): on the pages of how many hosts the visible text holds the word.

    A host counts once for each word, however many pages it has, and not at all
    for words that its own name contains: a site that writes its name on its
    pages would otherwise make that name a word, and it would never be split.
    Hosts are told apart by 64-bit hashes: a chance collision makes a count one less.
    """
    text = F.regexp_replace(F.coalesce(F.col(html_column), F.lit("")), _MARKUP, " ")
    # A column of its own: lower-casing names the text four times, and a generator would work it out for each.
    texts = pages.select(parse(F.col(url_column))[0].alias("host"), text.alias("text")).select(
        "host", ascii_lower(F.col("text")).alias("text"))
    words = texts.select("host", F.explode(F.array_distinct(
        F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))).alias("word"))
    return (words.where(~F.contains("host", "word")).select("word", F.xxhash64("host").alias("host")).distinct()
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def split_words(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split of a name. A word that was never met is less
    probable by a factor of ten for each letter."""
    known = {w: math.log(n / total) for w, n in counts.items()}
    best = [0.0] + [-math.inf] * len(name)
    back = [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for begin in range(max(0, end - MAX_WORD), end):
            word = name[begin:end]
            p = best[begin] + known.get(word, -math.log(total) - math.log(10) * len(word))
            if p > best[end]:
                best[end], back[end] = p, begin
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _splitter(total: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"part": pdf["part"], "words": [
                split_words(p, dict(zip(w, n)), total) for p, w, n in zip(pdf["part"], pdf["known"], pdf["counts"])]})
    return run


def segment(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """(part, words) for distinct strings ``part``: every substring of at most
    MAX_WORD characters is looked up among the counts, then the best split is taken."""
    total = (counts.agg(F.sum("n")).first()[0] or 0) + 1
    starts = F.explode(F.sequence(F.lit(1), F.length("part"))).alias("at")
    lengths = F.explode(F.expr(f"sequence(1, least({MAX_WORD}, length(part) - at + 1))")).alias("long")
    pieces = parts.where("part <> ''").select("part", starts).select("part", "at", lengths).select(
        "part", F.expr("substr(part, at, long)").alias("word")).distinct()
    met = stage(pieces.join(counts, "word"), "url-substrings")
    known = met.groupBy("part").agg(F.collect_list("word").alias("known"), F.collect_list("n").alias("counts"))
    none = {"known": F.array().cast("array<string>"), "counts": F.array().cast("array<long>")}
    every = parts.where("part <> ''").join(known, "part", "left").select(
        "part", *[F.coalesce(c, d).alias(c) for c, d in none.items()])
    return every.mapInPandas(_splitter(total), "part string, words array<string>")


def judge(pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url",
          html_column: str = "html", rules=RULES) -> DataFrame:
    """One row per row: page_id, host, path, rule, verdict, host_words, score.

    score is the log odds of block, null where a rule decides; a url is blocked
    above 0. Without a url that a rule decides, all others are allowed. A null
    url, or one without ://, has an empty host and path and is judged by the
    prior alone; a null html has no words.
    """
    require(pages, id_column, url_column, html_column)
    host, path = parse(F.col(url_column))
    rows = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    tokens = F.transform(F.regexp_extract_all(ascii_lower(F.col("path")), F.lit(_TOKEN), F.lit(0)),
                         lambda t: F.regexp_replace(t, "[0-9]+", "#"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "path_words", F.array_join(F.array_sort(tokens), " "))
    rows = stage(rows.select("page_id", "host", "path", "path_words", "found.rule", "found.verdict"), "url-rows")

    # Words of each distinct host.
    hosts = stage(rows.groupBy("host").agg(
        F.count_if(F.col("verdict") == "block").alias("block"), F.count_if(F.col("verdict") == "allow").alias("allow"))
        .withColumn("parts", F.regexp_extract_all("host", F.lit(_WORD), F.lit(0))), "url-hosts")
    counts = stage(word_counts(pages, html_column, url_column), "url-words")
    split = stage(segment(hosts.select(F.explode("parts").alias("part")).distinct(), counts), "url-parts")
    by_host = (hosts.select("host", F.posexplode_outer("parts").alias("nth", "part")).join(split, "part", "left")
               .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("nth", "words"))).alias("w"))
               .select("host", F.flatten(F.transform("w", lambda x: F.coalesce(x["words"], F.array().cast("array<string>")))).alias("host_words")))
    host_words = stage(by_host.join(hosts.drop("parts"), "host"), "url-host-words")
    paths = stage(rows.groupBy("path_words").agg(F.count_if(F.col("verdict") == "block").alias("block"),
                                                 F.count_if(F.col("verdict") == "allow").alias("allow")), "url-paths")

    # Counts of every word by class; words of host and path are apart.
    def words_of(table: DataFrame, key: str, words, mark: str) -> DataFrame:
        return table.select(key, "block", "allow", F.explode(words).alias("word")).where("word <> ''").withColumn(
            "word", F.concat(F.lit(mark), "word"))

    in_hosts = stage(words_of(host_words, "host", F.col("host_words"), "h:"), "url-in-hosts")
    in_paths = stage(words_of(paths, "path_words", F.split("path_words", " "), "p:"), "url-in-paths")
    model = stage(reduce(DataFrame.unionByName, [t.select("word", "block", "allow") for t in (in_hosts, in_paths)])
                  .groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "url-model")
    seen = model.agg(F.count(F.lit(1)).alias("v"), F.sum("block").alias("b"), F.sum("allow").alias("a")).first()
    docs = hosts.agg(F.sum("block").alias("b"), F.sum("allow").alias("a")).first()
    prior = math.log(((docs["b"] or 0) + 1) / ((docs["a"] or 0) + 1))
    shift = math.log(((seen["a"] or 0) + seen["v"] + 1) / ((seen["b"] or 0) + seen["v"] + 1))
    odds = model.select("word", (F.log((F.col("block") + 1.0) / (F.col("allow") + 1.0)) + shift).alias("odds"))

    def scored(table: DataFrame, key: str, name: str) -> DataFrame:
        s = table.select(key, "word").join(odds, "word").groupBy(key).agg(F.sum("odds").alias(name))
        return stage(s, "url-scores").withColumnRenamed(key, f"__{key}")

    by_h, by_p = scored(in_hosts, "host", "host_odds"), scored(in_paths, "path_words", "path_odds")
    labels = host_words.select(F.col("host").alias("__h"), "host_words")
    wide = (rows.join(by_h, F.col("host") == F.col("__host"), "left")
            .join(by_p, F.col("path_words") == F.col("__path_words"), "left")
            .join(labels, F.col("host") == F.col("__h"), "left"))
    score = F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    has_class = bool(docs["b"] or docs["a"])
    judged = F.when(score > 0, F.lit("block")).otherwise(F.lit("allow")) if has_class else F.lit("allow")
    return wide.select("page_id", "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"),
                       "host_words", F.when(F.col("rule").isNull(), score).alias("score"))
