"""URL filter: parsing and rules by hand, the split against all splits, naive Bayes against a direct count."""

import itertools
import math
import random
import re

import pytest

from corpus_cases import CLASHES
from pyspark.sql import functions as F
from stratus.llm import url_filter as U
from stratus.plans.inspect import plan_text

URLS = ["http://shop.com/x", "https://WWW.Example.com/en/1?x=2", "http://a.example.com/en/x#y", "http://a.example.com/en", "http://com",
        "http://com/", "http://xcom/", "http://badnews.net/es/1", "http://badnews.net/fr/2", "http://badnews.net/de/3",
        "ftp://goodnews.org/en/9", None, "", "no scheme", "http://", "http:///path", "x://h?q=/a", "http://h#/b", "a://b://c/d",
        "http://ÄRGER.net/ES/1", "http://badnews.net/es/" + "p" * 20000, "http://" + "ab" * 3000 + ".org/", "http://goodnews.org/en/9",
        "http://a\nb.net/es/\n1"]


def host_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


@pytest.fixture(scope="module")
def judged(spark):
    html = "<html><style>x{bad:1}</style><p>good news and bad news &amp; more news</p><script>alert('zz')</script></html>"
    rows = [(i, u, html) for i, u in enumerate(URLS)] + [(5, URLS[5], None), (None, URLS[7], "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("clash") for c in CLASHES})
    return rows, U.judge(df).collect()


def test_hosts_paths_and_rules(judged):
    rows, got = judged
    key = lambda t: tuple(map(str, t))
    want = []
    for i, u, _ in rows:
        host, path = host_path(u)
        want.append((i, host, path, (rule(host, path) or (None,))[0]))
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        if r.rule:
            assert r.verdict == rule(r.host, r.path)[1] and r.score is None


def test_naive_bayes(judged):
    _, got = judged
    words = {h: list(r.host_words) for r in got for h in [r.host]}
    assert words["badnews.net"] == ["bad", "news", "net"] and words["goodnews.org"][:2] == ["good", "news"]
    counts, classes, vocabulary = {"block": {}, "allow": {}}, {"block": 0, "allow": 0}, set()

    def tokens(r):
        path = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.path))
        return ["h:" + w for w in words[r.host]] + ["p:" + re.sub("[0-9]+", "#", t) for t in path]
    for r in got:
        vocabulary.update(tokens(r))
        if r.rule:
            classes[r.verdict] += 1
            for t in tokens(r):
                counts[r.verdict][t] = counts[r.verdict].get(t, 0) + 1
    size = {c: sum(counts[c].values()) + len(vocabulary) + 1 for c in counts}
    for r in got:
        if not r.rule:
            score = math.log((classes["block"] + 1) / (classes["allow"] + 1))
            for t in tokens(r):
                score += math.log((counts["block"].get(t, 0) + 1) / size["block"]) - math.log((counts["allow"].get(t, 0) + 1) / size["allow"])
            assert r.score == pytest.approx(score) and r.verdict == ("block" if score > 0 else "allow")


def test_words_count_once_a_host_and_not_for_hosts_they_name(spark):
    pages = [("http://blueshop.net/1", "<p>blueshop sells Blue shoes, shoes</p>"), ("http://blueshop.net/2", "shoes <b>sky</b>"),
             ("http://sky.org/", "the sky is blue <script>shoes</script>"), ("http://other.org", "shop blue the"),
             ("http://other.org/x", None), (None, "shop the")]
    got = {r.word: r.n for r in U.word_counts(spark.createDataFrame(pages, "url string, html string")).collect()}
    hosts = {}
    for url, html in pages:
        text = re.sub(r"<script>.*?</script>|<[^>]*>", " ", html or "").lower()
        hosts.setdefault(host_path(url)[0], set()).update(re.findall("[a-z]+", text))
    want = {}
    for host, words in hosts.items():
        for w in words:
            if w not in host:
                want[w] = want.get(w, 0) + 1
    assert got == want and got["blue"] == 2 and "blueshop" not in got and got["shoes"] == 1
    split = U.segment(spark.createDataFrame([("blueshop",)], "part string"), spark.createDataFrame(list(got.items()), "word string, n long"))
    assert split.first().words == ["blue", "shop"]


def test_best_split():
    counts, total = {"a": 5, "ab": 9, "abc": 2, "bc": 7, "c": 3, "cab": 4}, 40

    def p(word):
        return math.log(counts[word] / total) if word in counts else -math.log(total) - math.log(10) * len(word)
    for n in range(1, 8):
        for name in map("".join, itertools.product("abc", repeat=n)):
            best = max(sum(map(p, (name[i:j] for i, j in zip((0, *cut), (*cut, n)))))
                       for k in range(n) for cut in itertools.combinations(range(1, n), k))
            assert sum(map(p, U.split_words(name, counts, total))) == pytest.approx(best)
    assert U.split_words("", {}, 1) == []


def test_no_rule_decides_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://x.org/a", "<p>x</p>"), (2, None, None)], "page_id long, url string, html string")
    assert {r.verdict for r in U.judge(df).collect()} == {"allow"}
    assert U.judge(df.limit(0)).count() == 0


def test_page_text_is_cleaned_once(spark):
    pages = spark.createDataFrame([("http://a.com/", "<p>Word</p>")], "url string, html string")
    plan = plan_text(U.word_counts(pages))
    assert plan.count("regexp_replace(") == 1


def test_markup_is_found_as_by_plain_alternatives(spark):
    rng = random.Random(4)
    parts = ["<", ">", "&", ";", "#", "<script", "</script>", "<STYLE>", "</style>", "<scripts>", "amp", "&amp;", "&#1", " ", "\n", "x", "é", "/"]
    df = spark.createDataFrame([("".join(rng.choice(parts) for _ in range(rng.randrange(25))),) for _ in range(3000)], "t string")
    plain = r"(?is)<(?:script|style)\b.*?</(?:script|style)>|<[^>]*>|&#?\w+;"
    assert df.where(F.regexp_replace("t", plain, "|") != F.regexp_replace("t", U._MARKUP, "|")).count() == 0
