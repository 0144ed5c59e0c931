"""Personal data by candidate generation and gradient boosting.

Base rules find e-mail addresses, IP addresses, card and phone numbers. They
miss a span that something else runs into: a phone number followed by a card
number is one match of too many digits. Generators of high recall propose
overlapping spans; boosted trees judge them by format and context. Labels come
from the base rules themselves: a proposal that is a base span is positive, one
that stands apart from every match, or is itself a match that failed, is
negative, and one inside a longer failed match is unlabelled and left to the
model. Per kind, a threshold calibrated on a held-out quarter of the documents
selects what is added. DataFrame functions only; the driver fits the trees on a
bounded table of counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.boosting import Boosted
from stratus.llm.common import require, stage

KINDS = ("email", "ip", "card", "phone")
# Base patterns. Possessive quantifiers and the guards in front change no match:
# they only stop a long run from being tried again from each of its characters.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: (kind, pattern) of the generators; what they propose may overlap.
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}+"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}+"
              r"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63}+){1,8}+"),
    ("ip", r"(?<![0-9])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{13,19}+(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    ("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    ("phone", r"(?<![0-9])[0-9]{7,12}+(?![0-9])"),
)
#: Words that announce a kind in the CONTEXT characters before a span.
CUES = {"email": "mail|contact|write|@", "ip": "ip|addr|host|server|from",
        "card": "card|visa|master|amex|pay|number", "phone": "phone|tel|call|mobile|fax|contact"}
CONTEXT = 24
FEATURES = ["kind", "generator", "digits", "luhn", "octets", "plus", "separators", "before", "after", "cue", "letters"]
#: Bounds of the fit: distinct feature vectors that reach the driver (the most frequent ones).
MAX_VECTORS = 5_000
MIN_PRECISION = 0.98
#: Above every score: a kind whose precision is out of reach gets no added spans.
NEVER = 2.0
_SCAN = 256


def _spans(prefix: str) -> str:
    """SQL for array<struct<start, end, s>> of the matches ``m_<prefix>`` and the
    texts between them ``p_<prefix>``; two levels of sums, so many matches stay cheap."""
    m, p = f"m_{prefix}", f"p_{prefix}"
    one = (f"struct(acc.pos + length({p}[i]) as start, acc.pos + length({p}[i]) + length({m}[i]) as end, {m}[i] as s)")
    chunk = (f"aggregate(sequence(c, least(c + {_SCAN} - 1, size({m}) - 1)), "
             f"named_struct('pos', b, 'out', cast(array() as array<struct<start:int,end:int,s:string>>)), "
             f"(acc, i) -> named_struct('pos', acc.pos + length({p}[i]) + length({m}[i]), 'out', concat(acc.out, array({one}))), "
             f"acc -> acc.out)")
    sums = (f"aggregate(sequence(0, size({m}) - 1, {_SCAN}), named_struct('pos', 0, 'out', cast(array() as array<struct<c:int,b:int>>)), "
            f"(acc, c) -> named_struct('pos', acc.pos + aggregate(sequence(c, least(c + {_SCAN} - 1, size({m}) - 1)), 0, "
            f"(n, i) -> n + length({p}[i]) + length({m}[i])), 'out', concat(acc.out, array(struct(c as c, acc.pos as b)))), acc -> acc.out)")
    inner = chunk.replace("sequence(c,", "sequence(x.c,").replace("least(c +", "least(x.c +").replace("'pos', b,", "'pos', x.b,")
    return (f"if(size({m}) > 0, flatten(transform({sums}, x -> {inner})), "
            f"cast(array() as array<struct<start:int,end:int,s:string>>))")


def _class(c: str) -> str:
    """0 nothing or a line end, 1 blank, 2 letter, 3 digit, 4 other."""
    return (f"case when {c} is null or {c} = '' or {c} rlike '[\\n\\r]' then 0 when {c} rlike '\\\\s' then 1 "
            f"when {c} rlike '\\\\p{{L}}' then 2 when {c} rlike '[0-9]' then 3 else 4 end")


def _valid(kind: str, s: str) -> str:
    digits = f"regexp_replace({s}, '[^0-9]', '')"
    if kind == "ip":
        return f"{s} rlike '^{_OCTET}(?:[.]{_OCTET}){{3}}$'"
    if kind == "card":
        return f"(length({digits}) between 13 and 19 and luhn_check({digits}))"
    if kind == "phone":
        return f"(length({digits}) between 9 and 15)"
    return "true"


def _features(kind: str, number: int) -> str:
    """SQL of a proposal's struct, for span ``x`` and column ``text``."""
    digits, k = "regexp_replace(x.s, '[^0-9]', '')", KINDS.index(kind)
    overlaps = "b.start < x.end and x.start < b.end"
    label = (f"case when exists(base_{kind}, b -> b.start = x.start and b.end = x.end) then 1 "
             f"when exists(base_{kind}, b -> {overlaps}) then null "
             f"when exists(failed_{kind}, b -> {overlaps} and not (b.start = x.start and b.end = x.end)) then null else 0 end")
    return (f"transform(spans_g{number}, x -> named_struct('kind', {k}, 'start', x.start, 'end', x.end, 'generator', {number}, "
            f"'digits', least(length({digits}), 31), 'luhn', cast(length({digits}) > 1 and luhn_check({digits}) as int), "
            f"'octets', cast(x.s rlike '^{_OCTET}(?:[.]{_OCTET}){{3}}$' as int), 'plus', cast(x.s like '+%' as int), "
            f"'separators', least(length(regexp_replace(x.s, '[A-Za-z0-9]', '')), 9), "
            f"'before', {_class('substr(text, x.start, 1)').replace('substr(text, x.start, 1)', 'if(x.start > 0, substr(text, x.start, 1), null)')}, "
            f"'after', {_class('substr(text, x.end + 1, 1)')}, "
            f"'cue', cast(lower(substr(text, greatest(x.start - {CONTEXT}, 0) + 1, least({CONTEXT}, x.start))) rlike '{CUES[kind]}' as int), "
            f"'letters', least(length(regexp_replace(x.s, '[^A-Za-z]', '')), 15), "
            f"'taken', exists(base_{kind}, b -> {overlaps}), 'label', {label}))")


def propose(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, base_<kind> (array of start, end, s) and proposals with their features."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    patterns = {**BASE, **{f"g{i}": p for i, (_, p) in enumerate(GENERATORS)}}
    kind_of = {**{k: k for k in KINDS}, **{f"g{i}": k for i, (k, _) in enumerate(GENERATORS)}}
    # A text without the sign that every match of a kind holds is not searched.
    need = {"email": F.col("text").rlike("@|[(\\[]at[)\\]]"), "ip": F.col("text").rlike(r"[0-9]\.[0-9]"),
            "card": F.col("text").rlike("[0-9]"), "phone": F.col("text").rlike("[0-9]")}
    none = F.array().cast("array<string>")
    rows = rows.withColumns({f"has_{k}": c for k, c in need.items()})
    rows = rows.withColumns({f"m_{n}": F.when(F.col(f"has_{kind_of[n]}"), F.regexp_extract_all("text", F.lit(p), F.lit(0)))
                             .otherwise(none) for n, p in patterns.items()})
    rows = rows.withColumns({f"p_{n}": F.when(F.size(f"m_{n}") > 0, F.split("text", p, -1)).otherwise(none)
                             for n, p in patterns.items()})
    rows = rows.select("doc_id", "text", *[F.expr(_spans(n)).alias(f"spans_{n}") for n in patterns])
    rows = rows.withColumns({f"base_{k}": F.expr(f"filter(spans_{k}, x -> {_valid(k, 'x.s')})") for k in KINDS}
                            | {f"failed_{k}": F.expr(f"filter(spans_{k}, x -> not ({_valid(k, 'x.s')}))") for k in KINDS})
    proposals = F.expr("concat(" + ", ".join(_features(k, i) for i, (k, _) in enumerate(GENERATORS)) + ")")
    slim = {k: F.expr(f"transform(base_{k}, x -> named_struct('start', x.start, 'end', x.end))") for k in KINDS}
    return rows.select("doc_id", *[c.alias(f"base_{k}") for k, c in slim.items()], proposals.alias("proposals"))


def calibrate(scored: list[tuple[float, int, int]], precision: float = MIN_PRECISION) -> float:
    """The lowest score at and above which ``precision`` of the (score, positive, negative)
    are positive; above every score if there is none, so that nothing is added.
    Equal scores stand or fall together."""
    by: dict[float, list[int]] = {}
    for score, pos, neg in scored:
        own = by.setdefault(score, [0, 0])
        own[0] += pos
        own[1] += neg
    threshold, good, bad = NEVER, 0, 0
    for score, (pos, neg) in sorted(by.items(), reverse=True):
        good, bad = good + pos, bad + neg
        if good and good >= precision * (good + bad):
            threshold = score
    return threshold


def _score(model: Boosted, names: list[str]) -> str:
    """SQL of the score in steps of 0.001, as it is calibrated and applied."""
    return f"(floor({model.sql(names)} * 1000) / 1000)"


def fit(proposed: DataFrame) -> tuple[Boosted, list[float]]:
    """The trees and the threshold of each kind.

    Trained on three quarters of the rows, by a hash of id and proposals, from the
    MAX_VECTORS most frequent feature vectors. The thresholds are calibrated on
    all labelled proposals of the other quarter, scored where they lie.
    """
    fold = F.pmod(F.xxhash64("doc_id", "proposals"), F.lit(4))
    flat = proposed.select(fold.alias("fold"), F.explode_outer("proposals").alias("x"))
    counts = stage(flat.where("x.label is not null")
                   .groupBy((F.col("fold") == 0).alias("test"), *[F.col(f"x.{f}").alias(f) for f in FEATURES])
                   .agg(F.sum("x.label").alias("pos"), F.sum(1 - F.col("x.label")).alias("neg")), "pii-counts")
    rows = (counts.where("not test").orderBy(F.desc(F.col("pos") + F.col("neg")), *FEATURES)
            .limit(MAX_VECTORS).collect())
    model = Boosted().fit([(tuple(int(r[f]) for f in FEATURES), int(r["pos"]), int(r["neg"])) for r in rows])
    scored = (counts.where("test").groupBy("kind", F.expr(_score(model, FEATURES)).alias("score"))
              .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect())  # 1001 scores of a kind at most
    return model, [calibrate([(float(r["score"]), int(r["pos"]), int(r["neg"])) for r in scored if r["kind"] == k])
                   for k in range(len(KINDS))]


def find(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: doc_id, base and spans (arrays of kind, start, end in code
    points, end exclusive, by kind and start); spans holds base and what the trees add.

    A null or empty text has no spans. An added span overlaps no base span nor
    another added one of its own kind; it may overlap one of another kind. Ids are
    not looked at but to split the fit. Without labelled proposals nothing is added.
    """
    require(docs, id_column, text_column)
    proposed = stage(propose(docs, id_column, text_column), "pii-proposals")
    model, thresholds = fit(proposed)
    limit = "element_at(array(" + ", ".join(f"{t!r}D" for t in thresholds) + "), c.kind + 1)"
    chosen = (f"array_sort(transform(filter(proposals, c -> not c.taken and {_score(model, [f'c.{f}' for f in FEATURES])} >= {limit}), "
              f"c -> struct(c.kind as k, c.start as start, c.end as end)))")
    # Of those that overlap, the first and then longest stays.
    apart = ("aggregate(array_sort(chosen, (x, y) -> case when x.k <> y.k then x.k - y.k when x.start <> y.start "
             "then x.start - y.start else y.end - x.end end), "
             "cast(array() as array<struct<k:int,start:int,end:int>>), (acc, c) -> if(size(acc) > 0 and "
             "element_at(acc, -1).k = c.k and element_at(acc, -1).end > c.start, acc, concat(acc, array(c))))")
    base = "concat(" + ", ".join(f"transform(base_{k}, x -> struct({i} as k, x.start as start, x.end as end))"
                                 for i, k in enumerate(KINDS)) + ")"
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    named = "transform({}, x -> struct(element_at(%s, x.k + 1) as kind, x.start as start, x.end as end))" % names
    return (proposed.withColumn("chosen", F.expr(chosen)).withColumn("base", F.expr(base)).withColumn("added", F.expr(apart))
            .select("doc_id", F.expr(named.format("base")).alias("base"),
                    F.expr(named.format("array_sort(concat(base, added))")).alias("spans")))


def redact(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text): the text with every span replaced by its kind in brackets;
    spans that overlap are replaced together by the kind of the first."""
    found = find(docs.select(F.col(id_column), F.col(text_column)).withColumn(
        "__row", F.struct(F.col(id_column).alias("id"), F.col(text_column).alias("text"))),
        id_column="__row", text_column=text_column)
    joined = F.expr("array_sort(transform(spans, x -> struct(x.start as start, x.end as end, x.kind as kind)))")
    cut = F.expr("aggregate(ordered, named_struct('at', 0, 'out', ''), (a, x) -> if(x.end <= a.at, a, named_struct("
                 "'at', x.end, 'out', if(x.start < a.at, a.out, concat(a.out, substr(doc_id.text, a.at + 1, x.start - a.at), '[', x.kind, ']')))), "
                 "a -> concat(a.out, substr(doc_id.text, a.at + 1)))")
    return found.withColumn("ordered", joined).select(F.col("doc_id.id").alias("doc_id"), cut.alias("text"))
