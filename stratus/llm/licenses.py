"""License scans by canonical digests.

A text is normalised until editions of one license agree: case, punctuation,
white space, copyright lines, comment marks and equivalent spellings are
levelled. The digest of the entire normalised text is then looked up among
those of known licenses; the same is done for each line, so that one-line
notices inside a document are found. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import ascii_lower, require
from stratus.llm.license_texts import LICENSES, NOTICES, editions, files, titled

# Spellings held to be equal.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("cancelled", "canceled"), ("centre", "center"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("https", "http"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("licence", "license"), ("licenced", "licensed"), ("modelled", "modeled"), ("non commercial", "noncommercial"),
    ("organisation", "organization"), ("owner", "holder"), ("per cent", "percent"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("sub license", "sublicense"),
    ("sublicence", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)
# The beginning of a copyright line: a sign or "copyright", with a year, a sign or a place for them on the same line.
# Lines of a license's body that happen to begin with the word have none.
_CLAIM = (r"^[^\w\n]*(?:copyright\b[^\n]*(?:\b(?:19|20)[0-9][0-9]\b|\(c\)|©|[<\[{][^\n]*[>\]}])"
          r"|(?:\(c\)|©)[^\n]*\b(?:19|20)[0-9][0-9]\b)[^\n]*$")
#: What the forms of a text leave out: copyright lines; the rest of their paragraphs as well (for claims that
#: were broken into several lines); nothing (for texts whose claim is fixed, broken anywhere).
_COPYRIGHT = _CLAIM + r"|^[^\w\n]*all rights reserved[^\w\n]*$"
_CLAIM_PARAGRAPH = _CLAIM + r"(?:\r?\n[^\n]*\w[^\n]*$)*|^[^\w\n]*all rights reserved[^\w\n]*$"
FORMS = (_COPYRIGHT, _CLAIM_PARAGRAPH, None)
_PUNCTUATION = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F\u2010-\u201f\u00a0]+"


def normalise(text, left_out: str | None = _COPYRIGHT):
    """Column of the canonical form: words of a-z, 0-9 and letters beyond ASCII, one blank apart."""
    c = text if left_out is None else F.regexp_replace(text, "(?imd)" + left_out, " ")
    c = F.regexp_replace(ascii_lower(c), _PUNCTUATION, " ")
    # only texts that hold a word of the table are searched for each of its words
    table = "|".join(a for a, _ in SPELLINGS)
    level = F.concat(F.lit(" "), c, F.lit(" "))
    for a, b in SPELLINGS:
        level = F.replace(level, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(F.when(c.rlike(rf"\b(?:{table})\b"), level).otherwise(c))


def digest(text):
    return F.sha2(normalise(text), 256)


def known(spark: SparkSession) -> DataFrame:
    """(license_digest, license_id, whole): the texts of license_texts, a fixed and small table."""
    rows = [(k, v, True) for k, v in [*LICENSES.items(), *editions()]] + [(k, v, False) for v, k in NOTICES]
    texts = spark.createDataFrame(rows, "license_id string, text string, whole boolean")
    # Digested once, so that no plan carries the texts. A text is known by each of its forms.
    forms = F.explode(F.array(*[F.sha2(normalise(F.col("text"), f), 256) for f in FORMS]))
    digests = texts.select(forms.alias("license_digest"), "license_id", "whole").distinct().collect()
    return spark.createDataFrame(digests, "license_digest string, license_id string, whole boolean")


def scan(docs: DataFrame, licenses: DataFrame | None = None, *, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words (of the normalised text), text_digest,
    license_id (the license that the entire text is, or null), line_licenses
    (the licenses that entire lines are, sorted, each once).

    ``licenses``: license_digest and license_id; several ids of one digest all
    match, and license_id is the first in order. A null text is like an empty
    one: no words, the digest of the empty text, no license; the empty text is
    never a license. Repeated rows get a row each.
    """
    require(docs, id_column, text_column)
    licenses = known(docs.sparkSession) if licenses is None else licenses
    empty = F.sha2(F.lit("").cast("binary"), 256)
    # One row per digest: ids of equal texts are gathered (a handful: names of one license).
    table = licenses.where(F.col("license_digest") != empty).groupBy("license_digest").agg(
        F.array_sort(F.collect_set("license_id")).alias("ids"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    # A text without a copyright line has one form.
    claims = text.rlike("(?imd)" + _COPYRIGHT)
    others = F.when(claims, F.array(*[F.sha2(normalise(text, f), 256) for f in FORMS[1:]])).otherwise(F.array().cast("array<string>"))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_hash"),
                       normalise(text).alias("norm"), others.alias("others"), F.split(text, r"\r\n|\r|\n").alias("lines"))
    # A header with the whole text's digest, its other forms, then every line.
    unit = lambda whole, value: F.struct(F.lit(whole).alias("whole"), value.alias("digest"))
    notice = F.transform(F.filter("lines", lambda x: F.length(x) > 0), lambda x: unit("line", digest(x)))
    whole = F.concat(F.array(unit("text", F.sha2("norm", 256))), F.transform("others", lambda x: unit("form", x)))
    n_words = F.when(F.col("norm") == "", 0).otherwise(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1)
    units = rows.select("doc_id", "text_hash", n_words.cast("long").alias("n_words"), F.concat(whole, notice).alias("units"))
    units = units.select("doc_id", "text_hash", "n_words", F.explode_outer("units").alias("u")).select(
        "doc_id", "text_hash", "n_words", F.col("u.whole").alias("whole"), F.col("u.digest").alias("digest"))
    met = units.join(table, F.col("digest") == F.col("license_digest"), "left").where("whole = 'text' or ids is not null")
    first, line = F.col("whole") == "text", F.col("whole") == "line"
    return (met.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.max(F.when(first, F.col("digest"))).alias("text_digest"),
        F.min(F.when(~line, F.col("ids")[0])).alias("license_id"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(line, F.col("ids")))))).alias("line_licenses"),
        F.sum(first.cast("int")).alias("copies"))
        .withColumn("copy", F.explode(F.expr("sequence(1, cast(copies as int))"))).drop("copy", "copies", "text_hash"))


def oracle() -> str:
    """DuckDB SQL of the registered query, with the texts of LICENSES, NOTICES and the
    license files under every title; of the files not the editions that differ in parts."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    levelled = "' ' || c || ' '"
    for a, b in SPELLINGS:
        levelled = f"replace({levelled}, {quoted(f' {a} ')}, {quoted(f' {b} ')})"

    def norm(name: str, table: str, keep: str, left_out: str | None = _COPYRIGHT) -> str:
        """CTE with ``norm`` of the column ``text``."""
        bare = "text" if left_out is None else f"regexp_replace(text, {quoted('(?im)' + left_out)}, ' ', 'g')"
        lower = f"translate({bare}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return (f"{name} AS (SELECT {keep}, trim({levelled}) AS norm FROM (SELECT {keep}, regexp_replace({lower}, "
                f"{quoted(_PUNCTUATION)}, ' ', 'g') AS c FROM {table}))")
    texts = [*LICENSES.items(), *[(i, t) for t, i in NOTICES], *titled(), *files()]
    values = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in texts)
    forms = range(len(FORMS))
    return f"""
WITH k AS (SELECT * FROM (VALUES {values}) AS t(license_id, text)),
{", ".join(norm(f"k{i}", "k", "license_id", FORMS[i]) for i in forms)},
known AS (SELECT sha256(norm) AS dig, list_sort(list(DISTINCT license_id)) AS ids
          FROM ({" UNION ALL ".join(f"SELECT * FROM k{i}" for i in forms)}) f WHERE norm <> '' GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
{", ".join(norm(f"d{i}", "docs", "r, doc_id", FORMS[i]) for i in forms)},
whole AS (SELECT r, min(ids[1]) AS license_id FROM ({" UNION ALL ".join(f"SELECT r, norm FROM d{i}" for i in forms)}) f
          JOIN known ON dig = sha256(norm) GROUP BY r),
ls AS (SELECT r, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS text FROM docs),
{norm("ln", "ls", "r")},
lf AS (SELECT r, string_agg(DISTINCT id, ',' ORDER BY id) AS found FROM (
    SELECT r, unnest(ids) AS id FROM ln JOIN known ON dig = sha256(norm)) GROUP BY r)
SELECT doc_id, CAST(CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS BIGINT) AS n_words,
    sha256(norm) AS text_digest, license_id, coalesce(found, '') AS line_licenses
FROM d0 LEFT JOIN whole USING (r) LEFT JOIN lf USING (r)
"""
