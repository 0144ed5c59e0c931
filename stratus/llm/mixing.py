"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target /
size of its source. The whole part is certain; the fractional part is rounded
by the pivotal method: two documents with fractional probabilities meet, mass
is moved between them at random until one of them is 0 or 1, and the other
goes on to meet the next. Mass is counted in words (probability x size), so
the words taken of a source are kept, not just its number of copies. The one
document per source that stays open to the end is rounded by a draw, and the
words this adds or takes away are made up by documents of the last leaf.

Documents are dealt to leaves by a hash of their id, the leaves sized so that
each holds about ``leaf_rows`` documents however large the source is; a leaf
leaves at most one fractional document. These residuals meet in a reduction
tree of fan-in ``leaf_rows`` until each source has one. All draws come from
hashes of the documents, so a rerun, or another number of partitions, takes the
same copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import require, stage

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
LEAF_ROWS = 500

_UNIT = "sid int, leaf long, leaves long, unit_key string, size long, p double, copies int"


def word_count(text):
    """Number of runs of characters other than blank and TAB..CR; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE,
            most: float = MOST) -> list[tuple[str | None, int, float]]:
    """(source, size, target) in code-point order, null last.

    A source whose share by weight is above ``most`` times its size stops
    there; what it leaves is shared again by weight among the others until
    none is above.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {i: weights[i % len(weights)] for i in range(len(order))}
    rest = min(share, most) * sum(n for _, n in order)
    target, open_ = {}, set(weight)
    while open_:
        total = sum(weight[i] for i in sorted(open_))
        above = [i for i in sorted(open_) if rest * weight[i] / total > most * order[i][1]]
        if not above:
            target |= {i: rest * weight[i] / total for i in open_}
            break
        for i in above:
            target[i] = most * order[i][1]
            open_.discard(i)
        rest = max(0.0, rest - sum(target[i] for i in above))
    return [(s, n, float(target[i])) for i, (s, n) in enumerate(order)]


def _draw(*parts) -> float:
    """Uniform number in [0, 1) from a hash of the parts."""
    digest = hashlib.blake2b("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"),
                             digest_size=8).digest()
    return int.from_bytes(digest, "little") / 2.0 ** 64


def _meet(a: tuple, b: tuple, seed: int) -> tuple[tuple, tuple]:
    """Two fractional units (key, size, p): move words from one to the other.

    Returns (settled, open); the open one may be settled too (p of 0 or 1).
    The expected p of both stays as it was and size x p summed is unchanged.
    """
    (ka, sa, pa), (kb, sb, pb) = a, b
    up = min((1.0 - pa) * sa, pb * sb)      # words that can go from b to a
    down = min(pa * sa, (1.0 - pb) * sb)    # and from a to b
    move = up if _draw(seed, ka, kb) * (up + down) < down else -down
    qa, qb = pa + move / sa, pb - move / sb
    ends = [abs(q - round(q)) for q in (qa, qb)]
    if ends[0] <= ends[1]:
        return (ka, sa, float(round(qa))), (kb, sb, min(1.0, max(0.0, qb)))
    return (kb, sb, float(round(qb))), (ka, sa, min(1.0, max(0.0, qa)))


def _settled(p: float) -> bool:
    return p <= 1e-12 or p >= 1.0 - 1e-12


def _close_gap(units: list[tuple], left: tuple, draw: float) -> list[tuple]:
    """Settle a source's last open unit by a draw; the words this adds or takes
    away are made up, largest document first, by settled units that fit."""
    units = [*units, (*left[:2], float(draw < left[2]))]
    gap = (left[2] - units[-1][2]) * left[1]
    out = [units[-1]]
    for key, size, p in sorted(units[:-1], key=lambda u: (-u[1], u[0])):
        if size > 0 and (p == 0.0 and size <= gap or p == 1.0 and size <= -gap):
            gap += size if p else -size
            p = 1.0 - p
        out.append((key, size, p))
    return out


def _rounder(seed: int):
    """Over rows sorted by (sid, leaf): round each leaf, at most one row stays fractional.

    ``copies`` comes in as the source's whole number of copies and is the same
    for all its units. ``leaves`` is 1 where the leaf holds all that is left of
    its source; then the unit left open is settled too. Holds one open unit, or
    the units of such a last leaf.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, whole, left, held, out = None, 0, None, [], []

        def close(unit):
            if at[2] == 1:
                held.append(unit)
            else:
                out.append((*at, unit[0], unit[1], 0.0, whole + round(unit[2])))

        def finish():
            if left is not None and at[2] == 1:
                held[:] = _close_gap(held, left, _draw(seed, "last", left[0]))
            elif left is not None:
                out.append((*at, *left, whole))
            out.extend((*at, key, size, 0.0, whole + round(p)) for key, size, p in held)
            held.clear()

        def frame():
            pdf = pd.DataFrame(out, columns=["sid", "leaf", "leaves", "unit_key", "size", "p", "copies"])
            out.clear()
            return pdf

        for pdf in batches:
            for sid, leaf, leaves, key, size, p, copies in pdf.itertuples(index=False, name=None):
                if (sid, leaf, leaves) != at:
                    finish()
                    at, whole, left = (sid, leaf, leaves), copies, None
                unit = (key, size, p)
                if size <= 0:  # no words to balance
                    close((key, size, float(_draw(seed, "empty", key) < p)))
                elif _settled(p):
                    close((key, size, float(round(p))))
                elif left is None:
                    left = unit
                else:
                    done, left = _meet(left, unit, seed)
                    close(done)
                    if _settled(left[2]):
                        close((*left[:2], float(round(left[2]))))
                        left = None
            yield frame()
        finish()
        yield frame()
    return run


def _round(units: DataFrame, seed: int) -> DataFrame:
    dealt = units.repartition("sid", "leaf").sortWithinPartitions("sid", "leaf", "unit_key")
    return dealt.mapInPandas(_rounder(seed), _UNIT)


def mix(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", weights=WEIGHTS, share: float = SHARE, most: float = MOST,
        leaf_rows: int = LEAF_ROWS, seed: int = 7) -> DataFrame:
    """Copies of each document that bring every source near its target.

    Returns one row per input row: id_text (its id as text), digest (of the
    whole row), size, source_size, target, copies, taken (copies x size). One
    row per source reaches the driver, where the targets are worked out.

    A null text has size 0; documents of no words get their copies by a draw
    each and take no words. A null source is a source of its own, ordered last.
    Equal rows are numbered and rounded one by one. No input gives no rows.
    """
    require(docs, id_column, text_column, source_column)
    keyed = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
                        word_count(F.col(text_column)).alias("size"),
                        row_digest(docs).alias("digest"))
    rows = stage(keyed, "mixing-rows")
    found = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    counts = {r["source"]: r["rows"] for r in found}
    plan = [(i, s, n, t, max(1, math.ceil(counts[s] / leaf_rows)))
            for i, (s, n, t) in enumerate(targets([(r["source"], r["n"]) for r in found],
                                                  weights, share, most))]
    spark = docs.sparkSession
    plan_df = spark.createDataFrame(plan, "sid int, source string, source_size long, target double, leaves long")
    units = (rows.join(plan_df, rows["source"].eqNullSafe(plan_df["source"]))
             .groupBy("sid", "leaves", "source_size", "target", "doc_id", "digest", "size")
             .agg(F.count(F.lit(1)).alias("n"))
             .select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("nth")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.concat_ws(":", F.hex("digest"), F.col("nth"),
                      F.coalesce(F.concat(F.lit("v"), F.col("doc_id").cast("string")), F.lit("n")))
    level = units.select(
        "sid", F.pmod(F.xxhash64(key, F.lit(seed)), F.col("leaves")).alias("leaf"), "leaves",
        key.alias("unit_key"), "size", (ratio - F.floor(ratio)).alias("p"),
        F.floor(ratio).cast("int").alias("copies"))
    most_leaves, settled = max([p[4] for p in plan], default=1), None
    while True:
        done = stage(_round(level, seed), "mixing-level")
        part = done.where("p = 0")
        settled = part if settled is None else settled.unionByName(part)
        if most_leaves == 1:
            break
        level = done.where("p > 0").withColumns({
            "leaf": F.floor(F.col("leaf") / leaf_rows), "leaves": F.ceil(F.col("leaves") / leaf_rows)})
        most_leaves = math.ceil(most_leaves / leaf_rows)
    return (settled.join(plan_df.select("sid", "source_size", "target"), "sid")
            .select(F.regexp_extract("unit_key", r"(?s)^\w+:\w+:v(.*)$", 1).alias("id_text"),
                    F.col("unit_key").rlike(r"^\w+:\w+:n$").alias("id_null"),
                    F.unhex(F.split_part("unit_key", F.lit(":"), F.lit(1))).alias("digest"),
                    "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"))
            .withColumn("id_text", F.when(~F.col("id_null"), F.col("id_text"))).drop("id_null"))


def row_digest(docs: DataFrame):
    """Digest of all columns of a row; equal rows have equal digests."""
    parts = []
    for name, kind in docs.dtypes:
        c = F.col(f"`{name}`")
        parts += [F.coalesce(F.length(c.cast("string")) if kind == "string" else F.lit(1), F.lit(-1)),
                  F.coalesce((c if kind == "string" else F.to_json(F.struct(c))).cast("string"), F.lit(""))]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as :func:`mix` takes it.

    Same columns as ``docs``; a row taken twice appears twice, with the same id.
    """
    taken = mix(docs, **options)
    copies = (taken.where("copies > 0").groupBy("digest").agg(F.sum("copies").alias("__copies")))
    rows = docs.withColumn("__digest", row_digest(docs)).dropDuplicates(["__digest"])
    return (rows.join(copies, rows["__digest"] == copies["digest"])
            .select(*[rows[c] for c in docs.columns],
                    F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__n"))
            .drop("__n"))
