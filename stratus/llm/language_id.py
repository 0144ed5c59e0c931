"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes. Each byte is
embedded, filters of several widths run over the window, each keeps its
largest response, and a softmax layer turns those into probabilities of the
languages. The text's probabilities are the mean over all its windows, weighted
by their bytes. The network is trained in numpy on the driver, on windows of a
bounded sample of labelled documents; it is applied in a pandas UDF.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import require

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 16, 8
#: Bound of the training sample: labelled documents per language (about), windows of each.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 600, 3
EPOCHS, BATCH = 6, 64
MIN_SCORE = 0.3
UNKNOWN = "und"
HELD_OUT = 2


def _bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, bytes used of each window); texts are padded with zeros to whole windows."""
    lengths = [max(1, -(-len(t) // WINDOW)) for t in texts]
    data = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, lengths))
    used = np.full(sum(lengths), WINDOW, dtype=np.float64)
    ends = np.cumsum(lengths) - 1
    used[ends] = [max(1, len(t) - (n - 1) * WINDOW) for t, n in zip(texts, lengths)]
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, WINDOW), used


class ByteNet:
    """The network: embedding, one filter bank per width, softmax layer."""

    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"e": rng.normal(0, 0.5, (256, EMBEDDING))}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        hidden = FILTERS * len(WIDTHS)
        self.p |= {"v": rng.normal(0, 1 / np.sqrt(hidden), (hidden, len(languages))), "c": np.zeros(len(languages))}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def _forward(self, windows: np.ndarray):
        n, x = len(windows), self.p["e"][windows]
        pooled, where = [], []
        for w in WIDTHS:
            span = np.lib.stride_tricks.sliding_window_view(x.reshape(n, -1), w * EMBEDDING, axis=1)[:, ::EMBEDDING]
            out = np.ascontiguousarray(span).reshape(-1, w * EMBEDDING) @ self.p[f"w{w}"]
            out = out.reshape(n, -1, FILTERS)
            at = out.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(out, at[:, None], 1)[:, 0] + self.p[f"b{w}"])
        hidden = np.concatenate(pooled, axis=1)
        z = np.maximum(hidden, 0) @ self.p["v"] + self.p["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return x, where, hidden, z / z.sum(axis=1, keepdims=True)

    def _gradients(self, windows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        x, where, hidden, prob = self._forward(windows)
        n = len(windows)
        dz = prob.copy()
        dz[np.arange(n), y] -= 1
        dz /= n
        g = {"v": np.maximum(hidden, 0).T @ dz, "c": dz.sum(axis=0), "e": np.zeros_like(self.p["e"])}
        dh = (dz @ self.p["v"].T) * (hidden > 0)
        rows = np.arange(n)[:, None, None]
        for k, w in enumerate(WIDTHS):
            d = dh[:, k * FILTERS:(k + 1) * FILTERS]
            at = where[k][:, :, None] + np.arange(w)              # n, filters, w
            seen = x[rows, at].reshape(n, FILTERS, w * EMBEDDING)  # what each winner saw
            g[f"w{w}"] = np.einsum("nf,nfk->kf", d, seen)
            g[f"b{w}"] = d.sum(axis=0)
            back = d[:, :, None] * self.p[f"w{w}"].T               # n, filters, w * embedding
            np.add.at(g["e"], windows[rows, at].ravel(), back.reshape(-1, EMBEDDING))
        return g

    def fit(self, windows: np.ndarray, y: np.ndarray, weight_seed: int = 9) -> ByteNet:
        """Adam over shuffled batches; languages are drawn equally often."""
        rng = np.random.default_rng(weight_seed)
        m = {k: np.zeros_like(x) for k, x in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        share = 1.0 / np.bincount(y, minlength=len(self.languages))[y]
        steps = max(60, EPOCHS * len(y) // BATCH)
        for step in range(1, steps + 1):
            pick = rng.choice(len(y), BATCH, p=share / share.sum())
            rate = 0.01 * min(1.0, 2 * (1 - (step - 1) / steps))
            for k, g in self._gradients(windows[pick], y[pick]).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                              / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def predict(self, texts: list[bytes], step: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """(language index, probability) of each text, over all its windows."""
        windows, used = _bytes(texts)
        prob = np.concatenate([self._forward(windows[i:i + step])[3] for i in range(0, len(windows), step)])
        counts = [max(1, -(-len(t) // WINDOW)) for t in texts]
        starts = np.cumsum([0, *counts[:-1]])
        total = np.add.reduceat(prob * used[:, None], starts) / np.add.reduceat(used, starts)[:, None]
        best = total.argmax(axis=1)
        return best, np.clip(total[np.arange(len(texts)), best], 0.0, 1.0)


def held_out(id_column: str = "doc_id"):
    """Documents kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def train(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
          lang_column: str = "lang", seed: int = 3) -> ByteNet | None:
    """Fit the network; None when no document that may be learned from has a language.

    Learns from texts with a letter of rows with a language that are not held
    out. The sample holds about DOCS_PER_LANGUAGE documents of each language,
    chosen by a hash of the id, and WINDOWS_PER_DOC windows of each, from
    anywhere in its text.
    """
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("string").alias("id"), text.alias("text"),
                       F.col(lang_column).cast("string").alias("lang"),
                       held_out(id_column).alias("held")).where(
        "not held and lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000)) / 1_000_000.0
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, DOCS_PER_LANGUAGE / counts[lang]))).otherwise(share)
    picked = rows.where(draw < share).where(F.col("text").rlike(r"\p{L}"))
    starts = [F.pmod(F.xxhash64("id", F.lit(seed + 1 + k)), F.greatest(F.lit(1), F.length("text") - WINDOW)) + 1
              for k in range(WINDOWS_PER_DOC)]
    picked = picked.select("lang", "id", F.array(*[
        F.substr("text", s.cast("int"), F.lit(WINDOW)) for s in starts]).alias("parts"))
    sample = picked.limit(2 * DOCS_PER_LANGUAGE * len(languages)).collect()
    sample.sort(key=lambda r: (r["lang"], r["id"] or ""))
    pieces = [(p.encode()[:WINDOW], languages.index(r["lang"])) for r in sample for p in dict.fromkeys(r["parts"])]
    if not pieces:
        return None
    windows, _ = _bytes([p for p, _ in pieces])
    return ByteNet(languages).fit(windows, np.array([y for _, y in pieces]))


def predictor(net: ByteNet | None):
    """pandas UDF: text -> struct(lang, score); ``und`` and 0 for texts without a letter."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if t is not None and net is not None
                     and any(map(str.isalpha, t))]
            # some texts at a time, so that what is held does not grow with the batch
            for block in _blocks(known, texts):
                best, p = net.predict([texts.iloc[i].encode("utf-8", "surrogatepass") for i in block])
                for i, b, s in zip(block, best, p):
                    lang[i], score[i] = net.languages[b], s
            yield pd.DataFrame({"lang": lang, "score": score})
    return F.pandas_udf(run, "lang string, score double")


def _blocks(rows: list[int], texts: pd.Series, chars: int = 2_000_000):
    block, held = [], 0
    for i in rows:
        block.append(i)
        held += len(texts.iloc[i])
        if held >= chars:
            yield block
            block, held = [], 0
    if block:
        yield block


def identify(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
             lang_column: str = "lang") -> DataFrame:
    """One row per row: doc_id, held_out, lang_pred, score.

    A null text, an empty one or one without a letter is ``und`` with score 0,
    and so is every text when there is no language to learn. A null id is not
    held out. Languages are never inputs of a prediction.
    """
    require(docs, id_column, text_column, lang_column)
    predict = predictor(train(docs, id_column=id_column, text_column=text_column, lang_column=lang_column))
    return docs.select(F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"),
                       predict(F.col(text_column)).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, *, min_score: float = MIN_SCORE, id_column: str = "doc_id",
                    text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``docs`` without those whose text is in no known language: ``und``, or no
    language has ``min_score`` of the probability. Columns as they are."""
    require(docs, id_column, text_column, lang_column)
    predict = predictor(train(docs, id_column=id_column, text_column=text_column, lang_column=lang_column))
    marked = docs.withColumn("__language", predict(F.col(text_column)))
    return marked.where((F.col("__language.lang") != UNKNOWN) & (F.col("__language.score") >= min_score)
                        ).drop("__language")
