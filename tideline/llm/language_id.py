"""Language identification by a byte convolutional network, trained in numpy and applied in batches.

Bytes with A-Z lower-cased are embedded, filters of several widths slide over windows of fixed
length, each filter keeps its greatest response in the window, and a softmax layer names the
language. A document's answer is the mean over all its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import tokens, words

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Bound of the training sample: documents per language, and windows of each.
SAMPLE_DOCUMENTS = 800
SAMPLE_WINDOWS = 6
#: A language's rows compete within parts first, so that the last rank sees at most 8 times the sample, whatever the table.
SAMPLE_PARTS = (256, 8, 1)
UNKNOWN = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Model:
    """``first``: responses of filters to pairs of bytes; ``third`` and ``later`` complete the wider ones."""

    languages: list[str]
    first: np.ndarray
    third: np.ndarray
    later: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def windows(self, bytes_: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for rows of ``WINDOW`` bytes."""
        pairs = bytes_[:, :-1].astype(np.int32) * 256 + bytes_[:, 1:]
        steps, n = WINDOW - max(WIDTHS) + 1, FILTERS
        response = self.first.take(pairs[:, :steps], axis=0)
        response[:, :, n : 2 * n] += self.third.take(bytes_[:, 2 : 2 + steps], axis=0)
        response[:, :, 2 * n :] += self.later.take(pairs[:, 2 : 2 + steps], axis=0)
        return _softmax(np.maximum(response.max(axis=1), 0) @ self.weights + self.bias)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _window_rows(texts: list[bytes]) -> np.ndarray:
    rows = np.zeros((len(texts), WINDOW), np.uint8)
    for row, text in zip(rows, texts):
        part = np.frombuffer(text[:WINDOW], np.uint8)
        row[: len(part)] = _LOWER[part]
    return rows


def train(texts: list[bytes], languages: list[str], steps: int = 1200, batch: int = 64, seed: int = 1) -> Model | None:
    """Fit the network to labelled windows by Adam; the result is the same for the same input.

    Windows are cut to random lengths now and then, so that short texts are known too.
    """
    names = sorted(set(languages))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    x, y = _window_rows(texts), np.searchsorted(names, languages)
    by_language = [np.flatnonzero(y == i) for i in range(len(names))]
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING))}
    for w in WIDTHS:
        p[f"w{w}"] = rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names)))
    p["bias"] = np.zeros(len(names))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    positions = WINDOW - max(WIDTHS) + 1
    for step in range(1, steps + 1):
        picked = np.array([rng.choice(by_language[i]) for i in rng.integers(0, len(names), batch)])
        rows, target = x[picked].copy(), y[picked]
        for i in np.flatnonzero(rng.random(batch) < 0.3):
            rows[i, rng.integers(6, WINDOW) :] = 0
        embedded = p["e"][rows]
        pooled, kept = [], {}
        for w in WIDTHS:
            runs = np.concatenate([embedded[:, j : j + positions] for j in range(w)], axis=2)
            response = runs @ p[f"w{w}"] + p[f"b{w}"]
            best = response.argmax(axis=1)
            value = np.take_along_axis(response, best[:, None], 1)[:, 0]
            kept[w] = runs, best, value
            pooled.append(np.maximum(value, 0))
        pooled = np.concatenate(pooled, axis=1)
        error = _softmax(pooled @ p["out"] + p["bias"])
        error[np.arange(batch), target] -= 1
        error /= batch
        grad = {"out": pooled.T @ error, "bias": error.sum(0), "e": np.zeros_like(p["e"])}
        back = error @ p["out"].T
        for i, w in enumerate(WIDTHS):
            runs, best, value = kept[w]
            g = back[:, i * FILTERS : (i + 1) * FILTERS] * (value > 0)
            at = runs[np.arange(batch)[:, None], best]  # what each filter responded to most
            grad[f"w{w}"] = np.einsum("bfk,bf->kf", at, g)
            grad[f"b{w}"] = g.sum(0)
            into = np.einsum("kf,bf->bfk", p[f"w{w}"], g).reshape(batch, FILTERS, w, EMBEDDING)
            for j in range(w):
                np.add.at(grad["e"], rows[np.arange(batch)[:, None], best + j], into[:, :, j])
        for k in p:
            mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
            square[k] = 0.999 * square[k] + 0.001 * grad[k] ** 2
            p[k] -= 0.01 * (1 - 0.9 * step / steps) * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return _tables(p, names)


def _tables(p: dict[str, np.ndarray], names: list[str]) -> Model:
    """The trained filters as sums over tables of bytes and pairs of bytes."""
    by_byte = {(w, j): p["e"] @ p[f"w{w}"][j * EMBEDDING : (j + 1) * EMBEDDING] for w in WIDTHS for j in range(w)}

    def pair(w, j):
        return (by_byte[w, j][:, None] + by_byte[w, j + 1][None]).reshape(65536, FILTERS)

    first = np.concatenate([pair(w, 0) + p[f"b{w}"] for w in WIDTHS], axis=1)
    parts = first, by_byte[3, 2], pair(4, 2), p["out"], p["bias"]
    return Model(names, *(np.ascontiguousarray(x, np.float32) for x in parts))


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Train on a bounded sample of the labelled rows whose id's CRC-32 leaves another remainder than 1.

    Per language the ``SAMPLE_DOCUMENTS`` rows with the least id hash are taken, whatever the table's
    size, with ``SAMPLE_WINDOWS`` windows spread over each text. None if no row is labelled.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    chosen = rows.select("id", "lang")
    for parts in SAMPLE_PARTS:
        part = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(parts))
        order = Window.partitionBy("lang", part).orderBy(F.xxhash64("id"), "id")
        chosen = chosen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_DOCUMENTS).drop("rank")
    # At most SAMPLE_DOCUMENTS rows a language.
    sample = rows.join(F.broadcast(chosen.select("id", "lang")), ["id", "lang"])
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)),
        lambda i: F.substring(F.col("text"), F.floor(i * F.length("text") / SAMPLE_WINDOWS).cast("int") + 1, F.lit(WINDOW)),
    )
    found = sample.select("id", "lang", F.explode(F.array_distinct(spread)).alias("window")).filter(F.col("window").rlike(r"\p{L}"))
    found = sorted((r.lang, r.id, r.window) for r in found.collect())
    model = train([w.encode() for _, _, w in found], [lang for lang, _, _ in found])
    tokens.trim()  # the driver lives on
    return model


def _predict(model: Model | None):
    def of_slice(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of each row; every byte is in one window."""
        sizes = np.diff(offsets)
        counts = np.maximum(-(-sizes // WINDOW), 1)
        first = np.concatenate([[0], np.cumsum(counts)])
        rows = np.zeros(first[-1] * WINDOW, np.uint8)
        for a, b, at in zip(offsets[:-1], offsets[1:], first * WINDOW):
            rows[at : at + b - a] = _LOWER[data[a:b]]
        rows = rows.reshape(-1, WINDOW)
        got = np.concatenate([model.windows(rows[i : i + 64]) for i in range(0, len(rows), 64)])
        weight = np.full(len(rows), float(WINDOW))
        weight[first[1:] - 1] = np.maximum(sizes - (counts - 1) * WINDOW, 1)
        total = np.add.reduceat(got * weight[:, None], first[:-1], axis=0)
        return total / np.add.reduceat(weight, first[:-1])[:, None]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens.forget()
        for texts in batches:
            known = texts.is_valid().to_numpy(zero_copy_only=False) & bool(model)
            data, offsets = words.utf8(texts)
            best, score = np.zeros(len(known), np.int64), np.zeros(len(known))
            for lo, hi in words.slices(offsets) if model else ():
                mean = of_slice(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                best[lo:hi], score[lo:hi] = mean.argmax(axis=1), mean.max(axis=1)
            names = np.array([*(model.languages if model else []), UNKNOWN], object)
            named = names[np.where(known, best, len(names) - 1)]
            columns = [pa.array(named, pa.string()), pa.array(np.where(known, np.clip(score, 0, 1), 0.0))]
            yield pa.StructArray.from_arrays(columns, names=["lang_pred", "score"])

    return F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()


def identify(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``: the language of each whole text and its probability.

    ``und`` with score 0 for a null text, a text without a letter, or without a model. Only the text
    is looked at. Repeated rows get the same answer; of languages equally likely the first in
    order of names is given. Input columns called ``lang_pred`` or ``score`` are replaced.
    """
    words.small_batches(df.sparkSession)
    names = [c for c in df.columns if c not in {"lang_pred", "score"}]
    text = F.col(f"`{text_col}`")
    # Only texts go to Python and only answers come back; nondeterministic, so that filters on both do not ask twice.
    answer = _predict(model)(F.when(text.rlike(r"\p{L}"), text))
    rows = df.select(*[f"`{c}`" for c in names], answer.alias("_li_answer"))
    return rows.select(*[f"`{c}`" for c in names], "_li_answer.lang_pred", "_li_answer.score")
