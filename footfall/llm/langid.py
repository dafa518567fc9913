"""Language identification with a string kernel.

A text is the set of its n-grams of one to four UTF-8 bytes (a blended
spectrum, presence only), hashed to a fixed number of cells. The kernel of two
texts is the size of the intersection over the root of the product of sizes.
Landmark texts span the Nystroem space, kernel ridge regression against the
rest gives one column of weights per language, and a batch of texts is scored
with two matrix products: presence x landmarks, kernel x weights.

Edge cases: a text that is null or has no letter is ``und`` with score 0. With
no labelled text everything is ``und``. Repeated rows get the same answer each.
Ties go to the language first in code-point order. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.frames import map_rows
from footfall.llm.words import LOWER, mix, pieces

#: Cells that n-grams are hashed to.
CELLS = 1 << 14
ORDERS = (1, 2, 3, 4)
#: Most training texts per language, and most of them that become landmarks.
SAMPLE = 384
LANDMARKS = 32
RIDGE = 1e-3
UNKNOWN = "und"
#: Texts scored in one matrix product.
BLOCK = 256

_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    """Landmarks as packed bits, weights landmark x language, languages in order."""

    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray
    languages: tuple[str, ...]


def _presence(data: np.ndarray, bounds: np.ndarray, low: int, high: int) -> np.ndarray:
    """Presence matrix, text x cell, of the texts ``low`` to ``high``."""
    found = np.zeros((high - low, CELLS), bool)
    a, b = int(bounds[low]), int(bounds[high])
    # Letters keep their bytes; all else is one kind of gap, so digits, marks and line ends do not count.
    own = LOWER[data[a:b]]
    own = np.where((own >= 97) & (own <= 122) | (own >= 128), own, 32).astype(np.uint64)
    row = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
    code = np.zeros(len(own), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(own) < n:
            break
        code = (code[: len(own) - n + 1] << np.uint64(8)) | own[n - 1 :]
        if n in ORDERS:
            same = row[: len(code)] == row[n - 1 :]
            found[row[: len(code)][same], (mix(code[same], n) & np.uint64(CELLS - 1)).astype(np.int64)] = True
    return found


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    for low, high, data, bounds in pieces(texts):
        for a in range(0, high - low, BLOCK):
            b = min(a + BLOCK, high - low)
            yield low + a, low + b, _presence(data, bounds, a, b)


def _features(batches):
    for batch in batches:
        for low, high, found in _blocks(batch.column("text")):
            bits = np.packbits(found, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").slice(low, high - low), pa.array([x.tobytes() for x in bits], pa.binary())],
                ["lang", "bits"],
            )


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` texts of each language: of every hash bucket the least hash.

    The choice depends on the text alone. It is an aggregation of one number
    per language and bucket, so a frequent language is combined map side.
    """
    hashed = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("text"))
    least = hashed.groupBy("lang", F.pmod("h", F.lit(sample)).alias("bucket")).agg(F.min("h").alias("h"))
    chosen = least.select("lang", "h")  # at most languages x sample rows
    return hashed.select("lang", "text", "h").join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"])


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Learn from ``text`` and ``lang`` of ``docs``; None where nothing is labelled."""
    picked = training_rows(docs.select("text", "lang"), sample).select("lang", "text")
    rows = picked.mapInArrow(_features, "lang string, bits binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.bits))
    languages = tuple(sorted({r.lang for r in rows}))
    found = np.unpackbits(np.stack([np.frombuffer(r.bits, np.uint8) for r in rows]), axis=1).astype(np.float32)
    labels = np.array([languages.index(r.lang) for r in rows])
    # Landmarks of each language: evenly spread over its texts by size, so that short ones count.
    picks = []
    for k in range(len(languages)):
        own = np.flatnonzero(labels == k)
        own = own[np.argsort(found[own].sum(1), kind="stable")]
        picks.extend(own[np.unique(np.linspace(0, len(own) - 1, landmarks).astype(int))])
    marks = found[picks]
    norms = np.sqrt(np.maximum(marks.sum(1), 1))
    own = np.sqrt(np.maximum(found.sum(1), 1))
    kernel = (found @ marks.T / own[:, None] / norms).astype(float)
    values, vectors = np.linalg.eigh(kernel[picks])
    keep = values > 1e-6 * values.max()
    project = vectors[:, keep] / np.sqrt(values[keep])  # K_mm^-1/2
    space = kernel @ project
    target = (labels[:, None] == np.arange(len(languages))).astype(float)
    per_class = np.sqrt(1 / np.maximum(target.sum(0), 1))[labels]  # languages weigh the same
    a, y = space * per_class[:, None], target * per_class[:, None]
    weights = np.linalg.solve(a.T @ a + ridge * np.eye(a.shape[1]), a.T @ y)
    return Model(np.packbits(marks.astype(bool), axis=1), norms, project @ weights, languages)


def _has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def classify(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, scores
    marks = np.unpackbits(model.landmarks, axis=1).astype(np.float32).T
    wordy = [_has_letter(t) for t in texts.to_pylist()]
    for low, high, found in _blocks(texts):
        found = found.astype(np.float32)
        kernel = found @ marks / np.sqrt(np.maximum(found.sum(1), 1))[:, None] / model.norms
        out = np.clip(kernel @ model.weights, 1e-6, None)
        best = out.argmax(1)
        share = out[np.arange(len(out)), best] / out.sum(1)
        for i in range(high - low):
            if wordy[low + i]:
                names[low + i] = model.languages[best[i]]
                scores[low + i] = min(1.0, share[i])
    return names, scores


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``; only ``text`` is looked at."""

    def run(batches):
        for batch in batches:
            names, scores = classify(model, batch.column("text"))
            columns = [batch.column(c) for c in keep] + [pa.array(names), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    read = docs.select(*dict.fromkeys([*keep, "text"]))
    return read.mapInArrow(run, f"{fields}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with all columns, without the texts that are ``und``; a null ``lang`` becomes the prediction.

    Without a model, as no row told a language, texts with a letter stay as they are.
    """
    names = docs.columns

    def run(batches):
        for batch in batches:
            found, _ = classify(model, batch.column("text"))
            if model is None:
                known = pa.array([_has_letter(t) for t in batch.column("text").to_pylist()], pa.bool_())
                yield batch.filter(known)
                continue
            known = pa.array([x != UNKNOWN for x in found], pa.bool_())
            columns = [
                pc.coalesce(batch.column(n), pa.array(found, batch.schema.field(n).type)) if n == "lang" else batch.column(n)
                for n in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names).filter(known)

    return map_rows(docs, run, docs.schema)
