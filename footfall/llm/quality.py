"""Quality from compression: which dictionary shortens a text more.

One zstandard dictionary is trained on texts labelled good, one on texts
labelled bad. A text is compressed whole with either. Logistic regression turns
the difference of the two sizes, over the length of the text and as a log ratio,
together with the smaller size over the length, into the probability of label 1.

Edge cases: a null text scores as an empty one, and an empty one gets what the
calibration says of equal sizes. Without texts of both labels every score is
the share of label 1, or 0.5 where nothing is labelled. Labels that contradict
each other, and null ids or labels, are not learned from. Repeated rows get the
same score each; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled texts per class that are learned from, and the longest of them in characters.
SAMPLE = 1000
LONGEST = 8000
#: Bytes of each dictionary, and the compression level.
DICTIONARY = 256 << 10
LEVEL = 3
#: Folds of the sample for the calibration.
FOLDS = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_AUTO if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=kind)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False)


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, texts, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:DICTIONARY] or b"-" * 8


def _sizes(good, bad, texts: list[bytes]) -> np.ndarray:
    out = np.empty((len(texts), 3))
    for i, text in enumerate(texts):
        a, b = len(bad.compress(text)), len(good.compress(text))
        out[i] = (a - b) / max(1, len(text)), np.log((a + 8) / (b + 8)), min(a, b) / (len(text) + 20)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(quality, text)`` of at most ``sample`` labelled texts a class, one from each hash bucket of ids."""
    sure = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
    )
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(sample)).alias("bucket")
    chosen = sure.groupBy("quality", bucket).agg(F.min("doc_id").alias("doc_id")).select("doc_id", "quality")
    short = docs.select("doc_id", "text").where(F.length("text").between(1, LONGEST))
    # At most two classes x sample ids: small whatever the corpus is.
    return short.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "quality", "text")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Dictionaries from the whole sample; calibration on texts that the dictionaries of their fold have not seen.

    Classes count in the calibration by how frequent they are among all labels.
    """
    rows = sorted(training_rows(docs, labels, sample).collect(), key=lambda r: r.doc_id)
    totals = {r.quality: r["count"] for r in labels.where(F.col("quality").isNotNull()).groupBy("quality").count().collect()}
    prior = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    texts = {q: [r.text.encode() for r in rows if r.quality == q] for q in (0, 1)}
    if min(map(len, texts.values())) < FOLDS:
        return Model(b"", b"", np.zeros(3), np.ones(3), np.zeros(4), prior)
    x, y, weight = [], [], []
    for fold in range(FOLDS):
        seen = {q: [t for i, t in enumerate(texts[q]) if i % FOLDS != fold] for q in (0, 1)}
        tools = _compressor(_dictionary(seen[1])), _compressor(_dictionary(seen[0]))
        for q in (0, 1):
            held = texts[q][fold::FOLDS]
            x.append(_sizes(*tools, held))
            y += [float(q)] * len(held)
            weight += [totals[q] / len(texts[q])] * len(held)
    x, y, weight = np.concatenate(x), np.array(y), np.array(weight)
    mean, spread = x.mean(0), x.std(0) + 1e-9
    weights = _logistic((x - mean) / spread, y, weight / weight.mean())
    return Model(_dictionary(texts[1]), _dictionary(texts[0]), mean, spread, weights, prior)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the last weight is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        w = w + step / max(1.0, np.abs(step).max())
    return w


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``score``, from the whole ``text`` alone."""

    def run(batches):
        tools = (_compressor(model.good), _compressor(model.bad)) if model.good else None
        for batch in batches:
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            if tools:
                x = np.c_[(_sizes(*tools, texts) - model.mean) / model.spread, np.ones(len(texts))]
                scores = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
            else:
                scores = np.full(len(texts), float(model.prior))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores)], [*keep, "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, score double")
