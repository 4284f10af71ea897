"""Quality classifier of supervised subword embeddings.

Every word and every character n-gram of it has a learned vector, found by hash. A document is the mean of the
vectors of its whole text; a softmax layer on the mean gives the classes. Vectors and layer are trained by
stochastic gradient descent in numpy on a bounded sample of labelled documents. Once trained, a feature adds one
number to a document's logit, so scoring keeps a sum and a count per word.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import mapped, worker_cache

#: Labelled documents the model is fitted on at most: the first by a hash of the doc_id.
SAMPLE = 3_000
BUCKETS = 2**16
DIMENSIONS = 8
NGRAMS = (3, 4, 5)
EPOCHS = 12
RATE = 1.0
#: Words a worker remembers, about 90 MB; the frequent ones come early.
KEPT = 600_000
HELD_OUT = 2


def features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams, with marks for its ends."""
    marked = f"<{word}>"
    parts = [marked] + [marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1) if n < len(marked)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows whose labels are never learned from; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def with_document(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """The labels whose doc_id ``docs`` has: others must not use up a sample. One plan at every size."""
    return labels.join(docs.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")


@dataclass
class Model:
    """``adds[b]``: what a feature of bucket ``b`` adds to the logit, before the mean."""

    adds: np.ndarray
    bias: float

    def score(self, total: float, count: float) -> float:
        logit = self.bias + (total / count if count else 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def _counted(docs: DataFrame) -> DataFrame:
    """``(doc_id, label, text)`` to hashed feature counts, as arrays in bytes."""

    def run(batch: pa.RecordBatch) -> dict:
        ids, shares = [], []
        for text in batch.column("text").to_pylist():
            found, counts = np.unique(np.array([b for w in (text or "").lower().split() for b in features(w)], np.int64), return_counts=True)
            ids.append(found.astype("<u2").tobytes())
            shares.append((counts / max(1, counts.sum())).astype("<f4").tobytes())
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "ids": pa.array(ids, pa.binary()), "shares": pa.array(shares, pa.binary())}

    return mapped(docs, run, "doc_id bigint, label int, ids binary, shares binary")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 11) -> Model:
    """Model of ``labels(doc_id, label 0/1)`` over the texts of ``docs(doc_id, text)``.

    Labels that are null or not 0 or 1, and labels without a document, teach nothing. With no document of one of the
    classes the model says the other class's share, with none at all a half.
    """
    usable = labels.where("doc_id is not null and label in (0, 1)").select("doc_id", "label").distinct()
    chosen = with_document(usable, docs).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = _counted(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.ids))
    good = sum(r.label for r in rows)
    bias = math.log((good + 0.5) / (len(rows) - good + 0.5))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer = np.zeros((DIMENSIONS, 2))
    shift = np.array([0.0, bias])
    data = [(np.frombuffer(r.ids, "<u2").astype(np.int64), np.frombuffer(r.shares, "<f4").astype(float), r.label) for r in rows]
    steps = EPOCHS * len(data) if 0 < good < len(rows) else 0
    order = np.concatenate([rng.permutation(len(data)) for _ in range(EPOCHS)]) if steps else []
    for step, at in enumerate(order):
        ids, shares, label = data[at]
        rate = RATE * (1 - step / steps)
        own = vectors[ids]
        mean = shares @ own
        logits = mean @ layer + shift
        chance = np.exp(logits - logits.max())
        wrong = chance / chance.sum()
        wrong[label] -= 1
        back = layer @ wrong
        layer -= rate * np.outer(mean, wrong)
        shift -= 0.1 * rate * wrong
        # Shares are small, so the vectors' rate is a multiple: every document moves its mean by about the same.
        vectors[ids] = own - rate * np.outer(shares / max(float(shares @ shares), 1e-9), back) * 0.5
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(shift[1] - shift[0]))


def scored(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, held_out, score, predicted)``, a row for each row, over whole texts.

    A null or empty text has no features and gets the model's bias. Null and repeated doc_ids are kept (a null one is
    not held out); an empty table gives an empty table; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.adds.astype(np.float64), model.bias))  # 512 KB
    key = f"{zlib.crc32(model.adds.tobytes())}-{model.bias}"

    def run(batch: pa.RecordBatch) -> dict:
        adds, bias = shared.value
        words_of = worker_cache(__name__)
        if key not in words_of:
            words_of.clear()
        known, own = words_of.setdefault(key, {}), Model(adds, bias)

        def worth(word: str) -> complex:
            """Sum of what the features add, and (imaginary) their number."""
            ids = features(word)
            out = complex(float(adds[ids].sum()), len(ids))
            if len(known) < KEPT:
                known[word] = out
            return out

        scores = []
        for text in batch.column("text").to_pylist():
            words = (text or "").lower().split()
            found = list(map(known.get, words))
            total = sum(worth(w) if x is None else x for w, x in zip(words, found)) if None in found else sum(found)
            scores.append(own.score(complex(total).real, complex(total).imag))
        return {"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())}

    out = mapped(docs.select("doc_id", "text"), run, "doc_id bigint, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all ``docs`` by a model of ``labels(doc_id, quality)``, learned from labels that are not held out."""
    known = labels.where(~held_out()).select("doc_id", F.col("quality").cast("int").alias("label"))
    return scored(docs, fit(docs, known))
