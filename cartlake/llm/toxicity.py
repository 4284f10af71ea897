"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity has grades 0 to 3. One weight per term is shared by all grades; ordered thresholds part the grades:
P(grade >= k) = sigmoid(w x - t_k). The expected severity is the sum of these chances.

Terms are whole words and the first letters of words, so that inflected forms of a word meet in one term.

Labels say toxic or not. The grade of a toxic text is learned from how many of the terms that mark toxic texts it
has, in thirds of the toxic training texts. Terms are counted over all training texts; weights and thresholds are
fitted in numpy on a bounded sample of them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import mapped, worker_cache
from cartlake.llm.decontaminate import normal
from cartlake.llm.quality import held_out, with_document

#: Labelled documents that weights are fitted on, at most.
SAMPLE = 20_000
#: Likelihood ratio that a term must reach, and toxic texts it must be in.
RATIO = 20.0
SUPPORT = 3
GRADES = 3
STEMS = (4, 5, 6)
#: Words a worker remembers, about 50 MB; the frequent ones come early.
KEPT = 300_000


@dataclass
class Model:
    terms: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, counts: dict[str, int]) -> np.ndarray:
        """P(grade >= k) for k from 1."""
        pull = sum(self.weights[self.terms[w]] * np.log1p(n) for w, n in sorted(counts.items()))
        return 1 / (1 + np.exp(-np.clip(pull - self.thresholds, -30, 30)))


def words_of(text: str | None) -> list[str]:
    return normal(text).decode("utf-8", "surrogatepass").split()


def terms_of(word: str) -> list[str]:
    """The word, and its first letters where there are more."""
    return [word] + [word[:n] + "*" for n in STEMS if len(word) > n]


def _term_counts(docs: DataFrame) -> DataFrame:
    """``(text, toxic)`` to texts and toxic texts per term; combined per batch before the shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        every, toxic = Counter(), Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(words_of(text))
            terms = words.union(*[[w[:n] + "*" for w in words if len(w) > n] for n in STEMS])
            every.update(terms)
            if label:
                toxic.update(terms)
        terms = list(every)
        return {"term": pa.array(terms, pa.string()), "n": pa.array([every[t] for t in terms], pa.int64()), "bad": pa.array([toxic[t] for t in terms], pa.int64())}

    return mapped(docs, run, "term string, n bigint, bad bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def telling_terms(docs: DataFrame) -> list[str]:
    """All terms that mark toxic texts of ``docs(text, toxic)``, the most telling first.

    More of them than the driver may hold end the run by ``spark.driver.maxResultSize``; none are left out.
    """
    totals = docs.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = totals.n, totals.bad or 0
    if not 0 < bad < n:
        return []
    a, b = F.col("bad"), F.col("n") - F.col("bad")
    c, d = bad - a, (n - bad) - b
    part = lambda seen, rows, cols: F.when(seen > 0, seen * F.log(seen * n / (rows * cols))).otherwise(0.0)
    ratio = 2 * (part(a, a + b, F.lit(bad)) + part(b, a + b, F.lit(n - bad)) + part(c, c + d, F.lit(bad)) + part(d, c + d, F.lit(n - bad)))
    found = _term_counts(docs).where((a >= SUPPORT) & (a * (n - bad) > b * bad)).withColumn("ratio", ratio).where(F.col("ratio") >= RATIO)
    return [r.term for r in sorted(found.select("term", "ratio").collect(), key=lambda r: (-r.ratio, r.term))]


class Finder:
    """Counts of a model's terms in texts."""

    def __init__(self, terms):
        self.terms = terms
        self.known: dict[str, tuple[str, ...]] = {}

    def _hits(self, word: str) -> tuple[str, ...]:
        if (own := self.known.get(word)) is None:
            own = tuple(t for t in terms_of(word) if t in self.terms)
            if len(self.known) < KEPT:
                self.known[word] = own
        return own

    def found(self, text: str | None) -> dict[str, int]:
        words = words_of(text)
        if not (hit := [w for w in set(words) if self._hits(w)]):
            return {}
        out, often = Counter(), Counter(words)
        for word in hit:
            for term in self._hits(word):
                out[term] += often[word]
        return dict(out)


def _finder(terms) -> Finder:
    key, finders = hash(tuple(terms)), worker_cache(__name__)
    if key not in finders:
        finders.clear()
        finders[key] = Finder(frozenset(terms))
    return finders[key]


def _featured(docs: DataFrame, terms: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batch: pa.RecordBatch) -> dict:
        place = {t: i for i, t in enumerate(shared.value)}
        find = _finder(shared.value).found
        found = [find(t) for t in batch.column("text").to_pylist()]
        ids = [sorted((place[w], n) for w, n in f.items()) for f in found]
        return {
            "doc_id": batch.column("doc_id"),
            "toxic": batch.column("toxic"),
            "ids": pa.array([[i for i, _ in x] for x in ids], pa.list_(pa.int32())),
            "counts": pa.array([[n for _, n in x] for x in ids], pa.list_(pa.int32())),
        }

    return mapped(docs, run, "doc_id bigint, toxic int, ids array<int>, counts array<int>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, steps: int = 600, ridge: float = 1e-4) -> Model:
    """Model of ``labels(doc_id, toxic 0/1)`` over the texts of ``docs(doc_id, text)``.

    Labels that are null or not 0 or 1, and labels without a document, teach nothing. Without toxic texts, or
    without others, there are no terms and every text gets the same severity, below the bar.
    """
    usable = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    # The labels grow with the corpus: the same plan at every size, texts are shuffled once and not sorted.
    texts = docs.select("doc_id", "text").join(usable.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "toxic")
    terms = telling_terms(texts.select("text", "toxic"))
    if not terms:
        return Model({}, np.zeros(0), np.array([3.0, 4.0, 5.0]))
    chosen = with_document(usable, docs).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    rows = _featured(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), terms).collect()
    rows.sort(key=lambda r: (r.doc_id, r.toxic, r.ids))
    amount = np.array([sum(r["counts"]) for r in rows], float)
    toxic = np.array([r.toxic for r in rows], bool)
    cuts = np.quantile(amount[toxic], [1 / 3, 2 / 3]) if toxic.any() else np.zeros(2)
    grade = np.where(toxic, 1 + (amount > cuts[0]) + (amount > cuts[1]), 0)
    row = np.repeat(np.arange(len(rows)), [len(r.ids) for r in rows])
    col = np.concatenate([np.array(r.ids, np.int64) for r in rows])
    val = np.log1p(np.concatenate([np.array(r["counts"], float) for r in rows]))
    weights, first, gaps = np.zeros(len(terms)), 2.0, np.zeros(GRADES - 1)
    over = (grade[:, None] >= np.arange(1, GRADES + 1)).astype(float)
    state = [(0.0, 0.0)] * 3
    for step in range(1, steps + 1):
        thresholds = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        pull = np.bincount(row, weights[col] * val, len(rows))
        error = 1 / (1 + np.exp(-np.clip(pull[:, None] - thresholds, -30, 30))) - over
        each = error.sum(axis=1) / len(rows)
        on_threshold = -error.sum(axis=0) / len(rows)
        slopes = [
            np.bincount(col, each[row] * val, len(terms)) + ridge * weights,
            np.array(on_threshold.sum()),
            np.exp(gaps) * np.array([on_threshold[k + 1 :].sum() for k in range(GRADES - 1)]),
        ]
        values = [weights, np.array(first), gaps]
        for k, slope in enumerate(slopes):  # steps of about the same length for frequent and rare terms
            m, v = (0.9 * state[k][0] + 0.1 * slope, 0.99 * state[k][1] + 0.01 * slope**2)
            state[k] = (m, v)
            values[k] = values[k] - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        weights, first, gaps = np.maximum(values[0], 0.0), float(values[1]), np.clip(values[2], -3, 3)
    return Model({t: i for i, t in enumerate(terms)}, weights, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, severity, grade, p_toxic, toxic)``, a row for each row, over whole texts.

    ``severity`` is the expected grade (0 to 3), ``grade`` the number of thresholds that are passed with a chance of
    a half or more, ``toxic`` whether the first is. A null or empty text has no terms. Null and repeated doc_ids are
    kept; an empty table gives an empty table; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        own = shared.value
        find = _finder(list(own.terms)).found
        chances = [own.chances(find(t)) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "severity": pa.array([float(c.sum()) for c in chances]), "grade": pa.array([int((c >= 0.5).sum()) for c in chances], pa.int32()), "p_toxic": pa.array([float(c[0]) for c in chances])}

    out = mapped(docs.select("doc_id", "text"), run, "doc_id bigint, severity double, grade int, p_toxic double")
    return out.withColumn("toxic", F.col("p_toxic") >= 0.5)


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the labels that are not held out, as for the quality classifier."""
    return fit(docs, labels.where(~held_out()).select("doc_id", "toxic"))


def deny(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model rejects, judged in place: no shuffle; all columns stay as they are."""
    schema = docs.schema

    def run(batches):
        find = _finder(list(model.terms)).found
        for batch in batches:
            keep = [model.chances(find(t))[0] < 0.5 for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
