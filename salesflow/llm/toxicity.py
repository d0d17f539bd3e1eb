"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the presence of hashed character n-grams in a text. The ratio of an n-gram is the log
of its smoothed share among toxic texts over that among the others; a logistic regression is
trained by full gradient steps on the presences scaled by these ratios. N-grams that are rare in
the sample or lean to neither side carry no signal and get no weight, so the score of a long
clean text does not drift.

The model is fitted on a bounded sample of labelled documents (``SAMPLE_ROWS``, half of it toxic
where there are enough), weighted back to the shares of all labelled rows. Scoring reads whole
texts in Arrow tasks, without a shuffle.

Defined results: null and empty texts get the score of a text without features; without labelled
rows of both kinds every score is the share of toxic labels (0 without any); every input row
gives one row; a doc_id with different labels counts with each, repeated labels and repeated rows count once; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from salesflow.llm.ngrams import grams
from salesflow.session import stage

SAMPLE_ROWS = 4000
SIZES = (4, 6, 9)
THRESHOLD = 0.7
_SIEVE = 1 << 20


@dataclass(frozen=True)
class Model:
    """Sorted hashes of the weighted n-grams, their weights, and the bias."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float


def _split(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return code >> 32, code & 0xFFFFFFFF


def _distinct(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash) of the n-grams of a piece of the texts, once per block."""
    for _, owner, value in grams(texts, SIZES):
        yield _split(np.unique((owner.astype(np.int64) << 32) | value.astype(np.int64)))


def presences(texts: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in ``wanted``, which is sorted) once for every wanted n-gram that a text holds."""
    codes = [np.zeros(0, np.int64)]
    sieve = np.zeros(_SIEVE, bool)
    sieve[wanted % np.uint32(_SIEVE)] = True
    for _, owner, value in grams(texts, SIZES):
        near = np.flatnonzero(sieve[value & np.uint32(_SIEVE - 1)])
        owner, value = owner[near], value[near]
        place = np.searchsorted(wanted, value)
        hit = np.flatnonzero(wanted[np.minimum(place, len(wanted) - 1)] == value)
        codes.append(np.unique((owner[hit].astype(np.int64) << 32) | place[hit]))
    return _split(np.unique(np.concatenate(codes)))


def fit(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, least_docs: int = 4,
        least_gain: float = 10.83, least_ratio: float = 2.0, smooth: float = 1.0, l2: float = 1e-4,
        steps: int = 1000) -> Model:
    """Ratios, then a weighted logistic regression on the scaled presences.

    An n-gram needs ``least_docs`` texts, and a likelihood ratio against the share of toxic texts
    of ``least_gain`` (chi-squared, one degree of freedom): labels are noisy, and an n-gram of a few
    mixed texts would only learn their noise. Neither grows with the texts of other languages.
    """
    toxic = labels == 1
    share = float(np.average(toxic, weights=weights)) if len(labels) else 0.0
    if not toxic.any() or toxic.all():
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(0, np.uint32), np.zeros(0), float(np.log(share / (1 - share))))

    def ratios(with_it: np.ndarray, without: np.ndarray) -> np.ndarray:
        return np.log(((with_it + smooth) / (toxic.sum() + 2 * smooth))
                      / ((without + smooth) / ((~toxic).sum() + 2 * smooth)))

    def gain(with_it: np.ndarray, docs: np.ndarray) -> np.ndarray:
        base = toxic.mean()
        return 2 * sum(n * np.log(np.maximum(n, 1) / (docs * p))
                       for n, p in ((with_it, base), (docs - with_it, 1 - base)))

    # first by buckets of hashes, so that only promising n-grams are held for all texts
    counts = np.zeros((2, _SIEVE), np.int64)
    for owner, code in _distinct(texts):
        for side in (0, 1):
            counts[side] += np.bincount(code[toxic[owner] == side] % _SIEVE, minlength=_SIEVE)
    promising = (counts.sum(axis=0) >= least_docs) & (np.abs(ratios(counts[1], counts[0])) >= least_ratio / 2)
    owner, code = (np.concatenate(x) for x in zip(*(
        (o[promising[c % _SIEVE]], c[promising[c % _SIEVE]]) for o, c in _distinct(texts)), strict=True))
    owner, code = _split(np.unique((owner << 32) | code))
    hashes, place, docs = np.unique(code, return_inverse=True, return_counts=True)
    with_it = np.bincount(place, weights=toxic[owner], minlength=len(hashes))
    ratio = ratios(with_it, docs - with_it)
    used = np.flatnonzero((docs >= least_docs) & (np.abs(ratio) >= least_ratio)
                          & (gain(with_it, docs) >= least_gain))
    new = np.full(len(hashes), -1)
    new[used] = np.arange(len(used))
    keep = np.flatnonzero(new[place] >= 0)
    row, col = owner[keep], new[place[keep]]
    scale = ratio[used]
    value = scale[col]
    w, b = np.zeros(len(used)), float(np.log(share / (1 - share)))
    each = weights / weights.sum()
    # gradient descent with momentum; the step follows the largest curvature (squared row norms)
    norms = np.bincount(row, weights=value * value, minlength=len(labels)) + 1
    rate = 4.0 / max(float(np.average(norms, weights=each)), 1.0)
    speed_w, speed_b = np.zeros_like(w), 0.0
    for _ in range(steps):
        z = np.bincount(row, weights=value * w[col], minlength=len(labels)) + b
        wrong = each * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - toxic)
        speed_w = 0.9 * speed_w - rate * (np.bincount(
            col, weights=value * wrong[row], minlength=len(used)) + l2 * w)
        speed_b = 0.9 * speed_b - rate * wrong.sum()
        w, b = w + speed_w, b + speed_b
    return Model(hashes[used].astype(np.uint32), w * scale, b)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, **params) -> Model:
    """Fit on about ``rows`` labelled documents, chosen by a hash of their id and text.

    ``docs`` (doc_id, text), ``labels`` (doc_id, toxic): both already without held-out rows. Equal labels of an
    id count once, and so do equal texts of an id; an id with many texts is as likely as any of them.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    mark = F.xxhash64(F.lit(7), "text").alias("mark")
    cases = stage(docs.select(F.col("doc_id").alias("id"), mark).distinct().join(known, "id"), "labelled")
    totals = {r["toxic"]: r["n"] for r in cases.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic_rows = min(rows // 2, totals.get(1, 0))
    share = {1: toxic_rows / max(totals.get(1, 0), 1),
             0: min(1.0, (rows - toxic_rows) / max(totals.get(0, 0), 1))}
    spot = F.pmod(F.xxhash64(F.lit(13), "id", "mark"), F.lit(1 << 30))
    bound = F.when(F.col("toxic") == 1, int(share[1] * (1 << 30))).otherwise(int(share[0] * (1 << 30)))
    chosen = cases.filter(spot < bound).orderBy(spot, "id", "mark", "toxic").limit(2 * rows)
    text = docs.select(F.col("doc_id").alias("id"), "text", mark)
    # a broadcast of at most 2 * ``rows`` ids: no text is shuffled but the sample's
    table = text.join(F.broadcast(chosen), ["id", "mark"]).select("id", "text", "toxic").distinct().select(
        "text", "toxic").toArrow()
    table = table.take(pc.sort_indices(table, [("text", "ascending"), ("toxic", "ascending")]))
    texts = pa.concat_arrays(table.column("text").chunks) if len(table) else pa.array([], pa.string())
    labels_ = np.asarray(table.column("toxic")).astype(np.int64)
    weights = np.where(labels_ == 1, 1 / max(share[1], 1e-9), 1 / max(share[0], 1e-9))
    return fit(texts, labels_, weights, **params)


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    total = np.full(len(texts), model.bias)
    if len(model.hashes):
        owner, place = presences(texts, model.hashes)
        total += np.bincount(owner, weights=model.weights[place], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``__score``, the chance of label 1, for every row; the name must be free."""
    if "__score" in docs.columns:
        raise ValueError("docs has a column __score already")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    place = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(score_texts(batch.column(place), shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores],
                                             names=[*batch.schema.names, "__score"])

    return docs.mapInArrow(task, StructType([*docs.schema.fields, StructField("__score", DoubleType())]))
