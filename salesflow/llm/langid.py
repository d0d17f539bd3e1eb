"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its hashed character n-grams; a linear layer and a
softmax give the language. Both are trained together by mini-batch stochastic gradient descent in
numpy, on a bounded sample of labelled documents (``SAMPLE_ROWS``). One fifth of that sample
calibrates: a temperature that minimises the log loss, and the confidence below which a prediction
counts as rejected, chosen so that what is accepted reaches ``precision``.

At prediction the embeddings and the layer are folded into one table of logits per n-gram, a few
hundred kB whatever the corpus, and whole texts are scored in Arrow tasks without a shuffle.

Defined results: null texts and texts without a letter give ``und`` with score 0; without any
labelled row every text is ``und``; every input row gives one row; ties go to the first language
in alphabetical order; columns other than those named are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.ngrams import grams

SAMPLE_ROWS = 3000
SIZES = (2, 3, 4)
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """``logits``: buckets x languages; ``bias``; temperature; the confidence asked for."""

    languages: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float


def _bags(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, share of the text's n-grams) of every bucket that a text uses."""
    codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, owner, value in grams(texts, SIZES):
        code, n = np.unique(owner.astype(np.int64) * buckets + value % np.uint32(buckets),
                            return_counts=True)
        codes.append(code)
        counts.append(n)
    code, place = np.unique(np.concatenate(codes), return_inverse=True)
    count = np.bincount(place, weights=np.concatenate(counts), minlength=len(code))
    owner = code // buckets
    total = np.bincount(owner, weights=count, minlength=len(texts))
    return owner, code % buckets, (count / total[owner]).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: pa.Array, langs: list[str], held: np.ndarray, buckets: int = 1 << 15, dim: int = 16,
        epochs: int = 6, rate: float = 10.0, precision: float = 0.99, seed: int = 7) -> Model:
    """Train on the rows outside ``held``, calibrate on those inside (on all, if there are none)."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return Model((), np.zeros((buckets, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    layer = rng.normal(0, 0.1, (dim, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    label = np.searchsorted(np.array(languages), np.array(langs))
    owner, bucket, share = _bags(texts, buckets)
    begin = np.searchsorted(owner, np.arange(len(langs) + 1))
    train = np.flatnonzero(~held & (np.diff(begin) > 0))
    if not len(train):
        train = np.flatnonzero(np.diff(begin) > 0)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 32)):
            if not len(part):
                continue
            take = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in part])
            which = np.repeat(np.arange(len(part)), begin[part + 1] - begin[part])
            cuts = np.searchsorted(which, np.arange(len(part)))
            mean = np.add.reduceat(emb[bucket[take]] * share[take, None], cuts)
            wrong = _softmax(mean @ layer + bias)
            wrong[np.arange(len(part)), label[part]] -= 1
            wrong /= len(part)
            back = wrong @ layer.T
            layer -= 0.1 * step * mean.T @ wrong
            bias -= 0.1 * step * wrong.sum(axis=0)
            used, place = np.unique(bucket[take], return_inverse=True)
            grad = back[which] * share[take, None]
            change = np.stack([np.bincount(place, weights=grad[:, k], minlength=len(used))
                               for k in range(dim)], axis=1)
            emb[used] -= (step * len(part) * change).astype(np.float32)
    logits = emb @ layer
    check = np.flatnonzero(held & (np.diff(begin) > 0))
    check = check if len(check) else train
    scores = _weigh(owner, bucket, share, logits, len(langs))[check] + bias
    grid = np.geomspace(0.05, 20, 61)
    losses = [-np.log(_softmax(scores / t)[np.arange(len(check)), label[check]] + 1e-12).mean()
              for t in grid] if len(check) else [0.0]
    temperature = float(grid[int(np.argmin(losses))]) if len(check) else 1.0
    least = 0.0
    if len(check):
        chance = _softmax(scores / temperature)
        sure, right = chance.max(axis=1), chance.argmax(axis=1) == label[check]
        order = np.argsort(-sure)
        good = np.flatnonzero(np.cumsum(right[order]) >= precision * np.arange(1, len(order) + 1))
        least = float(sure[order][good[-1]]) if len(good) else 1.0
    return Model(languages, logits, bias, temperature, least)


def _weigh(owner: np.ndarray, bucket: np.ndarray, weight: np.ndarray, logits: np.ndarray,
           count: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weights=weight * logits[bucket, k], minlength=count)
                     for k in range(logits.shape[1])], axis=1)


def train(labelled: DataFrame, rows: int = SAMPLE_ROWS, **params) -> Model:
    """Fit on about ``rows`` different labelled texts (text, lang, held), chosen by a hash.

    Copies count once, so a large group of them can't fill the sample; one with a held copy is held.
    """
    spot = F.xxhash64(F.lit(11), "text", "lang")
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").withColumn("__spot", spot)
    total = usable.select("__spot").distinct().count()
    bound = int(min(1.0, rows / max(total, 1)) * (1 << 30))
    chosen = usable.filter(F.pmod("__spot", F.lit(1 << 30)) < bound).groupBy("text", "lang").agg(
        F.max("held").alias("held"))
    table = chosen.select("text", "lang", "held").toArrow().combine_chunks()
    # by text, so that the order in which tasks end does not matter
    table = table.take(pc.sort_indices(table, [("text", "ascending"), ("lang", "ascending")]))
    texts = table.column("text").combine_chunks()
    return fit(texts, table.column("lang").to_pylist(), np.asarray(table.column("held")), **params)


def _letterless(texts: pa.Array) -> np.ndarray:
    """Rows that are null or have no letter of any script."""
    plain = np.asarray(pc.fill_null(pc.match_substring_regex(texts, "[A-Za-z]"), False))
    out = ~plain
    for i in np.flatnonzero(out):
        out[i] = not any(c.isalpha() for c in (texts[i].as_py() or ""))
    return out


def score_texts(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(index of the best language or -1, its calibrated chance) of each text."""
    n, k = len(texts), len(model.languages)
    sums, counts = np.zeros((n, k)), np.zeros(n)
    if not k:
        return np.full(n, -1), np.zeros(n)
    buckets = np.uint32(len(model.logits))
    columns = np.ascontiguousarray(model.logits.T)
    for first, owner, value in grams(texts, SIZES):
        bucket = (value % buckets).astype(np.int32)
        if not len(owner):
            continue
        low, width = int(owner[0]), int(owner[-1]) - int(owner[0]) + 1
        local = owner - low
        counts[low:low + width] += np.bincount(local, minlength=width)
        begins = np.flatnonzero(np.r_[True, local[1:] != local[:-1]])
        for c in range(k):
            sums[low + local[begins], c] += np.add.reduceat(columns[c][bucket], begins, dtype=np.float64)
    chance = _softmax((sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
    best = chance.argmax(axis=1)
    unknown = _letterless(texts) | (counts == 0)
    return np.where(unknown, -1, best), np.where(unknown, 0.0, chance[np.arange(n), best])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected (below the calibrated confidence) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by ``buckets``

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNKNOWN], object)
        for batch in batches:
            best, chance = score_texts(batch.column(1), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(chance),
                 pa.array((best < 0) | (chance < known.least))],
                names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(
        task, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, "
              "score double, rejected boolean")
