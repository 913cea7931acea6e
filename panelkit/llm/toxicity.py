"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.subwords import Grams, by_key, sample_features, sampled, sparse, sum_rows
from panelkit.llm.words import ranges, slices

#: Labelled documents of each class for the gradient descent.
PER_CLASS = 1500
GRAMS = Grams(sizes=(3, 4, 5), bits=18, once=True)


@dataclass(frozen=True)
class ToxicityModel:
    grams: Grams
    weights: np.ndarray  # classifier weight times log-count ratio, one a bucket
    bias: float


def count_documents(rows: DataFrame, grams: Grams, toxic: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Documents of classes 0 and 1 with each n-gram, over all ``rows`` (2 x 2^bits, all that comes to the driver), and of each class."""
    size = 1 << grams.bits

    def count(batches):
        seen = np.zeros((2, size + 1), dtype=np.int64)  # the last place counts documents
        for part, data, offsets in slices(batches, 1, lower=True):
            side = part.column(0).to_numpy(zero_copy_only=False)
            low, starts, ends, word, row = grams.distinct(data, offsets)
            bucket, owner = grams.of_words(low, starts, ends)
            order = np.argsort(owner, kind="stable")
            bucket, first = bucket[order], np.searchsorted(owner[order], np.arange(len(starts) + 1))
            for k, (begin, end) in enumerate(zip(*(np.searchsorted(row, np.arange(len(offsets) - 1), side=s) for s in ("left", "right")))):
                found = word[begin:end]
                seen[side[k], size] += 1
                seen[side[k], np.unique(bucket[ranges(first[found], first[found + 1] - first[found])])] += 1
        flat = seen.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["at", "n"])

    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("n", T.LongType())])
    found = rows.select(F.col(toxic).cast("int").alias("toxic"), F.col(text).cast("string").alias("text")).mapInArrow(count, schema)
    table = found.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * (size + 1), dtype=np.int64)
    out[table.column("at").to_numpy()] = table.column("n").to_numpy()
    out = out.reshape(2, size + 1)
    return out[:, :size], out[:, size]


def _ratios(counts, documents, smooth=1.0):
    """Log ratio of the smoothed shares of documents with each n-gram in the two classes."""
    without, with_ = (np.log((counts[k] + smooth) / (max(int(documents[k]), 1) + 2 * smooth)) for k in (0, 1))
    return with_ - without


def _train(buckets, values, first, toxic, size, epochs, rate, decay, seed=5):
    """Logistic regression by stochastic gradient descent, step sizes by past gradients, weights drawn towards zero."""
    rng = np.random.default_rng(seed)
    weights, bias, past, past_bias = np.zeros(size), 0.0, np.full(size, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(toxic))
        for at in range(0, len(order), 64):
            rows = order[at:at + 64]
            lengths = first[rows + 1] - first[rows]
            picked = ranges(first[rows], lengths)
            row = np.repeat(np.arange(len(rows)), lengths)
            margin = sum_rows(weights[buckets[picked]] * values[picked], row, len(rows)) + bias
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic[rows]) / len(rows)
            step = np.bincount(buckets[picked], weights=values[picked] * slope[row], minlength=size) + decay * weights
            past += step ** 2
            weights -= rate * step / np.sqrt(past)
            past_bias += slope.sum() ** 2
            bias -= rate * slope.sum() / np.sqrt(past_bias)
    return weights, bias


def train_toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                         per_class: int = PER_CLASS, grams: Grams = GRAMS, epochs: int = 8, rate: float = 0.05,
                         decay: float = 1e-4, required: bool = True) -> ToxicityModel:
    """Learn from all labelled documents how common each n-gram is in each class, and its weight from about ``per_class`` labelled
    documents of each class, picked by a hash of the id; whole texts.

    ``labels`` holds ids and 0 or 1; other labels and null ids don't count; an id with both labels counts as toxic. The picked
    ids are bounded by ``per_class`` and may be broadcast to find their texts. N-grams count once a document; each is scaled
    by its log-count ratio, then weighted by logistic regression. Unless both classes occur, raises if
    ``required``, else gives a constant score by the classes of the documents: near 0 or 1, and near 0 if none is labelled.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(label_col).cast("int").alias("_toxic"))
    picked = F.broadcast(sampled(known, "_toxic", "_id", per_class))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(picked, "_id")
    labelled = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(known.hint("merge"), "_id")  # labels grow with the table
    table = sample_features(rows.limit(4 * per_class), grams, "_toxic", "_id", "_text")
    order = by_key(table)
    toxic = table.column("label").to_numpy()[order].astype(float)
    if not ((toxic == 1).any() and (toxic == 0).any()):
        if required:
            raise ValueError("both classes are needed to learn from")
        n, m = int((toxic == 1).sum()), int((toxic == 0).sum())
        return ToxicityModel(grams, np.zeros(1 << grams.bits, dtype=np.float32), float(np.log((n + 0.5) / (m + 0.5))) if n + m else -30.0)
    buckets, _, first = sparse(table, order)
    del table
    ratio = _ratios(*count_documents(labelled, grams, "_toxic", "_text"))
    weights, bias = _train(buckets, ratio[buckets], first, toxic, 1 << grams.bits, epochs, rate, decay)
    return ToxicityModel(grams, (weights * ratio).astype(np.float32), float(bias))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 if score >= 0.5).

    Whole texts are scored, each distinct n-gram of a document once. Null, empty and wordless texts get the model's bias
    alone. Other columns are ignored; an empty table gives no rows. The model has 2^bits weights, a fixed size, and is broadcast.
    """
    shared, grams, bias = docs.sparkSession.sparkContext.broadcast(model.weights), model.grams, model.bias

    def score(batches):
        weights = shared.value
        for part, data, offsets in slices(batches, 1, lower=True):
            low, starts, ends, word, row = grams.distinct(data, offsets)
            bucket, owner = grams.of_words(low, starts, ends)
            order = np.argsort(owner, kind="stable")
            bucket, first = bucket[order], np.searchsorted(owner[order], np.arange(len(starts) + 1))
            margin = np.full(len(offsets) - 1, bias)
            for k, (begin, end) in enumerate(zip(*(np.searchsorted(row, np.arange(len(offsets) - 1), side=s) for s in ("left", "right")))):
                found = word[begin:end]
                margin[k] += weights[np.unique(bucket[ranges(first[found], first[found + 1] - first[found])])].sum(dtype=np.float64)
            value = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                                             names=["id", "score", "predicted"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(score, schema).withColumnRenamed("id", id_col)
