"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection; trained by numpy SGD."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.subwords import Grams, by_key, sample_features, sampled, sparse, sum_rows
from panelkit.llm.words import ranges, returning, slices

UNKNOWN = "und"
#: Documents of each language to learn from; a fifth of them calibrates.
PER_LANGUAGE = 1000
#: Share of the rightly labelled calibration documents that rejection may cost.
MISS = 0.002
#: A language's share of documents with an n-gram is taken as if it had so many more documents without it; least share; n-grams of usual
#: evidence added to every text, so that a few odd words don't decide; bits below the usual evidence that are never held against a text.
DOUBT, RARE, ADDED, SLACK = 10, 0.0005, 30, 1.0
#: Bytes of text that are scored at once.
PART_BYTES = 1 << 20
#: N-grams of the sample that are measured at once.
PIECE = 1 << 18


@dataclass(frozen=True)
class LanguageModel:
    grams: Grams
    languages: list[str]
    weights: np.ndarray  # embedding times softmax layer, one row a bucket
    bias: np.ndarray
    temperature: float
    threshold: float
    known: np.ndarray  # evidence, one a bucket: log2 of the largest share of a language's documents with it
    usual: float  # median evidence of the labelled documents
    floor: float  # least evidence of a text that is accepted


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _train(buckets, counts, first, label, n_labels, size, width, epochs, rate, seed=11):
    """Stochastic gradient descent on the mean embedding of each document and a linear softmax, step sizes by past gradients."""
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (size, width))
    layer, bias = rng.normal(0, 0.3, (width, n_labels)), np.zeros(n_labels)
    past_e, past_l, past_b = np.full(size, 1e-8), np.full(layer.shape, 1e-8), np.full(n_labels, 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), 32):
            rows = order[at:at + 32]
            lengths = first[rows + 1] - first[rows]
            picked = ranges(first[rows], lengths)
            row = np.repeat(np.arange(len(rows)), lengths)
            share = counts[picked] / np.maximum(sum_rows(counts[picked].astype(float), row, len(rows)), 1)[row]
            ids, inverse = np.unique(buckets[picked], return_inverse=True)
            mean = sum_rows(embedding[buckets[picked]] * share[:, None], row, len(rows))
            slope = _softmax(mean @ layer + bias)
            slope[np.arange(len(rows)), label[rows]] -= 1
            slope /= len(rows)
            by_id = np.argsort(inverse, kind="stable")
            step_e = sum_rows((share[:, None] * (slope @ layer.T)[row])[by_id], inverse[by_id], len(ids))
            step_l, step_b = mean.T @ slope, slope.sum(axis=0)
            past_e[ids] += (step_e ** 2).mean(axis=1)
            past_l += step_l ** 2
            past_b += step_b ** 2
            embedding[ids] -= rate * step_e / np.sqrt(past_e[ids])[:, None]
            layer -= rate * step_l / np.sqrt(past_l)
            bias -= rate * step_b / np.sqrt(past_b)
    return embedding @ layer, bias


def _logits(buckets, counts, first, weights, bias):
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total = sum_rows(counts.astype(float), row, len(first) - 1)
    return sum_rows(weights[buckets] * counts[:, None], row, len(first) - 1) / np.maximum(total, 1)[:, None] + bias


def _shares(buckets, counts, first, label, languages, size):
    """Evidence of every bucket, and of every row: the mean over its n-grams of their evidence without that row, and its n-grams. Rows
    hold a bucket once, so a table of documents by language and bucket says it all; rows are taken in pieces."""
    pieces = np.unique(np.searchsorted(first, np.arange(0, first[-1] + PIECE, PIECE)).clip(0, len(label)))
    parts = [(a, b, slice(first[a], first[b])) for a, b in zip(pieces[:-1], pieces[1:])]
    seen = np.zeros(languages * size, dtype=np.int64)
    for a, b, at in parts:
        seen += np.bincount(np.repeat(label[a:b], np.diff(first[a:b + 1])) * size + buckets[at], minlength=languages * size)
    seen = seen.reshape(languages, size)
    n = np.bincount(label, minlength=languages) + DOUBT
    share = seen / n[:, None]
    lead, best = share.argmax(axis=0), share.max(axis=0)
    share[lead, np.arange(size)] = 0
    second = share.max(axis=0)
    total, mean = np.zeros(len(label)), np.zeros(len(label))
    for a, b, at in parts:
        row = np.repeat(np.arange(b - a), np.diff(first[a:b + 1]))
        bucket, language = buckets[at], label[a:b][row]
        others = np.where(lead[bucket] == language, second[bucket], best[bucket])
        own = np.log2(np.maximum((seen[language, bucket] - 1) / (n[language] - 1), others) + RARE)
        total[a:b] = sum_rows(counts[at].astype(float), row, b - a)
        mean[a:b] = sum_rows(own * counts[at], row, b - a) / total[a:b]
    return np.log2(best + RARE), total, mean


def _evidence(total, mean, usual):
    return (total * mean + ADDED * usual) / (total + ADDED)


def train_language_model(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
                         per_language: int = PER_LANGUAGE, grams: Grams = Grams(), width: int = 16, epochs: int = 4,
                         rate: float = 0.1, miss: float = MISS, required: bool = True) -> LanguageModel:
    """Learn from at most about ``per_language`` documents of each language, picked by a hash of the id; whole texts.

    Four fifths of the sample train, one fifth sets the temperature of the softmax (least log loss) and the score below which a
    document is rejected: at most ``miss`` of the calibration documents that are labelled rightly fall below, and at most ``miss``
    of the texts that are half one of them and half one of another language. The score only compares known languages, so a text
    must also consist of known n-grams: its evidence is the mean over its n-grams of the log share of documents with the n-gram, in
    the language where it is most common. Each document of the sample is measured without itself; at most ``miss`` of
    any language fall below the floor, which is at least ``SLACK`` bits below the median. A sample of fewer than 50 documents is too small to
    divide: all of it trains and all of it calibrates. Rows without language, id or text don't count; of more than 1,000 languages
    the 1,000 with the most documents are learnt, those of equal number in order. If nothing is labelled,
    raises if ``required``, else gives a model without languages, to which every text is ``und``.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(lang_col, id_col, text_col)
    table = sample_features(sampled(labelled, lang_col, id_col, per_language), grams, lang_col, id_col, text_col)
    order = by_key(table)
    order = order[pa.compute.list_value_length(table.column("buckets")).to_numpy()[order] > 0]
    if not len(order):
        if required:
            raise ValueError("no labelled text to learn from")
        size = 1 << grams.bits
        return LanguageModel(grams, [], np.zeros((size, 0), dtype=np.float32), np.zeros(0), 1.0, 0.0, np.zeros(size, dtype=np.float32), 0.0, 0.0)
    apart = np.arange(len(order)) % 5 == 4 if len(order) >= 50 else np.zeros(len(order), dtype=bool)
    order, cut = np.r_[order[~apart], order[apart]], int((~apart).sum())  # learnt from and set apart: two stretches, no copies
    languages, label = np.unique(table.column("label").to_numpy()[order].astype(str), return_inverse=True)
    languages = languages.tolist()
    buckets, counts, first = sparse(table, order)
    del table

    weights, bias = _train(buckets, counts, first[:cut + 1], label[:cut], len(languages), 1 << grams.bits, width, epochs, rate)
    held = cut if cut < len(order) else 0
    logits, truth = _logits(buckets[first[held]:], counts[first[held]:], first[held:] - first[held], weights, bias), label[held:]
    scales = np.geomspace(0.2, 5, 41)
    losses = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in scales]
    temperature = float(scales[int(np.argmin(losses))])
    sure = _softmax(logits / temperature)
    right = sure[np.arange(len(truth)), truth][sure.argmax(axis=1) == truth]
    threshold = min((float(np.quantile(s, miss, method="lower")) for s in (right, _halves(logits, truth, temperature)) if len(s)), default=0.0)
    known, total, mean = _shares(buckets, counts, first, label, len(languages), 1 << grams.bits)
    usual = float(np.median(mean))
    evidence = _evidence(total, mean, usual)
    floor = min(usual - SLACK, *(float(np.quantile(evidence[label == k], miss, method="lower")) for k in range(len(languages))))
    return LanguageModel(grams, languages, weights.astype(np.float32), bias, temperature, threshold, known.astype(np.float32), usual, floor)


def _halves(logits, truth, temperature, pairs=20000, seed=7):
    """Scores of texts that are half one calibration document and half one of another language: logits are means over n-grams."""
    one, other = np.random.default_rng(seed).integers(0, max(len(truth), 1), (2, pairs if len(truth) else 0))
    one, other = one[truth[one] != truth[other]], other[truth[one] != truth[other]]
    return _softmax((logits[one] + logits[other]) / 2 / temperature).max(axis=1)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = np.concatenate([[0], np.cumsum(((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A))])
    has = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for row in np.flatnonzero(~has):
        has[row] = any(c.isalpha() for c in data[offsets[row]:offsets[row + 1]].tobytes().decode())
    return has


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: the id, ``lang_pred``, ``score`` (calibrated probability of it), ``accepted``, and the text if
    ``with_text``. The id may be a struct of other columns.

    Whole texts are scored: n-grams of each distinct word of a slice once, then sums over each document's words. A text that is
    null or has no letter, or any text if the model has no languages, is ``und`` with score 0 and isn't accepted; others are accepted if the score reaches the model's
    threshold and the evidence its floor. Equal scores go to the first language in order. Other columns are ignored; an empty table gives no rows. The
    model has a fixed size (2^bits rows, one column a language and one of evidence) and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.column_stack([model.weights, model.known]))
    usual, floor = model.usual, model.floor
    grams, bias, temperature, threshold = model.grams, model.bias, model.temperature, model.threshold
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def predict(batches):
        weights = shared.value
        for part, data, offsets in slices(batches, 1, PART_BYTES, lower=True):
            lettered = _has_letter(data, offsets) & (len(names) > 1)
            low, starts, ends, word, row = grams.distinct(data, offsets)
            bucket, owner = grams.of_words(low, starts, ends)
            order = np.argsort(owner, kind="stable")
            per_word = sum_rows(weights[bucket[order]], owner[order], len(starts))
            n_grams = np.bincount(owner, minlength=len(starts)).astype(float)
            total = sum_rows(n_grams[word], row, len(offsets) - 1)
            means = sum_rows(per_word[word], row, len(offsets) - 1) / np.maximum(total, 1)[:, None]
            sure = _softmax((means[:, :-1] + bias) / temperature) if len(names) > 1 else np.zeros((len(offsets) - 1, 1))
            known = _evidence(total, means[:, -1], usual) >= floor
            best = np.where(lettered, sure.argmax(axis=1), len(names) - 1)
            score = np.where(lettered, sure.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[best], pa.string()), pa.array(score),
                                              pa.array(lettered & (score >= threshold) & known), *part.columns[1:1 + with_text]],
                                             names=["id", "lang_pred", "score", "accepted", "text"][:4 + with_text])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())] + [T.StructField("text", T.StringType())] * with_text)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(returning(predict), schema).withColumnRenamed("id", id_col)
