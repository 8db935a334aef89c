"""Quality classifier: supervised subword embeddings, averaged per document.

A word has hashed features: the word itself and its character n-grams. Each feature owns a learned
vector; a word is the mean of its features' vectors, a document the mean of its words', and a softmax
over two classes reads the document. A word that equals the one before counts one more time, as a
feature of its own. Numpy trains by stochastic gradient descent on a bounded sample. After training
the output of a feature is one number, so scoring looks up numbers for distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.textscan import U64, Names, flat_ranges, forget_cache, give_back, mix, slices, small_batches, text_column, thrifty, word_bounds

NGRAMS = (3, 4)
BUCKETS = 1 << 17  # the last one is the repeated word's
REPEATED = BUCKETS - 1
DIMENSIONS = 8
EPOCHS = 5
RATE = 2.0
THRESHOLD = 0.3


@dataclass
class QualityModel:
    """What each feature adds to the log odds of label 1, and what every text starts from."""

    features: np.ndarray
    bias: float


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of each distinct word, flat, and their offsets."""
    words = words.cast(pa.string())
    sizes = pc.utf8_length(words).to_numpy() + 2
    letters = "".join(f"<{word}>" for word in words.to_pylist())
    codes = np.frombuffer(letters.encode("utf-32-le"), dtype=np.uint32)
    names = Names(mix(codes.astype(U64) + U64(1)), 0)
    starts = np.cumsum(sizes) - sizes
    counts = np.stack([np.ones_like(sizes), *(np.maximum(sizes - n + 1, 0) for n in NGRAMS)])
    total = counts.sum(axis=0)
    offsets = np.concatenate(([0], np.cumsum(total)))
    buckets = np.empty(int(offsets[-1]), dtype=np.int64)
    at = offsets[:-1].copy()
    for kind, count in enumerate(counts):
        first = flat_ranges(starts, count)
        width = np.repeat(sizes, count) if kind == 0 else NGRAMS[kind - 1]
        place = flat_ranges(at, count)
        buckets[place] = (names.of(first, first + width) % U64(BUCKETS - 1)).astype(np.int64)
        at += count
    return buckets, offsets


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Index of each word in the distinct words, those, word offsets of the texts, and marks of words
    that equal the one before in their text."""
    data, offsets = text_column(texts)
    starts, ends, words = word_bounds(data, offsets)
    sizes = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    solid = np.ascontiguousarray(data[flat_ranges(starts, ends - starts)])
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(solid)]).dictionary_encode()
    index = coded.indices.to_numpy()
    again = np.zeros(len(index), dtype=bool)
    again[1:] = index[1:] == index[:-1]
    again[words[:-1][words[:-1] < len(index)]] = False
    return index, coded.dictionary, words, again


def bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and weights of each text; weights add up to 1."""
    column = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    return [bag for part in slices(column, "text") for bag in part_bags(part.column("text"))]


def part_bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    index, distinct, words, again = coded_words(texts)
    buckets, offsets = word_features(distinct)
    for first, last in zip(words[:-1], words[1:]):
        used, counts = np.unique(index[first:last], return_counts=True)
        repeats = int(again[first:last].sum())
        lengths = offsets[used + 1] - offsets[used]
        weights = np.repeat(counts / np.maximum(lengths, 1) / max(last - first + repeats, 1), lengths)
        flat = buckets[flat_ranges(offsets[used], lengths)]
        if repeats:
            flat, weights = np.append(flat, REPEATED), np.append(weights, repeats / (last - first + repeats))
        features, inverse = np.unique(flat, return_inverse=True)
        yield features.astype(np.int32), np.bincount(inverse, weights, minlength=len(features)).astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, seed: int = 0) -> QualityModel:
    """Trains on texts and labels 0 or 1. Without both labels the score is the share of label 1."""
    if len(set(labels.tolist())) < 2:
        return QualityModel(np.zeros(BUCKETS), 20.0 * (2 * labels.mean() - 1) if len(labels) else 0.0)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    output, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    samples = bags(texts)
    steps, step = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for sample in random.permutation(len(samples)):
            features, weights = samples[sample]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = weights @ vectors[features]
            scores = output @ hidden + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[labels[sample]] -= 1
            back = output.T @ error
            output -= rate * np.outer(error, hidden)
            bias -= rate * error
            vectors[features] -= rate * np.outer(weights, back)
    return QualityModel(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


def held_out(id: str = "doc_id") -> Column:
    """True for the fifth of the ids whose labels are never learned; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = 4000) -> QualityModel:
    """Learns ``label`` from at most ``sample_rows`` labelled rows outside the held-out fifth.

    The sample is the first rows in order of a hash of the id. Labels other than 0 and 1 and null ids
    teach nothing; a null text is an empty one.
    """
    usable = labels.where(~held_out(id) & F.col(label).isin(0, 1) & F.col(id).isNotNull())
    chosen = usable.select(F.col(id).alias("id"), F.col(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows).collect()
    texts: dict[int, list[str]] = {}
    ids = sorted({row.id for row in chosen})
    if ids:
        for row in docs.where(F.col(id).isin(ids)).select(F.col(id).alias("id"), F.col(text).alias("text")).collect():
            texts.setdefault(row.id, []).append(row.text or "")
    pairs = sorted((row.id, int(row.label), one) for row in chosen for one in texts.get(row.id, ()))
    model = fit([one for _, _, one in pairs], np.array([label for _, label, _ in pairs], dtype=np.int64))
    del texts, pairs
    # The driver keeps nothing of the sample while the job goes on.
    give_back()
    return model


def score(docs: DataFrame, model: QualityModel, id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """(id, score) of every whole text; the score nears 1 where label 1 is likelier.

    With ``carry`` all columns of ``docs`` come along; a score column among them is replaced. A text without words, or null, has the score every text starts from. Rows are scored one by one,
    repeated ones alike; other columns play no part.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker may have packed tokens before; its tokenizers are of no use here.
        forget_cache("encoders")
        for batch in batches:
            for part in slices(batch, text):
                index, distinct, words, again = coded_words(part.column(text))
                buckets, offsets = word_features(distinct)
                sums = np.concatenate(([0.0], np.cumsum(model.features[buckets])))
                values = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)
                total = np.concatenate(([0.0], np.cumsum(values[index] + again * model.features[REPEATED])))[words]
                number = np.concatenate(([0], np.cumsum(1 + again.astype(np.int64))))[words]
                odds = np.diff(total) / np.maximum(np.diff(number), 1) + model.bias
                scores = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
                rest = [part.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(scores)], names=[*kept, "score"])

    kept = [name for name in docs.columns if name != "score"] if carry else [id]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*kept).dtypes) + ", score double"
    return small_batches(docs).select(*dict.fromkeys([*kept, text])).mapInArrow(thrifty(scan), schema)
