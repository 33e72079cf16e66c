"""A quality classifier over subword embeddings.

Each document is the mean of learned vectors of its features: words (runs of bytes that are not white
space), character n-grams of ``GRAMS`` bytes (case and white space kept, since shouting and tables show
there), a mark for every word that equals the one before it, and an end mark that counts
``END_COUNT`` times (so that a text of a word or two is not judged by them alone), all in ``BUCKETS`` rows by hash. A softmax over that mean gives the label; vectors and output weights are
trained by stochastic gradient descent in numpy, one document at a time, with a falling rate.

Training takes at most ``SAMPLE_ROWS`` labelled documents, those with the smallest hash of their id, with
their whole texts; they come to one task as counted features (no text), whose need the sample bounds. Scoring reads every whole text: since the model is linear after the lookup, a feature's share in
the score is one number, and tasks carry a table of ``BUCKETS`` numbers.

Null and empty texts have only the end mark and get the score learned for it. Several label rows of one
document count as the lowest label; labels that are null or name no document are unused. Without any
training row every score is 0.5. Rows are scored one by one, so repeated rows get equal scores; an empty
table gives an empty one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.arrow import NARROW_SLICE_BYTES, flat_bytes, list_array, text_slices
from headway.llm.hashing import SPACE, gram_hashes, prefix_sums, span_hashes, word_spans

SAMPLE_ROWS = 2000
BUCKETS = 1 << 17
GRAMS = (2, 3, 4)
DIMENSIONS = 10
EPOCHS = 5
RATE = 1.0
END = 0
END_COUNT = 20
AGAIN = 1


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    """Rows 2 and up; the first two are the marks."""
    return (hashes % np.uint64(BUCKETS - 2)).astype(np.int64) + 2


def feature_blocks(flat: np.ndarray, bounds: np.ndarray):
    """For words and each n-gram size: the features in order, and each text's range among them."""
    first, last, offsets = word_spans(~SPACE[flat], bounds)
    words = buckets_of(span_hashes(prefix_sums(flat), first, last))
    yield words, offsets[:-1], offsets[1:]
    again = np.flatnonzero(words[1:] == words[:-1]) + 1
    again = again[~np.isin(again, offsets)]
    at = np.searchsorted(again, offsets)
    yield np.full(len(again), AGAIN), at[:-1], at[1:]
    for n in GRAMS:
        found = buckets_of(gram_hashes(flat, n))
        low = np.minimum(bounds[:-1], len(found))
        yield found, low, np.maximum(bounds[1:] - n + 1, low)


def mean_of(table: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The mean of a number per feature, for each text."""
    total = np.full(len(bounds) - 1, END_COUNT * float(table[END]))
    count = np.full(len(bounds) - 1, float(END_COUNT))
    for found, low, high in feature_blocks(flat, bounds):
        sums = np.r_[0.0, np.cumsum(table[found], dtype=np.float64)]
        total += sums[high] - sums[low]
        count += high - low
    return total / count


def counted_features(batches):
    """Arrow batches (label, text) to (label, buckets, counts)."""
    for batch in text_slices(batches, limit=NARROW_SLICE_BYTES):
        flat, bounds = flat_bytes(batch.column("text"))
        blocks = [*feature_blocks(flat, bounds)]
        rows = [np.r_[np.full(END_COUNT, END), *(found[a[i] : b[i]] for found, a, b in blocks)] for i in range(batch.num_rows)]
        counted = [np.unique(row, return_counts=True) for row in rows]
        offsets = np.r_[0, np.cumsum([len(k) for k, _ in counted])]
        lists = [list_array(np.concatenate(part), offsets, pa.int32()) for part in zip(*counted)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), *lists], ["label", "buckets", "counts"])


class Embeddings:
    """Feature vectors and output weights of a two-label softmax."""

    def __init__(self, vectors: np.ndarray, output: np.ndarray):
        self.vectors, self.output = vectors, output

    def table(self) -> np.ndarray:
        """What each feature adds to the score of label 1 over label 0."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7, epochs: int = EPOCHS) -> Embeddings:
    """Fit to (label, buckets, counts) rows by gradient steps of one document each."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), np.float32)
    weights = [(counts / counts.sum()).astype(np.float32) for _, _, counts in rows]
    steps = epochs * len(rows)
    step = 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            label, buckets, _ = rows[i]
            rate = np.float32(RATE * (1 - step / steps))
            hidden = weights[i] @ vectors[buckets]
            logits = hidden @ output
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = output @ p
            output -= rate * np.outer(hidden, p)
            # As each occurrence would take the whole gradient of the mean: steps do not shrink with length.
            vectors[buckets] -= np.outer(rate * weights[i] / weights[i].max(), back)
            step += 1
    return Embeddings(vectors, output)


def held_out(doc_id):
    """Whether a document is kept from training: crc32 of the id as text leaves 1 by 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(label, buckets, counts) of the sample."""
    chosen = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    # The broadcast side is a limited sample: at most ``sample_rows`` pairs of numbers.
    joined = texts.join(F.broadcast(chosen), "doc_id").select("label", "text")
    return joined.mapInArrow(counted_features, "label int, buckets array<int>, counts array<int>")


def train_batches(batches):
    """All rows of the sample to one row with the model's bytes."""
    rows = []
    for batch in batches:
        for label, buckets, counts in zip(*(batch.column(i) for i in range(3))):
            rows.append((label.as_py(), buckets.values.to_numpy(), counts.values.to_numpy()))
    # A fixed order, whatever order the tasks ended in; equal rows are interchangeable.
    rows.sort(key=lambda r: (r[0], len(r[1]), zlib.crc32(r[1]), zlib.crc32(r[2])))
    if rows:
        model = train(rows)
        packed = [pa.array([x.tobytes()], pa.binary()) for x in (model.vectors, model.output)]
        yield pa.RecordBatch.from_arrays(packed, ["vectors", "output"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Embeddings | None:
    """The model of the labelled documents that are not held out; None without any.

    One task trains on the sample; the driver gets the weights alone.
    """
    sample = training_sample(docs, labels, sample_rows).repartition(1)
    found = sample.mapInArrow(train_batches, "vectors binary, output binary").first()
    if found is None:
        return None
    vectors, output = (np.frombuffer(x, np.float32) for x in found)
    return Embeddings(vectors.reshape(BUCKETS, DIMENSIONS), output.reshape(DIMENSIONS, 2))


def scorer(model: Embeddings | None, spark):
    """A function from an Arrow text column to scores; the table goes to tasks as one broadcast."""
    table = spark.sparkContext.broadcast(model.table() if model else np.zeros(BUCKETS, np.float32))

    def score(column) -> np.ndarray:
        flat, bounds = flat_bytes(column)
        return 1 / (1 + np.exp(-mean_of(table.value, flat, bounds)))

    return score


def score_quality(docs: DataFrame, model: Embeddings | None) -> DataFrame:
    """(doc_id, score) of every document; the score is the chance of label 1."""
    score = scorer(model, docs.sparkSession)

    def run(batches):
        for batch in text_slices(batches, limit=NARROW_SLICE_BYTES):
            scores = pa.array(score(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Embeddings | None, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    score = scorer(model, docs.sparkSession)

    def run(batches):
        for batch in text_slices(batches, limit=NARROW_SLICE_BYTES):
            yield batch.filter(pa.array(score(batch.column("text")) >= threshold))

    return docs.mapInArrow(run, docs.schema)
