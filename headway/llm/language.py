"""Language identification by a linear-chain conditional random field over words.

A word is a run of letters A-Z, a-z and bytes over 127 (so of any other script), A-Z lower-cased. Characters of
three or four bytes are words by themselves, since many of these scripts have no spaces (those whose first byte is
226, mostly punctuation and signs, are not). Its
features: hashed affixes of 1 to 3 bytes, hashed n-grams of 2 and 3 bytes with the word's edges, the word
itself hashed, and its lexicon row, the shares of the languages among its occurrences in the training
words. The labels are the languages of the training rows; transitions between neighbouring words and the
start of a document are learned, and forward-backward gives each word's label probabilities.

Training takes up to ``PER_LABEL`` different texts of each language, those with the smallest hashes, so that the
sample is the same in every run and copies count once. They are cut into stretches of ``STRETCH`` words, the last
one of a text as short as it comes; every training sequence joins ``JOINED`` stretches, some of other
languages, so that switches inside a text are learned too. The driver's need is bounded by that sample.

Documents may have any length: all words of a slice form one chain that starts afresh at each document.
It is cut into columns of equal length, the product of each column's transfer matrices is found for all
columns at once, and the messages that enter a column follow from the products. So the number of numpy
calls does not grow with the longest text, and the result is that of the plain recursion.

Null texts and texts without a letter are ``und`` with score 0. A tie goes to the first label in order.
Without any training row all are ``und``. Rows are independent; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.arrow import flat_bytes, ranges, strings, text_slices
from headway.llm.hashing import LOWER, gram_hashes, mix, prefix_sums, span_hashes, word_spans
from headway.llm.quality import held_out

UNKNOWN = "und"
PER_LABEL = 150
STRETCH = 16
JOINED = 4
SWITCH = 0.25
BUCKETS = 1 << 16
GRAMS = (2, 3)
EPOCHS = 3
LEAST_STEPS = 60
BATCH = 192
RATE = 0.1
LEXICON_COUNT = 3
COLUMN = 128

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def find_words(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each text, and the n+1 offsets of texts into them."""
    first_byte = np.flatnonzero((flat >= 0xE0) & (flat != 0xE2))
    after = first_byte + 3 + (flat[first_byte] >= 0xF0)
    cuts = np.concatenate([bounds, first_byte, after[after <= len(flat)]]) if len(first_byte) else bounds
    first, last, _ = word_spans(LETTER[flat], cuts)
    return first, last, np.searchsorted(first, bounds)


def word_features(flat: np.ndarray, bounds: np.ndarray):
    """Of all words: hashes, fixed features (7 buckets a word), for each n all buckets and the words' ranges."""
    first, last, offsets = find_words(flat, bounds)
    low = LOWER[flat]
    sums = prefix_sums(low)
    whole = span_hashes(sums, first, last)
    fixed = [whole]
    for n in (1, 2, 3):
        fixed.append(mix(span_hashes(sums, first, np.minimum(first + n, last)) + np.uint64(n)))
        fixed.append(mix(span_hashes(sums, np.maximum(last - n, first), last) + np.uint64(16 + n)))
    fixed = (np.stack(fixed, axis=1) % np.uint64(BUCKETS)).astype(np.int32)
    # Bytes outside words count as one edge byte, so that n-grams see where a word begins and ends.
    padded = np.r_[np.uint8(32), np.where(LETTER[flat], low, np.uint8(32)), np.uint8(32)]
    grams = []
    for n in GRAMS:
        found = (gram_hashes(padded, n) % np.uint64(BUCKETS)).astype(np.int32)
        grams.append((found, first, last - first + 3 - n))
    return whole, fixed, grams, offsets


def take_grams(grams, rows=slice(None)) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of the chosen words, for each n: the buckets one after the other, and how many each word has."""
    return [(found[ranges(start[rows], size[rows])], size[rows]) for found, start, size in grams]


def log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=-1, keepdims=True)))[..., 0]


class WordCRF:
    """The field's weights."""

    def __init__(self, labels: list[str], lexicon: tuple[np.ndarray, np.ndarray]):
        k = len(labels)
        self.labels = labels
        self.known, self.shares = lexicon
        self.weights = np.zeros((BUCKETS, k), np.float32)
        self.lexicon = np.zeros((k, k), np.float32)
        self.start = np.zeros(k)
        self.moves = np.zeros((k, k))

    def lexicon_rows(self, whole: np.ndarray) -> np.ndarray:
        """The language shares of each word; zeros for unknown ones."""
        if not len(self.known):
            return np.zeros((len(whole), len(self.labels)), np.float32)
        at = np.minimum(np.searchsorted(self.known, whole), len(self.known) - 1)
        return self.shares[at] * (self.known[at] == whole)[:, None]

    def emissions(self, whole, fixed, grams) -> np.ndarray:
        """The score of each label for each word."""
        scores = self.lexicon_rows(whole) @ self.lexicon
        for j in range(fixed.shape[1]):
            scores += self.weights[fixed[:, j]]
        for found, sizes in grams:
            if len(sizes):  # a word and its edges have at least one n-gram of each size
                scores += np.add.reduceat(self.weights[found], np.cumsum(sizes) - sizes)
        return scores

    def marginals(self, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Each word's label probabilities; ``begins`` marks the first word of each document."""
        n, k = scores.shape
        if not n:
            return np.zeros((0, k))
        columns = -(-n // COLUMN)
        psi = np.ones((columns * COLUMN, k))
        psi[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
        fresh = np.ones(columns * COLUMN, bool)
        fresh[:n] = begins
        psi, fresh = psi.reshape(columns, COLUMN, k), fresh.reshape(columns, COLUMN)
        move, start = np.exp(self.moves - self.moves.max()), np.exp(self.start - self.start.max())

        def step(states, t):
            """Rows of label weights before word t of each column, to after it."""
            flow = states @ move
            restart = states.sum(axis=-1, keepdims=True) * start
            flow = np.where(fresh[:, t, None, None], restart, flow) * psi[:, t, None, :]
            return flow / flow.sum(axis=(1, 2), keepdims=True)

        product = np.broadcast_to(np.eye(k), (columns, k, k)).copy()
        for t in range(COLUMN):
            product = step(product, t)
        into, out = np.ones((columns, k)) / k, np.ones((columns, k)) / k
        for c in range(1, columns):
            into[c] = into[c - 1] @ product[c - 1]
            into[c] /= into[c].sum()
        for c in range(columns - 2, -1, -1):
            out[c] = product[c + 1] @ out[c + 1]
            out[c] /= out[c].sum()
        forward, state = np.empty_like(psi), into[:, None, :]
        for t in range(COLUMN):
            state = step(state, t)
            forward[:, t] = state[:, 0]
        result, back = np.empty_like(psi), out
        for t in range(COLUMN - 1, -1, -1):
            result[:, t] = forward[:, t] * back
            gone = psi[:, t] * back
            back = np.where(fresh[:, t, None], (gone @ start)[:, None], gone @ move.T)
            back /= back.sum(axis=1, keepdims=True)
        result = result.reshape(-1, k)[:n]
        return result / result.sum(axis=1, keepdims=True)


def build_lexicon(whole: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words seen often enough, and the shares of the labels among them."""
    known, index = np.unique(whole, return_inverse=True)
    counts = np.zeros((len(known), k))
    np.add.at(counts, (index, labels), 1)
    kept = counts.sum(axis=1) >= LEXICON_COUNT
    counts = counts[kept] + 0.1
    return known[kept], (counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def train(samples: list[tuple[str, str]], seed: int = 11, epochs: int = EPOCHS) -> WordCRF | None:
    """Fit to (language, text) pairs by AdaGrad steps on the log-likelihood of joined stretches."""
    labels = sorted({lang for lang, _ in samples})
    if not labels:
        return None
    k, rng = len(labels), np.random.default_rng(seed)
    flat, bounds = flat_bytes(pa.array([text for _, text in samples], pa.large_string()))
    whole, fixed, grams, offsets = word_features(flat, bounds)
    gold = np.repeat([labels.index(lang) for lang, _ in samples], np.diff(offsets))
    model = WordCRF(labels, build_lexicon(whole, gold, k))
    cuts = [np.arange(a, b, STRETCH) for a, b in zip(offsets[:-1], offsets[1:])]
    cuts = np.concatenate([np.zeros(0, np.int64), *cuts]).astype(np.int64)
    if not len(cuts):
        return model
    stretch = np.minimum(STRETCH, offsets[np.searchsorted(offsets, cuts, side="right")] - cuts)
    of_label = [np.flatnonzero(gold[cuts] == y) for y in range(k)]
    present = [y for y in range(k) if len(of_label[y])]
    squares = {name: np.full(np.shape(getattr(model, name)), 1e-6) for name in ("weights", "lexicon", "start", "moves")}
    lexicon_rows = model.lexicon_rows(whole)

    def update(name, gradient):
        squares[name] += gradient * gradient
        target = getattr(model, name)
        target -= (RATE * gradient / np.sqrt(squares[name])).astype(target.dtype)

    steps = max(LEAST_STEPS, epochs * len(cuts) // (BATCH * JOINED))
    for _ in range(steps):
        # Languages take turns with equal weight; each next stretch switches with chance SWITCH.
        label = rng.choice(present, BATCH)
        picks = []
        for _ in range(JOINED):
            label = np.where(rng.random(BATCH) < SWITCH, rng.choice(present, BATCH), label)
            picks.append([of_label[y][int(u * len(of_label[y]))] for y, u in zip(label, rng.random(BATCH))])
        picks = np.array(picks).T
        # The stretches of a sequence one after the other; what is left of its row is no word.
        length = stretch[picks].sum(axis=1)
        real = np.arange(length.max()) < length[:, None]
        rows = ranges(cuts[picks].ravel(), stretch[picks].ravel())
        y = np.zeros(real.shape, np.int64)
        y[real] = gold[rows]
        taken = take_grams(grams, rows)
        scores = np.zeros((*real.shape, k))
        scores[real] = model.emissions(whole[rows], fixed[rows], taken)
        length = real.shape[1]
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[:, 0] = model.start + scores[:, 0]
        for t in range(1, length):
            moved = log_sum(alpha[:, t - 1][:, None, :] + model.moves.T[None]) + scores[:, t]
            alpha[:, t] = np.where(real[:, t, None], moved, alpha[:, t - 1])
        for t in range(length - 2, -1, -1):
            moved = log_sum(model.moves[None] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :])
            beta[:, t] = np.where(real[:, t + 1, None], moved, 0.0)
        total = log_sum(alpha[:, -1])
        p = np.exp(alpha + beta - total[:, None, None])
        pair = alpha[:, :-1, :, None] + model.moves + (scores + beta)[:, 1:, None, :] - total[:, None, None, None]
        moves = np.exp(pair[real[:, 1:]]).sum(axis=0)
        np.add.at(moves, (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), -1.0)
        start = p[:, 0].sum(axis=0) - np.bincount(y[:, 0], minlength=k)
        error = p[real]
        error[np.arange(len(rows)), y[real]] -= 1.0
        buckets, owners = [fixed[rows].ravel()], [np.repeat(np.arange(len(rows)), fixed.shape[1])]
        for found, sizes in taken:
            buckets.append(found)
            owners.append(np.repeat(np.arange(len(rows)), sizes))
        buckets, owners = np.concatenate(buckets), np.concatenate(owners)
        gradient = np.stack([np.bincount(buckets, error[owners, j], BUCKETS) for j in range(k)], axis=1)
        update("weights", gradient / BATCH)
        update("lexicon", lexicon_rows[rows].T @ error / BATCH)
        update("start", start / BATCH)
        update("moves", moves / BATCH)
    return model


def training_sample(docs: DataFrame, per_label: int = PER_LABEL) -> list[tuple[str, str]]:
    """Up to ``per_label`` different (lang, text) pairs of each language, of documents that are not held out."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["lang"].alias("lang"), docs["text"].alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    rows = rows.filter(F.col("text").isNotNull()).withColumn("mark", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")).collect()}
    if not counts:
        return []
    # Twice as many as wanted go on, so that few languages' texts are sorted and hardly any language falls short.
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * per_label / max(n, 1)))))
    point = F.pmod("mark", F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.filter(point < share[F.col("lang")]).select("lang", "text", "mark").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("mark", F.lit(1 << 30)), "text"))
    found = chosen.withColumn("place", place).filter(F.col("place") <= per_label).select("lang", "text").collect()
    return sorted((r["lang"], r["text"]) for r in found)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def batch_marginals(model: WordCRF, column):
    """Spans, label probabilities and document offsets of the words of a text column."""
    flat, bounds = flat_bytes(column)
    first, last, _ = find_words(flat, bounds)
    whole, fixed, grams, offsets = word_features(flat, bounds)
    begins = np.zeros(len(whole), bool)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return first, last, bounds, offsets, model.marginals(model.emissions(whole, fixed, take_grams(grams)), begins)


def identify(docs: DataFrame, model: WordCRF | None) -> DataFrame:
    """(doc_id, lang_pred, score): the label with the largest mean probability over the words, and that mean."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        crf = shared.value
        for batch in text_slices(batches):
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if crf is not None:
                column = batch.column("text")
                *_, offsets, p = batch_marginals(crf, column)
                sums = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])
                sizes = np.diff(offsets)
                mean = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(sizes, 1)[:, None]
                best = mean.round(12).argmax(axis=1)
                for i, text in enumerate(strings(column)):
                    if sizes[i] and has_letter(text):
                        names[i], scores[i] = crf.labels[best[i]], min(1.0, float(mean[i, best[i]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )

    columns = docs.select(docs["doc_id"].cast("long"), "text")
    return columns.mapInArrow(run, "doc_id long, lang_pred string, score double")


def label_words(docs: DataFrame, model: WordCRF) -> DataFrame:
    """(doc_id, start, end, lang): runs of words with one label, in byte offsets, for code-switched texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        crf = shared.value
        for batch in text_slices(batches):
            first, last, bounds, offsets, p = batch_marginals(crf, batch.column("text"))
            label, doc = p.argmax(axis=1), np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            head = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])][: len(label)])
            tail = np.r_[head[1:], len(label)][: len(head)] - 1
            ids = batch.column("doc_id").take(pa.array(doc[head]))
            base = bounds[doc[head]]
            langs = pa.array([crf.labels[k] for k in label[head]], pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(first[head] - base), pa.array(last[tail] - base), langs], ["doc_id", "start", "end", "lang"]
            )

    columns = docs.select(docs["doc_id"].cast("long"), "text")
    return columns.mapInArrow(run, "doc_id long, start long, end long, lang string")
