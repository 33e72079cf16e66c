"""Lempel-Ziv phrase fingerprints.

A text's UTF-8 bytes are parsed into phrases, each the shortest string not met before (LZ78). The set of
phrases is hashed, and the ``SIZE`` smallest 32-bit hashes are the fingerprint, as hex. The likeness of
two fingerprints is the share, among the ``SIZE`` smallest hashes of their union, of those in both: an
estimate of the Jaccard likeness of the phrase sets, exact for sets up to that size.

``fingerprint_neighbours`` compares each document with the next one and with an edited copy, whose last
quarter is replaced by the beginning of the next one. Documents are dealt into ranges of doc_id with fixed
bounds and sorted there; a task goes through its rows holding two of them. The last row of each range
meets the first of the next range in a join of two rows a range. Parsing goes on from the state at the
cut, so an edited copy costs a quarter.

Order: doc_id (null first), then a hash of the text. Repeated rows are neighbours of each other; the last
row is followed by the first, a single row by itself. Null counts as empty; an empty text has an empty
fingerprint, likeness 1 with another empty one and 0 with any other. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.arrow import strings, text_slices
from headway.llm.hashing import prefix_sums, span_hashes
from headway.session import shuffle_tasks

SIZE = 128
RANGES_PER_TASK = 4
LOWEST = -(1 << 63)
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def parse(data: str, seen: dict[str, None], phrase: str = "") -> str:
    """Add the phrases of ``data`` to ``seen``, in order; returns the unfinished last one."""
    for character in data:
        phrase += character
        if phrase not in seen:
            seen[phrase] = None
            phrase = ""
    return phrase


def smallest(data: bytes, seen: dict[str, None]) -> np.ndarray:
    """The smallest distinct hashes of the phrases, which stand in ``data`` one after the other."""
    if not seen:
        return np.zeros(0, np.uint32)
    ends = np.cumsum(np.fromiter(map(len, seen), np.int64, len(seen)))
    starts = np.r_[0, ends[:-1]]
    flat = np.frombuffer(data, np.uint8)
    hashes = (span_hashes(prefix_sums(flat), starts, ends) >> np.uint64(32)).astype(np.uint32)
    if len(hashes) > 4 * SIZE:
        hashes = np.partition(hashes, 2 * SIZE)[: 2 * SIZE]
    return np.unique(hashes)[:SIZE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of common hashes among the smallest of both."""
    union = np.union1d(a, b)[:SIZE]
    if not len(union):
        return 1.0
    return float((np.isin(union, a) & np.isin(union, b)).sum() / len(union))


def to_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


class Parsed:
    """One text, its fingerprint, and the state of its parse where the edited copy leaves it."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.replaced = len(text) // 4
        self.kept = text[: len(text) - self.replaced]
        head, tail = self.kept.encode(), text[len(text) - self.replaced :].encode()
        self.seen: dict[str, None] = {}
        self.phrase = parse(head.decode("latin-1"), self.seen)
        full = dict(self.seen)
        parse(tail.decode("latin-1"), full, self.phrase)
        self.hashes = smallest(head + tail, full)

    def row(self, following: Parsed) -> tuple:
        """The result row, given the next document."""
        edited = self.kept + following.text[: self.replaced]
        data = edited.encode()
        seen = self.seen
        parse(data[len(self.kept.encode()) :].decode("latin-1"), seen, self.phrase)
        hashes = smallest(data, seen)
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(data).hexdigest(),
            to_text(self.hashes),
            to_text(hashes),
            likeness(self.hashes, hashes),
            likeness(self.hashes, following.hashes),
        )


KINDS = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in KINDS]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], NAMES)


def sorted_rows(batches):
    """Rows for all documents but the last of each range; the rows come in order."""
    held, held_part = None, None
    for batch in text_slices(batches):
        rows = []
        columns = (batch.column(n).to_pylist() for n in ("part", "doc_id"))
        for part, doc_id, text in zip(*columns, strings(batch.column("text"))):
            parsed = Parsed(doc_id, text)
            if held is not None and part == held_part:
                rows.append(held.row(parsed))
            held, held_part = parsed, part
        yield to_batch(rows)


def joined_rows(batches):
    """Rows for documents that come with the next one's text."""
    for batch in text_slices(batches):
        rows = zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strings(batch.column("next_text")))
        yield to_batch([Parsed(d, a).row(Parsed(None, b)) for d, a, b in rows])


def with_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, key, tie, doc_id, text): ``part`` numbers ranges of doc_id that hold about equally many."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    cuts = rows.select("doc_id").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    cuts = sorted({int(c) for c in cuts})
    # Two levels of bounds, so that finding a row's range takes the square root of their number.
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("key")))
    if groups:
        coarse = below(F.array(*[F.lit(g[0]) for g in groups]))
        inner = F.element_at(F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups]), F.greatest(coarse, F.lit(1)))
        part = F.when(coarse == 0, 0).otherwise((coarse - 1) * width + below(inner))
    else:
        part = F.lit(0)
    return rows.select(part.cast("int").alias("part"), "key", F.xxhash64("text").alias("tie"), "doc_id", "text")


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited copy's, and its likeness to that and to the next document."""
    tasks = shuffle_tasks(docs.sparkSession)
    rows = with_ranges(docs, RANGES_PER_TASK * tasks)
    ordered = rows.repartitionByRange(tasks, "part").sortWithinPartitions("part", "key", "tie")
    within = ordered.select("part", "doc_id", "text").mapInArrow(sorted_rows, SCHEMA)

    ends = rows.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # At most two ids a range: RANGES_PER_TASK ranges a task.
    edge = rows.alias("r").join(
        F.broadcast(ends).alias("e"),
        (F.col("r.part") == F.col("e.part")) & F.col("r.key").isin(F.col("e.low"), F.col("e.high")),
    )
    place, text = F.struct("r.key", "r.tie"), F.struct("r.doc_id", "r.text")
    edge = edge.groupBy(F.col("r.part").alias("part")).agg(
        F.min_by(text, place).alias("head"), F.max_by(text, place).alias("tail")
    )
    order = W.orderBy("part")
    follows = ends.select("part", F.lead("part").over(order).alias("next"))
    first = ends.agg(F.min("part").alias("first"))
    follows = follows.join(first).select("part", F.coalesce("next", "first").alias("next"))
    heads = edge.select(F.col("part").alias("next"), F.col("head.text").alias("next_text"))
    last = edge.join(follows, "part").join(heads, "next").select("tail.doc_id", "tail.text", "next_text")
    return within.unionByName(last.mapInArrow(joined_rows, SCHEMA))
