"""Near duplicates by circulant MinHash.

A text's words (runs of bytes other than white space, A-Z lower-cased) give its set of distinct five-word
shingles, as 64-bit hashes. One permutation places each shingle on a circle of ``CIRCLE`` points; the
second one, read from there on, gives the values of all ``BANDS * ROWS`` signature coordinates: coordinate
k takes it shifted by k. Texts that agree in a band are candidates, and a candidate pair is a link if the
full sets' likeness reaches the threshold.

At likeness 0.85 a pair shares no band with chance (1 - 0.85**8)**40, about 3 in a million.

* Texts with equal sets are one class, named by its smallest doc_id; only classes go further. Buckets with
  the same members count once.
* A bucket's pairs are not listed. In each round some leaders of every bucket (up to ``LEADERS``, which
  settles dense families, then ``MORE_LEADERS`` times as many each round) meet those members that are not yet in their component. Leaders then leave,
  since all of their pairs are decided; a bucket is closed when its members are in one component. So
  copies cost few comparisons, and no pair that could join two components is left out.
* A meeting counts as a pair only if sizes allow a link and so does the number of differing bits in
  ``BITS``-bit maps of the sets, which is never more than the sets differ: an exact bound that spares most
  members of a loose family the comparison of their sets.
* Sets are read from the whole texts again, of the classes in buckets only.

Fewer than five words are one shingle, the whole sequence; without words or text the set is empty and
links with nothing. Rows with the same doc_id are one document. A row without doc_id belongs to its class
and is kept only if nothing in its class has an id. An empty table gives an empty one; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.arrow import NARROW_SLICE_BYTES, flat_bytes, list_array, text_slices
from headway.llm.components import compact, components
from headway.llm.hashing import LOWER, SPACE, mix, prefix_sums, span_hashes, word_spans
from headway.session import durable

WORDS = 5
CIRCLE = 1 << 20
ROWS = 8
BANDS = 40
BITS = 1024
PERCENT = 85
LEADERS = 4
MORE_LEADERS = 1 << 18
CHUNK = 1 << 12
SKETCH = "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>"


class Permutations:
    """The two permutations, made from a seed once per worker."""

    made: Permutations | None = None

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.place = rng.permutation(CIRCLE).astype(np.int32)
        around = rng.permutation(CIRCLE).astype(np.int32)
        self.value = np.lib.stride_tricks.sliding_window_view(np.r_[around, around[: ROWS * BANDS - 1]], ROWS * BANDS)
        self.salt = rng.integers(1, 1 << 62, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)

    @classmethod
    def get(cls) -> Permutations:
        if cls.made is None:
            cls.made = cls()
        return cls.made

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        at = self.place[(shingles % np.uint64(CIRCLE)).astype(np.int64)]
        lowest = np.full(ROWS * BANDS, CIRCLE, np.int32)
        for i in range(0, len(at), CHUNK):
            np.minimum(lowest, self.value[at[i : i + CHUNK]].min(axis=0), out=lowest)
        return lowest

    def bands(self, signatures: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band of each signature; equal keys mean the same band and values."""
        rows = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64) + np.uint64(1)
        return mix((rows * self.salt).sum(axis=2, dtype=np.uint64) + self.salt[:, 0]).view(np.int64)


def shingle_sets(column) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    flat, bounds = flat_bytes(column)
    low = LOWER[flat]
    first, last, offsets = word_spans(~SPACE[flat], bounds)
    words = span_hashes(prefix_sums(low), first, last)
    odd = np.random.default_rng(9).integers(1, 1 << 62, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    count = max(len(words) - WORDS + 1, 0)
    rolled = np.zeros(count, np.uint64)
    for j in range(WORDS):
        rolled += words[j : j + count] * odd[j]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= WORDS:
            sets.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            short = (words[a:b] * odd[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix(np.array([short], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def bit_map(shingles: np.ndarray) -> np.ndarray:
    """The set as ``BITS`` bits, in 64-bit words."""
    flags = np.zeros(BITS, np.uint8)
    flags[(shingles >> np.uint64(32)).astype(np.int64) % BITS] = 1
    return np.packbits(flags).view(np.int64)


def sketch_batches(batches):
    made = Permutations.get()
    for batch in text_slices(batches, limit=NARROW_SLICE_BYTES):
        sets = shingle_sets(batch.column("text"))
        full = [made.signature(s) for s in sets if len(s)]
        bands = made.bands(np.array(full, np.int32).reshape(-1, ROWS * BANDS)).ravel()
        offsets = np.r_[0, np.cumsum([BANDS * bool(len(s)) for s in sets])]
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        columns = [
            batch.column("doc_id"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(digests, pa.binary()),
            list_array(bands, offsets, pa.int64()),
            list_array(np.concatenate([bit_map(s) for s in sets]), np.arange(len(sets) + 1) * (BITS // 64), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "bands", "bits"])


def set_batches(batches):
    for batch in text_slices(batches, limit=NARROW_SLICE_BYTES):
        sets = shingle_sets(batch.column("text"))
        offsets = np.r_[0, np.cumsum([len(s) for s in sets])]
        values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_array(values, offsets, pa.int64())], ["rep", "shingles"])


def could_link(n, bits, m, other_bits, percent: int):
    """Whether sets with these sizes and bit maps can be as alike; sets that link always pass."""
    words = F.zip_with(bits, other_bits, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differing = F.aggregate(words, F.lit(0), lambda total, x: total + x)
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (differing * (100 + percent) <= (n + m) * (100 - percent))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    a = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.join(b.hint("merge"), "b").join(a.hint("merge"), "a").filter(common * 100 >= union * percent).select("a", "b").distinct()


def shared_buckets(reps: DataFrame) -> DataFrame:
    """(bucket, rep) of the buckets with several classes, one bucket of those with the same members."""
    entries = reps.select("rep", F.explode("bands").alias("bucket"))
    full = entries.groupBy("bucket").agg(
        F.min("rep").alias("low"),
        F.max("rep").alias("high"),
        F.sum(F.xxhash64(F.lit(1), "rep").bitwiseAND(F.lit((1 << 40) - 1))).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(2), "rep")).alias("xor"),
    )
    one = full.filter("low <> high").groupBy("low", "high", "sum", "xor").agg(F.min("bucket").alias("bucket"))
    return entries.join(one.select("bucket").hint("merge"), "bucket")


def link_components(texts: DataFrame, reps: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) over the classes ``reps`` (rep, n, bands, bits) that have links; None without."""
    facts = reps.select("rep", "n", "bits", F.col("rep").alias("component"))
    members, size = compact(shared_buckets(reps).join(facts.hint("merge"), "rep"))
    if not size:
        return None
    wanted = members.select("rep").distinct().hint("merge")
    sets = durable(
        texts.join(wanted, F.col("doc_id") == F.col("rep"), "left_semi")
        .mapInArrow(set_batches, "rep long, shingles array<long>")
    )
    links, leaders = None, LEADERS
    while True:
        part = F.pmod(F.xxhash64("rep"), F.lit(leaders))
        chosen = members.groupBy("bucket", part.alias("part")).agg(
            F.min("rep").alias("leader"),
            F.min_by(F.struct("n", "bits", "component"), "rep").alias("of"),
        )
        near = could_link(F.col("n"), F.col("bits"), F.col("of.n"), F.col("of.bits"), percent)
        met = members.join(chosen.hint("merge"), "bucket").filter((F.col("component") != F.col("of.component")) & near)
        pairs = met.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
        found = verified(pairs, sets, percent)
        links, count = compact(found if links is None else links.union(found).distinct())
        labels, _ = compact(components(links, count), 2 * count)
        gone = chosen.select("bucket", F.col("leader").alias("rep"))
        rest = members.drop("component").join(gone.hint("merge"), ["bucket", "rep"], "left_anti")
        rest = rest.join(labels.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
        rest = rest.withColumn("component", F.coalesce("component", "rep"))
        mixed = rest.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        rest = rest.join(mixed.filter("low <> high").select("bucket").hint("merge"), "bucket")
        members, size = compact(rest, size)
        if not size:
            return labels
        leaders *= MORE_LEADERS


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    sketches = durable(texts.mapInArrow(sketch_batches, SKETCH))
    filled = sketches.filter("n_shingles > 0")
    classes = filled.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = filled.join(classes.hint("merge"), "digest").filter("doc_id = rep")
    labels = link_components(texts, reps.select("rep", F.col("n_shingles").alias("n"), "bands", "bits"), percent)
    if labels is None:
        named, component = classes, F.col("rep")
    else:
        named = classes.join(labels.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
        component = F.coalesce("component", "rep")
    named = named.select("digest", component.alias("found"))
    own = sketches.select("doc_id", "n_shingles", "digest").join(named.hint("merge"), "digest", "left")
    own = own.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("found")).otherwise(F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return own.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
