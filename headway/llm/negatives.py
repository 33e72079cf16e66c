"""Hard negatives of anchors, by rotated one-bit codes that bound every score, and integer scores of the rest.

Every vector is scaled to integers. Its code is one bit a dimension: the signs of the vector after a fixed
random rotation, that is a unit vector c with entries of equal size. Stored with it are the alignment <v, c>
and the length of the residual v - <v, c> c. An anchor's rotated vector is cut into ``PLANES`` bit planes, so
that <a, c> comes from popcounts, with an error of at most the length of what the planes leave out. The score
is <a, v> = <v, c><a, c> + <a, residual>, and since the residual is at a right angle to c, the last term is at
most the residual's length times that of a's part beside c (Cauchy-Schwarz). These bounds hold always, not
just likely. A pair whose interval lies outside the scores that are still wanted is left out, all others are
scored exactly, in integers. So results are those of all pairs. On vectors without structure intervals are wide (about 0.6 of the
lengths' product) and most pairs are scored; the closer the wanted scores are to the extremes, the fewer.

Rows and anchors are dealt by hashes of their ids into blocks of about ``ROWS`` and ``ANCHORS``, whatever
their labels, and each pair of blocks is a task's work: it needs memory for two blocks and a tile, and leaves
at most the wanted number of rows an anchor. The work is anchors times rows by its definition.

Rows with a null id, label or vector, or with any null or non-finite component, take no part. Of rows with one id the one with the
smallest label, then vector, counts. Vectors of different lengths are filled with zeros up to the longest;
scaled components end at a bound (148,000 for 64 dimensions, unscaled) that keeps scores inside 64 bits.
Ties go to the smaller id. An empty table, or one without anchors, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.arrow import flat_bytes, list_array
from headway.session import durable

SCALE = 256
ROWS = 1 << 13
ANCHORS = 1 << 13
PLANES = 6
#: Pairs that are bounded and scored at a time, and rows of them.
TILE, TILE_ROWS = 1 << 20, 1 << 12
LOWEST = np.iinfo(np.int64).min

INDEX = "vec_id long, label long, vector array<long>, code binary, aligned double, residual double"


@lru_cache(maxsize=2)
def rotation(dim: int) -> np.ndarray:
    """A random rotation of ``dim`` dimensions, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(20240601).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def limit_of(dim: int) -> int:
    """The largest scaled component with which a hundred times a score stays inside 64 bits."""
    return math.isqrt((2**63 - 1) // (100 * max(dim, 1)))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (words of 64 bits), alignments and residual lengths of integer vectors, one a row."""
    n, dim = vectors.shape
    turned = vectors.astype(np.float64) @ rotation(dim)
    bits = np.zeros((n, -(-dim // 64) * 64), bool)
    bits[:, :dim] = turned > 0
    codes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    aligned = np.abs(turned).sum(axis=1) / math.sqrt(dim)
    residual = np.sqrt(np.maximum((turned * turned).sum(axis=1) - aligned * aligned, 0))
    return codes, aligned, residual


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, one an id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    first = rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    return first.select("vec_id", "row.label", "row.embedding")


def build_index(rows: DataFrame, dim: int) -> DataFrame:
    """The scaled vector, code, alignment and residual of every row of ``usable``."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            lists = batch.column("embedding")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            filled = np.arange(dim)[None, :] < sizes[:, None]
            vectors = np.zeros((n, dim), np.int64)
            limit = limit_of(dim)
            vectors[filled] = np.clip(np.floor(SCALE * lists.flatten().to_numpy()), -limit, limit).astype(np.int64)
            codes, aligned, residual = encode(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 list_array(vectors.ravel(), np.arange(n + 1) * dim, pa.int64()),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(aligned), pa.array(residual)],
                ["vec_id", "label", "vector", "code", "aligned", "residual"],
            )

    return rows.mapInArrow(run, INDEX)


class Block:
    """The rows of a block as arrays, in the order of their ids."""

    def __init__(self, table: pa.Table, dim: int):
        table = table.combine_chunks().sort_by("vec_id")
        column = lambda name: table.column(name).to_numpy()
        self.ids, self.labels = column("vec_id"), column("label")
        self.aligned, self.residual = column("aligned"), column("residual")
        self.vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        codes = flat_bytes(table.column("code").combine_chunks())[0]
        self.codes = codes.view(np.uint64).reshape(-1, -(-dim // 64))
        self.ones = np.bitwise_count(self.codes).sum(axis=1, dtype=np.int64)
        self.largest = int(np.abs(self.vectors).max(initial=0))


class Anchors:
    """Integer vectors with bit planes of their rotations, and the scores ``low`` to ``high`` wanted in each slot."""

    def __init__(self, ids, labels, vectors, low, high, k: int):
        self.ids, self.labels, self.vectors, self.low, self.high = ids, labels, vectors, low, high
        turned = vectors.astype(np.float64) @ rotation(vectors.shape[1])
        self.floor = turned.min(axis=1)
        steps = (1 << PLANES) - 1
        self.step = np.maximum((turned.max(axis=1) - self.floor) / steps, np.finfo(np.float64).tiny)
        levels = np.clip(np.rint((turned - self.floor[:, None]) / self.step[:, None]), 0, steps).astype(np.int64)
        left_out = turned - self.floor[:, None] - self.step[:, None] * levels
        self.error = np.sqrt((left_out * left_out).sum(axis=1))
        self.length = np.sqrt((turned * turned).sum(axis=1))
        self.total = levels.sum(axis=1)
        n, dim = vectors.shape
        bits = np.zeros((PLANES, n, -(-dim // 64) * 64), bool)
        for p in range(PLANES):
            bits[p, :, :dim] = levels >> p & 1
        self.planes = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)
        self.scores = np.full((n, low.shape[1], k), LOWEST)
        self.found = np.zeros((n, low.shape[1], k), np.int64)

    def bounds(self, at: slice, block: Block, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of anchors ``at`` with ``rows`` of a block."""
        codes = block.codes[rows]
        weighted = np.zeros((at.stop - at.start, len(rows)), np.int64)
        for p in range(PLANES):
            for w in range(codes.shape[1]):
                weighted += np.bitwise_count(self.planes[p, at, w][:, None] & codes[None, :, w]).astype(np.int64) << p
        dim = self.vectors.shape[1]
        column = lambda values: values[at][:, None]
        along = column(self.step) * (2 * weighted - column(self.total)) + column(self.floor) * (2 * block.ones[rows] - dim)
        along /= math.sqrt(dim)
        error, length = column(self.error), column(self.length)
        least = np.maximum(np.abs(along) - error, 0)
        beside = np.sqrt(np.maximum(length * length - least * least, 0))
        aligned, residual = block.aligned[rows][None, :], block.residual[rows][None, :]
        # Sums in floating point are off by far less than this.
        slack = 1e-9 * length * (aligned + residual) + 1e-6
        half = aligned * error + residual * beside + slack
        centre = aligned * along
        return centre - half, centre + half

    def search(
        self, block: Block, rows: np.ndarray, mine: np.ndarray, same: bool, tile: int = TILE, tile_rows: int = TILE_ROWS
    ) -> int:
        """Bring the best scores up to date with ``rows`` of a block; how many pairs were scored."""
        scored, size = 0, max(1, tile // tile_rows)
        for start in range(0, len(mine), size):
            anchors = mine[start : start + size]
            part = self._take(anchors)
            for first in range(0, len(rows), tile_rows):
                scored += part._tile(block, rows[first : first + tile_rows], same)
            self.scores[anchors], self.found[anchors] = part.scores, part.found
        return scored

    def _take(self, at: np.ndarray) -> Anchors:
        part = object.__new__(Anchors)
        for name, value in vars(self).items():
            setattr(part, name, value[:, at] if name == "planes" else value[at])
        return part

    def _tile(self, block: Block, rows: np.ndarray, same: bool) -> int:
        every = slice(0, len(self.ids))
        lower, upper = self.bounds(every, block, rows)
        # A slot wants nothing below its best k so far; a row that ties with the last may have a smaller id.
        wanted = np.maximum(self.low, self.scores[:, :, -1])
        open_slots = wanted <= self.high
        least = np.where(open_slots, wanted.astype(np.float64), np.inf).min(axis=1, initial=np.inf)
        most = np.where(open_slots, self.high.astype(np.float64), -np.inf).max(axis=1, initial=-np.inf)
        equal = self.labels[:, None] == block.labels[rows][None, :]
        alive = (equal if same else ~equal) & (self.ids[:, None] != block.ids[rows][None, :])
        alive &= (upper >= least[:, None]) & (lower <= most[:, None])
        some, any_row = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(some):
            return 0
        alive, rows = alive[np.ix_(some, any_row)], rows[any_row]
        scores = integer_scores(self.vectors[some], block.vectors[rows], block.largest)
        for slot in range(self.low.shape[1]):
            inside = alive & (scores >= wanted[some, slot][:, None]) & (scores <= self.high[some, slot][:, None])
            a, b = np.nonzero(inside)
            if len(a):
                self._keep(some, slot, a, scores[a, b], block.ids[rows[b]])
        return int(alive.sum())

    def _keep(self, some: np.ndarray, slot: int, owner: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """The k best of what a slot had and what is new, by score, then id."""
        k = self.scores.shape[2]
        touched = np.unique(owner)
        had = self.scores[some[touched], slot]
        real = had != LOWEST
        owner = np.concatenate([owner, np.repeat(touched, real.sum(axis=1))])
        scores = np.concatenate([scores, had[real]])
        ids = np.concatenate([ids, self.found[some[touched], slot][real]])
        order = np.lexsort((ids, -scores, owner))
        owner, scores, ids = owner[order], scores[order], ids[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = rank < k
        at = some[owner[kept]]
        self.scores[some[touched], slot] = LOWEST
        self.scores[at, slot, rank[kept]], self.found[at, slot, rank[kept]] = scores[kept], ids[kept]


def integer_scores(left: np.ndarray, right: np.ndarray, largest: int) -> np.ndarray:
    """All inner products, exactly; in floating point where every sum is a whole number below 2**53."""
    bound = int(np.abs(left).max(initial=0)) * largest * left.shape[1]
    if bound < 1 << 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def _dealt(index: DataFrame, queries: DataFrame, rows: int, anchors: int):
    """Rows and queries grouped by pairs of blocks."""
    across, down = -(-rows // ROWS), max(1, -(-anchors // ANCHORS))

    def block(seed: int, n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = index.withColumn("down", every(down)).withColumn("across", block(1, across))
    right = queries.withColumn("across", every(across)).withColumn("down", block(2, down))
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # both come from the index
    return left.groupBy("across", "down").cogroup(right.groupBy("across", "down"))


def _positives(index: DataFrame, anchors: DataFrame, dim: int, sizes: tuple[int, int], count: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the best ``count`` other rows of each anchor's label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, own = Block(left, dim), Block(right, dim)
        n = len(own.ids)
        low, high = np.full((n, 1), LOWEST + 1), np.full((n, 1), np.iinfo(np.int64).max)
        queries = Anchors(own.ids, own.labels, own.vectors, low, high, count)
        for label in np.unique(own.labels):
            rows = np.flatnonzero(block.labels == label)
            queries.search(block, rows, np.flatnonzero(own.labels == label), same=True)
        a, _, k = np.nonzero(queries.scores != LOWEST)
        return pa.table({"anchor_id": own.ids[a], "positive_id": queries.found[a, 0, k], "positive_score": queries.scores[a, 0, k]})

    found = _dealt(index, anchors, *sizes).applyInArrow(run, "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= count).drop("place")


def _negatives(
    index: DataFrame, queries: DataFrame, dim: int, sizes: tuple[int, int], count: int, low: int, high: int
) -> DataFrame:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score), the best ``count`` of each block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.combine_chunks().sort_by("vec_id")
        block, own = Block(left, dim), Block(right, dim)
        pairs = right.column("positives").to_pylist()
        width = max(map(len, pairs), default=0)
        positive, score = np.zeros((2, len(pairs), width), np.int64)
        least, most = np.zeros((len(pairs), width), np.int64), np.full((len(pairs), width), -1)
        for a, slots in enumerate(pairs):
            for j, slot in enumerate(slots):
                positive[a, j], score[a, j] = slot["positive_id"], slot["positive_score"]
                least[a, j], most[a, j] = -(-low * slot["positive_score"] // 100), high * slot["positive_score"] // 100
        queries = Anchors(own.ids, own.labels, own.vectors, least, most, count)
        queries.search(block, np.arange(len(block.ids)), np.arange(len(own.ids)), same=False)
        a, j, k = np.nonzero(queries.scores != LOWEST)
        return pa.table(
            {"anchor_id": own.ids[a], "positive_id": positive[a, j], "positive_score": score[a, j],
             "negative_id": queries.found[a, j, k], "negative_score": queries.scores[a, j, k]}
        )

    fields = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    return _dealt(index, queries, *sizes).applyInArrow(run, fields)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    embeddings: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """For each anchor and each of its best ``positives`` rows of its label, the best ``negatives`` rows of other labels.

    ``embeddings``: vec_id, label, embedding; ``anchors``: which of its rows are anchors. A negative's score is
    from ``low`` to ``high`` percent of the positive's.
    """
    rows = usable(embeddings)
    dim = embeddings.agg(F.max(F.size("embedding"))).first()[0]
    dim = max(dim or 0, 1)
    index = durable(build_index(rows, dim))
    sizes = index.agg(F.count(F.lit(1)), F.count(F.when(anchors, 1))).first()
    if not sizes[1]:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    asked = index.filter(anchors)
    best = durable(_positives(index, asked, dim, tuple(sizes), positives))
    slots = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")  # at most `positives`
    )
    found = _negatives(index, asked.join(slots, "vec_id"), dim, tuple(sizes), negatives, low, high)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
