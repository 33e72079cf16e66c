"""Connected components of a graph of long ids, by contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headway.session import durable

ROWS_PER_TASK = 200_000


def compact(df: DataFrame, most: int | None = None) -> tuple[DataFrame, int]:
    """``df`` from durable files, in no more partitions than its rows ask for, and the number of rows.

    Loops go on with frames that get small; joins of frames of one partition then need no shuffle at all. With ``most``, a
    bound of the rows, the partitions are merged before the files are written.
    """
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    kept = durable(df if most is None else df.coalesce(max(1, -(-most // ROWS_PER_TASK))))
    count = seen.get["rows"]
    return kept.coalesce(max(1, -(-count // ROWS_PER_TASK))), count


def joined(batches):
    """(node, component) of all edges of a task, by union-find."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (above := root.setdefault(x, x)) != x:
            root[x] = root[above]
            x = above
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    columns = [pa.array(x, pa.int64()) for x in (list(root), [find(x) for x in root])]
    yield pa.RecordBatch.from_arrays(columns, ["node", "component"])


def components(edges: DataFrame, count: int) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    ``edges``: ``count`` distinct pairs a < b that can be read again and again.

    Each round, every node picks the lowest of itself and its neighbours, nodes are replaced by what they
    picked, and edges within one node go. The first round ranks by id, which settles stars at once; later
    ones by a hash that changes, so that a chain shrinks by a constant factor. Only per-node minima are
    aggregated (with map-side partial sums), so a node with very many neighbours is no single task's work.
    Joins are by sorting, as no side has a bound that would let the driver collect it. At most
    ``ROWS_PER_TASK`` edges are joined in one task instead, with the same result.
    """
    if count <= ROWS_PER_TASK:
        return edges.coalesce(1).mapInArrow(joined, "node long, component long")
    picks = []
    left = edges
    while count:
        ways = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in (("a", "b"), ("b", "a"))]
        both = left.select(F.inline(F.array(*ways)))
        rank = (lambda c: F.col(c)) if not picks else (lambda c, k=len(picks): F.xxhash64(F.lit(k), c))  # noqa: B023
        lowest = both.groupBy("node").agg(
            F.min_by("other", rank("other")).alias("other"), F.min(rank("other")).alias("rank")
        )
        pick = F.when(F.col("rank") < rank("node"), F.col("other")).otherwise(F.col("node"))
        picked, _ = compact(lowest.select("node", pick.alias("pick")), 2 * count)
        picks.append(picked)
        a, b = picked.toDF("a", "x"), picked.toDF("b", "y")
        left = left.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        left, count = compact(left.filter("a <> b").distinct(), count)
    if not picks:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    found = picks[0].toDF("node", "label")
    for picked in picks[1:]:
        following = picked.toDF("label", "next")
        found = found.join(following.hint("merge"), "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    lowest = found.groupBy("label").agg(F.min("node").alias("component"))
    return found.join(lowest.hint("merge"), "label").select("node", "component")
