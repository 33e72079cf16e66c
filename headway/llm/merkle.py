"""A Merkle manifest of a document table as a content-addressed DAG, and a proof for every row by descent.

Every row is a leaf: the digest of its fields. The leaves of a language, in the order of their ids, are the
bottom of one tree: two neighbours become the digest of their two digests, a lone last one the digest of its
own, until one is left, the subroot. The subroots, in the order of their languages, are the bottom of a last
tree, whose top is the root of the manifest.

What is stored are records from a digest to its children. Records travel in pages, the ``LEVELS`` levels
below one digest, kept once a digest, so that a page holds at most 2**``LEVELS`` leaves and the largest
language is only more pages. A request starts at the root and goes down by the binary digits of its rank, keeps the
child that it does not choose at every record, and has its path in the end by reversing the segments.
Requests to the same page below go together: a page is asked once a place, not once a leaf, so no digest
near the root meets all rows. The number of rounds is that of the page levels, the logarithm of the largest
language, and no row, page or path goes through the driver.

Null fields count as ``-``. Null languages are the first tree, null ids the first leaves; rows with the same
id are ordered by their digest; equal rows are leaves each. A language with one row has that leaf as its
subroot. An empty table has no root and gives no rows. Texts may have any length; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.session import durable, shuffle_tasks

LEVELS = 8
#: Ranked rows of one task.
TASK_ROWS = 1 << 20
ALONE, LEFT, RIGHT = "", "<", ">"

RECORDS = "array<struct<digest:string,children:array<string>>>"


def digest_of(digests: list[str]) -> str:
    """The digest of the digests' hexadecimal text, one after the other."""
    return hashlib.sha256("".join(digests).encode("ascii")).hexdigest()


def levels_of(total: int, most: int) -> int:
    """How many levels, at most ``most``, of one page lie over ``total`` digests."""
    return min(most, (total - 1).bit_length())


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(n_chars: Column) -> Column:
    """The digest of a row's doc_id, source, lang, ``n_chars`` and text."""
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    return F.sha2(F.concat(*map(_field, fields)), 256)


def tampered() -> Column:
    """Whether a row is one whose ``n_chars`` is changed after the manifest was made."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()


def leaf_rows(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, altered) of every row; ``altered``: the leaf after tampering, null without."""
    docs = docs.select(F.col("doc_id").cast("long"), "source", "lang", F.col("n_chars").cast("long"), "text")
    more = F.try_add(F.col("n_chars"), F.lit(1).cast("long"))
    return docs.select(
        # A key that is never null and sorts as the languages do, the null one first.
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        "doc_id",
        leaf_digest(F.col("n_chars")).alias("leaf"),
        F.when(tampered(), leaf_digest(more)).alias("altered"),
    )


def ranked(rows: DataFrame, order: list[str], tasks: int) -> DataFrame:
    """``rows`` with their ``rank`` in their tree, from 0, and its ``total``.

    Rows are sorted by ranges, so a tree of any size is many tasks; only its counts per range meet.
    ``rows`` must be stored. Equal rows are told apart by their place, so that ranges can cut between them.
    """
    part = F.shiftright("_at", 33)
    keys = ["tree", *order, "_place"]
    placed = durable(
        rows.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(tasks, *keys)
        .sortWithinPartitions(*keys)
        .drop("_place")
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", part)
    counts = placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("tree")
    shifts = counts.select(
        "tree",
        "_part",
        (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("total"),
    )
    joined = placed.join(shifts, ["tree", "_part"])
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "total")


def _pages(nodes: DataFrame, most: int) -> DataFrame:
    """(tree, block, total, digest, records, members) of every run of 2**``most`` digests of a tree.

    ``nodes``: tree, rank, digest, total, and ``carried``, a struct that the members keep.
    """

    def build(batches):
        for batch in batches:
            digests, records = [], []
            for members, total in zip(batch.column("members").to_pylist(), batch.column("total").to_pylist()):
                level, found = [m["digest"] for m in members], {}
                for _ in range(levels_of(total, most)):
                    above = []
                    for i in range(0, len(level), 2):
                        children = level[i : i + 2]
                        above.append(digest_of(children))
                        found[above[-1]] = children
                    level = above
                digests.append(level[0])
                records.append([{"digest": d, "children": c} for d, c in found.items()])
            kind = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("tree", "block", "total")), pa.array(digests, pa.string()),
                 pa.array(records, kind), batch.column("members")],
                ["tree", "block", "total", "digest", "records", "members"],
            )

    grouped = nodes.groupBy("tree", F.shiftright("rank", most).alias("block")).agg(
        F.first("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("rank", "digest", "carried"))).alias("members"),
    ).select("tree", "block", "total", "members")
    kind = grouped.schema["members"].dataType.simpleString()
    return grouped.mapInArrow(build, f"tree string, block long, total long, digest string, records {RECORDS}, members {kind}")


def _trees(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The pages over ``leaves`` (tree, rank, digest, total, carried), band by band from the bottom."""
    span = 1 << most
    largest = leaves.agg(F.max("total")).first()[0]
    bands, nodes = [], leaves
    while largest is not None:
        bands.append(durable(_pages(nodes, most)))
        if largest <= span:
            break
        largest = -(-largest // span)
        nodes = bands[-1].filter(F.col("total") > span).select(
            "tree", F.col("block").alias("rank"), "digest",
            F.expr(f"(total + {span - 1}) div {span}").alias("total"),
            F.lit(None).cast("struct<none:int>").alias("carried"),
        )
    return bands


def _tops(bands: list[DataFrame], most: int) -> DataFrame | None:
    """(tree, digest) of the last page of every tree."""
    tops = None
    for pages in bands:
        found = pages.filter(F.col("total") <= 1 << most).select("tree", "digest")
        tops = found if tops is None else tops.unionAll(found)
    return tops


@dataclass
class Manifest:
    """The pages of the languages' trees and of the tree over them; both lists are empty for an empty table."""

    bands: list[DataFrame]
    top: list[DataFrame]
    levels: int = LEVELS

    def records(self) -> DataFrame | None:
        """(digest, children), each digest once."""
        every = None
        for pages in [*self.bands, *self.top]:
            found = pages.select(F.inline("records"))
            every = found if every is None else every.unionAll(found)
        return None if every is None else every.dropDuplicates(["digest"])

    def root(self) -> str | None:
        """The digest that names the whole table."""
        return self.top[-1].first().digest if self.top else None


def build_manifest(leaves: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of ``leaves`` as ``leaf_rows`` gives them; runs jobs and stores what it makes.

    ``levels``: those of a page. The digests are the same whatever it is.
    """
    tasks = shuffle_tasks(leaves.sparkSession)
    stored = durable(leaves)  # the texts are read once
    rows = stored.count()
    placed = ranked(stored, ["doc_id", "leaf"], max(tasks, -(-rows // TASK_ROWS)))
    carried = F.struct("doc_id", "altered").alias("carried")
    bands = _trees(placed.select("tree", "rank", F.col("leaf").alias("digest"), "total", carried), levels)
    if not bands:
        return Manifest([], [], levels)
    # The subroots are the leaves of one more tree.
    roots = durable(_tops(bands, levels).select(F.lit("").alias("tree"), F.col("tree").alias("language"), "digest"))
    count = roots.count()
    placed = ranked(roots, ["language"], max(1, -(-count // TASK_ROWS)))
    carried = F.struct("language").alias("carried")
    top = _trees(placed.select("tree", "rank", "digest", "total", carried), levels)
    return Manifest(bands, top, levels)


def _descend(page: dict[str, list[str]], digest: str, k: int, levels: int) -> tuple[str, list[str]]:
    """From ``digest`` down to the ``k``-th digest at the page's bottom: that one, and what was not chosen."""
    segment = []
    for level in reversed(range(levels)):
        children = page[digest]
        chosen = k >> level & 1
        if len(children) == 1:
            segment.append(ALONE)
        else:
            segment.append(f"{LEFT}{children[0]}" if chosen else f"{RIGHT}{children[1]}")
        digest = children[chosen]
    return digest, segment


def _asked(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """The requests with the members of their place and the records of their digest."""
    members = pages.select("tree", "block", F.col("total").alias("total"), "members")
    store = pages.select("digest", "records").dropDuplicates(["digest"])
    return requests.join(members, ["tree", "block"]).join(store, "digest")


def _walk(bands: list[DataFrame], starts: DataFrame, most: int) -> DataFrame:
    """From the tops of the trees to the requests of their lowest pages, with members and records.

    ``starts``: tree, digest, path and further columns. A tree is joined at the band that holds its top.
    """
    extra = [c for c in starts.columns if c not in ("tree", "digest", "path")]
    requests = None
    for at in reversed(range(len(bands))):
        pages = bands[at]
        first = pages.filter(F.col("total") <= 1 << most).select("tree", F.lit(0).cast("long").alias("block"))
        entering = starts.join(first, "tree").select("tree", "block", "digest", "path", *extra)
        requests = entering if requests is None else requests.unionByName(entering)
        asked = _asked(requests, pages)
        if not at:
            return asked

        def below(batches):
            for batch in batches:
                index, blocks, digests, paths = [], [], [], []
                columns = [batch.column(c).to_pylist() for c in ("block", "digest", "path", "total", "members", "records")]
                for row, (block, digest, path, total, members, records) in enumerate(zip(*columns)):
                    page = {r["digest"]: r["children"] for r in records}
                    for k in range(len(members)):
                        child, segment = _descend(page, digest, k, levels_of(total, most))
                        index.append(row)
                        blocks.append((block << most) + k)
                        digests.append(child)
                        paths.append(path + segment)
                taken = [batch.column(c).take(pa.array(index, pa.int64())) for c in ("tree", *extra)]
                yield pa.RecordBatch.from_arrays(
                    [*taken, pa.array(blocks, pa.int64()), pa.array(digests, pa.string()), pa.array(paths, pa.list_(pa.string()))],
                    ["tree", *extra, "block", "digest", "path"],
                )

        kept = ", ".join(f"{c} {starts.schema[c].dataType.simpleString()}" for c in extra)
        fields = "tree string, " + (f"{kept}, " if kept else "") + "block long, digest string, path array<string>"
        requests = asked.mapInArrow(below, fields)


def _subroot_requests(manifest: Manifest) -> DataFrame:
    """(tree, digest, path, root): every language's subroot, reached from the root."""
    starts = manifest.top[-1].select("tree", "digest", F.array().cast("array<string>").alias("path"), F.col("digest").alias("root"))
    most = manifest.levels

    def reach(batches):
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("digest", "path", "root", "total", "members", "records")]
            for digest, path, root, total, members, records in zip(*columns):
                page = {r["digest"]: r["children"] for r in records}
                for k, member in enumerate(members):
                    child, segment = _descend(page, digest, k, levels_of(total, most))
                    out.append((member["carried"]["language"], child, path + segment, root))
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
            values = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(v), kind) for v, kind in zip(values, kinds)], ["tree", "digest", "path", "root"]
            )

    return _walk(manifest.top, starts, most).mapInArrow(reach, "tree string, digest string, path array<string>, root string")


def siblings_of(path: list[str]) -> list[str]:
    """The siblings of a path that leads down from the root, in the order of a proof."""
    return [step[1:] for step in reversed(path) if step]


def fold(leaf: str, path: list[str]) -> str:
    """The root that ``leaf`` leads to over the siblings of ``path``."""
    for step in reversed(path):
        side, sibling = step[:1], step[1:]
        leaf = digest_of([sibling, leaf] if side == LEFT else [leaf, sibling])
    return leaf


PROOF = {
    "doc_id": ("long", pa.int64()), "leaf": ("string", pa.string()), "subroot": ("string", pa.string()),
    "root": ("string", pa.string()), "proof_sha256": ("string", pa.string()),
    "folded_root": ("string", pa.string()), "verified": ("boolean", pa.bool_()),
}
PATH = {"path": ("array<string>", pa.list_(pa.string()))}


def prove(manifest: Manifest, spark, paths: bool = False) -> DataFrame:
    """A row for every leaf: its proof's digest, and whether what the row holds now still leads to the root.

    ``paths`` adds the steps down from the root: ``<`` or ``>`` and the sibling at that side, or nothing.
    """
    columns, most = {**PROOF, **(PATH if paths else {})}, manifest.levels
    fields = ", ".join(f"{name} {kind}" for name, (kind, _) in columns.items())
    if not manifest.bands:
        return spark.createDataFrame([], fields)

    def verify(batches):
        for batch in batches:
            out = {name: [] for name in columns}
            names = ("digest", "subroot", "path", "root", "total", "members", "records")
            for digest, subroot, path, root, total, members, records in zip(*(batch.column(c).to_pylist() for c in names)):
                page = {r["digest"]: r["children"] for r in records}
                for k, member in enumerate(members):
                    leaf, segment = _descend(page, digest, k, levels_of(total, most))
                    steps = path + segment
                    folded = fold(member["carried"]["altered"] or leaf, steps)
                    proof = digest_of(siblings_of(steps))
                    row = (member["carried"]["doc_id"], leaf, subroot, root, proof, folded, folded == root, steps)
                    for name, value in zip(columns, row):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[name], kind) for name, (_, kind) in columns.items()], list(columns)
            )

    starts = _subroot_requests(manifest).withColumn("subroot", F.col("digest"))
    return _walk(manifest.bands, starts, most).mapInArrow(verify, fields)
