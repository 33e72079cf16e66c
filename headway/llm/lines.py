"""Line deduplication by pairwise alignment.

Lines (between line feeds, compared without outer spaces, tabs and returns) are hashed. Two documents can
share an aligned block of at least ``MIN_CHARS`` characters only if they share a shortest run of neighbouring
lines of so many characters, counted from a line on or back from a line; every line of a block lies in such a
run of the block. So these runs, short and blank lines included, name the partners, by the rule by which blocks
are deleted. Each document is aligned with its partners by patience diff: lines that occur once in both, the
longest run of them that is in order in both, equal lines next to them, and again between them. Aligned blocks
of at least ``MIN_CHARS`` characters are deleted from the later document; out of order, repetition stays.

The result is that of an alignment with all earlier documents, by doc_id, in rounds. In the first, a run names
the first document that holds it, so pairs grow with the lines. Later rounds take the shared runs of which lines
are left, and align the document with more of their earlier holders (``SPREAD``), the last one with all that were
not tried; of holders with equal texts one does there. Rare runs, with up to ``RARE`` holders, name them as they
are. A more frequent one names only those holders that share an anchor with the document too: a line that occurs once
in both, or the first or the last line that is not blank, as far from the end. Without any a patience diff matches
nothing but blank lines, so none is lost, and lines repeated inside of documents, like separators, name no partners
by themselves.

Only line hashes travel to the alignment, as one array a document; texts are read again for the result.

Null and empty texts, and documents without doc_id, stay as they are. Rows with the same doc_id are not
partners of each other. Repeated rows get the same result. Documents may have any number of lines. An
empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.arrow import SLICE_BYTES
from headway.llm.hashing import BASE, INVERSE, mix, powers
from headway.session import durable

MIN_CHARS = 40
#: Holders of a run, one of each hash class of doc_id, that the rounds between the first and the last try.
SPREAD = (16, 256)
#: Holders up to which a run is rare. Both kinds give the same result.
RARE = 64
#: Numbers (line hashes, rows of a few columns) that make a partition of what a round passes on.
PART_NUMBERS = 20_000
#: Line hashes and runs of the documents that are left up to which they are sent to all tasks, at most some MB.
FEW = 100_000


def lines_of(text) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def bare(line) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence, given in order of the first, that also rises in the second (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        if k == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[k], piles[k] = b, i
        back[i] = piles[k - 1] if k else -1
    found, i = [], piles[-1] if piles else -1
    while i >= 0:
        found.append(pairs[i])
        i = back[i]
    return found[::-1]


def once(lines: list[int], low: int, high: int) -> dict[int, int]:
    """Line to place, for lines that occur once in the range; -1 stands for more."""
    places: dict[int, int] = {}
    for i in range(low, high):
        places[lines[i]] = -1 if lines[i] in places else i
    return places


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, rising in both, by patience diff; 0 is a blank line and no anchor."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = once(a, a0, a1), once(b, b0, b1)
        anchors = in_order(
            [(i, in_b[x]) for x, i in in_a.items() if x and i >= 0 and in_b.get(x, -1) >= 0]
        )
        before = (a0, b0)
        for i, j in anchors:
            matched.append((i, j))
            todo.append((before[0], i, before[1], j))
            before = (i + 1, j + 1)
        if anchors:
            todo.append((before[0], a1, before[1], b1))
    return sorted(matched)


def blocks(pairs: list[tuple[int, int]], sizes: list[int], min_chars: int) -> list[int]:
    """Places in the second document of aligned blocks (neighbours in both) with enough characters."""
    found: list[int] = []
    block: list[int] = []
    for k, (i, j) in enumerate(pairs):
        if block and pairs[k - 1] != (i - 1, j - 1):
            found += block if sum(sizes[x] for x in block) >= min_chars else []
            block = []
        block.append(j)
    return found + (block if sum(sizes[x] for x in block) >= min_chars else [])


def aligned_batches(min_chars: int):
    step = max(1, SLICE_BYTES >> 12)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                columns = (batch.column(n).to_pylist() for n in ("lines_a", "lines_b", "sizes_b"))
                removed = [blocks(align(a, b), sizes, min_chars) for a, b, sizes in zip(*columns)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("tie"), pa.array(removed, pa.list_(pa.int32()))],
                    ["doc_id", "tie", "removed"],
                )

    return run


def run_keys(hashes, sizes, bounds, min_chars: int, gone=None) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of the shortest runs of ``min_chars`` characters from each line on and back from each.

    ``bounds`` are the documents' offsets into the lines. With ``gone``, only runs that hold a line not marked.
    """
    n = len(hashes)
    chars = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    sums = np.zeros(n + 1, np.uint64)
    # Blank lines are 0; one more, so that they count.
    np.cumsum((hashes + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    on = np.searchsorted(chars, chars[:-1] + min_chars, side="left")
    back = np.searchsorted(chars, chars[1:] - min_chars, side="right") - 1
    forward, backward = on <= bounds[doc + 1], back >= bounds[doc]
    start = np.r_[np.flatnonzero(forward), back[backward]]
    stop = np.r_[on[forward], np.flatnonzero(backward) + 1]
    if gone is not None:
        marked = np.r_[0, np.cumsum(gone, dtype=np.int64)]
        left = marked[stop] - marked[start] < stop - start
        start, stop = start[left], stop[left]
    keys = mix((sums[stop] - sums[start]) * powers(INVERSE, n + 1)[start] + (stop - start).astype(np.uint64))
    found = np.unique(np.stack([doc[start].astype(np.uint64), keys], axis=1), axis=0)
    return found[:, 0].astype(np.int64), found[:, 1].astype(np.int64)


def key_batches(min_chars: int):
    step = max(1, SLICE_BYTES >> 12)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                lists = batch.column("hashes")
                bounds = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]
                hashes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
                gone = None
                if "removed" in batch.schema.names:
                    gone = np.zeros(len(hashes), bool)
                    for k, places in enumerate(batch.column("removed").to_pylist()):
                        gone[bounds[k] + np.array(places or [], np.int64)] = True
                sizes = batch.column("sizes").flatten().to_numpy(zero_copy_only=False)
                doc, keys = run_keys(hashes, sizes, bounds, min_chars, gone)
                rows = pa.array(doc)
                columns = [pa.array(keys), batch.column("doc_id").take(rows), batch.column("tie").take(rows)]
                yield pa.RecordBatch.from_arrays(columns, ["line", "doc_id", "tie"])

    return run


def anchor_keys(hashes, bounds) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of the lines that can begin an alignment: those that occur once, the first and the last.

    Blank lines can not. First and last lines count with the blank ones before or behind them.
    """
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(hashes)
    order = at[np.lexsort((hashes[at], doc[at]))]
    same = (doc[order][1:] == doc[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    single = order[~(np.r_[False, same] | np.r_[same, False])] if len(order) else order
    new = np.r_[True, doc[at][1:] != doc[at][:-1]] if len(at) else np.zeros(0, bool)
    first, last = at[new], at[np.r_[new[1:], True]] if len(at) else at
    # An odd number tells a first line from a last one and both from the plain hash.
    from_start = mix(hashes[first] + (2 * (first - bounds[doc[first]]) + 1).astype(np.uint64) * np.uint64(BASE))
    from_end = mix(~hashes[last] + (2 * (bounds[doc[last] + 1] - last) + 1).astype(np.uint64) * np.uint64(BASE))
    return np.r_[doc[single], doc[first], doc[last]], np.r_[hashes[single], from_start, from_end].view(np.int64)


def anchor_batches(batches):
    step = max(1, SLICE_BYTES >> 12)
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            batch = whole.slice(at, step)
            lists = batch.column("hashes")
            bounds = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]
            doc, keys = anchor_keys(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), bounds)
            own = (batch.column(n).take(pa.array(doc)) for n in ("doc_id", "tie"))
            yield pa.RecordBatch.from_arrays([*own, pa.array(keys)], ["doc_id", "tie", "anchor"])


def left_batches(min_chars: int):
    """Rows of ``removed_lines``' documents with ``runs`` reduced to those that hold a line not in ``removed``."""
    step = max(1, SLICE_BYTES >> 12)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                lists, runs, removed = (batch.column(n) for n in ("hashes", "runs", "removed"))
                bounds = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]
                hashes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
                gone = np.zeros(len(hashes), bool)
                places = removed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                counts = removed.value_lengths().to_numpy(zero_copy_only=False)
                gone[np.repeat(bounds[:-1], counts) + places] = True
                sizes = batch.column("sizes").flatten().to_numpy(zero_copy_only=False)
                doc, keys = run_keys(hashes, sizes, bounds, min_chars, gone)
                first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                ends = np.r_[0, np.cumsum(runs.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]
                flat = runs.flatten()
                named = flat.field("line").to_numpy(zero_copy_only=False)
                left = np.ones(len(named), bool)
                for k in np.flatnonzero(counts):
                    left[ends[k] : ends[k + 1]] = np.isin(named[ends[k] : ends[k + 1]], keys[first[k] : first[k + 1]])
                offsets = np.r_[0, np.cumsum(left)][ends].astype(np.int32)
                kept = pa.ListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(left)))
                columns = [kept if n == "runs" else batch.column(n) for n in batch.schema.names]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def filled(numbers: int) -> int:
    """How many partitions so many numbers fill."""
    return max(1, -(-numbers // PART_NUMBERS))


def gathered(df: DataFrame, numbers: Column | None = None) -> tuple[DataFrame, int]:
    """``df`` kept, in no more partitions than its rows (or the ``numbers`` they hold) fill, and how many these are.

    What the rounds pass on is mostly small, whatever the number of shuffle partitions, and is read several times.
    """
    kept = durable(df)
    parts = filled(kept.agg(F.sum(F.lit(1) if numbers is None else numbers)).first()[0] or 0)
    return kept.coalesce(parts), parts


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, tie, removed, partners): places of the lines to delete, of documents that lose some.

    ``tie`` is a hash of the text, so that rows which share a doc_id are told apart. ``partners`` counts the
    aligned documents that took lines.
    """
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    lines = F.transform(lines_of(F.col("text")), bare)
    hashed = F.transform("lines", lambda x: F.when(x == "", F.lit(0)).otherwise(F.xxhash64(x)).cast("long"))
    keyed, parts = gathered(
        texts.filter("doc_id IS NOT NULL AND text IS NOT NULL")
        .select("doc_id", F.xxhash64("text").alias("tie"), lines.alias("lines"))
        .select("doc_id", "tie", hashed.alias("hashes"), F.transform("lines", F.length).alias("sizes")),
        F.size("hashes"),
    )
    own = ["doc_id", "tie"]
    naming = keyed.mapInArrow(key_batches(min_chars), "line long, doc_id long, tie long")
    owners = naming.groupBy("line").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest"), (F.count("*") > RARE).alias("frequent")
    )
    owners, _ = gathered(owners.filter("owner < latest").select("line", "owner", "frequent"))
    shared, _ = gathered(naming.join(owners, "line"))

    # The documents with an earlier holder of a run: their lines, the runs left, the owners tried, the result so far.
    runs = shared.filter("owner < doc_id").groupBy(*own).agg(F.collect_set(F.struct("line", "owner", "frequent")).alias("runs"))
    state = keyed.join(runs, own).dropDuplicates(own)
    state = state.withColumns({
        "tried": F.array_distinct("runs.owner"), "removed": F.array().cast("array<int>"), "partners": F.lit(0).cast("long")
    })
    numbers = F.size("hashes") + F.size("runs")
    state, state_parts = gathered(state, numbers)

    def align_pairs(pairs: DataFrame) -> DataFrame:
        earlier = keyed.select(F.col("doc_id").alias("owner"), F.col("hashes").alias("lines_a"))
        both = pairs.join(earlier, "owner").select(*own, "lines_a", "lines_b", "sizes_b")
        aligned = both.mapInArrow(aligned_batches(min_chars), "doc_id long, tie long, removed array<int>")
        return aligned.filter(F.size("removed") > 0)

    def settled(state: DataFrame, parts: int, aligned: DataFrame) -> DataFrame:
        """``state`` with what ``aligned`` removes; finished documents have no runs left, and their lines go."""
        # A set of places, so that what is gathered is bounded by the document's lines, not by its partners.
        places = aligned.select(*own, F.posexplode("removed").alias("nth", "place"))
        more = F.count(F.when(F.col("nth") == 0, F.lit(1))).alias("more")
        taken = places.groupBy(*own).agg(F.collect_set("place").alias("taken"), more)
        both = state.join(taken, own, "left").withColumns({
            "removed": F.when(F.col("taken").isNull(), F.col("removed")).otherwise(F.array_union("removed", "taken")),
            "partners": F.col("partners") + F.coalesce("more", F.lit(0)),
        }).select(*state.columns)
        left = both.coalesce(parts).mapInArrow(left_batches(min_chars), state.schema)
        return left.withColumns({n: F.when(F.size("runs") > 0, F.col(n)) for n in ("hashes", "sizes", "tried")})

    def lines_b(pairs: DataFrame) -> DataFrame:
        return pairs.withColumnsRenamed({"hashes": "lines_b", "sizes": "sizes_b"})

    def holders_of(left: DataFrame, frequent: bool) -> tuple[DataFrame, int]:
        """(line, anchor, doc_id, tie) of all holders: no anchor (0) for a rare run, for a frequent one each that others have."""
        holders = shared.join(left.select("line"), "line", "left_semi").drop("owner")
        rare = holders.filter("NOT frequent").select("line", F.lit(0).cast("long").alias("anchor"), *own)
        if not frequent:
            return gathered(rare)
        often, _ = gathered(holders.filter("frequent").select("line", *own))
        of = keyed.join(often.select(*own), own, "left_semi").dropDuplicates(own).coalesce(parts)
        anchors, _ = gathered(of.mapInArrow(anchor_batches, "doc_id long, tie long, anchor long"))
        ends = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        anchors = anchors.join(ends.filter("low < high").select("anchor"), "anchor", "left_semi")
        return gathered(rare.unionByName(often.join(anchors, own).select("line", "anchor", *own)))

    pairs = state.select(F.explode("tried").alias("owner"), *own, "hashes", "sizes")
    state = durable(settled(state, state_parts, align_pairs(lines_b(pairs))))
    done, tried, holders = state.filter(F.size("runs") == 0), None, None
    for spread in (*SPREAD, None):
        state = state.filter(F.size("runs") > 0)
        frequent = F.coalesce(F.sum(F.exists("runs", lambda x: x["frequent"]).cast("int")), F.lit(0))
        size, frequent = state.agg(F.coalesce(F.sum(numbers), F.lit(0)), frequent).first()
        if not size:
            break
        # Few documents stay. While they do, the rest is not dealt out anew to find them.
        few = F.broadcast if size <= FEW else lambda df: df
        state_parts = filled(size)
        state = state.coalesce(state_parts)
        left = state.select(F.explode("runs.line").alias("line"), *own)
        if holders is None:
            holders, holder_parts = holders_of(few(left), frequent > 0)
        else:
            holders = holders.join(few(left.select("line")), "line", "left_semi")
        mine = holders.join(few(left), ["line", *own], "left_semi")
        part = F.col("tie") if spread is None else F.pmod(F.xxhash64("doc_id"), F.lit(spread))
        firsts = holders.groupBy("line", "anchor", part.alias("part")).agg(F.min("doc_id").alias("owner")).coalesce(holder_parts)
        named = mine.join(firsts, ["line", "anchor"]).filter("owner < doc_id")
        # One holder of a part for a run, whatever the number of anchors that name it.
        named = named.groupBy("line", "part", *own).agg(F.min("owner").alias("owner"))
        before = state.select(F.explode("tried").alias("owner"), *own)
        before = before if tried is None else before.unionByName(tried)
        more, _ = gathered(named.select("owner", *own).distinct().join(before, ["owner", *own], "left_anti"))
        tried = more if tried is None else tried.unionByName(more)
        pairs = more.join(few(state.select(*own, "hashes", "sizes")), own)
        if size <= FEW and (pairs.agg(F.sum(F.size("hashes"))).first()[0] or 0) <= FEW:
            pairs = F.broadcast(pairs)
        state = durable(settled(state, state_parts, align_pairs(lines_b(pairs))))
        done = done.unionByName(state.filter(F.size("runs") == 0))
    else:
        done = done.unionByName(state.filter(F.size("runs") > 0))
    return done.filter(F.size("removed") > 0).select(*own, "removed", "partners")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, counts: bool = True, keep_emptied: bool = True) -> DataFrame:
    """The rows of ``docs`` with ``text`` shortened.

    With ``counts``, columns ``lines_removed`` and ``partners`` follow, null for rows that lose nothing
    (columns of these names in ``docs`` go). Without ``keep_emptied``, rows go that had lines deleted and
    have nothing but white space left.
    """
    gone = removed_lines(docs, min_chars).withColumnsRenamed(
        {"doc_id": "_gone_id", "tie": "_gone_tie", "removed": "_gone", "partners": "_partners"}
    )
    match = (docs["doc_id"].cast("long") == gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["_gone_tie"])
    joined = docs.join(gone, match, "left")
    lines = lines_of(docs["text"])
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone["_gone"])
    kept = F.array_join(F.transform(places, lambda i: F.element_at(lines, i + 1)), "\n")
    if not keep_emptied:
        joined = joined.filter(gone["_gone"].isNull() | (F.btrim(kept, F.lit(" \t\r\n")) != ""))
    text = F.when(gone["_gone"].isNull(), docs["text"]).otherwise(kept)
    added = [F.size(gone["_gone"]).alias("lines_removed"), gone["_partners"].alias("partners")] if counts else []
    own = [c for c in docs.columns if not (counts and c in ("lines_removed", "partners"))]
    return joined.select(*(text.alias("text") if c == "text" else docs[c] for c in own), *added)
