"""Repeated passages by enhanced suffix arrays over anchored pieces of the texts.

A window is any string of ``min_bytes`` bytes inside a document. Its anchor is the place of the smallest
hash among its strings of ``gram`` bytes, leftmost if equal; equal windows have equal anchors, and
neighbouring windows mostly share one. What is shuffled is per anchor, about one in 14 bytes:

1. Each chunk of documents sends the distinct hashes of its anchors to buckets of hashes.
2. A bucket answers which of them stand in more than one document.
3. For those, the chunk sends the pieces of text that their windows cover, each distinct piece once, with
   the smallest doc_id that holds it. An anchor that very many chunks hold is sent as single windows,
   dealt by their own hash, so that a frequent passage is one piece a chunk and no bucket gets it whole.
4. A bucket builds the suffix array of its pieces (suffixes of at least ``min_bytes``), the array of
   common prefix lengths, and the tree of common-prefix intervals by a stack scan. An interval whose
   suffixes have different bytes on the left (the edge of a piece counts as different) is a maximal repeat
   within the pieces; it is answered with all its occurrences.
5. The chunk turns answers into spans of its documents.

A piece ends where the next anchor's begins, so a longer repeat comes out as overlapping groups, which
together cover it. Documents with equal texts are found by digest first; all but the smallest doc_id are
copies as a whole and send no pieces. Chunks and buckets grow in number, not in size, with the input.

A byte is removed if a window that covers it also stands in a document with a smaller doc_id. Null counts
as empty. Rows with one doc_id are one document to each other. A document without doc_id loses nothing
and takes nothing. Texts may have any length. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.arrow import flat_bytes, list_array, ranges
from headway.llm.hashing import gram_hashes, prefix_sums, span_hashes
from headway.session import shuffle_tasks

MIN_BYTES = 50
GRAM = 24
CHUNK_BYTES = 8 << 20
BUCKETS_PER_CHUNK = 4
HOT_CHUNKS = 256
SLICE_BYTES = 1 << 18
PLACE_BITS = np.uint64(30)
PLACE = np.uint64((1 << 30) - 1)
COPY, CODES, MARKS = 0, 1, 2
SENT = "bucket int, chunk int, a binary, b binary, c binary, d binary"
ANSWER = "chunk int, kind int, bucket int, doc_id long, a binary, b binary, c binary"
RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
    " starts array<long>, ends array<long>"
)
GROUPS = "group_id long, doc_id long, start long, length long"


def anchors(flat: np.ndarray, bounds: np.ndarray, min_bytes: int, gram: int):
    """Runs of windows with one anchor: the anchors' hashes, and the first and last window of each run."""
    width = min_bytes - gram + 1
    hashes = gram_hashes(flat, gram)
    if len(hashes) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: size - width], least[width - size :])
    inside = np.ones(len(least), bool)
    crossing = (bounds[1:, None] - 1 - np.arange(min_bytes - 1)).ravel()
    inside[crossing[(crossing >= 0) & (crossing < len(inside))]] = False
    windows = np.flatnonzero(inside)
    place = (least[windows] & PLACE).astype(np.int64)
    first = np.ones(len(windows), bool)
    first[1:] = (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)
    head = np.flatnonzero(first)
    tail = np.r_[head[1:], len(windows)][: len(head)] - 1
    return hashes[place[head]], windows[head], windows[tail]


class Chunk:
    """The documents of one chunk, in order of doc_id and text, and their anchors."""

    def __init__(self, table: pa.Table, min_bytes: int, gram: int, buckets: int, plan: bool = True):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        self.min_bytes, self.buckets = min_bytes, buckets
        self.ids = table.column("doc_id").combine_chunks()
        text = table.column("text")
        text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
        self.flat, self.bounds = flat_bytes(text)
        numbers = self.ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.doc_of_row = numbers
        self.named = self.ids.is_valid().to_numpy(zero_copy_only=False)
        keys, low, high = [], [], []
        row, rows = 0, len(self.ids)
        while row < rows:
            stop = row + 1
            while stop < rows and self.bounds[stop + 1] - self.bounds[row] <= SLICE_BYTES:
                stop += 1
            base = self.bounds[row]
            part = self.bounds[row : stop + 1] - base
            found = anchors(self.flat[base : self.bounds[stop]], part, min_bytes, gram)
            for target, values in zip((keys, low, high), (found[0], found[1] + base, found[2] + base)):
                target.append(values)
            row = stop
        empty = np.zeros(0, np.int64)
        keys = np.concatenate([np.zeros(0, np.uint64), *keys])
        self.low, self.high = np.concatenate([empty, *low]), np.concatenate([empty, *high])
        self.row = np.searchsorted(self.bounds, self.low, side="right") - 1
        named = self.named[self.row] if len(self.row) else np.zeros(0, bool)
        keys, self.low, self.high, self.row = keys[named], self.low[named], self.high[named], self.row[named]
        bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((keys, bucket))
        new = np.ones(len(order), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        self.index = np.empty(len(order), np.int64)
        self.index[order] = np.cumsum(new) - 1
        head = order[new]
        self.keys, self.bucket = (keys[head] & np.uint64(0xFFFFFFFF)).astype(np.uint32), bucket[head]
        docs = numbers[self.row[order]] if len(order) else empty
        starts = np.flatnonzero(new)
        if len(starts):
            self.many = np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)
        else:
            self.many = np.zeros(0, bool)

    def by_bucket(self, bucket: np.ndarray):
        """(bucket, from, to) for the runs of a sorted array."""
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, int)
        return [(int(bucket[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]

    def pieces(self, answers: pa.Table):
        """Distinct pieces to send, and their occurrences.

        Returns bucket, start, length, smallest doc_id and many of each piece in order, then start and
        piece number of every occurrence.
        """
        kind = answers.column("kind").to_numpy()
        codes = np.zeros(len(self.keys), np.uint8)
        parts = answers.filter(pa.array(kind == CODES))
        payload = dict(zip(parts.column("bucket").to_pylist(), parts.column("a").to_pylist()))
        for bucket, a, b in self.by_bucket(self.bucket):
            codes[a:b] = np.frombuffer(payload[bucket], np.uint8)
        copies = answers.filter(pa.array(kind == COPY)).column("doc_id").to_numpy()
        self.copy_row = np.isin(self.doc_of_row, copies) & self.named
        code = codes[self.index]
        code[self.copy_row[self.row]] = 0
        once, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        single = ranges(self.low[hot], self.high[hot] - self.low[hot] + 1)
        start = np.r_[self.low[once], single]
        length = np.r_[self.high[once] - self.low[once], np.zeros(len(single), np.int64)] + self.min_bytes
        row = np.searchsorted(self.bounds, start, side="right") - 1
        content = self.contents(start, length)
        anchored = self.bucket[self.index[once]]
        bucket = np.r_[anchored, (content[len(once) :] % np.uint64(self.buckets)).astype(np.int64)]
        order = np.lexsort((content, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (content[order[1:]] != content[order[:-1]]) | (bucket[order[1:]] != bucket[order[:-1]])
        start, length, bucket = start[order], length[order], bucket[order]
        docs = self.doc_of_row[row[order]]
        heads = np.flatnonzero(new)
        if len(heads):
            least, most = np.minimum.reduceat(docs, heads), np.maximum.reduceat(docs, heads)
        else:
            least = most = np.zeros(0, np.int64)
        return (bucket[heads], start[heads], length[heads], least, least != most), start, np.cumsum(new) - 1

    def contents(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hashes of spans, slice by slice."""
        found = np.zeros(len(start), np.uint64)
        order = np.argsort(start, kind="stable")
        at = 0
        while at < len(order):
            base = start[order[at]]
            stop = int(np.searchsorted(start[order], base + SLICE_BYTES, side="right"))
            chosen = order[at:stop]
            end = (start[chosen] + length[chosen]).max()
            sums = prefix_sums(self.flat[base:end])
            found[chosen] = span_hashes(sums, start[chosen] - base, start[chosen] + length[chosen] - base)
            at = stop
        return found


def to_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


SENT_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), *((c, pa.binary()) for c in "abcd")])
ANSWER_SCHEMA = pa.schema(
    [("chunk", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("doc_id", pa.int64())]
    + [(c, pa.binary()) for c in "abc"]
)


def send_hashes(min_bytes: int, gram: int, buckets: int):
    """Step 1: a chunk's distinct anchor hashes, by bucket."""

    def run(table: pa.Table) -> pa.Table:
        chunk, number = Chunk(table, min_bytes, gram, buckets), table.column("chunk")[0].as_py()
        rows = [
            (bucket, number, chunk.keys[a:b].tobytes(), np.packbits(chunk.many[a:b]).tobytes(), None, None)
            for bucket, a, b in chunk.by_bucket(chunk.bucket)
        ]
        return to_table(rows, SENT_SCHEMA)

    return run


def answer_hashes(hot_chunks: int):
    """Step 2: for each hash sent, 0 if one document has it, 2 if very many chunks do, else 1."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint32) for x in table.column("a").to_pylist()]
        many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(table.column("b").to_pylist(), keys)]
        flat, order = np.concatenate(keys), None
        order = np.argsort(flat, kind="stable")
        starts = np.flatnonzero(np.r_[True, flat[order[1:]] != flat[order[:-1]]])
        sizes = np.diff(np.r_[starts, len(flat)])
        some = np.maximum.reduceat(np.concatenate(many)[order], starts)
        code = np.where((sizes > 1) | (some > 0), 1, 0)
        code[sizes > hot_chunks] = 2
        codes = np.empty(len(flat), np.uint8)
        codes[order] = np.repeat(code, sizes)
        ends = np.cumsum([len(k) for k in keys])
        bucket = table.column("bucket")[0].as_py()
        rows = [
            (chunk, CODES, bucket, None, codes[end - len(k) : end].tobytes(), None, None)
            for chunk, k, end in zip(table.column("chunk").to_pylist(), keys, ends)
        ]
        return to_table(rows, ANSWER_SCHEMA)

    return run


def send_pieces(min_bytes: int, gram: int, buckets: int):
    """Step 3: the pieces around repeated anchors, by bucket."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return to_table([], SENT_SCHEMA)
        chunk, number = Chunk(table, min_bytes, gram, buckets), table.column("chunk")[0].as_py()
        (bucket, start, length, least, many), *_ = chunk.pieces(answers)
        rows = []
        for k, a, b in chunk.by_bucket(bucket):
            text = chunk.flat[ranges(start[a:b], length[a:b])]
            packed = (length[a:b].astype(np.uint32), text, least[a:b], np.packbits(many[a:b]))
            rows.append((k, number, *(x.tobytes() for x in packed)))
        return to_table(rows, SENT_SCHEMA)

    return run


def lcp_intervals(lcp: list[int]) -> list[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval with a common prefix; ``lcp[i]`` is of i - 1 and i."""
    found = []
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        common = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while common < stack[-1][0]:
            length, first = stack.pop()
            found.append((length, first, i - 1))
        if common > stack[-1][0]:
            stack.append((common, first))
    return found


def maximal_repeats(text, base, length, least, many, min_bytes: int, every: bool):
    """(piece, offset, length, group) of the occurrences of maximal repeats in the pieces of a bucket.

    ``base`` and ``length`` place the pieces in ``text``. Unless ``every``, only repeats in documents of
    different ids, and of those only occurrences in pieces that no document with the smallest id has.
    """
    suffixes = length - min_bytes + 1
    piece = np.repeat(np.arange(len(base)), suffixes)
    offset = ranges(np.zeros(len(base), np.int64), suffixes)
    place = base[piece] + offset
    windows = np.zeros(len(place), np.uint64)
    for i in range(0, len(base), 1 << 13):  # whole pieces, so that hashes of some text are held at a time
        j = min(i + (1 << 13), len(base))
        here = slice(int(suffixes[:i].sum()), int(suffixes[:j].sum()))
        at = base[i]
        hashed = gram_hashes(text[at : base[j - 1] + length[j - 1]], min_bytes)
        windows[here] = hashed[place[here] - at]
    order = np.argsort(windows, kind="stable")
    equal = windows[order[1:]] == windows[order[:-1]]
    order = order[np.r_[False, equal] | np.r_[equal, False]]
    if not len(order):
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]

    def left_of(chosen):
        edge = offset[chosen] == 0
        return np.where(edge, 256 + np.arange(len(chosen)), text[place[chosen] - 1])

    # Windows with one byte on the left everywhere are part of a longer repeat: left out before sorting.
    starts = np.flatnonzero(np.r_[True, windows[order[1:]] != windows[order[:-1]]])
    left = left_of(order)
    differs = np.r_[False, left[1:] != left[:-1]]
    differs[starts] = False
    wanted = np.logical_or.reduceat(differs, starts)
    if not every:
        docs = least[piece[order]]
        wanted &= np.minimum.reduceat(docs, starts) < np.maximum.reduceat(docs, starts)
    order = order[np.repeat(wanted, np.diff(np.r_[starts, len(order)]))]
    if not len(order):
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]

    rest = length[piece[order]] - offset[order] - min_bytes
    width = -(-int(rest.max() + 1) // 8) * 8
    at = place[order][:, None] + min_bytes + np.arange(width)
    tails = np.where(np.arange(width) < rest[:, None], text[np.minimum(at, len(text) - 1)], 0).astype(np.uint8)
    words = tails.view(">u8")
    ranked = np.lexsort((rest, *(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), windows[order]))
    order, rest, tails = order[ranked], rest[ranked], tails[ranked]
    same = tails[1:] == tails[:-1]
    common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    common = min_bytes + np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    for i in range(0, len(common), 1 << 16):  # the bytes decide, not their hash
        j = min(i + (1 << 16), len(common))
        heads = text[place[order[i : j + 1]][:, None] + np.arange(min_bytes)]
        common[i:j][(heads[1:] != heads[:-1]).any(axis=1)] = 0
    intervals = np.array(lcp_intervals([0, *common.tolist()]), np.int64).reshape(-1, 3)
    size, first, last = intervals.T
    left = left_of(order)
    changes = np.cumsum(np.r_[False, left[1:] != left[:-1]])
    docs = np.r_[least[piece[order]], 0]
    edges = np.stack([first, last + 1], axis=1).ravel()
    lowest = np.minimum.reduceat(docs, edges)[::2] if len(edges) else size
    keep = changes[last] > changes[first]
    if not every:
        keep &= lowest < (np.maximum.reduceat(docs, edges)[::2] if len(edges) else size)
    size, first, last, lowest = size[keep], first[keep], last[keep], lowest[keep]
    counts = last - first + 1
    member = order[ranges(first, counts)]
    sizes = np.repeat(size, counts)
    group = np.zeros(len(member), np.uint64)
    if every:
        sums = prefix_sums(text)
        group = np.repeat(span_hashes(sums, place[order[first]], place[order[first]] + size), counts)
    else:
        new = least[piece[member]] > np.repeat(lowest, counts)
        member, sizes, group = member[new], sizes[new], group[new]
    return piece[member], offset[member], sizes, group


def answer_pieces(min_bytes: int, every: bool):
    """Step 4: the occurrences of maximal repeats among the pieces of a bucket."""

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in "abcd"}
        lengths = [np.frombuffer(x, np.uint32).astype(np.int64) for x in columns["a"]]
        text = np.frombuffer(b"".join(columns["b"]), np.uint8)
        least = np.concatenate([np.frombuffer(x, np.int64) for x in columns["c"]])
        many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(n)) for x, n in zip(columns["d"], lengths)]
        many, length = np.concatenate(many).astype(bool), np.concatenate(lengths)
        base = np.cumsum(length) - length
        piece, offset, size, group = maximal_repeats(text, base, length, least, many, min_bytes, every)
        if every:  # a piece that several documents of one chunk share is a repeat by itself
            own = np.flatnonzero(many)
            whole = span_hashes(prefix_sums(text), base[own], base[own] + length[own])
            piece, offset = np.r_[piece, own], np.r_[offset, np.zeros(len(own), np.int64)]
            size, group = np.r_[size, length[own]], np.r_[group, whole]
        ends = np.cumsum([len(n) for n in lengths])
        source = np.searchsorted(ends, piece, side="right")
        order = np.argsort(source, kind="stable")
        cuts = np.searchsorted(source[order], np.arange(len(ends) + 1))
        bucket, rows = table.column("bucket")[0].as_py(), []
        for k, number in enumerate(table.column("chunk").to_pylist()):
            mine = order[cuts[k] : cuts[k + 1]]
            if len(mine):
                local = (piece[mine] - (ends[k] - len(lengths[k]))).astype(np.uint32)
                span = np.stack([offset[mine], size[mine]], axis=1).astype(np.uint32)
                names = group[mine].tobytes() if every else None
                rows.append((number, MARKS, bucket, None, local.tobytes(), span.tobytes(), names))
        return to_table(rows, ANSWER_SCHEMA)

    return run


def chunk_marks(chunk: Chunk, answers: pa.Table):
    """Step 5: for every answered occurrence its start, length, piece and group; and the pieces."""
    pieces, start, number = chunk.pieces(answers)
    bucket = pieces[0]
    firsts = {k: a for k, a, _ in chunk.by_bucket(bucket)}
    marks = answers.filter(pa.array(answers.column("kind").to_numpy() == MARKS))
    found = []
    for k, a, b, c in zip(*(marks.column(n).to_pylist() for n in ("bucket", "a", "b", "c"))):
        span = np.frombuffer(b, np.uint32).reshape(-1, 2).astype(np.int64)
        names = np.frombuffer(c, np.uint64) if c else np.zeros(len(span), np.uint64)
        found.append((np.frombuffer(a, np.uint32).astype(np.int64) + firsts[k], span[:, 0], span[:, 1], names))
    piece, offset, size, group = (
        np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),), *found)
    )
    # Occurrences are in order of their piece's number.
    count = np.bincount(number, minlength=len(bucket))
    place = ranges((np.cumsum(count) - count)[piece], count[piece])
    repeat = count[piece]
    return (start[place] + np.repeat(offset, repeat), np.repeat(size, repeat), np.repeat(group, repeat)), pieces, start, number


def keep_rest(min_bytes: int, gram: int, buckets: int):
    """The result rows of a chunk."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema(
            [(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")]
            + [("kept_sha256", pa.string()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))]
        )
        if not table.num_rows:
            return schema.empty_table()
        chunk = Chunk(table, min_bytes, gram, buckets)
        (begin, size, _), pieces, start, number = chunk_marks(chunk, answers)
        row = np.searchsorted(chunk.bounds, start, side="right") - 1
        later = chunk.doc_of_row[row] > pieces[3][number]
        change = np.zeros(len(chunk.flat) + 1, np.int32)
        for a, n in ((begin, size), (start[later], pieces[2][number][later])):
            change += np.bincount(a, minlength=len(change)).astype(np.int32)
            change -= np.bincount(a + n, minlength=len(change)).astype(np.int32)
        low, high = chunk.bounds[:-1], chunk.bounds[1:]
        whole = chunk.copy_row & (high - low >= min_bytes)
        gone = np.cumsum(change[:-1]) > 0
        gone[ranges(low[whole], (high - low)[whole])] = True
        sums, hashes = np.r_[0, np.cumsum(gone)], []
        for a, b in zip(low.tolist(), high.tolist()):
            body = chunk.flat[a:b]
            hashes.append(hashlib.sha256(body[~gone[a:b]] if sums[b] > sums[a] else body).hexdigest())
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        first[low[low < len(gone)]] = gone[low[low < len(gone)]]
        last = gone.copy()
        last[:-1] &= ~gone[1:]
        filled = high[high > low] - 1
        last[filled] = gone[filled]
        first, last = np.flatnonzero(first), np.flatnonzero(last) + 1
        offsets = np.searchsorted(first, chunk.bounds)
        base = np.repeat(low, np.diff(offsets))
        return pa.Table.from_arrays(
            [
                chunk.ids,
                pa.array(high - low),
                pa.array(sums[high] - sums[low]),
                pa.array(np.diff(offsets)),
                pa.array(hashes, pa.string()),
                list_array(first - base, offsets, pa.int64()),
                list_array(last - base, offsets, pa.int64()),
            ],
            schema=schema,
        )

    return run


def list_groups(min_bytes: int, gram: int, buckets: int):
    """The occurrences of maximal repeats in a chunk."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["group_id", "doc_id", "start", "length"]
        if not table.num_rows:
            return pa.schema([(n, pa.int64()) for n in names]).empty_table()
        chunk = Chunk(table, min_bytes, gram, buckets)
        (begin, size, group), *_ = chunk_marks(chunk, answers)
        row = np.searchsorted(chunk.bounds, begin, side="right") - 1
        columns = (group.view(np.int64), chunk.doc_of_row[row], begin - chunk.bounds[row], size)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _passes(docs, last, schema, every, min_bytes, gram, chunk_bytes, hot_chunks) -> DataFrame:
    """The five steps; ``last`` makes the function of the last one."""
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    buckets = BUCKETS_PER_CHUNK * chunks
    tasks = min(chunks, shuffle_tasks(docs.sparkSession))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    number = F.pmod(key, F.lit(chunks)).cast("int")
    # One exchange of the texts, read by three steps.
    parts = texts.withColumn("chunk", number).repartition(tasks, "chunk")
    digests = texts.filter("doc_id IS NOT NULL").select("doc_id", F.md5("text").alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = digests.join(firsts.filter("first < last"), "digest").filter("doc_id > first").select("doc_id").distinct()
    empty = [F.lit(None).cast("binary").alias(c) for c in "abc"]
    copies = copies.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int").alias("chunk"),
        F.lit(COPY).alias("kind"),
        F.lit(None).cast("int").alias("bucket"),
        "doc_id",
        *empty,
    )
    hashes = parts.groupBy("chunk").applyInArrow(send_hashes(min_bytes, gram, buckets), SENT)
    codes = hashes.groupBy("bucket").applyInArrow(answer_hashes(hot_chunks), ANSWER)
    known = codes.union(copies)
    sent = parts.groupBy("chunk").cogroup(known.groupBy("chunk"))
    sent = sent.applyInArrow(send_pieces(min_bytes, gram, buckets), SENT)
    marks = sent.groupBy("bucket").applyInArrow(answer_pieces(min_bytes, every), ANSWER)
    answers = known.union(marks)
    result = parts.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return result.applyInArrow(last(min_bytes, gram, buckets), schema)


def remove_repeats(
    docs: DataFrame,
    min_bytes: int = MIN_BYTES,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
    hot_chunks: int = HOT_CHUNKS,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends): what each document loses."""
    return _passes(docs, keep_rest, RESULT, False, min_bytes, gram, chunk_bytes, hot_chunks)


def repeat_groups(
    docs: DataFrame,
    min_bytes: int = MIN_BYTES,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
    hot_chunks: int = HOT_CHUNKS,
) -> DataFrame:
    """(group_id, doc_id, start, length): all occurrences of each maximal repeat, whole copies by the first alone."""
    return _passes(docs, list_groups, GROUPS, True, min_bytes, gram, chunk_bytes, hot_chunks)
