"""Benchmark decontamination under edits.

A document is contaminated if some stretch of it is within ``edits`` times an item's length of the item
in edit distance, both with A-Z lower-cased and white space as single spaces' bytes.

Items are put in classes of similar length. An item that may have E edits is cut into E + 1 pieces, and a
stretch within the bound holds one of them unchanged. Where a document has such a piece, an item-sized window
begins as far before it as the piece stands in its item; so no match is without a window, wherever its words
begin and whatever the other items are. Windows and items that have a
piece in common are embedded by CGK random walks (each step writes the current byte, and a random bit of step and byte says
whether to advance), which make edit distance Hamming distance. ``TABLES`` tables of ``BITS`` sampled
coordinates each, dealt over ``WALKS`` walks, give candidates. Each candidate is verified by its exact edit
distance (Myers' bit vectors) to the best stretch around its windows, and so every reported match is right.

Only the tables can lose a match. Walks that fall out of step make the Hamming rate depend on the kind of edits,
so the number of tables is not taken from a rate: it was set by planting copies with exactly the edits allowed
(``test_recall_at_the_full_bound``).

Items go to tasks in blocks of at most ``BLOCK_BYTES`` of text, one broadcast and one pass over the
documents a block, whatever the benchmark's size. Items of fewer than ``GRAM`` bytes are matched exactly.

Null and empty texts and items match nothing. Repeated items each have their rows, repeated documents
too. Texts may have any length. Empty tables give an empty result, or all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from headway.llm.arrow import flat_bytes, ranges, text_slices
from headway.llm.hashing import LOWER, SPACE, gram_hashes

EDITS = 0.08
GRAM = 8
#: Bytes of a piece that are looked up: the most of these that all pieces of an item have.
KEYS = (1, 2, 4, 8, 11)
BITS = 3
TABLES = 96
WALKS = 24
GROWTH = 1.2
FILTER_BITS = 22
BLOCK_BYTES = 4 << 20
WINDOWS = 1 << 12
#: Texts that the filter goes through at once: smaller slices take less of a worker's memory, but each costs a walk of every class.
FILTER_SLICE_BYTES = 1 << 19
SCHEMA = "doc_id long, item_id long, distance int, start long, end long"

PLAIN = LOWER.copy()
PLAIN[SPACE] = 32


def plain(text: str | None) -> bytes:
    """An item's bytes as they are compared."""
    return PLAIN[np.frombuffer((text or "").encode(), np.uint8)].tobytes().strip()


def best_stretch(item: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of the item to any stretch of the text, and the end of the first such stretch."""
    m = len(item)
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(x | up) & full, up & x
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | ~((eq | down) | plus) & full
        down = plus & (eq | down)
        if score < best:
            best, end = score, j + 1
    return best, end


def pieces(n: int, edits: float) -> list[int]:
    """The n+1 cuts of an item of ``n`` bytes into one piece more than it may have edits."""
    count = int(edits * n) + 1
    return [n * i // count for i in range(count + 1)]


class PieceIndex:
    """Pieces by the hash of their first ``size`` bytes, each with the items that have it and its offsets in them."""

    def __init__(self, size: int, found: np.ndarray):
        self.size = size
        found = found[np.lexsort(found.T[::-1])]
        found = found[np.r_[True, (found[1:] != found[:-1]).any(axis=1)]]
        self.keys, at = np.unique(found[:, 0], return_index=True)
        self.at = np.r_[at, len(found)]
        self.item, self.offset = found[:, 1].astype(np.int64), found[:, 2].astype(np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.cell(self.keys)] = True

    @staticmethod
    def cell(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def windows(self, flat, bounds):
        """(item, start) of the windows around the pieces in the texts, in portions of bounded size."""
        grams = gram_hashes(flat, self.size)
        place = np.flatnonzero(self.filter[self.cell(grams)])
        key = np.minimum(np.searchsorted(self.keys, grams[place]), len(self.keys) - 1)
        doc = np.searchsorted(bounds, place, side="right") - 1
        real = (self.keys[key] == grams[place]) & (place + self.size <= bounds[doc + 1])
        place, key, doc = place[real], key[real], doc[real]
        size = self.at[key + 1] - self.at[key]
        ends = np.cumsum(size)
        low = 0
        while low < len(place):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - size[low] + (1 << 20), side="right")))
            mine = ranges(self.at[key[low:high]], size[low:high])
            start = np.repeat(place[low:high], size[low:high]) - self.offset[mine]
            start = np.maximum(start, np.repeat(bounds[doc[low:high]], size[low:high]))
            yield self.item[mine], start
            low = high


class ItemBlock:
    """Items with their length classes, pieces and hash tables."""

    def __init__(self, items: list[tuple[int, bytes]], edits: float, tables: int = TABLES, seed: int = 3):
        self.edits, self.tables = edits, tables
        self.items = [(k, text) for k, text in items if len(text) >= GRAM]
        self.short = [(k, text) for k, text in items if 0 < len(text) < GRAM]
        rng = np.random.default_rng(seed)
        self.classes, self.kind = [], np.zeros(len(self.items), np.int64)
        found: dict[int, list[np.ndarray]] = {}
        order = sorted(range(len(self.items)), key=lambda i: len(self.items[i][1]))
        while order:
            least = len(self.items[order[0]][1])
            members = [i for i in order if len(self.items[i][1]) <= least * GROWTH]
            order = order[len(members) :]
            members.sort()
            for i in members:
                text = self.items[i][1]
                cuts = np.array(pieces(len(text), edits))
                size = max(k for k in KEYS if k <= np.diff(cuts).min())
                hashes = gram_hashes(np.frombuffer(text, np.uint8), size)[cuts[:-1]]
                owner = np.full(len(hashes), i, np.uint64)
                found.setdefault(size, []).append(np.stack([hashes, owner, cuts[:-1].astype(np.uint64)], axis=1))
            self.kind[members] = len(self.classes)
            flat = np.frombuffer(b"".join(self.items[i][1] for i in members), np.uint8)
            ends = np.cumsum([len(self.items[i][1]) for i in members])
            most = max(len(self.items[i][1]) for i in members)
            steps = 2 * least
            one = {
                "width": most + int(edits * most),
                "members": np.array(members),
                "bits": rng.integers(0, 2, (steps, WALKS, 256), dtype=np.uint8),
                "places": [sorted(rng.choice(steps, BITS, replace=False).tolist()) for _ in range(tables)],
            }
            one["keys"] = self.embed(flat, np.r_[0, ends[:-1]], ends, one)
            self.classes.append(one)
        self.indexes = [PieceIndex(size, np.concatenate(rows)) for size, rows in sorted(found.items())]

    def embed(self, flat, starts, ends, one) -> np.ndarray:
        """Table keys (table, window): the sampled coordinates of the windows' walks, all walks in step."""
        keys = np.zeros((self.tables, len(starts)), np.int64)
        padded = np.r_[flat, np.uint8(0)]
        wanted: dict[int, list[int]] = {}
        for t, places in enumerate(one["places"]):
            for j in places:
                wanted.setdefault(j, []).append(t)
        at = np.repeat(starts[None, :], WALKS, axis=0)
        row = np.arange(WALKS)[:, None] * 256
        for j in range(max(wanted) + 1):
            byte = padded[np.where(at < ends, at, len(flat))]
            if j in wanted:
                t = np.array(wanted[j])
                keys[t] = keys[t] << 8 | byte[t % WALKS]
            at += one["bits"][j].ravel()[row + byte]
        return keys

    def candidates(self, flat, bounds):
        """(item, document, start) of windows around a piece of the item that share a table key with it."""
        for index in self.indexes:
            for items, places in index.windows(flat, bounds):
                kinds = self.kind[items]
                for kind in np.unique(kinds).tolist():
                    mine = kinds == kind
                    starts, window = np.unique(places[mine], return_inverse=True)
                    pairs = np.unique(window * len(self.items) + items[mine])
                    cuts = np.searchsorted(pairs, np.arange(0, len(starts) + WINDOWS, WINDOWS) * len(self.items))
                    for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
                        part = starts[i * WINDOWS : (i + 1) * WINDOWS]
                        of_part = pairs[low:high] - i * WINDOWS * len(self.items)
                        yield from self.meet(flat, bounds, self.classes[kind], part, of_part)

    def meet(self, flat, bounds, one, starts, pairs):
        """Of some windows of one class and the pairs (window * items + item) that have a piece in common."""
        doc = np.searchsorted(bounds, starts, side="right") - 1
        keys = self.embed(flat, starts, np.minimum(starts + one["width"], bounds[doc + 1]), one)
        window, item = np.divmod(pairs, len(self.items))
        shared = np.zeros(len(pairs), bool)
        place = np.searchsorted(one["members"], item)
        for t in range(self.tables):
            shared |= keys[t, window] == one["keys"][t, place]
        for w, k in zip(window[shared].tolist(), item[shared].tolist()):
            yield k, int(doc[w]), int(starts[w])

    def matches(self, column) -> list[tuple[int, int, int, int, int]]:
        """(row, item_id, distance, start, end), in bytes of the text, one for each item in a document."""
        flat, bounds = flat_bytes(column)
        flat = PLAIN[flat]
        grouped: dict[tuple[int, int], list[int]] = {}
        for item, doc, start in self.candidates(flat, bounds):
            grouped.setdefault((doc, item), []).append(start)
        found = []
        for (doc, item), starts in sorted(grouped.items()):
            k, text = self.items[item]
            allowed = int(self.edits * len(text))
            low, high = int(bounds[doc]), int(bounds[doc + 1])
            best = None
            starts.sort()
            while starts:
                # Windows that overlap are one region.
                n = 1
                while n < len(starts) and starts[n] - starts[n - 1] <= len(text):
                    n += 1
                # A match begins at most ``allowed`` bytes from its window and is at most so much longer.
                a = max(low, starts[0] - allowed)
                b = min(high, starts[n - 1] + len(text) + 2 * allowed)
                starts = starts[n:]
                region = flat[a:b].tobytes()
                exact = region.find(text)
                if exact >= 0:
                    got = (0, a + exact, a + exact + len(text))
                else:
                    distance, end = best_stretch(text, region)
                    if distance > allowed:
                        continue
                    _, back = best_stretch(text[::-1], region[:end][::-1])
                    got = (distance, a + end - back, a + end)
                best = min(best, got) if best else got
            if best:
                found.append((doc, k, best[0], best[1] - low, best[2] - low))
        for k, text in self.short:
            for doc in range(len(bounds) - 1):
                at = flat[bounds[doc] : bounds[doc + 1]].tobytes().find(text)
                if at >= 0:
                    found.append((doc, k, 0, at, at + len(text)))
        return found


def item_blocks(benchmark: DataFrame, edits: float = EDITS, block_bytes: int = BLOCK_BYTES):
    """The benchmark's items in blocks of bounded size, read to the driver block by block."""
    rows = benchmark.select(benchmark["item_id"].cast("long"), benchmark["text"]).toLocalIterator()
    block, size = [], 0
    for item_id, text in rows:
        item = plain(text)
        if block and size + len(item) > block_bytes:
            yield ItemBlock(block, edits)
            block, size = [], 0
        if item:
            block.append((item_id, item))
            size += len(item)
    if block:
        yield ItemBlock(block, edits)


def find_leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """(doc_id, item_id, distance, start, end) for every item in every document; places in UTF-8 bytes."""
    spark = docs.sparkSession
    texts = docs.select(docs["doc_id"].cast("long"), "text")
    found = None
    for block in item_blocks(benchmark, edits):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in text_slices(batches):
                rows = shared.value.matches(batch.column("text"))
                ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                rest = list(zip(*(r[1:] for r in rows))) or [[]] * 4
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                columns = [ids, *(pa.array(c, k) for c, k in zip(rest, kinds))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "start", "end"])

        one = texts.mapInArrow(run, SCHEMA)
        found = one if found is None else found.unionByName(one)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The documents without any item, with all their columns: a filter in place, without a join."""
    for block in item_blocks(benchmark, edits):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in text_slices(batches, limit=FILTER_SLICE_BYTES):
                clean = np.ones(batch.num_rows, bool)
                clean[[r[0] for r in shared.value.matches(batch.column("text"))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
