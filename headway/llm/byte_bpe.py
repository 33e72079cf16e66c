"""Byte-level byte-pair encoding as a reduction over a tree, and decoding.

A text is cut by the vocabulary's pattern; each match is encoded by itself. The tokens of a stretch of bytes
are those of its two halves, joined; a single byte is a token. Joining re-encodes a window around the
boundary: first the two tokens that meet, then twice as many on a side that is not stable yet. A side is
stable when the window's outermost token and its neighbour outside, encoded by themselves, stay these two.

That is enough. Say every two neighbouring tokens of a list, encoded by themselves, stay as they are. Merging
all the bytes takes at each time the lowest rank, the leftmost first. Look at the first merge across a
boundary of the list: until then the bytes of the two tokens beside it were merged as they are by themselves,
in the same order, so this merge would have happened there too, against what was said. So no merge crosses a
boundary, and inside each token the bytes end up as that token. Joining is therefore associative, and its
result is the one of merging the whole match at once, whatever the ranks. Answers about pairs are kept.

Decoding gathers the tokens' bytes and concatenates neighbours up a tree.

Null counts as empty: no ids, no bytes. Rows are independent, so repeated rows repeat; an empty table gives an
empty one; other columns are ignored. Texts and matches may have any length: a text's matches are taken
``BLOCK`` at a time, matches of over ``LONG`` characters are not kept for the next time.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from headway.llm.arrow import list_array, ranges, strings, text_slices

#: The pattern that the vocabulary's texts are cut by; a fixed value that goes with the file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 1 << 17
#: Pairs, windows and short stretches whose tokens a worker keeps, each.
CACHE_PARTS = 1 << 19
SHORT = 8
BLOCK = 1 << 16
LONG = 256
#: Parts that decoding concatenates at each step up the tree.
FAN = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank of every token: lines of a token in base 64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class ByteBPE:
    """The encoder and decoder of one vocabulary; every single byte must be a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.tokens = [b""] * (1 + max(ranks.values()))
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pattern = regex.compile(pattern)
        self.pairs: dict[tuple[int, int], list[int]] = {}
        self.windows: dict[bytes, list[int]] = {}
        self.short: dict[bytes, list[int]] = {bytes([b]): [t] for b, t in enumerate(self.single)}
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge(self, window: bytes) -> list[int]:
        """The window's tokens by merging its bytes: the lowest rank first, the leftmost of equal ones."""
        rank_of, n = self.ranks.get, len(window)
        if n < 64:
            parts = [window[i : i + 1] for i in range(n)]
            while len(parts) > 1:
                found = [rank_of(a + b) for a, b in zip(parts, parts[1:])]
                lowest = min((r for r in found if r is not None), default=None)
                if lowest is None:
                    break
                i = found.index(lowest)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            return [self.ranks[p] for p in parts]
        ends = list(range(1, n + 1))  # of the part that starts here; 0 if none does
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(window[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= n or ends[middle] != end:
                continue
            ends[i], ends[middle] = end, 0
            if end < n:
                before[end] = i
                if (r := rank_of(window[i : ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if (left := before[i]) >= 0 and (r := rank_of(window[left:end])) is not None:
                heapq.heappush(heap, (r, left, end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[window[i : ends[i]]])
            i = ends[i]
        return out

    def pair(self, a: int, b: int) -> list[int]:
        """What the bytes of two tokens are by themselves."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_PARTS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.tokens[a] + self.tokens[b])
        return known

    def stable(self, a: int, b: int) -> bool:
        """Whether two tokens, encoded by themselves, stay these two."""
        known = self.pair(a, b)
        return len(known) == 2 and known[0] == a

    def window(self, tokens: list[int]) -> list[int]:
        """The tokens of a window, re-encoded."""
        data = b"".join([self.tokens[t] for t in tokens])
        if len(data) >= 64:
            return self.merge(data)
        known = self.windows.get(data)
        if known is None:
            if len(self.windows) >= CACHE_PARTS:
                self.windows.clear()
            known = self.windows[data] = self.merge(data)
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring stretches from the tokens of each, neither empty."""
        a, b = left[-1], right[0]
        middle = self.pair(a, b)
        if len(middle) == 2 and middle[0] == a:
            return left + right
        i = j = 1
        while True:
            left_stable = i == len(left) or self.stable(left[-i - 1], middle[0])
            right_stable = j == len(right) or self.stable(middle[-1], right[j])
            if left_stable and right_stable:
                return left[: len(left) - i] + middle + right[j:]
            if not left_stable:
                i = min(2 * i, len(left))
            if not right_stable:
                j = min(2 * j, len(right))
            middle = self.window(left[len(left) - i :] + right[:j])

    def encode_bytes(self, data: bytes) -> list[int]:
        """The tokens of one match: its halves', joined; those of short stretches are kept."""
        known = self.short.get(data)
        if known is not None:
            return known
        n = len(data)
        if not n:
            return []
        # Cut at the largest power of two, so that the tokens of long runs of one byte lie in step.
        half = 1 << (n - 1).bit_length() - 1
        ids = self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))
        if n <= SHORT:
            if len(self.short) >= CACHE_PARTS:
                self.short = {bytes([b]): [t] for b, t in enumerate(self.single)}
            self.short[data] = ids
        return ids

    def _learn(self, words: list[str]) -> None:
        coded = [self.encode_bytes(w.encode("utf-8")) for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        base = len(self.flat)
        self.starts = np.concatenate([self.starts, base + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.array([t for ids in coded for t in ids], np.int32)])
        for word in words:
            self.index[word] = len(self.index)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of one block of matches, one after the other, and how many each has."""
        new = {w for w in words if w not in self.index}
        if len(self.index) + len(new) > CACHE_WORDS:
            self.forget()
            new = set(words)
        if new:
            self._learn(sorted(new, key=len))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[at]
        ids = self.flat[ranges(self.starts[at], sizes)]
        if long := [w for w in new if len(w) > LONG]:  # they were learned last
            for word in long:
                del self.index[word]
            kept = len(self.index)
            self.flat = self.flat[: self.starts[kept]].copy()
            self.starts, self.sizes = self.starts[:kept], self.sizes[:kept]
        return ids, sizes

    def _blocks(self, texts: list[str]) -> Iterator[tuple[list[str], list[tuple[int, int]]]]:
        """All matches in blocks of about ``BLOCK``, with (text, end in the block) of every text in it."""
        words, ends = [], []
        for k, text in enumerate(texts):
            if len(text) <= BLOCK:
                words += self.pattern.findall(text)
            else:
                matches = (m[0] for m in self.pattern.finditer(text))
                while part := list(islice(matches, BLOCK)):
                    words += part
                    ends.append((k, len(words)))
                    yield words, ends
                    words, ends = [], []
            ends.append((k, len(words)))
            if len(words) >= BLOCK:
                yield words, ends
                words, ends = [], []
        if words:
            yield words, ends

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the n+1 offsets."""
        parts, counts = [np.zeros(0, np.int32)], np.zeros(len(texts) + 1, np.int64)
        for words, ends in self._blocks(texts):
            ids, sizes = self._ids(words)
            parts.append(ids)
            owner, stop = np.array(ends).T
            upto = np.r_[0, np.cumsum(sizes)][stop]
            np.add.at(counts, owner + 1, np.diff(upto, prepend=0))
        return np.concatenate(parts), np.cumsum(counts)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a list of ids."""
        parts = [self.tokens[t] for t in ids]
        while len(parts) > 1:
            parts = [b"".join(parts[k : k + FAN]) for k in range(0, len(parts), FAN)]
        return parts[0] if parts else b""


@lru_cache(maxsize=2)
def load(path: str, pattern: str = PATTERN) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def encode_decode(docs: DataFrame, vocabulary: str, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, ids, decoded) of every text; ``vocabulary``: a file of ranks that every executor can open."""

    def run(batches):
        bpe = load(vocabulary, pattern)
        for batch in text_slices(batches):
            ids, offsets = bpe.encode(strings(batch.column("text")))
            flat, bounds = ids.tolist(), offsets.tolist()
            decoded = pa.array([bpe.decode(flat[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), list_array(ids, offsets, pa.int32()), decoded], ["doc_id", "ids", "decoded"]
            )

    columns = docs.select(docs["doc_id"].cast("long"), "text")
    return columns.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
