"""Byte-pair encoding with word ends, and decoding, in batches of words.

A text is cut at special tokens; each part is put in NFC, lower-cased character by character and split
into words by the vocabulary's pattern. A word's bytes become symbols, the last one with the word end.
New words are encoded together: their symbols lie in one flat array, the rank of every adjacent pair is
found by binary search over the sorted pair keys, and each round merges, in every word, all places of its
lowest-ranked pair; words without a known pair leave. This equals merging one place at a time as long as
every merge is ranked after those that make its two parts, which is checked when the vocabulary is read.
Words over ``LONG_WORD`` symbols are merged one by one with a heap, since a round would go through all of
their symbols. Encoded words are kept up to ``CACHE_WORDS`` a worker.

Decoding joins the tokens of the ids by one space (these vocabularies have no decoder of their own).

Null counts as empty: no ids, an empty decoded text. Rows are independent, so repeated rows repeat; an
empty table gives an empty one; other columns are ignored. Texts may have any length.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from headway.llm.arrow import NARROW_SLICE_BYTES, list_array, ranges, strings, text_slices

CACHE_WORDS = 1 << 17
LONG_WORD = 512
NO_RANK = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBPE:
    """The encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocabulary = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"]
        characters = byte_characters()
        self.inner = np.array([vocabulary[c] for c in characters], np.int64)
        self.final = np.array([vocabulary[c + end] for c in characters], np.int64)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.base = 1 + max([*vocabulary.values(), *special.values()])
        self.tokens = [""] * self.base
        for token, k in [*vocabulary.items(), *special.items()]:
            self.tokens[k] = token
        left, right, made = (
            np.array([vocabulary[t] for t in part], np.int64)
            for part in zip(*((a, b, a + b) for a, b in model["merges"]))
        )
        rank_of = {int(k): rank for rank, k in reversed(list(enumerate(made)))}
        ordered = all(rank_of.get(int(k), -1) < r for part in (left, right) for r, k in enumerate(part))
        if not ordered or len(rank_of) < len(made):
            raise ValueError("a merge is ranked before one that makes its parts")
        keys = left * self.base + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(pattern["pattern"]["Regex"])
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or "(?!)")
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for token, k in self.special.items():
            self._learn([token], np.array([k], np.int32), np.array([1]))

    def _learn(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        base = len(self.flat)
        self.starts = np.concatenate([self.starts, base + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int64)])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        for word in words:
            self.index[word] = len(self.index)

    def words(self, text: str) -> list[str]:
        """The words of a text, special tokens among them."""
        if "<" not in text or not (cuts := list(self.cut.finditer(text))):
            return self.word.findall(self._plain(text))
        found, at = [], 0
        for cut in cuts:
            found += self.word.findall(self._plain(text[at : cut.start()]))
            found.append(cut[0])
            at = cut.end()
        return found + self.word.findall(self._plain(text[at:]))

    @staticmethod
    def _plain(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # str.lower() looks at the neighbours of a capital sigma
                return "".join(c.lower() for c in text)
        return text.lower()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NO_RANK`` for unknown ones, by binary search."""
        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each distinct word."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.array([len(b) for b in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[flat[last]]
        done_ids: list[np.ndarray] = []
        done_words: list[np.ndarray] = []
        done_sizes: list[np.ndarray] = []

        def finish(mask, symbols, sizes, owner):
            done_ids.append(symbols[np.repeat(mask, sizes)])
            done_words.append(owner[mask])
            done_sizes.append(sizes[mask])

        owner = np.arange(len(words))
        for k in np.flatnonzero(sizes > LONG_WORD):
            merged = self._merge_long(symbols[last[k] + 1 - sizes[k] : last[k] + 1])
            done_ids.append(merged)
            done_words.append(np.array([k]))
            done_sizes.append(np.array([len(merged)]))
        live = sizes <= LONG_WORD
        symbols, owner, sizes = symbols[np.repeat(live, sizes)], owner[live], sizes[live]
        ranks = self._ranks(symbols, sizes)
        while len(owner):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest != NO_RANK
            if not live.all():
                finish(~live, symbols, sizes, owner)
                keep = np.repeat(live, sizes)
                symbols, ranks, owner, sizes, lowest = symbols[keep], ranks[keep], owner[live], sizes[live], lowest[live]
                if not len(owner):
                    break
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            run = np.arange(len(at))
            first = np.r_[True, np.diff(at) != 1]
            at = at[(run - np.maximum.accumulate(np.where(first, run, 0))) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            word_of = np.repeat(np.arange(len(sizes)), sizes)
            sizes = sizes - np.bincount(word_of[at], minlength=len(sizes))
            moved = at - np.arange(len(at))
            symbols, ranks, word_of = symbols[~gone], ranks[~gone], word_of[~gone]
            for p in (moved, moved[moved > 0] - 1):
                ranks[p] = NO_RANK
                p = p[p + 1 < len(symbols)]
                p = p[word_of[p] == word_of[p + 1]]
                ranks[p] = self.rank(symbols[p], symbols[p + 1])
        ids, order, counts = map(np.concatenate, (done_ids, done_words, done_sizes))
        starts = np.cumsum(counts) - counts
        back = np.argsort(order, kind="stable")
        return ids[ranges(starts[back], counts[back])].astype(np.int32), counts[back]

    def _ranks(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each symbol; none at a word's last."""
        ranks = np.full(len(symbols), NO_RANK, np.int32)
        if len(symbols) > 1:
            ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
            ranks[np.cumsum(sizes) - 1] = NO_RANK
        return ranks

    def _merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """One long word: lowest rank first, then leftmost, over a linked list."""
        value, n = symbols.tolist(), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self._ranks(symbols, np.array([n]))
        heap = [(int(r), i, value[i], value[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)
        pairs = self._pairs()
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if value[i] == a else n
            if j >= n or value[j] != b:
                continue
            value[i], value[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := pairs.get((value[x], value[y]))) is not None:
                    heapq.heappush(heap, (r, x, value[x], value[y]))
        return np.array([v for v in value if v >= 0], np.int64)

    @lru_cache(maxsize=1)  # noqa: B019  one object per vocabulary and worker
    def _pairs(self) -> dict[tuple[int, int], int]:
        left, right = np.divmod(self.keys, self.base)
        return dict(zip(zip(left.tolist(), right.tolist()), self.ranks.tolist()))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the n+1 offsets."""
        split = [self.words(t) for t in texts]
        new = {w for words in split for w in words if w not in self.index}
        if new and len(self.index) + len(new) > CACHE_WORDS:
            self.forget()
            new = {w for words in split for w in words if w not in self.index}
        if new:
            new = list(new)
            self._learn(new, *self.encode_words(new))
        get = self.index.__getitem__
        counts = np.array([len(words) for words in split], np.int64)
        words = np.fromiter((get(w) for words in split for w in words), np.int64, int(counts.sum()))
        sizes = self.sizes[words]
        ends = np.r_[0, np.cumsum(sizes)]
        return self.flat[ranges(self.starts[words], sizes)], ends[np.r_[0, np.cumsum(counts)]]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each list of ids."""
        tokens = [*map(self.tokens.__getitem__, ids.tolist())]
        return [" ".join(tokens[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


@lru_cache(maxsize=2)
def load(path: str) -> WordBPE:
    return WordBPE(path)


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded) of every text; ``vocabulary``: a tokenizers file that every executor can open."""

    def run(batches):
        bpe = load(vocabulary)
        for batch in text_slices(batches, limit=NARROW_SLICE_BYTES):
            ids, offsets = bpe.encode(strings(batch.column("text")))
            decoded = pa.array(bpe.decode(ids, offsets), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), list_array(ids, offsets, pa.int32()), decoded], ["doc_id", "ids", "decoded"]
            )

    columns = docs.select(docs["doc_id"].cast("long"), "text")
    return columns.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
