r"""Secrets in texts: fixed patterns, and strings that a tokenizer finds hard to shorten.

Fixed patterns give the spans of kinds ``assign``, ``access`` and ``hex`` (leftmost, not overlapping within
a kind; too short ones are passed over after they have matched). The token test adds kind ``random``:
words of 16 or more characters over ``[A-Za-z0-9+/_-]`` (with base64 padding) are encoded by a byte-level BPE vocabulary, and
fewer than ``max_ratio`` characters a token mean that the string is made of no common pieces. Left out
are known digests (32, 40, 56, 64, 96 or 128 hex digits), UUIDs, plain numbers and identifiers: strings
whose parts between ``_``, ``-``, ``/``, ``=``, ``+`` are each all letters of one case (a capital first
letter allowed) or all digits. Keys of letters of one case look like identifiers, too; so an identifier with
``LETTERS`` letters or more counts as one only from ``plain_ratio`` characters a token on, which names made of
words reach and random letters do not. Words longer than ``PIECE`` characters are encoded in pieces of that length.

Spans are in code points, the end exclusive. Null counts as empty and has no spans. Rows are independent:
repeated rows give repeated results; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from headway.llm.arrow import strings, text_slices

KINDS = ("assign", "access", "hex", "random")
MAX_RATIO = 2.2
PLAIN_RATIO = 1.9
LETTERS = 12
PIECE = 4096
VOCABULARY = "byte_bpe_50k.tiktoken"

ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
WORD = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
DIGEST_SIZES = (32, 40, 56, 64, 96, 128)
HEX_WORD = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
IDENTIFIER = re.compile(r"[_=+/-]*((?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+|[0-9]+)(?:[_=+/-]+|$))+")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base string, spans string"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; kind is an index of ``KINDS``."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def limit(word: str, max_ratio: float, plain_ratio: float) -> float:
    """Characters a token below which the word is a secret; 0 for known digests, UUIDs and numbers."""
    if len(word) in DIGEST_SIZES and HEX_WORD.fullmatch(word) or UUID.fullmatch(word):
        return 0.0
    if not IDENTIFIER.fullmatch(word):
        return max_ratio
    return min(plain_ratio, max_ratio) if sum(map(str.isalpha, word)) >= LETTERS else 0.0


@lru_cache(maxsize=4)
def encoding(path: str):
    """The vocabulary at ``path`` as an encoder without special tokens; built once per worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("given", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def ratio(word: str, encoder) -> float:
    """Characters per token."""
    pieces = [word[i : i + PIECE] for i in range(0, len(word), PIECE)]
    return len(word) / sum(len(encoder.encode_ordinary(p)) for p in pieces)


def random_spans(text: str, encoder, max_ratio: float, plain_ratio: float = PLAIN_RATIO) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the words that fail the token test."""
    found = []
    for m in WORD.finditer(text):
        least = limit(m[0], max_ratio, plain_ratio)
        if least and ratio(m[0], encoder) < least:
            found.append((m.start(), 3, m.end()))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_secrets(
    docs: DataFrame, vocabulary: str, max_ratio: float = MAX_RATIO, plain_ratio: float = PLAIN_RATIO
) -> DataFrame:
    """Per document the counts by kind, the fixed patterns' spans (``base``) and all ``spans``.

    ``vocabulary``: a tiktoken file that every executor can open.
    """

    def scan(batches):
        encoder = encoding(vocabulary)
        for batch in text_slices(batches):
            counts, base, spans = [[], [], [], []], [], []
            for text in strings(batch.column("text")):
                fixed = base_spans(text)
                more = random_spans(text, encoder, max_ratio, plain_ratio)
                for k in range(4):
                    counts[k].append(sum(s[1] == k for s in (more if k == 3 else fixed)))
                base.append(joined(fixed))
                spans.append(joined(fixed + more))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base", "spans"])

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(scan, SCHEMA)
