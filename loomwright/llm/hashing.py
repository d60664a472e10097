"""Vectorised tokenising and hashing of Arrow string batches.

A batch is handled as one byte buffer.  Tokens are maximal runs of one byte class, a token's 64-bit hash
is a difference of prefix sums ``sum T[b_i] * P**i`` shifted to position 0, so no Python code runs per
token or per character.  Whole texts are processed: a slice always ends at a document's end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 18
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)

_ASCII = np.arange(256)
_ALNUM = ((_ASCII >= 48) & (_ASCII <= 57)) | ((_ASCII >= 65) & (_ASCII <= 90)) | ((_ASCII >= 97) & (_ASCII <= 122)) | (_ASCII >= 128)
_SPACE = (_ASCII <= 32) | (_ASCII == 127)
#: ASCII letters and digits, and all bytes of other letters, are words; anything else separates.
WORDS = _ALNUM.astype(np.uint8)
#: Runs of word bytes and runs of punctuation are both tokens.
WORDS_AND_MARKS = np.where(_SPACE, 0, np.where(_ALNUM, 1, 2)).astype(np.uint8)
#: What stands between blanks, as ``[^ \t\n\f\r]+`` finds it.
FIELDS = (~np.isin(_ASCII, [32, 9, 10, 12, 13])).astype(np.uint8)

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, SLICE_BYTES + 1), U(base), dtype=np.uint64)
        out[0] = 1
        _powers[name] = have = np.multiply.accumulate(out)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: all bits of the result depend on all bits of ``h``."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


@dataclass
class Slice:
    """Some whole documents of a batch: their bytes, and where each begins (one more entry than documents)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None and texts.buffers()[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about SLICE_BYTES bytes, so that a large batch is never held in another form as a whole."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right"))
        to = min(max(to, at + 1), len(texts))
        yield at, to
        at = to


def slices(texts: pa.Array, lower: bool = True) -> Iterator[Slice]:
    """Null texts count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for at, to in ranges(texts):
        part = texts.slice(at, to - at)
        yield Slice(at, *_buffer(pc.utf8_lower(part) if lower else part))


@dataclass
class Tokens:
    doc: np.ndarray  # index in the slice
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    kind: np.ndarray  # byte class
    prefix: np.ndarray | None = None  # prefix sums, for hashes of parts of tokens


def tokenise(s: Slice, classes: np.ndarray = WORDS, hashes: bool = True, translate: np.ndarray | None = None) -> Tokens:
    data = s.data if translate is None else translate[s.data]
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Tokens(z, z, z, z.astype(np.uint64), z.astype(np.uint8), np.zeros(1, np.uint64))
    cls = classes[data]
    change = np.empty(n + 1, dtype=bool)
    change[0] = change[n] = True
    np.not_equal(cls[1:], cls[:-1], out=change[1:n])
    change[s.offsets] = True
    bounds = np.flatnonzero(change)
    kind = cls[bounds[:-1]]
    real = kind > 0
    start, end, kind = bounds[:-1][real], bounds[1:][real], kind[real]
    doc = np.searchsorted(s.offsets, start, "right") - 1
    if not hashes:
        return Tokens(doc, start, end, np.zeros(0, np.uint64), kind)
    prefix = np.empty(n + 1, dtype=np.uint64)
    prefix[0] = 0
    np.cumsum(_TABLE[data] * _power("up", _P, n), out=prefix[1:])
    return Tokens(doc, start, end, part_hash(prefix, start, end), kind, prefix)


def part_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * _power("down", _P_INV, len(prefix))[start])


def hash_of(text: str) -> int:
    """The hash that a token with these bytes gets."""
    s = Slice(0, np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text.encode())]))
    t = tokenise(s, np.ones(256, np.uint8))
    return int(t.hash[0]) if len(t.hash) else 0


def hashes_of(words) -> np.ndarray:
    return np.unique(np.array([hash_of(w) for w in words], dtype=np.uint64))


def is_in(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership in a sorted table."""
    if not len(table):
        return np.zeros(len(h), dtype=bool)
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    return table[at] == h


def grams(t: Tokens, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Documents and hashes of the rolling k-grams.  With ``short``, a document of fewer than k tokens, but of
    at least one, has one gram of all its tokens."""
    n = len(t.hash)
    if not n:
        return t.doc, t.hash
    h = t.hash[: max(0, n - k + 1)].copy()
    for j in range(1, k):
        h = mix(h * U(3) + t.hash[j : n - k + 1 + j])
    same = t.doc[: len(h)] == t.doc[k - 1 : k - 1 + len(h)]
    doc, h = t.doc[: len(h)][same], h[same]
    if short:
        docs, first, count = np.unique(t.doc, return_index=True, return_counts=True)
        few = count < k
        if few.any():
            extra = t.hash[first[few]].copy()
            for j in range(1, k):
                more = count[few] > j
                extra[more] = mix(extra[more] * U(3) + t.hash[first[few][more] + j])
            doc, h = np.concatenate([doc, docs[few]]), np.concatenate([h, mix(extra)])
            order = np.argsort(doc, kind="stable")
            doc, h = doc[order], h[order]
    return doc, h


def per_doc(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights=weights, minlength=n)


def count_fields(texts: pa.Array) -> np.ndarray:
    """Words between blanks, for each text; 0 for null."""
    out = np.zeros(len(texts), dtype=np.int64)
    for s in slices(texts, lower=False):
        out[s.first : s.first + len(s)] = per_doc(tokenise(s, FIELDS, hashes=False).doc, len(s))
    return out
