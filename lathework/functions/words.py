"""Words and word shingles of texts, in batches, for use inside Arrow functions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_FORMAT = regex.compile(r"\p{Cf}+")
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_S29, _S32 = np.uint64(29), np.uint64(32)


def norm(text: str | None) -> str:
    """NFKC, without invisible format characters, lower-cased; null counts as empty."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    return _FORMAT.sub("", unicodedata.normalize("NFKC", text)).lower()


# the same for texts as ``_ASCII`` below for bytes
_ASCII_TEXT = {i: chr(i + 32) if 65 <= i <= 90 else chr(i) if 48 <= i <= 57 or 97 <= i <= 122 else " " for i in range(128)}


def words(text: str | None) -> list[str]:
    """The longest runs of letters, marks and digits."""
    if not text:
        return []
    if text.isascii():
        return text.translate(_ASCII_TEXT).split()
    return _WORD.findall(norm(text))


# ASCII: capitals to small letters, all but letters and digits to blanks
_ASCII = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_bytes(text: str | None) -> list[bytes] | list[str]:
    """``words``, as bytes where the text is ASCII (several times faster)."""
    if text and text.isascii():
        return text.encode().translate(_ASCII).split()
    return words(text)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values."""
    x = (x ^ (x >> _S29)) * _MULT[1]
    x = (x ^ (x >> _S32)) * _MULT[2]
    return x ^ (x >> _S29)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Of each code point: 1 in words, 2 invisible format characters, 0 others."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((1, _WORD), (2, _FORMAT)):
        for m in pattern.finditer(every):
            s, e = (x if x < 0xD800 else x + 0x800 for x in m.span())
            kinds[s:e] = kind
    kinds[0xD800:0xE000] = 0
    return kinds


def _blanked(texts: list[str]) -> list[bytes]:
    """The texts as ``norm`` gives them, in UTF-8, with blanks for all that isn't in a word."""
    points = lambda s: np.frombuffer(s.encode("utf-32-le"), np.uint32)
    joined = "\0".join(unicodedata.normalize("NFKC", t.replace("\0", " ")) for t in texts)
    x = points(joined)
    x = points(x[_kinds()[x] != 2].tobytes().decode("utf-32-le").lower())
    x = np.where((_kinds()[x] == 1) | (x == 0), x, np.uint32(32))
    return x.tobytes().decode("utf-32-le").encode().split(b"\0")


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and the number of words of each text."""
    parts, other = [], []
    for i, t in enumerate(texts):
        if not t:
            parts.append(b"")
        elif t.isascii():
            parts.append(t.encode().translate(_ASCII))
        else:
            parts.append(b"")
            other.append(i)
    for i, x in zip(other, _blanked([texts[i] for i in other])):
        parts[i] = x
    data = b" " + b" ".join(parts) + b" " * 9
    inside = np.frombuffer(data, np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, size = edges[0::2], edges[1::2] - edges[0::2]
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # the 8 bytes from each place on
    h = mix(size.astype(np.uint64) * _MULT[4])
    at, done = np.arange(len(first)), 0
    while len(at):
        x = eight[first[at] + done] & _LOW[np.minimum(size[at] - done, 8)]
        h[at] = mix(h[at] + x * _MULT[0])
        done += 8
        at = at[size[at] > done]
    ends = np.cumsum([len(x) + 1 for x in parts], dtype=np.int64) if parts else np.empty(0, np.int64)
    return h, np.diff(np.searchsorted(first, ends + 1), prepend=0)


_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


class Shingler:
    """Distinct runs of ``k`` words of each text as sorted 32-bit hashes.

    A text of fewer than ``k`` words is one run (also a text without words).
    ``flat, starts = sets(texts)``: the set of text i is flat[starts[i]:starts[i + 1]].
    """

    def __init__(self, k: int):
        self.k = k

    def sets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        k = self.k
        if not len(texts):
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        ids, n = word_hashes(texts)
        size = np.maximum(n, k)
        ends = np.cumsum(size)
        x = np.repeat((n + 1).astype(np.uint64), size)  # fills short texts up: one run, of its own length
        x[np.arange(len(ids)) + np.repeat(ends - size - np.cumsum(n) + n, n)] = ids
        h = np.zeros(len(x) - k + 1, np.uint64)
        for j in range(k):
            h = mix(h + x[j : len(x) - k + 1 + j] * _MULT[j % 5])
        doc = np.repeat(np.arange(len(texts), dtype=np.uint64), size)[: len(h)]
        within = np.ones(len(h), bool)  # no run reaches into the next text
        for j in range(1, k):
            within[ends[:-1] - j] = False
        key = np.sort((doc[within] << _S32) | (h[within] >> _S32))
        key = key[np.r_[True, key[1:] != key[:-1]]]
        starts = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.uint64) << _S32)
        return key.astype(np.uint32), starts.astype(np.int64)


def class_ids(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits (as two int64 columns) that equal sets share."""
    x = flat.astype(np.uint64)
    n = (starts[1:] - starts[:-1]).astype(np.uint64)
    a = np.add.reduceat(mix(x * _MULT[3] + _MULT[0]), starts[:-1]) if len(n) else np.empty(0, np.uint64)
    b = np.add.reduceat(mix(x * _MULT[4] + _MULT[2]), starts[:-1]) if len(n) else np.empty(0, np.uint64)
    return mix(a + n).view(np.int64), mix(b ^ n).view(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared by the number found in either, of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def pair_likeness(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """``likeness`` of each pair of sets stored as bytes of sorted uint32."""
    if not len(a):
        return np.empty(0)
    na = np.array([len(x) for x in a]) // 4
    nb = np.array([len(x) for x in b]) // 4
    i = np.arange(len(a), dtype=np.uint64)
    x = np.concatenate([np.frombuffer(b"".join(a), np.uint32), np.frombuffer(b"".join(b), np.uint32)]).astype(np.uint64)
    key = np.sort((np.concatenate([np.repeat(i, na), np.repeat(i, nb)]) << _S32) | x)
    both = np.bincount((key[1:][key[1:] == key[:-1]] >> _S32).astype(np.int64), minlength=len(a))
    return both / np.maximum(1, na + nb - both)
