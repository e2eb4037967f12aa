"""Words of lines as 64-bit hashes, for whole slices of texts at once.

A text's bytes are lowered by a table that turns all others into spaces, words are what lies between, and a word's hash
takes its bytes eight at a time: the first eight of all words of a window, then the next eight of those that have more. So no
word becomes an object. Words are runs of ASCII letters and digits, A-Z lower-cased, and of all bytes above ASCII. A word
of more than ``LONG`` bytes is hashed on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

LONG = 1024
#: Counts from which on words are in order of their hashes only.
MANY = (1 << 20) - 1
_WINDOW = 1 << 18
#: Where a window's last word must end, unless it comes alone.
_SPAN = 2 * _WINDOW
_ODD = np.uint64(0x9E3779B97F4A7C15)

_LOWER = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
#: The first bytes of a little-endian long, by their number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _hashed(lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a window."""
    inside = np.zeros(len(lowered) + 2, bool)
    inside[1:-1] = np.frombuffer(lowered, np.uint8) != 0x20
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    longs = np.frombuffer(lowered + bytes(16 - len(lowered) % 8), "<u8")
    found = (end - start).astype(np.uint64) * _ODD
    alone = end - start > LONG
    word, at, left = np.arange(len(start)), start, np.where(alone, 0, end - start)
    while len(word):
        shift = (at & 7).astype(np.uint64) << np.uint64(3)
        # A shift by 64 bits gives 0.
        eight = longs[at >> 3] >> shift | longs[(at >> 3) + 1] << np.uint64(64) - shift
        found[word] = mix(found[word] * _ODD ^ eight & _FIRST[np.minimum(left, 8)], 5)
        more = left > 8
        word, at, left = word[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(alone).tolist():
        found[i] = _long(lowered[start[i] : end[i]])
    return start, found


def _long(lowered: bytes) -> int:
    return xxhash.xxh64_intdigest(lowered)


def _windows(lowered: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Start of each window with its words' starts and hashes; a word that is as long as a window comes alone."""
    at = 0
    while at < len(lowered):
        end = lowered.find(b" ", at + _WINDOW, at + _SPAN)
        if end < 0 and at + _SPAN < len(lowered):
            # Up to the start of the long word, then the word itself.
            start = max(at, lowered.rfind(b" ", at, at + _WINDOW) + 1)
            yield at, *_hashed(lowered[at:start])
            end = lowered.find(b" ", at + _WINDOW)
            at, end = start, end if end >= 0 else len(lowered)
            if end - at > LONG:
                yield at, np.zeros(1, np.int64), np.array([_long(lowered[at:end])], np.uint64)
                at = end
                continue
        end = end if end >= 0 else len(lowered)
        yield at, *_hashed(lowered[at:end])
        at = end


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and line of each word, in order, and each text's first line; lines are counted through all texts."""
    texts = [text or b"" for text in texts]
    first = np.cumsum([0, *(text.count(b"\n") + 1 for text in texts)])
    data = b"\n".join(texts)
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at, start, found in _windows(data.translate(_LOWER)):
        starts.append(start + at)
        hashes.append(found)
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A)
    words = np.searchsorted(np.concatenate(starts), breaks)
    words = np.diff(words, prepend=0, append=sum(map(len, starts)))
    return np.concatenate(hashes), np.repeat(np.arange(len(words)), words), first


def by_line(hashes: np.ndarray, line: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of each line, rarest first, then by hash: hashes, lines, and how often they occur."""
    n_lines = int(line.max(initial=0)) + 1
    if n_lines <= 1 << 20:
        rarity = np.minimum(often, MANY).astype(np.uint64)
        key = line.astype(np.uint64) << np.uint64(44) | rarity << np.uint64(24) | hashes >> np.uint64(40)
        order = np.argsort(key)
        sorted_key, h = key[order], hashes[order]
        same = sorted_key[1:] == sorted_key[:-1]
        if not (same & (h[1:] != h[:-1])).any():
            keep = np.concatenate(([True], ~same))[: len(order)]
            return h[keep], (sorted_key[keep] >> np.uint64(44)).astype(line.dtype), often[order[keep]]
    rarity = np.minimum(often, MANY)
    order = np.lexsort((hashes, rarity, line))
    h, own = hashes[order], line[order]
    keep = order[np.concatenate(([True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])))[: len(order)]]
    return hashes[keep], line[keep], often[keep]
