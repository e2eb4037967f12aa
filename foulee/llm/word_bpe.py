"""Token ids of whole texts from a tokenizer of the ``tokenizers`` library, word by word.

The vocabulary's words never reach over white space, so a text's ids are those of its words in order, and
a word's ids are looked up once for each worker. A text of ASCII and Latin-1 letters, digits and marks is cut into
pieces at once (letters, single digits, runs of marks). Other texts are cut into chunks at white space first: a chunk
with anything else, apostrophes included, goes to the tokenizer as it is, and so does one that holds a special token's
string: the tokenizer gives the token's id there, in the case of letters that it asks for. All ids come from the
tokenizer itself.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

_SPACE = " \t\n\r\x0b\x0c"
_MARKS = r"!-&(-/:-@\[-`{-~"
_ODD = re.compile(rf"[^A-Za-zÀ-ÖØ-öø-ÿ0-9{_MARKS}{_SPACE}]")
_PIECE = re.compile(rf"[a-zß-öø-ÿ]+|[0-9]|[{_MARKS}]+")
_CHUNK = re.compile(rf"[^{_SPACE}]+")
#: Entries that a worker remembers of chunks and of pieces: about 200 bytes each.
CACHED = 500_000
#: Pieces that the tokenizer gets as one text; of longer ones it takes more time a piece.
_JOINED = 100


class WordEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        self.tokenizer = Tokenizer.from_file(path)
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # No text matches the empty alternative's stand-in: a vocabulary may have no such tokens.
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)", re.I)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4") for one in found]

    def _learn_pieces(self, new: list[str]) -> None:
        groups = [new[i : i + _JOINED] for i in range(0, len(new), _JOINED)]
        for group, ids in zip(groups, self._ids([" ".join(group) for group in groups])):
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(group):
                starts = [0, *ends[:-1].tolist()]
                self.pieces.update((w, ids[a:b].tobytes()) for w, a, b in zip(group, starts, ends.tolist()))
            else:  # another vocabulary may cut a piece into words
                self.pieces.update((w, one.tobytes()) for w, one in zip(group, self._ids(group)))

    def _learn(self, new: set[str]) -> None:
        odd = [chunk for chunk in new if _ODD.search(chunk) or chunk != chunk.lower() or self.special.search(chunk)]
        self.chunks.update((chunk, ids.tobytes()) for chunk, ids in zip(odd, self._ids(odd)))
        cut = {chunk: _PIECE.findall(chunk) for chunk in new.difference(odd)}
        self._learn_pieces(list({piece for pieces in cut.values() for piece in pieces}.difference(self.pieces)))
        known = self.pieces.__getitem__
        self.chunks.update((chunk, b"".join(map(known, pieces))) for chunk, pieces in cut.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.chunks) > CACHED:
            self.chunks.clear()
        if len(self.pieces) > CACHED:
            self.pieces.clear()
        new: set[str] = set()
        pieces: set[str] = set()
        cut = []
        for text in texts:
            if _ODD.search(text) or self.special.search(text):
                cut.append((self.chunks, _CHUNK.findall(text)))
                new.update(cut[-1][1])
            else:
                cut.append((self.pieces, _PIECE.findall(text.lower())))
                pieces.update(cut[-1][1])
        self._learn_pieces(list(pieces.difference(self.pieces)))
        self._learn(new.difference(self.chunks))
        return [b"".join(map(known.__getitem__, words)) for known, words in cut]


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder, whose memory serves all tasks that the worker runs."""
    return WordEncoder(path)
