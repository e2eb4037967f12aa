"""Token counts of sections by offsets: each document is encoded once and whole.

A section is a line with the line break that ends it, or any other cut of the text into consecutive spans. Encoding
the whole text gives the tokens' byte spans (the vocabulary's byte lengths, summed up); an interval join by
binary search gives each token the sections that it touches. A token that crosses a boundary goes, whole, to the
section that holds most of its bytes; on a tie to the earlier one. So counts of sections add up to the document's.

Everything about a document happens in its own row: no shuffle, and no group to be hot. Output is a row per section.

Cases: null and empty texts have one empty section without tokens. Repeated rows are counted each. Strings that name
special tokens are ordinary text. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm.frames import annotate, read

_SECTION = "struct<section:int,start:long,end:long,n_tokens:long>"


def vocabulary_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ends, in bytes, of whole texts."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(token) for token in ranks]

    def ends(self, text: bytes) -> np.ndarray:
        ids = np.array(self.encoding.encode_ordinary(text.decode()), np.int64)
        return np.cumsum(self.lengths[ids])


def line_bounds(text: bytes) -> np.ndarray:
    """Starts of all sections and the end of the last one, in bytes."""
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    return np.concatenate(([0], breaks, [len(text)])).astype(np.int64)


def attribute(ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of tokens of each section."""
    starts = np.concatenate(([0], ends[:-1]))
    # Of empty sections at one place, the last one starts there; tokens have at least a byte.
    first = np.searchsorted(bounds[:-1], starts, side="right") - 1
    last = np.searchsorted(bounds[:-1], ends - 1, side="right") - 1
    for i in np.flatnonzero(first != last):
        sections = np.arange(first[i], last[i] + 1)
        held = np.minimum(bounds[sections + 1], ends[i]) - np.maximum(bounds[sections], starts[i])
        first[i] = sections[held.argmax()]
    return np.bincount(first, minlength=len(bounds) - 1) if len(ends) else np.zeros(len(bounds) - 1, np.int64)


def count(
    docs: DataFrame, text_col: str, keep: Sequence[str], vocabulary: str | None = None,
    cut: Callable[[bytes], np.ndarray] = line_bounds, name: str = "sections",
) -> DataFrame:
    """Columns ``keep`` and an array of sections: number, span in code points (end exclusive), tokens."""
    path = vocabulary or vocabulary_path()
    kind = T._parse_datatype_string(f"array<{_SECTION}>")

    def make():
        encoder = Encoder(path)

        def work(texts):
            sizes, columns = [0], [[], [], [], []]
            for text in texts:
                text = text or b""
                bounds = cut(text)
                tokens = attribute(encoder.ends(text), bounds)
                # A code point begins at every byte that continues none.
                points = np.concatenate(([0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)))[bounds]
                sizes.append(len(tokens))
                for column, values in zip(columns, (np.arange(len(tokens)), points[:-1], points[1:], tokens)):
                    column.append(values)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(np.concatenate(column).astype(np.int64)).cast(t) for column, t in zip(columns, kinds)]
            rows = pa.StructArray.from_arrays(arrays, ["section", "start", "end", "n_tokens"])
            return [pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), rows)]

        return work

    return annotate(docs, text_col, keep, [T.StructField(name, kind)], make)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count(read(spark, sf_dir, "documents"), "text", ["doc_id"]).select("doc_id", F.inline("sections"))
