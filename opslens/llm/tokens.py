"""Helpers of the operators that tokenize: texts in slices, values kept per distinct chunk of text.

Public tokenizers never join characters across certain blanks, so a text is cut
there and each distinct chunk is encoded once while it is remembered. What is
remembered is bounded; forgetting costs time, never a result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
MEMO_CHUNKS = 200_000
MEMO_VALUES = 4_000_000


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, where tasks run."""
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache
def byte_pair_tokenizer(name: str, plain_specials: bool = False):
    """A tokenizer from its JSON file, loaded once per Python worker; one thread, because Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    out = Tokenizer.from_file(tokenizer_path(name))
    out.encode_special_tokens = plain_specials
    return out


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in parts of about SLICE_BYTES of text; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(size):
        end = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), SLICE_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


class Ragged:
    """Rows of values of different lengths, appended in bulk and gathered by row number."""

    def __init__(self, dtype) -> None:
        self.values, self.ends, self.rows, self.used = np.empty(1 << 12, dtype), np.zeros(1 << 10, np.int64), 0, 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(values) > len(self.values):
            self.values = np.resize(self.values, 2 * (self.used + len(values)))
        if self.rows + len(sizes) >= len(self.ends):
            self.ends = np.resize(self.ends, 2 * (self.rows + len(sizes) + 1))
        self.values[self.used:self.used + len(values)] = values
        self.ends[self.rows + 1:self.rows + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.rows, self.used = self.rows + len(sizes), self.used + len(values)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the rows one after the other, size of each row)."""
        start = self.ends[rows]
        size = self.ends[rows + 1] - start
        before = np.cumsum(size) - size
        return self.values[np.repeat(start - before, size) + np.arange(int(size.sum()))], size


def by_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive values, ``counts`` of them for each text."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
