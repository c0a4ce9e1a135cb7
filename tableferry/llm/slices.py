"""Texts in slices of bounded size, and words that are encoded once for all places they stand at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are taken from an Arrow batch at a time.
SLICE_BYTES = 1 << 20


def text_slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` of about ``most`` bytes of text each; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def spread(word: np.ndarray, sizes: np.ndarray, made: list[bytes], kind: str) -> list[np.ndarray]:
    """The ids of texts, put together from those of their words.

    ``word``: the number of each word of the texts, in order, among the different ones; ``sizes``:
    the words of each text; ``made``: the ids of the different words, as bytes of type ``kind``.
    """
    flat = np.frombuffer(b"".join(made), kind)
    width = np.dtype(kind).itemsize
    each = np.array([len(ids) // width for ids in made], np.int64)
    size = each[word]
    ends = np.cumsum(size)
    first = np.cumsum(each)[word] - ends  # where a word's ids are, less where they go
    ids = flat[np.repeat(first, size) + np.arange(len(word) and int(ends[-1]))]
    stops = [0, *np.append(0, ends)[np.cumsum(sizes)].tolist()]
    return [ids[x:y] for x, y in zip(stops, stops[1:])]
