"""Helpers shared by the operators: whole-text word hashing in numpy and tables in the shared folder.

Words are maximal runs of characters other than blank and the controls 9 to 13, with A-Z lower-cased. They are found on
UTF-8 bytes, so a word's hash depends on its bytes only and is the same on every machine.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from triagegrid.session import new_path, stored  # noqa: F401

GROUP_BYTES = 1 << 19
#: Rows whose texts a task holds as Python values at once.
SLICE_ROWS = 256

BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.default_rng(20240229)
_BYTE = _random.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class Local(dict):
    """What a process has made for itself; it stays behind when functions that use it travel."""

    def __reduce__(self):
        return Local, ()


_POWERS = Local()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores in front while the frame has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(begin, SLICE_ROWS)


def map_slices(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` whose frames have few rows, so that long texts are turned into Python values piece by piece."""
    kinds = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        for out in fn(part.to_pandas() for part in slices(batches)):
            yield pa.RecordBatch.from_pandas(out, kinds, preserve_index=False)

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, GROUP_BYTES * 2)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[i] = np.cumprod(x, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def groups(texts: list[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` bytes together; a longer text stands alone."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def spans_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word in an array of bytes."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~BLANK[data]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of pieces of lower-cased bytes."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=total[1:])
    return mix((total[end] - total[begin]) * inverse[begin])


def _slices(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in pieces that end at blanks, where it has any."""
    at = 0
    while len(text) - at > limit:
        piece = np.frombuffer(text, np.uint8, min(limit, len(text) - at), at)
        blanks = np.flatnonzero(BLANK[piece])
        cut = at + int(blanks[-1]) if len(blanks) else None
        if cut is None:
            rest = np.flatnonzero(BLANK[np.frombuffer(text, np.uint8, offset=at + limit)])
            cut = at + limit + int(rest[0]) if len(rest) else len(text)
        yield text[at:cut]
        at = min(cut + 1, len(text))
    yield text[at:]


def word_hashes(texts: list[str | None], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts: first, last + 1, the hashes of all their words, and where each text's words begin."""
    raw = [encoded(t) for t in texts]
    for begin, end in groups(raw, limit):
        if end - begin == 1 and len(raw[begin]) > limit:
            parts = []
            for piece in _slices(raw[begin], limit):
                data = LOWER[np.frombuffer(piece, np.uint8)]
                parts.append(span_hashes(data, *spans_of(data)))
            hashes = np.concatenate(parts)
            yield begin, end, hashes, np.array([0, len(hashes)])
            continue
        data = LOWER[np.frombuffer(b"\n".join(raw[begin:end]), np.uint8)]
        first, last = spans_of(data)
        starts = np.cumsum([0, *(len(t) + 1 for t in raw[begin:end])])
        yield begin, end, span_hashes(data, first, last), np.searchsorted(first, starts)


_STEP = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; none when there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k : k + n] * _STEP[k]
    return mix(total)


def shingle_sets(words: np.ndarray, starts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer words is one shingle, one without words has none."""
    every = window_hashes(words, size)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= size:
            x = np.sort(every[a : b - size + 1])
            yield x[np.concatenate(([True], x[1:] != x[:-1]))]
        elif b > a:
            yield window_hashes(np.append(words[a:b], np.uint64(b - a)), b - a + 1)
        else:
            yield np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Bits of a filter per id or hash, and of the smallest and largest filter. It only spares work: what passes is joined exactly afterwards.
FILTER_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28


def id_filter(df: DataFrame, column: str):
    """Broadcast bits of a column of longs, sized by their number and combined on the executors; 32 MB at most."""
    wanted = max(LEAST_BITS, min(MOST_BITS, FILTER_BITS * df.count()))
    size = 1 << (wanted - 1).bit_length()

    def bits(batches):
        for x in batches:
            at = mix(x.iloc[:, 0].to_numpy(np.int64).view(np.uint64)) % np.uint64(size)
            word, place = np.unique((at >> np.uint64(6)).astype(np.int64), return_inverse=True)
            held = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(held, place, np.uint64(1) << (at & np.uint64(63)))
            yield pd.DataFrame({"word": word, "bit": signed(held)})

    found = df.select(column).mapInPandas(bits, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return df.sparkSession.sparkContext.broadcast(words)


def passes(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = mix(ids.view(np.uint64)) % np.uint64(64 * len(words))
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
