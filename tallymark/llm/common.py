"""Pieces that several corpus operators share: reading tables, keys of rows, and text batches as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that the array code below handles at once; a longer document is handled alone.
SLICE_BYTES = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20_240_601))
BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it of something in the shared folder, for tasks that read it themselves."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def row_digest(df: DataFrame) -> Column:
    """64-bit digest of a whole row; maps and variants have none and don't count."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing, so that sums and products behave like random numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = STEP
    return np.multiply.accumulate(out)


class Texts:
    """Some documents of an Arrow batch: their UTF-8 bytes one after another, and where each begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.n = len(offsets) - 1

    @staticmethod
    def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
        """``column`` in runs of documents of about ``most`` bytes; null counts as empty."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if not len(column):
            return
        if pa.types.is_null(column.type):
            column = column.cast(pa.string())
        if column.null_count:
            column = column.fill_null("")
        _, places, values = column.buffers()
        width = np.int64 if pa.types.is_large_string(column.type) else np.int32
        offsets = np.frombuffer(places, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
        at = 0
        while at < len(column):
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = min(max(to, at + 1), len(column))
            part = offsets[at : to + 1]
            yield Texts(data[part[0] : part[-1]], part - part[0], at)
            at = to

    def words(self, data: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, hash and document of each word, that is each run of bytes other than space and \\t to \\r."""
        data = self.data if data is None else data
        inside = (data != 32) & ((data < 9) | (data > 13))
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = self.offsets[:-1][self.offsets[:-1] < len(data)]
        begins[edges] = inside[edges]
        starts = np.flatnonzero(begins)
        doc = np.searchsorted(self.offsets, starts, side="right") - 1
        return starts, segment_hash(data, starts, inside), doc

    def per_document(self, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc, weights=weights, minlength=self.n).astype(np.int64)

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags, one for each byte, in each document."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def segment_hash(data: np.ndarray, starts: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of the bytes from each start to the next one; bytes that are not ``inside`` don't count."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    value = BYTE_CODE[data[starts[0] :]] * powers(int(lengths.max()))[place]
    if inside is not None:
        value[~inside[starts[0] :]] = 0
    return mixed(np.add.reduceat(value, starts - starts[0]))


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts rows by ``keys`` (the first key counts most), where each run of equal rows begins, and its length."""
    order = np.lexsort(keys[::-1])
    n = len(order)
    if not n:
        return order, np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, n))
