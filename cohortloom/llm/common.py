"""What several operators share: tables, stable hashes, words of Arrow text, byte streams."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.staging import shared_folder

#: Text that one step inside a task handles at once, in bytes; one longer text is a step by itself.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the cluster's shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Drop an intermediate table that its successor has replaced."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor``; a null counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor))


def text_key(column: str = "text") -> Column:
    """A 64-bit stand-in for a text, used beside doc_id to tell rows apart."""
    return F.xxhash64(F.col(column))


def steps(batch: pa.RecordBatch, column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into slices of about ``most`` bytes of ``column``, so that
    memory does not depend on how long the texts are."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Unused memory of this worker goes back to the system: one that waits should not hold
    what it has used. Where the C library cannot do it, only Arrow's is given back."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` of mapInArrow, after which the worker keeps nothing: when the task ends, what its
    variables held is free, and goes back to the system before the worker waits for another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and where each text's words begin and end.

    A word is a run of characters other than space and 0x09-0x0D; with
    ``lower``, A-Z are lowered and no other letter. A null text has no words.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), before[offsets - offsets[0]].astype(np.int64)


def numbered(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words, and the index among them of each word."""
    encoded = words.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def byte_view(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings end to end, and the len + 1 offsets into them."""
    if len(strings) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(strings.buffers()[1], np.int32, len(strings) + 1, strings.offset * 4)
    data = strings.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (shifts and odd multipliers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_hashes(strings: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash per string: a sum of mixed (byte, place) pairs, mixed again
    with the length. Depends on the bytes only, so it is the same everywhere."""
    data, offsets = byte_view(strings)
    if len(offsets) == 1:
        return np.zeros(0, np.uint64)
    lengths = np.diff(offsets)
    place = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], lengths)
    value = (place.astype(np.uint64) << np.uint64(8)) | data.astype(np.uint64)
    terms = mixed(value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed + 1))
    sums = np.zeros(len(terms) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    return mixed((sums[offsets[1:]] - sums[offsets[:-1]]) ^ mixed(lengths.astype(np.uint64)))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each slice ``offsets[i]:offsets[i + 1]``; 0 for an empty one."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all given runs, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def open_stream(path: str, compression: str | None = None):
    """A file of the shared folder as a stream, wherever Spark said it lies."""
    system, inner = _located(path)
    return system.open_input_stream(inner, compression=compression, buffer_size=1 << 20)


def open_file(path: str):
    """A file of the shared folder for reading byte ranges."""
    system, inner = _located(path)
    return system.open_input_file(inner)


def _located(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)
