"""Words of whole texts: as a column expression, and as hash arrays inside Arrow tasks.

A word is a run of characters other than space and the control characters 0x09-0x0D.
In UTF-8 these are single bytes, so texts are cut as bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text hashed at a time; a longer text is hashed alone.
SLICE_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def word_count(text: str) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that makes every bit depend on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd number modulo 2**64, and their inverses."""
    if len(_powers.get("up", ())) <= n:
        size = max(2 * n, SLICE_BYTES) + 2
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums modulo 2**64 of `values`, weighted by powers; one longer than `values`."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end), equal for equal contents wherever they lie."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of a column as bytes, one at a time."""
    return (x.as_py() for x in column.cast(pa.large_binary()))


def give_back() -> None:
    """Return what this Python worker has freed, but still holds, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`task` for mapInArrow, giving memory back before and after it.

    A Python worker is used by many tasks, also of later stages. Otherwise each worker keeps
    the most that any of them needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from task(batches)
        give_back()

    return run


def slices(texts: Iterable[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about SLICE_BYTES each, with the index of their first text."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if run and size + len(text) > SLICE_BYTES:
            yield first, run
            first, run, size = i, [], 0
        run.append(text)
        size += len(text) + 1
    if run:
        yield first, run


def word_hashes(run: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a run of texts, and where each text's words begin and end.

    The second array has one entry more than there are texts. `lower` maps A-Z to a-z.
    """
    data = np.frombuffer(b" ".join(run) + b" ", np.uint8)
    edge = np.diff(np.concatenate(([True], _SPACE[data])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = running((_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1))
    lengths = np.fromiter(map(len, run), np.int64, len(run))
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    return spans(sums, start, end), np.searchsorted(start, begins)
