"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Texts handed to one numpy step of a task; bounds the step's memory, never the result.
STEP_BYTES = 4_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


_KEPT: dict[object, object] = {}


def kept(key: object, build: Callable[[], object]):
    """What ``build`` makes, once per worker process and key. A worker keeps one such thing at a time:
    reused workers would otherwise hold what the operators before this one have loaded."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, keeps: object = None) -> DataFrame:
    """``mapInArrow`` with one function per record batch; ``keeps`` is the key of what it takes from ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if keeps not in _KEPT:
            _KEPT.clear()
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of a string column as UTF-8, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def words(raw: bytes) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of a text: ``bytes.split`` cuts at exactly these six bytes."""
    return raw.split()


def lowered(raw: bytes) -> bytes:
    """A-Z in lower case, everything else unchanged."""
    return raw.translate(_LOWER)


def steps(raws: list[bytes], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together."""
    start, held = 0, 0
    for i, raw in enumerate(raws):
        held += len(raw)
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(raws):
        yield start, len(raws)


def uniform(column: Column, seed: int) -> Column:
    """A repeatable draw from [0, 1) for a key."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), column), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def row_struct(df: DataFrame) -> Column:
    """All columns of a row as one struct; ``select("row.*")`` gives them back unchanged."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])
