"""What the operators share: staged tables, text in bounded pieces, vectorised word hashes."""

import ctypes
import re
from collections.abc import Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wellspring.workspace import ship_package, stage

#: Bytes of text that are worked on at once; longer texts are taken in several pieces.
PIECE_BYTES = 1 << 21
#: Powers that a worker keeps from one task to the next.
KEPT_POWERS = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_GAP = re.compile(rb"[ \t\n\r\f\v]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` staged with a row number ``uid``, unique and fixed because it is written down."""
    return stage(df.withColumn("uid", F.monotonically_increasing_id()), name)


def as_bytes(column) -> list[bytes]:
    """UTF-8 texts of an Arrow column; null is the empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def in_slices(batches: Iterable[pa.RecordBatch], size: int = PIECE_BYTES * 7 // 8) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in turn, in slices of about ``size`` bytes of ``text``, one row at least: a
    batch holds thousands of texts, which need not all be Python objects at once."""
    for batch in batches:
        sizes = pc.binary_length(batch["text"]).fill_null(0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes, dtype=np.int64) // size
        edges = [*np.flatnonzero(np.diff(run, prepend=-1)).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def grouped(texts: list[bytes], size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``size`` bytes together, one text at least."""
    first = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield first, i
            first, total = i, 0
        total += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A long text cut before white space, so that no word is divided. A single word longer
    than ``size`` stays whole."""
    at = 0
    while len(text) - at > size:
        gap = _GAP.search(text, at + size)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def letters(keep: bytes = b"") -> np.ndarray:
    """Byte table for ``word_hashes``: A-Z lower-cased; white space, and with ``keep`` given
    all ASCII but letters, digits and ``keep``, made 0."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    low[0] = 255  # which no UTF-8 text holds: 0 is to mean a gap
    low[[9, 10, 11, 12, 13, 32]] = 0
    if keep:
        plain = np.ones(128, bool)
        plain[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(keep)] = False
        low[:128][plain] = 0
    return low


WHOLE_WORDS = letters()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads every bit of 64 (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """At least ``n`` powers of the base, or of its inverse, modulo 2^64. The longest table asked
    for so far is kept, no shorter one beside it."""
    if len(_powers.get(inverse, ())) < n:
        p = np.full(1 << max(8, (n - 1).bit_length()), _INVERSE if inverse else _BASE, np.uint64)
        p[0] = 1
        _powers[inverse] = np.cumprod(p)
    return _powers[inverse]


def tidy(function):
    """``function`` for mapInArrow, after which a worker hands back the memory it no longer needs:
    workers are used again by later stages and would otherwise keep the peak of each."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            release_memory()

    return run


def release_memory() -> None:
    for kept in [k for k, p in _powers.items() if len(p) > KEPT_POWERS]:
        del _powers[kept]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of most Linux systems has it
    if trim is not None:
        trim(0)


def word_spans(text: bytes, low: np.ndarray = WHOLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, 64-bit hash) of each word of ``text``: a polynomial over its bytes, mixed.

    Running sums of byte times power give each word's polynomial as a difference, which the
    inverse power of its start brings to the same form wherever the word stands."""
    plain = low[np.frombuffer(text, np.uint8)]
    inside = np.zeros(len(plain) + 2, bool)
    np.not_equal(plain, 0, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    lengths = ends - starts
    sums = plain * powers(len(plain))[: len(plain)]
    np.cumsum(sums, out=sums)
    hashes = sums[ends - 1]
    later = int(starts[0] == 0)  # no other word can begin there
    hashes[later:] -= sums[starts[later:] - 1]
    hashes *= powers(len(plain), inverse=True)[starts]
    return starts, lengths, mixed(hashes + lengths.astype(np.uint64))


def word_hashes(text: bytes, low: np.ndarray = WHOLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    starts, _, hashes = word_spans(text, low)
    return starts, hashes


def joined(texts: Iterable[bytes], separator: bytes = b"\n") -> tuple[bytes, np.ndarray]:
    """Texts in one buffer, and where each begins; the last entry is the end."""
    texts = list(texts)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return separator.join(texts) + separator, np.concatenate(([0], np.cumsum(sizes)))


def keeps_columns(*used: str):
    """For a function of ``docs`` that returns rows of ``docs``: columns but the ``used`` ones bear
    other names inside it, so none can clash with a helper column, and their own ones again after."""

    def guarded(function):
        @wraps(function)
        def run(docs: DataFrame, *rest, **options) -> DataFrame:
            inside = {name: f"own column {i}" for i, name in enumerate(docs.columns) if name not in used}
            out = function(docs.withColumnsRenamed(inside), *rest, **options)
            return out.select(*[F.col(f"`{inside.get(name, name)}`").alias(name) for name in docs.columns])

        return run

    return guarded


def and_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` followed by more fields."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def rows(schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
