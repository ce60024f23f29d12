"""Texts to vectors with any encoder, as one Arrow-batched column expression."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from wellspring.backends import loaded


# Texts given to an encoder at once.
BATCH_SIZE = 64

ENCODED = "struct<embedding: array<float>, error: string>"


def encode(text: Column, factory, batch_size: int = BATCH_SIZE) -> Column:
    """``struct<embedding, error>`` of ``text``: the vector, empty where the text is NULL or
    fails, and the error's text where it fails.

    Only the text travels to Python, and the encoder gets ``batch_size`` texts at a time. The
    column is marked nondeterministic so that the optimizer never evaluates a model twice for
    one row.
    """

    @F.arrow_udf(returnType=ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = loaded(factory)
        for texts in batches:
            # a piece at a time: as Python objects, an Arrow batch of long texts takes many times its size
            for start in range(0, len(texts), batch_size):
                yield encoded(encoder, texts.slice(start, batch_size).to_pylist(), batch_size)

    return run.asNondeterministic()(text)


def encoded(encoder, texts: list[str | None], batch_size: int = BATCH_SIZE) -> pa.StructArray:
    rows: list[np.ndarray] = [np.empty(0, np.float32)] * len(texts)
    errors: list[str | None] = [None] * len(texts)
    known = [i for i, text in enumerate(texts) if text is not None]
    for start in range(0, len(known), batch_size):
        _fill(encoder, texts, known[start : start + batch_size], rows, errors)
    ends = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
    flat = np.concatenate(rows) if rows else np.empty(0, np.float32)
    vectors = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.float32()))
    return pa.StructArray.from_arrays([vectors, pa.array(errors, pa.string())], names=["embedding", "error"])


def _fill(encoder, texts, places: list[int], rows, errors) -> None:
    """Encode the texts at ``places``. Texts that fail together are halved until those at
    fault are alone, which takes a few calls for each of them."""
    try:
        found = encoder([texts[i] for i in places])
        if len(found) != len(places):
            raise ValueError("encoder returned another number of vectors")
        for i, row in zip(places, found):
            rows[i] = np.asarray(row, dtype=np.float32).ravel()
    except Exception as problem:
        if len(places) == 1:
            errors[places[0]] = str(problem) or type(problem).__name__
            return
        half = len(places) // 2
        _fill(encoder, texts, places[:half], rows, errors)
        _fill(encoder, texts, places[half:], rows, errors)
