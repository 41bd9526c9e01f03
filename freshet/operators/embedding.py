"""Embedders: pluggable functions from a text column to ARRAY<FLOAT>."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import pairwise
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Embedder(Protocol):
    """Any model behind an Arrow UDF. `kind` is "document" or "query"."""

    model: str
    dim: int

    def embed(self, text: Column, kind: str = "document") -> Column: ...


# Words whose place is remembered per Python worker, and texts and values handled at a time.
CACHED_WORDS, TEXTS_AT_ONCE, VALUES_AT_ONCE = 100_000, 512, 4_000_000


# ASCII letters in lower case; 0 for any other byte.
_LETTERS = np.zeros(256, np.uint8)
for _c in range(ord("a"), ord("z") + 1):
    _LETTERS[[_c, _c - 32]] = _c


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The runs of ASCII letters of all texts, in lower case, and for each the number of its text.

    All bytes are looked at together; a regular expression takes several times as long.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    letters = _LETTERS[np.frombuffer(data, np.uint8)[at[0] : at[-1]]]
    at = at - at[0]
    inside = letters != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # No word runs on from one text into the next.
    starts = at[:-1][at[:-1] < len(letters)]
    first[starts] = inside[starts]
    row = np.searchsorted(at, np.flatnonzero(first), side="right") - 1
    kept = letters[inside]
    ends = np.append(np.flatnonzero(first[inside]), len(kept)).astype(np.int64)
    return row, pa.LargeStringArray.from_buffers(len(row), pa.py_buffer(ends), pa.py_buffer(kept))


@dataclass(frozen=True)
class HashedBagOfWords:
    """Offline stand-in for a hosted model: words hashed into signed buckets, scaled to unit length.

    Deterministic, and different per model name; it makes no claim to match any hosted vectors.
    """

    model: str = "hashed-bow-1"
    dim: int = 1024

    def embed(self, text: Column, kind: str = "document") -> Column:
        model, dim = self.model, self.dim
        # Twice the bucket, and one more for a negative sign.
        places: dict[bytes, int] = {}
        named = f"{model}:".encode()

        def place(word: bytes) -> int:
            digest = hashlib.md5(named + word).hexdigest()
            return 2 * (int(digest[:8], 16) % dim) + (digest[8] >= "8")

        def vectors(texts: pa.Array) -> np.ndarray:
            row, words = words_of(texts)
            words = words.dictionary_encode()
            if len(places) > CACHED_WORDS:
                places.clear()
            _, ends, data = words.dictionary.buffers()
            at, letters = np.frombuffer(ends, np.int64)[: len(words.dictionary) + 1].tolist(), data.to_pybytes() if data else b""
            seen = [letters[i:j] for i, j in pairwise(at)]
            for word in seen:
                if word not in places:
                    places[word] = place(word)
            code = np.fromiter(map(places.__getitem__, seen), np.int64, len(seen))
            bucket, sign = code >> 1, 1 - 2 * (code & 1)
            which = np.asarray(words.indices)
            sums = np.bincount(row * dim + bucket[which], weights=sign[which], minlength=len(texts) * dim)
            # Without any words the sums are whole numbers.
            sums = sums.astype(np.float64, copy=False).reshape(len(texts), dim)
            norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            return np.divide(sums, norms, out=sums, where=norms > 0).astype(np.float32)

        @F.arrow_udf("array<float>")
        def embed(texts: pa.Array) -> pa.Array:
            rows = max(1, min(TEXTS_AT_ONCE, VALUES_AT_ONCE // dim))
            parts = [vectors(texts.slice(i, rows)).reshape(-1) for i in range(0, len(texts), rows)]
            flat = np.concatenate(parts) if parts else np.zeros(0, np.float32)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * dim
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

        return embed(text)


def embed_chunks(staged: DataFrame, embedder: Embedder) -> DataFrame:
    """Staged chunks with vector, model and dim set and status `embedded`."""
    return staged.withColumn("embedding", embedder.embed(F.col("text"), "document")).withColumns(
        {"model": F.lit(embedder.model), "dim": F.size("embedding"), "status": F.lit("embedded")}
    )


def embed_questions(questions: DataFrame, embedder: Embedder, text: str = "query") -> DataFrame:
    """Questions that are not blank after trimming, with their vectors."""
    asked = questions.where(F.length(F.trim(text)) > 0)
    return asked.withColumn("embedding", embedder.embed(F.col(text), "query"))
