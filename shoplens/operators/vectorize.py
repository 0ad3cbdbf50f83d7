"""Product text to unit vectors, in Arrow batches, with a pluggable encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.text import product_text

BATCH = 100  # texts per call of the encoder
Encoder = Callable[[list[str]], np.ndarray]


def hashing_encoder(dims: int) -> Encoder:
    """Deterministic stand-in for a model: signed feature hashing of the words."""

    @lru_cache(maxsize=100_000)
    def place(word: str) -> tuple[int, float]:
        h = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
        return (h >> 1) % dims, 1.0 if h & 1 else -1.0

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims))
        for row, words in zip(out, (t.lower().split() for t in texts)):
            for column, sign in map(place, words):
                row[column] += sign
        return out

    return encode


def vectorize_catalog(goods: DataFrame, dims: int, make_encoder: Callable[[int], Encoder] = hashing_encoder) -> DataFrame:
    """Adds `product_vector`, normalised. The encoder is built once per task."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder(dims)
        for texts in batches:
            parts = [encoder(texts.iloc[i:i + BATCH].tolist()) for i in range(0, len(texts), BATCH)]
            vectors = np.concatenate(parts) if parts else np.zeros((0, dims))
            lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
            yield pd.Series(list((vectors / np.where(lengths > 0, lengths, 1.0)).astype(np.float32)), index=texts.index)

    text = product_text(F.col("product_name"), F.col("category"), F.col("description"))
    return goods.withColumn("product_vector", encode(text))
