"""Embedders: functions from a text column to a column of vectors. The hashing embedder needs no model; others are plugged in."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from kolam.functions.names import as_col


def hashing_embedder(dimensions: int = 256, grams: int = 3, prefix: str = "") -> Callable[[str], Column]:
    """Unit vectors of hashed character n-grams: deterministic, without a model; equal texts are equal, small edits are near."""

    def embed(c) -> Column:
        @F.pandas_udf(ArrayType(FloatType()))
        def vectors(texts: pd.Series) -> pd.Series:
            return pd.Series([None if t is None else _hashed(prefix + t.lower(), dimensions, grams) for t in texts], dtype=object)

        return vectors(as_col(c))

    return embed


def _hashed(text: str, dimensions: int, grams: int) -> np.ndarray:
    import zlib

    v = np.zeros(dimensions, np.float32)
    padded = f" {text} "
    for i in range(max(1, len(padded) - grams + 1)):
        h = zlib.crc32(padded[i : i + grams].encode("utf-8", "surrogatepass"))
        v[h % dimensions] += 1 if h & 0x80000000 else -1
    n = float(np.sqrt((v * v).sum()))
    return v / n if n else v


_models: dict[str, object] = {}


def model_embedder(name: str, prefix: str = "", normalize: bool = True, batch: int = 64) -> Callable[[str], Column]:
    """Vectors of a sentence-transformers model, loaded once per Python worker; needs that library on the executors."""

    def embed(c) -> Column:
        @F.pandas_udf(ArrayType(FloatType()))
        def vectors(texts: pd.Series) -> pd.Series:
            if name not in _models:
                from sentence_transformers import SentenceTransformer

                _models[name] = SentenceTransformer(name)
            known = texts.notna()
            out = pd.Series([None] * len(texts), dtype=object)
            if known.any():
                made = _models[name].encode([prefix + t for t in texts[known]], normalize_embeddings=normalize, batch_size=batch)
                out[known.to_numpy()] = list(np.asarray(made, np.float32))
            return out

        return vectors(as_col(c))

    return embed
