"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the usual pattern that parts a text before byte-pair merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(4)
def encoder(path: str = TOKENIZER):
    """The tokenizer of a .tiktoken file of ranks or a tokenizers .json file, as a function from texts to sizes; one per worker."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    t = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(ids) for ids in t.encode_ordinary_batch(texts, num_threads=1)]


def token_count(c, path: str = TOKENIZER) -> Column:
    """Tokens of the whole text; 0 for null and for texts of white space only, which are missing."""

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(encoder(path)([t.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if t and t.strip() else "" for t in texts]), dtype="int64")

    return count(F.col(c) if isinstance(c, str) else c)
