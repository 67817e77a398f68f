"""Texts as sets of words, for the near-duplicate operators.

Words are parted by white space; case and punctuation or symbols at a word's ends are ignored. A set is kept as the sorted distinct
32-bit hashes of its words; that two different words of one pair of texts meet has a chance near 1e-7.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from kolam.llm.lookalikes import look_alikes


@lru_cache(1 << 16)
def _edge(ch: str) -> bool:
    return unicodedata.category(ch)[0] in "PS"


def bare_word(w: str) -> str:
    a, b = 0, len(w)
    while a < b and _edge(w[a]):
        a += 1
    while b > a and _edge(w[b - 1]):
        b -= 1
    return w[a:b]


def _hash(s: str) -> int:
    return xxhash.xxh32_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 31)


_NONE = 1 << 40  # stands for a word without any letter or digit
_known: dict[str, int] = {}


def hashed_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts one after another, where each text's begin, and the end): of a text its sorted distinct word hashes;
    of a text without words, one hash of the text itself."""
    parts = [t.lower().split() for t in texts]
    new = set(chain.from_iterable(parts)).difference(_known)
    if new and len(_known) + len(new) > 400_000:
        _known.clear()
        new = set(chain.from_iterable(parts))
    for w in new:
        bare = bare_word(w)
        _known[w] = _hash(bare) if bare else _NONE
    known = _known.__getitem__
    sets = [sorted(set(map(known, p))) for p in parts]
    for i, own in enumerate(sets):
        if not own or own[-1] == _NONE:  # the greatest of all
            own[-1:] = []
            if not own:
                own.append(_hash("\0" + texts[i]))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, sets), np.int64, len(sets)), out=starts[1:])
    return np.fromiter(chain.from_iterable(sets), np.int32, int(starts[-1])), starts


def hashed_words(text: str) -> list[int]:
    """The sorted distinct word hashes of a text, as in hashed_sets."""
    return hashed_sets([text])[0].tolist()


def word_set(c, same_form: bool = False) -> Column:
    """hashed_words as array<int>, null for null; with same_form of the text's form in problem 6."""
    looks = look_alikes(SparkSession.getActiveSession()) if same_form else None

    @F.arrow_udf(ArrayType(IntegerType()))
    def sets(texts: pa.Array) -> pa.Array:
        given = texts.to_pylist()
        known = [t for t in given if t is not None]
        values, starts = hashed_sets([looks.form(t) for t in known] if looks else known)
        offsets = starts.astype(np.int32)
        if len(known) == len(given):
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        here = np.array([t is not None for t in given])
        at = np.concatenate([[0], np.cumsum(here)])
        return pa.ListArray.from_arrays(pa.array(offsets[at], mask=np.append(~here, False)), pa.array(values))

    return sets(F.col(c) if isinstance(c, str) else c)


def set_id(words_column: str) -> Column:
    return F.xxhash64(F.size(words_column), F.col(words_column))


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two word sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def most_difference(size_a: Column, size_b: Column, threshold: float) -> Column:
    """How many words may be in one of two sets only if their similarity is to reach the threshold; the epsilon is for rounding."""
    return (size_a + size_b) * ((1 - threshold) / (1 + threshold)) + 1e-9


def parity_bits(words_column: str, shift: int = 0) -> Column:
    """64 bits: whether the count of words with that number modulo 64 is odd. Two sets differ in at least as many words as bits."""
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(w, shift).bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(words_column, F.lit(0).cast("long"), lambda acc, w: acc.bitwiseXOR(bit(w)))
