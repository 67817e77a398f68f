"""Problem 2: groups of records that share most of their words, over a collection too large for pairwise comparison.

DartMinHash: every word's region (its weight high, time wide) is hit by hashed darts; each dart falls on one of the k coordinates,
and a text's signature keeps, per coordinate, the earliest dart in the regions of its words. Two signatures agree on a coordinate
with the weighted Jaccard similarity of the texts. Rare words weigh 1, words of a large part of all texts less, so that the bands of
a signature seldom join texts that only share common words. Bands meet in a sort-merge join; pairs of one band that differ in too
many of 64 parity bits can't reach the threshold and end in the join; the others are compared exactly, as sets of words.

Weights and threshold don't agree, and bands meet by chance, so an exact route follows: two sets that reach the threshold share one of
the first words of each, rarest first (prefix_rows); those buckets' pairs pass the same filter and comparison. As it misses none, bands
may get longer with the collection (band_shape), which keeps the pairs that meet in them by chance in proportion to it.

Equal word sets are one node from the start. A band shared by more than `hot` nodes, or a bucket of more than `crowd` in most of which
each resembles many others (thousands of different texts that resemble each other), isn't expanded into all its pairs: each node meets the band's first node, then only nodes of components other than the band's
largest meet the rest. That finds every group all its pairs would.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolam.llm.components import connected_components
from kolam.llm.wordsets import most_difference, set_id, similarity
from kolam.scratch import Scratch

_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


#: Words fall into so many classes by hash; of each class's count the parity is kept, 64 of them in bits, the others in mark, below
#: the flag of a row that only meets rows of smaller sets, and the size.
CLASSES = 103
LOW = (1 << (CLASSES - 64)) - 1
LARGER = 1 << (CLASSES - 64)
SIZE_AT = CLASSES - 64 + 1
MOST_SIZE = (1 << 23) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x + _G).astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def dart_signatures(tokens: np.ndarray, starts: np.ndarray, weights: np.ndarray, k: int, seed: int = 0, rate: float = 0.5) -> np.ndarray:
    """The k-coordinate signatures of weighted sets, as uint64 of shape (sets, k).

    tokens: element hashes of all sets, one after another; starts: where each set begins, and the end; weights: of each token, above
    0. rate: darts thrown into a unit of weight in the first stretch of time; each next stretch is as long as all before, so a
    heavy set is done after few darts. A dart depends on its element, the unit of weight and its number only, so equal elements
    throw equal darts in every set. A set takes further stretches until each coordinate is hit. A set without tokens keeps the
    greatest value everywhere.
    """
    n = len(starts) - 1
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * k, none, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(starts))
    element, place = np.unique(tokens, return_inverse=True)
    top, low = np.zeros(len(element)), np.full(len(element), np.inf)
    np.maximum.at(top, place, weights)
    np.minimum.at(low, place, weights)
    fixed = bool((top == low).all())  # each element has one weight: its darts are sorted out once, not for each set
    length, layer = 1.0, 0
    active = np.diff(starts) > 0
    with np.errstate(over="ignore"):
        while active.any():
            use = np.flatnonzero(active[owner])
            used = np.flatnonzero(np.bincount(place[use], minlength=len(element)))
            cells = np.ceil(top[used]).astype(np.int64)
            cell_of = np.repeat(used, cells)
            cell_no = np.arange(len(cell_of)) - np.repeat(np.cumsum(cells) - cells, cells)
            base = _mix(element[cell_of].astype(np.int64).view(np.uint64) ^ _mix((np.uint64(seed) << np.uint64(40)) + (np.uint64(layer) << np.uint64(32)) + cell_no.astype(np.uint64)))
            mean = rate * length
            thrown = np.searchsorted(_poisson(mean), _unit(_mix(base ^ _G)), side="right")
            dart_cell = np.repeat(np.arange(len(cell_of), dtype=np.int32), thrown)
            number = np.arange(len(dart_cell)) - np.repeat(np.cumsum(thrown) - thrown, thrown)
            h = _mix(base[dart_cell] + number.astype(np.uint64) * _M1)
            height = cell_no[dart_cell] + _unit(_mix(h ^ _M1))
            if fixed:
                hit = height < top[cell_of][dart_cell]
                h, dart_cell = h[hit], dart_cell[hit]
            rank = (np.uint64(layer) << np.uint64(58)) | (_mix(h ^ _M2) >> np.uint64(6))  # stretch, then time in it
            coordinate = (h % np.uint64(k)).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(np.bincount(cell_of[dart_cell], minlength=len(element)))])
            count = (first[1:] - first[:-1])[place[use]]
            dart = np.arange(count.sum()) + np.repeat(first[place[use]] - (np.cumsum(count) - count), count)
            at = np.repeat(owner[use] * k, count) + coordinate[dart]
            rank = rank[dart]
            if not fixed:
                inside = height[dart] < np.repeat(weights[use], count)
                at, rank = at[inside], rank[inside]
            np.minimum.at(out, at, rank)
            active &= (out.reshape(n, k) == none).any(axis=1)
            length, layer = length * (2 if layer else 1), layer + 1
            if layer > 40:
                break  # weights too small to be hit: what is empty stays so in equal sets too
    return out.reshape(n, k)


_cdf: dict[float, np.ndarray] = {}


def _poisson(mean: float) -> np.ndarray:
    if mean not in _cdf:
        most = int(mean + 12 * np.sqrt(mean) + 20)
        logs = np.arange(1, most + 1)
        _cdf[mean] = np.cumsum(np.exp(np.concatenate([[0.0], np.cumsum(np.log(mean) - np.log(logs))]) - mean))
    return _cdf[mean]


def common_word_weights(nodes: DataFrame, common_from: float = 0.001, light: float = 0.03, rare: float = 1 / 30, most: int = 1_000_000, crowd: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted word hashes, weights, numbers of sets) of the words in more than common_from of all sets, or in more than crowd of
    them where that is fewer, counted over every set.

    A set has l words on average, so at most l / common_from words can be that common without crowd, however large the input; of more than `most`
    the commonest are taken, which bounds what is sent to all tasks and changes no result, as only the order of words and the bands'
    luck depend on it. The weight falls from 1 at a share of `rare` with the logarithm of the share, down to `light`. All other words weigh 1.
    """
    n = nodes.count()
    over = common_from * n if crowd is None else min(common_from * n, crowd)
    counts = nodes.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > over)
    rows = counts.orderBy(F.desc("n"), "w").limit(most).toPandas().sort_values("w")
    weight = np.clip(np.log(np.maximum(n, 1) / np.maximum(rows["n"].to_numpy(float), 1)) / np.log(1 / rare), light, 1.0)
    return rows["w"].to_numpy(np.int64), weight, rows["n"].to_numpy(np.int64)


def _pieces(batches, words_at_once: int = 80_000):
    """(ids, words one after another, where each set begins and the end), some ten thousand words at a time, so that memory doesn't depend on the batch."""
    for b in batches:
        arr = b.column("words")
        every = arr.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(np.asarray(arr.value_lengths().fill_null(0)))])
        ids = b.column("id")
        i = 0
        while i < len(ends) - 1:
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + words_at_once, side="right")) - 1)
            yield ids.slice(i, j - i), every[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
            i = j


def _parities(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, mark) of each set, for _passes."""
    full, size = np.diff(starts) > 0, np.diff(starts)
    bits, rest = np.zeros(len(full), np.uint64), np.zeros(len(full), np.uint64)
    if full.any():
        kind = (tokens.astype(np.int64) % CLASSES).astype(np.uint64)
        one = np.uint64(1)
        low = np.where(kind < 64, one << np.minimum(kind, np.uint64(63)), np.uint64(0))
        high = np.where(kind >= 64, one << (np.maximum(kind, np.uint64(64)) - np.uint64(64)), np.uint64(0))
        bits[full] = np.bitwise_xor.reduceat(low, starts[:-1][full])
        rest[full] = np.bitwise_xor.reduceat(high, starts[:-1][full])
    mark = (np.minimum(size, MOST_SIZE).astype(np.uint64) << np.uint64(SIZE_AT)) | rest
    return bits.view(np.int64), mark.view(np.int64)


def _weights(tokens: np.ndarray, hashes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.ones(len(tokens))
    at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
    return np.where(hashes[at] == tokens, weight[at], 1.0)


def _band_keys(sig: np.ndarray, rows_per_band: int, bands: int, seed: int) -> np.ndarray:
    """The key of each set's each band; bands are consecutive coordinates."""
    sig = sig[:, : bands * rows_per_band].reshape(-1, bands, rows_per_band)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(seed << 20), sig.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for i in range(rows_per_band):
            key = _mix(key ^ (sig[:, :, i] * _M2))
    return key


def band_shape(some: DataFrame, n: int, common: tuple[np.ndarray, np.ndarray], rows_per_band: int, bands: int, partners: float = 10, most: int = 8, seed: int = 0) -> tuple[int, int]:
    """(rows of a band, bands) for n sets, of which some are a random part: the coordinates of rows_per_band x bands, cut into longer
    bands where a set would meet more than `partners` others in a band.

    Sets that only share common words meet in a band by chance, at a rate that falls with each row of it; at one rate, pairs grow with
    the square of n. The rate is measured on 8,000 sets. prefix_rows has the pairs that longer bands miss.
    """
    import pyarrow as pa

    shared = some.sparkSession.sparkContext.broadcast(common)
    k = rows_per_band * bands

    def part(batches):
        got, words = [np.zeros((0, k), np.uint64)], 0
        for _, tokens, starts in _pieces(batches):
            if words < 1_000_000:
                got.append(dart_signatures(tokens, starts, _weights(tokens, *shared.value), k, seed))
            words += len(tokens)
        sig = np.concatenate(got)
        for r in range(rows_per_band, max(rows_per_band, most) + 1):
            met = np.unique(_band_keys(sig, r, b := max(1, k // r), seed), return_counts=True)[1].astype(float) if r <= k else np.zeros(0)
            share = (met * (met - 1)).sum() / max(1, b * len(sig) * (len(sig) - 1))
            yield pa.RecordBatch.from_pydict({"r": pa.array([r]), "share": pa.array([share])})

    rates = some.select("id", "words").limit(8000).mapInArrow(part, "r long, share double").groupBy("r").agg(F.max("share")).orderBy("r").collect()
    r = next((r for r, share in rates if share * n <= partners), max([rows_per_band, *(r for r, _ in rates if r <= k)]))
    return r, max(1, k // r)


def band_rows(nodes: DataFrame, common: tuple[np.ndarray, np.ndarray], rows_per_band: int, bands: int, seed: int = 0) -> DataFrame:
    """(band, id, bits, mark), one row for each node and band. nodes: (id long, words array<int>)."""
    shared = nodes.sparkSession.sparkContext.broadcast(common)
    k = rows_per_band * bands

    def part(batches):
        hashes, weight = shared.value
        for p in _pieces(batches):
            yield piece(*p, hashes, weight)

    def piece(ids, tokens, starts, hashes, weight):
        import pyarrow as pa

        key = _band_keys(dart_signatures(tokens, starts, _weights(tokens, hashes, weight), k, seed), rows_per_band, bands, seed)
        bits, mark = _parities(tokens, starts)
        return pa.RecordBatch.from_pydict({
            "id": ids, "bits": pa.array(bits), "mark": pa.array(mark),
            "keys": pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * bands), pa.array(key.view(np.int64).ravel())),
        })

    made = nodes.select("id", "words").mapInArrow(part, "id long, bits long, mark long, keys array<long>")
    return made.select(F.explode("keys").alias("band"), "id", "bits", "mark")


def prefix_rows(nodes: DataFrame, common: tuple[np.ndarray, np.ndarray], threshold: float, crowd: int = 1000, depth: int = 3, most: int = 1_000_000) -> DataFrame:
    """prefix_parts in one table."""
    return prefix_parts(nodes, common, threshold, crowd, depth, most)[0][0]


def prefix_parts(nodes: DataFrame, common: tuple[np.ndarray, np.ndarray], threshold: float, crowd: int = 1000, depth: int = 3, most: int = 1_000_000, some: DataFrame | None = None, share: int = 1, at_once: int | None = None) -> tuple[list[DataFrame], int]:
    """Tables (band, id, bits, mark) and about how many rows all have: buckets of which every two sets that reach the threshold share
    at least one. With at_once there are as many tables, each of its own buckets, as keep a table near that many rows, up to 16, else one.

    common: (sorted hashes, numbers of sets) of the common words; the order is the rare words first, then these by number. A set of
    n words shares at least o = threshold * n with any such other, so the d-th word they share is among its first n - o + d. A bucket
    is a shared first word; those of more than crowd sets are parted by the second shared word too, then by the third. Sets that may
    share no further word (o < d) meet in a bucket of their own. An id may be of any type. Per depth, the keys of the `most` largest crowded buckets are sent to
    all tasks; other crowded ones aren't parted further. Buckets are counted in some, which has one of share sets: which ones are
    parted changes no result, as long as they are the same for all sets.

    The smaller of two sets that reach the threshold shares even 2 t / (1 + t) of its words, so it has the d-th among fewer first ones.
    Rows beyond those have LARGER in mark: they need only meet rows without it, of sets no larger than theirs.
    """
    import pyarrow as pa

    some = nodes if some is None else some

    sc = nodes.sparkSession.sparkContext
    place_of = np.empty(len(common[0]), np.int64)
    place_of[np.lexsort(common)] = np.arange(1, len(common[0]) + 1)  # by number, then hash
    shared = sc.broadcast((common[0], place_of))
    all_known = len(common[1]) > 0 and len(common[1]) < most and int(common[1].min()) <= crowd  # then no other word fills a bucket

    def within(sorted_, x):
        if not len(sorted_):
            return np.zeros(len(x), bool)
        return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x

    def rows_of(tokens, starts, crowded, only_common=False):
        """The (set, key, whether of the larger one only) of the buckets that end before the last depth, and of those of the last."""
        hashes, places = shared.value
        size = np.diff(starts)
        owner = np.repeat(np.arange(len(size)), size)
        often = np.zeros(len(tokens), np.int64)
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
            often = np.where(hashes[at] == tokens, places[at], 0)
        order = np.argsort((owner << 21) | often, kind="stable")  # a set's words come sorted by hash
        word = tokens[order].view(np.uint64)
        least = np.maximum(np.ceil(threshold * size - 1e-6), 1).astype(np.int64)
        smaller = np.where(size < MOST_SIZE, size - np.maximum(np.ceil(2 * threshold / (1 + threshold) * size - 1e-6), 1), MOST_SIZE * 1e3)
        place = np.arange(len(word)) - starts[owner]
        use = place <= (size - least)[owner]
        if only_common:
            use &= often[order] > 0
        who, place, key = owner[use], place[use], _mix(word[use])
        larger = place > smaller[who]
        done = []
        for d, keys in enumerate(crowded, 1):
            full = within(keys, key)
            done.append((who[~full], key[~full], larger[~full]))
            who, place, key, larger = who[full], place[full], key[full], larger[full]
            stop = least[who] <= d
            done.append((who[stop], _mix(~key[stop]), larger[stop]))
            more = np.maximum(np.minimum(size[who] - 1, size[who] - least[who] + d) - place, 0)
            i = np.repeat(np.arange(len(who)), more)
            place = place[i] + 1 + np.arange(len(i)) - np.repeat(np.cumsum(more) - more, more)
            who, key, larger = who[i], key[i], larger[i]
            larger = larger | (place > smaller[who] + d)
            key = _mix((key * _M2) ^ word[starts[who] + place])
        return done, (who, key, larger)

    def crowds(crowded):
        known = sc.broadcast(crowded)

        def part(batches):
            for _, tokens, starts in _pieces(batches):
                with np.errstate(over="ignore"):
                    key, n = np.unique(rows_of(tokens, starts, known.value, all_known)[1][1], return_counts=True)
                yield pa.RecordBatch.from_pydict({"band": pa.array(key.view(np.int64)), "n": pa.array(n.astype(np.int64))})

        full = some.select("id", "words").mapInArrow(part, "band long, n long").groupBy("band").agg(F.sum("n").alias("n")).where(F.col("n") > crowd / share)
        return np.sort(full.orderBy(F.desc("n"), "band").limit(most).select("band").toPandas()["band"].to_numpy(np.int64).view(np.uint64))

    crowded = []
    while len(crowded) < depth - 1 and len(keys := crowds(crowded)):
        crowded.append(keys)
    known = sc.broadcast(crowded)

    def made(batches):
        for ids, tokens, starts in _pieces(batches):
            with np.errstate(over="ignore"):
                done, last = rows_of(tokens, starts, known.value)
            yield ids, tokens, starts, *(np.concatenate(x) for x in zip(*done, last))

    def count(batches):
        yield pa.RecordBatch.from_pydict({"n": pa.array([sum(len(x[3]) for x in made(batches))], pa.int64())})

    def part(no, parts):
        def rows(batches):
            for ids, tokens, starts, who, key, larger in made(batches):
                if parts > 1:
                    here = key % np.uint64(parts) == no
                    who, key, larger = who[here], key[here], larger[here]
                bits, mark = _parities(tokens, starts)
                mark = mark[who] | np.where(larger, np.int64(LARGER), np.int64(0))
                yield pa.RecordBatch.from_pydict({"band": pa.array(key.view(np.int64)), "id": ids.take(pa.array(who)), "bits": pa.array(bits[who]), "mark": pa.array(mark)})

        return nodes.select("id", "words").mapInArrow(rows, f"band long, id {nodes.schema['id'].dataType.simpleString()}, bits long, mark long")

    if at_once is None:
        return [part(0, 1)], 0
    n = 16 * share * (some.where(F.pmod(F.shiftright(F.xxhash64("words"), 32), F.lit(16)) == 0).select("id", "words").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0)
    parts = min(16, max(1, -(-n // max(1, at_once))))  # each part goes through all sets again
    return [part(no, parts) for no in range(parts)], n


def _passes(bits_x, bits_y, most_x, most_y, mark_x, mark_y) -> np.ndarray:
    """The places of the pairs that may reach the threshold; the second half of the bits is only looked at where the first passes."""
    odd = np.bitwise_count(bits_x ^ bits_y)
    at = np.flatnonzero(odd <= most_x + most_y)
    sure = odd[at] + np.bitwise_count((mark_x[at] ^ mark_y[at]) & LOW) <= most_x[at] + most_y[at]
    return at[sure]


def _passes_between(bits_x, bits_y, most_x, most_y, mark_x, mark_y) -> tuple[np.ndarray, np.ndarray]:
    """The same for all of x with all of y: (places in x, places in y)."""
    odd = np.bitwise_count(bits_x[:, None] ^ bits_y[None])
    at = np.flatnonzero(odd <= most_x[:, None] + most_y[None])
    i, j = np.divmod(at, len(bits_y))
    sure = odd.ravel()[at] + np.bitwise_count((mark_x[i] ^ mark_y[j]) & LOW) <= most_x[i] + most_y[j]
    return i[sure], j[sure]


def _most(mark: np.ndarray, threshold: float) -> np.ndarray:
    """Half of what two sets may differ in, as each one's size has it; without limit where the size isn't known exactly."""
    size = mark >> SIZE_AT
    return np.where(size >= MOST_SIZE, np.inf, size * ((1 - threshold) / (1 + threshold)) + 1e-3).astype(np.float32)


def band_pairs(rows: DataFrame, threshold: float, hot: int, tasks: int | None = None, crowd: int | None = None) -> DataFrame:
    """(a, b) of the pairs of a band that may reach the threshold, a < b, and, with null a and b, the rows of hot bands: those of more
    than hot rows, and of more than crowd if these have more than crowd / 10 possible partners each, by a trial of 64.

    One shuffle by band, into so many tasks; a task then passes through its sorted rows once and holds no more than a batch and hot rows.
    """
    at_once = 60_000

    def part(batches):
        import pyarrow as pa

        names = ("band", "id", "bits", "mark")

        def pairs(cols):
            band, id_, bits, mark = cols
            if not len(band):
                return
            bits = bits.view(np.uint64)  # of signed numbers bitwise_count would count the absolute value's bits
            most = _most(mark, threshold)
            n = run_lengths(band)
            at = np.flatnonzero(n <= 48)
            for d in range(1, 49):
                at = at[: np.searchsorted(at, len(band) - d)]
                at = at[band[at] == band[at + d]]
                if not len(at):
                    break
                ok = at[_passes(bits[at], bits[at + d], most[at], most[at + d], mark[at], mark[at + d])]
                if len(ok):
                    yield id_[ok], id_[ok + d]
            begin = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
            for first in begin[n[begin] > 48]:
                at = first + np.argsort(mark[first : first + n[first]] >> SIZE_AT, kind="stable")  # the smaller of two comes first
                low = np.flatnonzero(mark[at] & LARGER == 0)
                for r in range(0, len(low), step := max(1, 200_000 // len(at))):
                    x, y = at[low[r : r + step]], at[low[r] :]
                    i, j = _passes_between(bits[x], bits[y], most[x], most[y], mark[x], mark[y])
                    ok = low[r + i] < low[r] + j
                    if ok.any():
                        yield id_[x[i[ok]]], id_[y[j[ok]]]

        def batch(a, b, cols=None):
            n = len(a) if cols is None else len(cols[0])
            none = pa.nulls(n, pa.int64())
            got = [none] * 4 if cols is None else [pa.array(c) for c in cols]
            return pa.RecordBatch.from_arrays([pa.array(a) if cols is None else none, pa.array(b) if cols is None else none, *got], names=["a", "b", *names])

        def given(cols):
            n = run_lengths(cols[0])
            much = (n > hot) | alike(cols, n)
            yield from (batch(np.minimum(*p), np.maximum(*p)) for p in settled([c[~much & (n > 1)] for c in cols], pairs))
            if much.any():
                yield batch(None, None, [c[much] for c in cols])

        held, hot_band = [np.zeros(0, np.int64)] * 4, None
        for b in batches:
            cols = [np.concatenate([h, b.column(n).to_numpy(zero_copy_only=False)]) for h, n in zip(held, names)]
            if not len(cols[0]):
                continue
            band = cols[0]
            last = int(np.searchsorted(band, band[-1]))  # the last band may go on in the next batch
            if hot_band is not None:
                upto = int(np.searchsorted(band, hot_band, side="right"))
                if upto:
                    yield batch(None, None, [c[:upto] for c in cols])
                hot_band = hot_band if upto == len(band) else None
                cols, last = [c[upto:] for c in cols], last - upto
            if last < at_once and len(cols[0]) - last <= hot and hot_band is None:  # wait for more rows
                held = cols
                continue
            yield from given([c[: max(0, last)] for c in cols])
            held = [c[max(0, last) :] for c in cols]
            if len(held[0]) > hot:
                hot_band = held[0][0]
                yield batch(None, None, held)
                held = [h[:0] for h in held]
        yield from given(held)  # what was held back may have whole hot bands

    def run_lengths(band):
        """For each row of a sorted column, how many rows have its value."""
        starts = np.concatenate([[0], np.flatnonzero(band[1:] != band[:-1]) + 1])
        n = np.diff(np.concatenate([starts, [len(band)]]))
        return np.repeat(n, n)

    def alike(cols, n):
        """Whether a row is of a band of more than crowd rows, up to hot, most of which resemble many others."""
        out = np.zeros(len(n), bool)
        if crowd is not None:
            band, _, bits, mark = cols
            bits, most = bits.view(np.uint64), _most(mark, threshold)
            for r in np.flatnonzero((n > crowd) & (n <= hot) & np.concatenate([[True], band[1:] != band[:-1]])[: len(n)]):
                y = slice(r, r + n[r])
                x = np.unique(np.linspace(r, r + n[r] - 1, 64).astype(np.int64))
                out[y] = len(_passes_between(bits[x], bits[y], most[x], most[y], mark[x], mark[y])[0]) > len(x) * (1 + crowd / 10)
        return out

    def settled(cols, pairs):
        """Pairs of bands that aren't hot, some thousands at once."""
        got, waiting = [], 0
        for p in pairs(cols):
            got.append(p)
            waiting += len(p[0])
            if waiting >= 20_000:
                yield tuple(map(np.concatenate, zip(*got)))
                got, waiting = [], 0
        if got:
            yield tuple(map(np.concatenate, zip(*got)))

    parted = rows.repartition("band") if tasks is None else rows.repartition(tasks, "band")
    return parted.sortWithinPartitions("band").mapInArrow(part, "a long, b long, band long, id long, bits long, mark long")


def near_duplicate_groups(texts: DataFrame, threshold: float = 0.6, rows_per_band: int = 3, bands: int = 30, hot: int = 20_000, box: Scratch | None = None, crowd: int = 1000, rows_per_task: int = 4_000_000) -> DataFrame:
    """One row per text: all columns of texts but words, and group. Texts are in one group if their word sets reach the threshold,
    or if other texts link them; a text alone is a group of its own.

    texts: needs a column words (word_set); rows with null words take no part and give no row, repeated rows stay; a column named group is replaced. A group's number
    is the least of its sets' ids, so equal inputs give equal numbers. No texts give no rows. Bands find most links, and those of
    thousands of texts that resemble each other; prefix_rows has the pairs they miss, so that no pair at the threshold stays apart.
    The rows_per_band x bands coordinates are cut into longer bands where the collection is so large that chance would fill them
    (band_shape).
    The shuffles by band have the session's number of partitions, or a task for each rows_per_task rows where that is more, so that
    no task's share grows with the input.
    """
    spark = texts.sparkSession
    own = box is None
    box = box or Scratch(spark, "neardup")
    docs = box.save(texts.where(F.col("words").isNotNull()).withColumn("_id", set_id("words")), "texts")
    nodes = box.save(docs.groupBy("_id").agg(F.first("words").alias("words")).select(F.col("_id").alias("id"), "words"), "nodes")
    links = box.save(_links(nodes, threshold, rows_per_band, bands, hot, box, crowd, rows_per_task), "links")
    comp = connected_components(links, "a", "b", box=box)
    if own:
        box.keep_only(docs, comp)
    named = comp.select(F.col("vertex").alias("_id"), F.col("component").alias("_component"))
    return docs.drop("words").join(named, "_id", "left").withColumn("group", F.coalesce("_component", "_id")).drop("_id", "_component")


def _verified(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The distinct pairs (a, b) of node ids whose sets reach the threshold."""
    left, right = nodes.select(F.col("id").alias("a"), F.col("words").alias("wa")), nodes.select(F.col("id").alias("b"), F.col("words").alias("wb"))
    return pairs.select("a", "b").distinct().join(left, "a").join(right, "b").where(similarity(F.col("wa"), F.col("wb")) >= threshold - 1e-12).select("a", "b")


def _may_reach(x: str, y: str, threshold: float):
    odd = F.bit_count(F.col(f"{x}.bits").bitwiseXOR(F.col(f"{y}.bits"))) + F.bit_count(F.col(f"{x}.mark").bitwiseXOR(F.col(f"{y}.mark")).bitwiseAND(F.lit(LOW)))
    size = lambda t: F.shiftright(f"{t}.mark", SIZE_AT)
    return (odd <= most_difference(size(x), size(y), threshold)) | (F.greatest(size(x), size(y)) >= MOST_SIZE)


def _links(nodes: DataFrame, threshold: float, rows_per_band: int, bands: int, hot: int, box: Scratch, crowd: int, rows_per_task: int) -> DataFrame:
    hashes, weights, numbers = common_word_weights(nodes, crowd=crowd)
    n, words = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    share = max(1, min(-(-n // 200_000), crowd // 16))
    some = nodes if share == 1 else box.save(nodes.where(F.pmod(F.xxhash64("words"), F.lit(share)) == 0), "some")
    least = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = lambda n: max(least, -(-n // rows_per_task))
    rows_per_band, bands = band_shape(some, n, (hashes, weights), rows_per_band, bands)
    rows = band_rows(nodes, (hashes, weights), rows_per_band, bands)
    links = _links_of([box.save(band_pairs(rows, threshold, hot, tasks(n * bands)), "candidates")], None, nodes, threshold, box)
    parts, made = prefix_parts(nodes, (hashes, numbers), threshold, crowd, some=some, share=share, at_once=words)  # one after another, so that a shuffle has about a row a word
    found = [box.save(band_pairs(rows, threshold, max(hot, crowd), tasks(-(-made // len(parts))), crowd), "candidates") for rows in parts]
    return _links_of(found, links, nodes, threshold, box)


def _links_of(tables: list[DataFrame], known: DataFrame | None, nodes: DataFrame, threshold: float, box: Scratch) -> DataFrame:
    """The links among the sets of each band, by the tables of band_pairs, which are dropped, and the known ones; of hot bands as many as join the same sets."""
    found = reduce(DataFrame.unionByName, tables)
    pairs = found.where(F.col("a").isNotNull()).select("a", "b")
    if known is not None:
        pairs = pairs.distinct().join(known, ["a", "b"], "left_anti")
    links = box.save(_verified(pairs, nodes, threshold), "pairs")
    if known is not None:
        links = links.unionByName(known)
    many = found.where(F.col("id").isNotNull()).select("id", "band", "bits", "mark")
    if many.isEmpty():
        box.drop(*tables)
        return links
    links = box.save(links.unionByName(_hot_links(many, nodes, links, threshold, box)).distinct(), "links")
    box.drop(*tables)
    return links


def _hot_links(many: DataFrame, nodes: DataFrame, links: DataFrame, threshold: float, box: Scratch, block: int = 8000) -> DataFrame:
    first = many.groupBy("band").agg(F.min_by(F.struct("id", "bits", "mark"), "id").alias("h")).select("band", "h.*")
    x, y = many.alias("x"), first.alias("y")
    star = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.id") != F.col("y.id")) & _may_reach("x", "y", threshold)).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    star = box.save(_verified(star, nodes, threshold), "star")
    comp = connected_components(links.unionByName(star), "a", "b", box=box).select(F.col("vertex").alias("id"), "component")
    labelled = box.save(many.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id")), "labelled")
    largest = labelled.groupBy("band", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("band").agg(F.max_by("component", F.struct("m", "component")).alias("main"))
    labelled = labelled.join(largest, "band").withColumn("other", F.col("component") != F.col("main"))
    sizes = labelled.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("all_blocks"), F.ceil(F.count_if("other") / block).cast("int").alias("other_blocks")).where(F.col("other_blocks") > 0)
    placed = labelled.join(sizes, "band").select("band", "id", "bits", "mark", "component", "other", "all_blocks", "other_blocks")
    at = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = placed.where("other").select("*", at(F.col("other_blocks")).alias("i"), F.lit(True).alias("left")).withColumn("j", each("all_blocks"))
    y = placed.select("*", at(F.col("all_blocks")).alias("j"), F.lit(False).alias("left")).withColumn("i", each("other_blocks"))
    cols = ["band", "i", "j", "left", "id", "bits", "mark", "component"]

    def cross(p):
        x, y = p[p["left"]], p[~p["left"]]
        out = []
        if len(x) and len(y):
            ids, bits, mark, comp = (np.ascontiguousarray(y[c].to_numpy()) for c in ("id", "bits", "mark", "component"))
            bits, most = bits.view(np.uint64), _most(mark, threshold)
            for k in range(0, len(x), step := max(1, 200_000 // len(y))):
                q = x.iloc[k : k + step]
                m = q["mark"].to_numpy()
                i, j = _passes_between(np.ascontiguousarray(q["bits"].to_numpy()).view(np.uint64), bits, _most(m, threshold), most, m, mark)
                ok = q["component"].to_numpy()[i] != comp[j]
                out.append(np.stack([q["id"].to_numpy()[i[ok]], ids[j[ok]]]))
        both = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return pd.DataFrame({"a": both.min(axis=0), "b": both.max(axis=0)}) if both.size else pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})

    pairs = x.select(*cols).unionByName(y.select(*cols)).groupBy("band", "i", "j").applyInPandas(cross, "a long, b long")
    return star.unionByName(_verified(box.save(pairs.distinct(), "cross"), nodes, threshold))
