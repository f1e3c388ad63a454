"""Exact Jaccard join of word-shingle sets as a metric-space join.

The metric is the symmetric difference of two sets, D(x, y) = |x| + |y| - 2|x n y|. A similarity of
at least 0.8 is D(x, y) <= (|x| + |y|) / 9, and implies that the sizes differ by a factor of 1.25 at most
(the triangle inequality with the empty set as pivot).

1. Equal sets collapse to a class (hash of the whole set), whose first row represents it.
2. Regions. Shingles are ordered (very common ones last, then by hash), and a region is made of the sets
   that hold its shingle. Cut at a shingle, the sets keep D(x', y') <= D(x, y), so linked sets have their first
   common shingle within the first ``|x| - ceil(0.8 |x|) + 1`` of each: a set is replicated to the regions
   of that window alone. Regions with one class only are dropped before anything else is moved.
3. Pivots. Within a region each set meets a few pivots of its size window; exact links to pivots give
   components, and pairs inside a component need no more work. So a large group of near copies costs a
   number of pairs that is linear in its size.
4. The rest of each region, as far as a set has one of another component in its size window, is joined recursively: pivots create Voronoi cells, sets within the window
   ``D(x, p) - D(x, home) <= 2 eps`` are replicated to cell p, cells recurse. Distances here are Hamming distances of
   parity sketches, a metric that never exceeds D, so nothing is lost. Regions beyond
   ``BLOCK`` classes are dealt out as pairs of blocks.
5. Surviving pairs are verified on the exact sets: first a few partners of each set, which join most of what belongs
   together, then, with the components that gives, all pairs that are still between two components.

Nulls, empty texts and texts without words have an empty set and link with nothing (their own doc_id is
the component). Fewer than five words make one shingle. Repeated rows give repeated result rows. Columns
other than doc_id and text are ignored. A null doc_id counts as the largest id of its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import components, keep, release, setup
from tarmac.llm.words import SHINGLE, mix, shingle_set, windows, words_of

COMMON_BITS = 20  # at most 2**20 shingles can be common, 8 MB
COMMON_LEAST = 64
BLOCK = 2048
LEAF = 64
DENSE = 32  # classes from which on a region carries what precedes its shingle
TRIES = 4  # pivots that each set meets
PIVOTS = 12
TOGETHER = 1 << 17  # words of texts whose sets are made together
PARTNERS = 4  # candidates of each set that are verified before the rest
_U = np.uint64


def _flat_sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sets of some texts at a time, one after the other, and where each begins."""
    words = words_of(texts)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(words.ptr, words.ptr[a] + TOGETHER, side="right")) - 1)
        own = words.ptr[a : b + 1]
        n = np.diff(own)
        if b == a + 1 or (n < SHINGLE).all():
            sets = [shingle_set(words.hashes[words.of(i)], SHINGLE) for i in range(a, b)]
            yield np.concatenate(sets), np.cumsum([0, *map(len, sets)])
        else:
            hashes = words.hashes[own[0] : own[-1]]
            text = np.repeat(np.arange(b - a), n)
            at = np.flatnonzero(np.arange(len(hashes)) + SHINGLE <= (own[1:] - own[0])[text])
            flat, text = windows(hashes, list(range(SHINGLE)))[at], text[at]
            short = np.flatnonzero((n > 0) & (n < SHINGLE))
            if len(short):
                flat = np.concatenate([flat, *(shingle_set(words.hashes[words.of(a + i)], SHINGLE) for i in short)])
                text = np.append(text, short)
            order = np.lexsort((flat, text))
            flat, text = flat[order], text[order]
            once = np.append(True, (flat[1:] != flat[:-1]) | (text[1:] != text[:-1]))
            yield flat[once], np.searchsorted(text[once], np.arange(b - a + 1))
        a = b


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for flat, ptr in _flat_sets(texts):
        for a, b in zip(ptr[:-1], ptr[1:], strict=True):
            yield flat[a:b]


def _fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of the whole set."""
    if len(shingles) == 0:
        return 0, 0
    a = int(mix(shingles).sum(dtype=_U)) & (2**64 - 1)
    b = int((mix(shingles ^ _U(0xA5A5A5A5A5A5A5A5)) * _U(0x9E3779B97F4A7C15)).sum(dtype=_U))
    return (a ^ len(shingles)) - 2**63, (b & (2**64 - 1)) - 2**63


def _fingerprints(flat: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_fingerprint``, of many sets."""
    n = np.diff(ptr)
    some = n > 0
    keys = np.zeros((2, len(n)), np.int64)
    if some.any():
        at = ptr[:-1][some]
        a = np.add.reduceat(mix(flat), at) ^ n[some].astype(_U)
        b = np.add.reduceat(mix(flat ^ _U(0xA5A5A5A5A5A5A5A5)) * _U(0x9E3779B97F4A7C15), at)
        keys[:, some] = (np.stack([a, b]) ^ _U(2**63)).view(np.int64)
    return keys[0], keys[1]


def sketch_bits(n: int) -> int:
    return max(64, 2 << max(0, int(n - 1)).bit_length())


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Parities of the counts of shingles per bin; bins are leading bits, so halves fold by xor."""
    bits = sketch_bits(len(shingles))
    bins = mix(shingles ^ _U(0x5BD1E995)) >> _U(64 - (bits.bit_length() - 1))
    odd = np.bincount(bins.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _parity_sketches(flat: np.ndarray, ptr: np.ndarray) -> list[bytes]:
    """As ``parity_sketch``, of many sets."""
    n = np.diff(ptr)
    power = np.maximum(6, 1 + np.frexp(np.maximum(n - 1, 0))[1])
    ends = np.append(0, np.cumsum(1 << power.astype(np.int64)))
    bins = mix(flat ^ _U(0x5BD1E995)) >> np.repeat(64 - power, n).astype(_U)
    odd = np.bincount(bins.astype(np.int64) + np.repeat(ends[:-1], n), minlength=ends[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[a:b] for a, b in zip((ends[:-1] // 8).tolist(), (ends[1:] // 8).tolist(), strict=True)]


def fold(sketches: np.ndarray) -> np.ndarray:
    """Rows of 64-bit pieces of sketches, folded to half the number of bins (adjacent bins)."""
    x = sketches ^ (sketches >> _U(1))
    for shift, mask in (
        (0, 0x5555555555555555),
        (1, 0x3333333333333333),
        (2, 0x0F0F0F0F0F0F0F0F),
        (4, 0x00FF00FF00FF00FF),
        (8, 0x0000FFFF0000FFFF),
        (16, 0x00000000FFFFFFFF),
    ):
        x = (x | (x >> _U(shift))) & _U(mask)
    return x[:, ::2] | (x[:, 1::2] << _U(32))


def allowance(n: int) -> int:
    return n - -(-4 * n // 5) + 1 if n else 0


def linked(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int):
    return 100 * common >= 80 * (a + b - common)


# ---- passes over the texts -----------------------------------------------------------------


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        distinct = {s.tobytes() for s in _sets(batch.column("text"))}
        if distinct:
            every = np.frombuffer(b"".join(distinct), _U)
            values, counts = np.unique(every, return_counts=True)
            often = counts > 1
            values = np.append(values[often], _U(0))  # 0: how many shingles there are
            counts = np.append(counts[often], len(every))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["s", "n"]
            )


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted shingles that repeat within batches, at least 2**-20 of all shingles each.

    Any set of shingles gives right results (it only orders the windows), and its size has a fixed bound.
    """
    counts = docs.select("text").mapInArrow(_frequent, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    counts = keep(counts.where(f"n >= {COMMON_LEAST}"))
    total = counts.where("s = 0").head()
    least = max(COMMON_LEAST, (total["n"] if total else 0) >> COMMON_BITS)
    rows = counts.where((F.col("s") != 0) & (F.col("n") >= least)).select("s").toPandas()
    return np.sort(rows["s"].to_numpy(np.int64).view(_U))


def _describe(common: np.ndarray):
    def window(flat: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first shingles of each set as far as its allowance goes, common ones last; and how many."""
        n = np.diff(ptr)
        take = np.where(n > 0, n - -(-4 * n // 5) + 1, 0)
        text = np.repeat(np.arange(len(n)), n)
        if len(common) and len(flat):
            late = common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] == flat
            flat = flat[np.lexsort((late, text))]
        return flat[np.arange(len(flat)) - ptr[text] < take[text]], take

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, k1, k2, anchors, takes = ([np.zeros(0, np.int64)] for _ in range(5))
            sketches: list[bytes] = []
            for flat, ptr in _flat_sets(batch.column("text")):
                sizes.append(np.diff(ptr))
                for keys, found in zip((k1, k2), _fingerprints(flat, ptr), strict=True):
                    keys.append(found)
                sketches += _parity_sketches(flat, ptr)
                first, take = window(flat, ptr)
                anchors.append(first.view(np.int64))
                takes.append(take)
            ptr = np.append(0, np.cumsum(np.concatenate(takes)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(np.concatenate(x), pa.int64()) for x in (sizes, k1, k2)),
                    pa.array(sketches, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(np.concatenate(anchors))),
                ],
                ["doc_id", "n", "k1", "k2", "sketch", "anchors"],
            )

    return run


# ---- joins within regions ------------------------------------------------------------------


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def _by_region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole regions of a partition sorted by region, several at a time."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("s", "block")]
        cut = int(_runs(keys)[-2])  # where the batch's last region starts
        first = tuple(k[0] for k in keys)
        if rest and (cut or first != last):
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)]).combine_chunks()
            rest = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        rest.append(batch.slice(cut))
        last = tuple(k[-1] for k in keys)
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


def _partnered(ends: np.ndarray, n: np.ndarray, rank: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Rows that may be one side of a link first met in their region; rows are sorted by n within regions.

    Such a row has one of another component in its size window, and another whose rank goes with its own:
    in the region of their first common shingle, what precedes it in either set is not in the other.
    """
    if not len(n):
        return np.zeros(0, bool)
    starts, size = ends[:-1], np.diff(ends)
    region = np.repeat(np.arange(len(size)), size)
    late = 9 * rank.astype(np.int64) - n  # of two rows the sum must not exceed 0
    least = np.minimum.reduceat(late, starts)
    at = np.flatnonzero(late == least[region])
    at = at[np.unique(region[at], return_index=True)[1]]
    others = late.copy()
    others[at] = np.iinfo(np.int64).max // 2
    best = least[region]
    best[at] = np.minimum.reduceat(others, starts)
    key = (region << 32) + n
    low = np.searchsorted(key, (region << 32) + -(-4 * n // 5))
    high = np.searchsorted(key, (region << 32) + 5 * n // 4, side="right")
    bounds = _runs([region, comp])
    run = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return (late + best <= 0) & ((low < bounds[run]) | (high > bounds[run + 1]))


def _undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that may be linked with a row of another component in their region."""
    for table in _by_region(batches):
        ends = _runs([table.column(c).to_numpy() for c in ("s", "block")])
        mate = _partnered(ends, *(table.column(c).to_numpy() for c in ("n", "rank", "comp")))
        yield from table.filter(pa.array(mate)).to_batches()


def _nearest_pivots(size: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For sorted sizes: the pivot of each set, taken in order of rank, each serving what is left of its size window."""
    home = np.full(len(size), -1, np.int64)
    for p in np.argsort(rank):
        if home[p] < 0:
            low = np.searchsorted(size, -(-4 * size[p] // 5))
            high = np.searchsorted(size, 5 * size[p] // 4, side="right")
            free = home[low:high] < 0
            home[low:high][free] = p
    return home


def _pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class of a region with pivots of its size window; classes that cannot have a link there are left out."""
    for table in _by_region(batches):
        cls = table.column("cls").to_numpy()
        n = table.column("n").to_numpy()
        ends = _runs([table.column("s").to_numpy(), table.column("block").to_numpy()])
        near = np.empty((TRIES, len(cls)), np.int64)
        size = np.diff(ends)
        two, more = ends[:-1][size == 2], np.flatnonzero(size != 2)
        apart = 5 * n[two] < 4 * n[two + 1]
        for k in range(TRIES):
            rank = mix(cls.view(_U) + _U(k))
            low = two + (rank[two] > rank[two + 1])
            near[k, two] = np.where(apart, two, low)
            near[k, two + 1] = np.where(apart, two + 1, low)
            for a, b in zip(ends[more], ends[more + 1], strict=True):  # sorted by n within a region
                near[k, a:b] = a + _nearest_pivots(n[a:b], rank[a:b])
        mate = _partnered(ends, n, table.column("rank").to_numpy(), cls)
        pivots = cls[near[:, mate]].T
        ptr = np.arange(len(pivots) + 1, dtype=np.int32) * TRIES
        column = pa.ListArray.from_arrays(pa.array(ptr), pa.array(pivots.ravel()))
        yield from table.filter(pa.array(mate)).append_column("pivots", column).to_batches()


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x[:, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)


def _compare(x, y, sketches, n, comp, out) -> None:
    """All pairs of two lists of rows, a few rows at a time (x is y: each pair once)."""
    same = x is y
    step = max(1, (1 << 18) // max(1, len(y) * sketches.shape[1]))
    for i in range(0, len(x), step):
        left = x[i : i + step]
        right = y[i + 1 :] if same else y
        if not len(right):
            continue
        total = n[left][:, None] + n[right][None, :]
        near = 9 * _distances(sketches[left], sketches[right]) <= total
        near &= comp[left][:, None] != comp[right][None, :]
        if same:
            near &= np.arange(len(left))[:, None] <= np.arange(len(right))[None, :]
        a, b = np.nonzero(near)
        out.append((left[a], right[b]))


def voronoi_join(rows: np.ndarray, others: np.ndarray | None, sketches, n, comp, out) -> None:
    """Pairs of rows (or of rows and others) that may be linked and are in different components."""
    every = rows if others is None else np.concatenate([rows, others])
    small = len(every) <= LEAF or (others is not None and min(len(rows), len(others)) <= 8)
    if not small:
        pivots = every[:: max(1, len(every) // PIVOTS)][:PIVOTS]
        d = _distances(sketches[every], sketches[pivots])
        home = d.argmin(axis=1)
        eps = n[every] / 4  # D <= (|x| + |y|) / 9 and |y| <= 1.25 |x|
        within = d - d.min(axis=1)[:, None] <= 2 * eps[:, None]
        if within.sum() > 2 * len(every):  # the cells overlap too much to gain anything
            small = True
    if small:
        _compare(rows, rows if others is None else others, sketches, n, comp, out)
        return
    first = np.arange(len(every)) < len(rows)
    for p in range(len(pivots)):
        inner, outer = home == p, within[:, p] & (home < p)
        if others is None:
            if inner.sum() > 1:
                voronoi_join(every[inner], None, sketches, n, comp, out)
            sides = [(every[inner], every[outer])]
        else:
            sides = [
                (every[inner & first], every[inner & ~first]),
                (every[inner & first], every[outer & ~first]),
                (every[outer & first], every[inner & ~first]),
            ]
        for x, y in sides:
            if len(x) and len(y):
                # a bipartite part that did not shrink is compared directly
                if len(x) + len(y) >= 0.9 * len(every):
                    _compare(x, y, sketches, n, comp, out)
                else:
                    voronoi_join(x, y, sketches, n, comp, out)


def region_pairs(n, comp, sketches: list[bytes], half=None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one region that pass the sketch filter; ``half`` marks the two blocks of a split region."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    width = np.array([len(x) for x in sketches])
    tables = {}
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        tables[w] = (rows, np.frombuffer(b"".join(sketches[i] for i in rows), _U).reshape(len(rows), -1))
    for w, (rows, own) in tables.items():
        parts = [(rows, own, None)]
        if 2 * w in tables:
            more, larger = tables[2 * w]
            parts.append((np.concatenate([rows, more]), np.concatenate([own, fold(larger)]), len(rows)))
        for at, table, split in parts:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            local = np.arange(len(at))
            if split is None:
                voronoi_join(local, None, table, n[at], comp[at], out)
            else:
                voronoi_join(local[:split], local[split:], table, n[at], comp[at], out)
            found += [(at[a], at[b]) for a, b in out]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = np.concatenate([x for x, _ in found])
    b = np.concatenate([y for _, y in found])
    good = (5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b])) & (comp[a] != comp[b])
    if half is not None:
        good &= half[a] != half[b]
    return a[good], b[good]


def _small_pairs(starts, size, n, comp, rank, half, sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As ``region_pairs``, for many regions of a few rows, each row with each: pairs first met in their region."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in np.unique(size):
        i, j = np.triu_indices(k, 1)
        begin = starts[size == k]
        left.append((begin[:, None] + i).ravel())
        right.append((begin[:, None] + j).ravel())
    a, b = np.concatenate(left), np.concatenate(right)
    good = (comp[a] != comp[b]) & (5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b]))
    good &= (9 * (rank[a] + rank[b]) <= n[a] + n[b]) & ((half[a] < 0) | (half[a] != half[b]))
    a, b = a[good], b[good]
    width = np.zeros(len(n), np.int64)
    rows = np.unique(np.concatenate([a, b]))
    width[rows] = [len(sketches[i]) for i in rows]
    a, b = np.where(width[a] <= width[b], (a, b), (b, a))
    near = np.zeros(len(a), bool)
    place = np.zeros(len(n), np.int64)
    tables = {}
    for w in np.unique(width[rows]):
        own = rows[width[rows] == w]
        place[own] = np.arange(len(own))
        tables[w] = np.frombuffer(b"".join(sketches[i] for i in own), _U).reshape(len(own), -1)
    for w, table in tables.items():
        for other in (w, 2 * w):
            at = np.flatnonzero((width[a] == w) & (width[b] == other))
            if len(at):
                second = tables[other][place[b[at]]]
                apart = np.bitwise_count(table[place[a[at]]] ^ (second if other == w else fold(second)))
                near[at] = 9 * apart.sum(axis=1, dtype=np.int64) <= n[a[at]] + n[b[at]]
    return a[near], b[near]


def _few_of_each(x: np.ndarray, y: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of each row the first ``PARTNERS``, in an order that does not depend on the region."""
    both = np.concatenate([x, y])
    order = np.lexsort((np.tile(mix(cls[x].view(_U) + cls[y].view(_U)), 2), both))
    ends = _runs([both[order]])
    place = np.arange(len(both)) - np.repeat(ends[:-1], np.diff(ends))
    few = np.unique(order[place < PARTNERS] % max(1, len(x)))
    return x[few], y[few]


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each region, a few partners of each row: their number is linear in the rows."""
    return _candidates(batches, _few_of_each)


def _rest_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All candidates of each region."""
    return _candidates(batches)


def _candidates(batches: Iterator[pa.RecordBatch], choose=None) -> Iterator[pa.RecordBatch]:
    for table in _by_region(batches):
        cls, n, rank, comp, half = (table.column(c).to_numpy() for c in ("cls", "n", "rank", "comp", "half"))
        sketches = table.column("sketch").to_pylist()
        earlier = table.column("earlier").to_pylist()
        ends = _runs([table.column("s").to_numpy(), table.column("block").to_numpy()])
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        small = np.diff(ends) < DENSE
        x, y = _small_pairs(ends[:-1][small], np.diff(ends)[small], n, comp, rank, half, sketches)
        if choose:
            x, y = choose(x, y, cls)
        left.append(cls[x])
        right.append(cls[y])
        for a, b in zip(ends[:-1][~small], ends[1:][~small], strict=True):
            if (comp[a:b] == comp[a]).all():
                continue
            split = half[a:b] if half[a] >= 0 else None
            x, y = region_pairs(n[a:b], comp[a:b], sketches[a:b], split)
            # In the region of their first common shingle, what precedes it in either is not in the other.
            first = 9 * (rank[a + x] + rank[a + y]) <= n[a + x] + n[a + y]
            x, y = x[first], y[first]
            # Pairs that share an earlier shingle are found in its region.
            before = [set(e or ()) for e in earlier[a:b]]
            own = np.array([before[i].isdisjoint(before[j]) for i, j in zip(x, y, strict=True)], bool)
            x, y = x[own], y[own]
            if choose:
                x, y = choose(x, y, cls[a:b])
            left.append(cls[a + x])
            right.append(cls[a + y])
        x, y = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _sketch_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [batch.column(c).to_numpy() for c in ("na", "nb")]
        good = np.zeros(batch.num_rows, bool)
        sides = [batch.column(c).to_pylist() for c in ("sa", "sb")]
        for i, (x, y) in enumerate(zip(*sides, strict=True)):
            u, v = (np.frombuffer(z, _U).reshape(1, -1) for z in (x, y))
            if u.shape[1] > v.shape[1]:
                u = fold(u)
            elif v.shape[1] > u.shape[1]:
                v = fold(v)
            if u.shape == v.shape:
                good[i] = 9 * int(np.bitwise_count(u ^ v).sum()) <= sizes[0][i] + sizes[1][i]
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _exact_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for flat, ptr in _flat_sets(batch.column("text")):
            keys = (pa.array(k) for k in _fingerprints(flat, ptr))
            sets = pa.array([flat[a:b].tobytes() for a, b in zip(ptr[:-1], ptr[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*keys, sets], ["k1", "k2", "shingles"])


def _exact_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True):
            u, v = np.frombuffer(x, _U), np.frombuffer(y, _U)
            at = np.minimum(np.searchsorted(v, u), len(v) - 1)
            good.append(bool(linked(int((v[at] == u).sum()), len(u), len(v))))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of classes whose exact sets are linked. Only texts of the classes in question are read again."""
    wanted = keep(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes, "cls"))
    ids = wanted.select(F.col("doc_id").alias("want")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("want")), "left_semi").select("text")
    sets = texts.mapInArrow(_exact_sets, "k1 long, k2 long, shingles binary").dropDuplicates(["k1", "k2"])
    sets = keep(wanted.join(sets, ["k1", "k2"]).select("cls", "shingles"))
    first = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("xa"))
    second = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("xb"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "xa", "xb")
    links = keep(both.mapInArrow(_exact_links, "a long, b long"))
    release(wanted, sets)
    return links


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    spark = setup(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = "doc_id long, n long, k1 long, k2 long, sketch binary, anchors array<long>"
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    shapes = docs.mapInArrow(_describe(common_shingles(docs)), schema)
    shapes = keep(shapes.withColumn("row", F.monotonically_increasing_id()))
    firsts = keep(shapes.groupBy("k1", "k2").agg(F.min("row").alias("cls")))
    rows = keep(shapes.join(firsts, ["k1", "k2"]))
    release(shapes, firsts)
    classes = rows.where("row = cls").select("cls", "doc_id", "k1", "k2", "n", "sketch", "anchors")

    # An anchor whose region holds a single class joins nothing.
    postings = classes.select(F.posexplode("anchors").alias("rank", "s"), "cls", "n")
    live = postings.groupBy("s").agg(
        F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.count(F.lit(1)).alias("k")
    )
    live = keep(live.where("lo < hi").select("s", "k"))
    regions = postings.join(live, "s").select("s", F.expr("0 as block"), "cls", "n", "rank", "k")
    regions = keep(regions)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    dealt = regions.repartition(parts, "s").sortWithinPartitions("s", "n").select("s", "block", "cls", "n", "rank", "k")
    near = "s long, block int, cls long, n long, rank int, k long, pivots array<long>"
    mated = keep(dealt.mapInArrow(_pivots, near))
    release(regions)
    pairs = mated.select(F.col("cls").alias("a"), F.explode("pivots").alias("b")).where("a <> b").distinct()
    shape = classes.select("cls", "n", "sketch")
    left = shape.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = shape.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    met = keep(pairs)
    sketched = met.join(left, "a").join(right, "b")
    pairs = keep(sketched.mapInArrow(_sketch_filter, "a long, b long"))
    known = classes.select("cls", "doc_id", "k1", "k2")
    links = _verified(docs, known, pairs)
    release(live, met, pairs)

    state = mated.select("s", "cls", "n", "rank", "k")
    g = F.greatest(F.lit(1), F.ceil(F.col("k") / BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("cls"), g).cast("int")
    cell = F.explode(
        F.expr("if(g = 1, array(0), transform(sequence(0, g - 1), i -> least(i, own) * g + greatest(i, own)))")
    )
    state = state.withColumn("g", g).withColumn("own", own).withColumn("block", cell)
    # Blocks (i, i) compare within block i, blocks (i, j) across.
    half = F.expr("if(g = 1 or block div g = block % g, -1, own)").alias("half")
    state = state.select("s", "block", "cls", "n", "rank", "k", half)
    open_rows = "s long, block int, cls long, n long, rank int, comp long, k long, half int"
    earlier = F.when(F.col("k") >= DENSE, F.slice("anchors", 1, F.col("rank"))).alias("earlier")
    tried = None
    for made in (_first_pairs, _rest_pairs):
        joined = components(links).select(F.col("node").alias("cls"), "root")
        # Only what may still be linked takes its sketch along.
        narrow = state.join(joined, "cls", "left").withColumn("comp", F.coalesce("root", "cls"))
        narrow = narrow.select("s", "block", "cls", "n", "rank", "comp", "k", "half")
        narrow = narrow.repartition(parts, "s", "block").sortWithinPartitions("s", "block", "n", "comp")
        still = keep(narrow.mapInArrow(_undecided, open_rows))
        release(mated)
        wide = still.join(classes.select("cls", "sketch", "anchors"), "cls").withColumn("earlier", earlier)
        wide = wide.repartition(parts, "s", "block").sortWithinPartitions("s", "block")
        wide = wide.select("s", "block", "cls", "n", "rank", "comp", "half", "sketch", "earlier")
        more = wide.mapInArrow(made, "a long, b long").distinct()
        more = keep(more if tried is None else more.join(tried, ["a", "b"], "left_anti"))
        if more.isEmpty():
            break
        links = links.union(_verified(docs, known, more))
        state, tried = still.drop("comp"), more

    roots = components(links).select(F.col("node").alias("cls"), "root")
    placed = keep(
        rows.select("doc_id", "n", "cls")
        .join(roots, "cls", "left")
        .select("doc_id", "n", F.coalesce("root", "cls").alias("root"))
    )
    smallest = keep(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    result = placed.join(smallest, "root")
    # Empty sets share a class but are linked with nothing.
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component.

    Rows that repeat a doc_id stay or go together; a null doc_id stays.
    """
    found = jaccard_components(docs).where("doc_id is not null")
    gone = keep(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
