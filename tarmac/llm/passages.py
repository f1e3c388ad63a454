"""Passages that repeat across documents, found by paragraph MinHash banding.

A paragraph is a line of at least five words. Its MinHash signature is cut into bands; ``tuned_bands`` picks the fewest hashes
that find a pair at the threshold with the wanted recall. All paragraphs that meet another in a band go through the exact
Jaccard join of their five-word shingles (``jaccard_join``), which clusters them into connected components. So that a passage pasted into a longer line is seen too, each sentence of
at least five words is a paragraph of its own that is compared for equality only, and so are windows of ``WINDOW`` words
that are selected by their words alone, wherever lines and sentences end. Around selected windows that repeat all windows
are compared, so each stretch of ``LEAST_WORDS`` words that two documents share word for word is found up to its ends.

Within a document, repeated paragraphs that touch (up to four words apart) make a passage; passages of at least
``LEAST_WORDS`` words are reported, in the document that comes first (``removed`` is false) as well as in
the others. Repetition within one document alone is not reported.

Nulls, empty texts and short lines repeat nothing. Repeated rows are documents of their own; of equal doc_ids
the first row as read comes first, null doc_ids come last. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.jaccard_join import jaccard_components
from tarmac.llm.store import keep, mark, release, release_since, setup
from tarmac.llm.words import SHINGLE, Words, mix, text_bytes, windows, words_of

THRESHOLD = 0.8
RECALL = 0.998
LEAST_WORDS = 25
GAP = 4
# Words of a window; of so many windows in a row at least one is selected.
WINDOW = 12
SELECT = 9
BLOCK = 1 << 18  # units that are packed together
SHARD = 4096  # documents a shard of keys
_U = np.uint64
_STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?"])


def tuned_bands(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows) of the fewest hashes that reach the recall at the threshold; more rows on ties."""
    options = [(max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**r))), r) for r in range(1, 6)]
    return min(options, key=lambda o: (o[0] * o[1], -o[1]))


BANDS, ROWS = tuned_bands(THRESHOLD, RECALL)


def _bounds(stop: np.ndarray, ptr: np.ndarray, n: int) -> np.ndarray:
    """First words of units: after a stop, and at the beginning of each text."""
    begin = np.zeros(n + 1, bool)
    begin[1:][stop] = True
    begin[ptr] = True
    return np.flatnonzero(begin[:n])


def _keys(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    place = np.arange(len(hashes)) - np.repeat(starts, sizes)
    return mix(np.add.reduceat(mix(hashes + place.astype(_U) * _U(0xD1B54A32D192ED03)), starts))


def _window_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """As ``_keys``, for windows that overlap."""
    total = np.zeros(len(at), _U)
    for k in range(WINDOW):
        total += mix(hashes[at + k] + _U(k * 0xD1B54A32D192ED03 % 2**64))
    return mix(total)


def selected(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Windows that their words alone select: the lowest hash of each ``SELECT`` windows in a row of one text."""
    n = len(hashes) - WINDOW - SELECT + 2
    if n <= 0:
        return np.zeros(0, np.int64)
    every = windows(hashes, list(range(WINDOW)))
    lowest = every[:n].copy()
    ahead = np.zeros(n, np.int8)
    for k in range(1, SELECT):
        np.putmask(ahead, every[k : k + n] < lowest, np.int8(k))
        np.minimum(lowest, every[k : k + n], out=lowest)
    whole = np.arange(n) + WINDOW + SELECT - 1 <= np.repeat(ptr[1:], np.diff(ptr))[:n]
    chosen = np.zeros(n + SELECT, bool)
    chosen[(np.arange(n) + ahead)[whole]] = True
    return np.flatnonzero(chosen)


def _stops_of(words: Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, whether a line ends behind it, and whether a line or a sentence does."""
    data, offsets = text_bytes(texts)
    shift = np.repeat(offsets[:-1], np.diff(words.ptr))
    ends, begins = words.ends + shift, words.starts + shift
    breaks = np.flatnonzero((data == 10) | (data == 13))
    line_end = np.zeros(len(ends), bool)
    line_end[:-1] = np.searchsorted(breaks, begins[1:]) > np.searchsorted(breaks, ends[:-1])
    return line_end, line_end | _STOPS[data[ends - 1]]


def _stretches(words: Words, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of what lies between stops, if at least ``SHINGLE`` words."""
    starts = _bounds(stop, words.ptr, len(words.hashes))
    sizes = np.diff(np.append(starts, len(words.hashes)))
    long = sizes >= SHINGLE
    starts, sizes = starts[long], sizes[long]
    return np.searchsorted(words.ptr, starts, side="right") - 1, starts, sizes


def _stretch_keys(words: Words, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, _U)
    at = np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
    return _keys(words.hashes[at], np.append(0, np.cumsum(sizes)[:-1]), sizes)


def _bands(words: Words, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The MinHash bands of lines."""
    bands = np.zeros((len(starts), BANDS), _U)
    if not len(starts):
        return bands
    every = windows(words.hashes, list(range(SHINGLE)))
    sizes = sizes - SHINGLE + 1
    first = np.append(0, np.cumsum(sizes)[:-1])
    every = every[np.repeat(starts - first, sizes) + np.arange(sizes.sum())]
    for b in range(BANDS):
        band = np.zeros(len(starts), _U)
        for r in range(ROWS):
            band = mix(band + np.minimum.reduceat(mix(every ^ _U(0x9E37 + 7919 * (b * ROWS + r))), first))
        bands[:, b] = mix(band + _U(b))
    return bands


UNITS = "doc_id long, row long, first_word int, n_words int, key long, bands array<long>"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All lines; those that repeat within a batch have bands only once."""
    for batch in batches:
        texts = batch.column("text")
        words = words_of(texts)
        if not len(words.hashes):
            continue
        text, starts, sizes = _stretches(words, _stops_of(words, texts)[0])
        key = _stretch_keys(words, starts, sizes)
        once = np.zeros(len(key), bool)
        once[np.unique(key, return_index=True)[1]] = True
        bands = _bands(words, starts[once], sizes[once])
        ptr = np.append(0, np.cumsum(once * BANDS)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(text)),
                batch.column("row").take(pa.array(text)),
                pa.array((starts - words.ptr[text]).astype(np.int32)),
                pa.array(sizes.astype(np.int32)),
                pa.array(key.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ptr), pa.array(bands.view(np.int64).ravel())),
            ],
            ["doc_id", "row", "first_word", "n_words", "key", "bands"],
        )


def units_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, kind, key) of all lines, sentences and selected windows.

    Places count from the first word of the text; a kind is twice the number of words, and one more for a line.
    """
    words = words_of(texts)
    if not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    line_end, stop = _stops_of(words, texts)
    text, starts, sizes = _stretches(words, line_end)
    units = [(text, starts, 2 * sizes + 1, _stretch_keys(words, starts, sizes))]
    line_size = np.zeros(len(words.hashes), np.int64)
    line_size[starts] = sizes
    text, starts, sizes = _stretches(words, stop)
    own = line_size[starts] != sizes  # sentences that are whole lines are there already
    text, starts, sizes = text[own], starts[own], sizes[own]
    units.append((text, starts, 2 * sizes, _stretch_keys(words, starts, sizes)))
    at = selected(words.hashes, words.ptr)
    text = np.searchsorted(words.ptr, at, side="right") - 1
    units.append((text, at, np.full(len(at), 2 * WINDOW), _window_keys(words.hashes, at)))
    text, at, kind, key = (np.concatenate(x) for x in zip(*units, strict=True))
    return text, at - words.ptr[text], kind, key


# ---- units that repeat: dealt out by key, packed --------------------------------------------------

DEALT = "shard int, known boolean, low long, keys binary, rows binary, places binary, kinds binary"


def _small(numbers: np.ndarray) -> bytes:
    """Numbers from 0, in as many bytes each as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, np.dtype(f"u{len(packed) // n}") if n else np.uint8).astype(np.int64)


def _deal(shards: int):
    """Units of ``BLOCK`` or more at a time, a row for each block and shard of their keys.

    Units that repeat within the block need nobody else: they go on as they are, to any shard, and only one mark
    (kind 0) for each such key goes to the shard of the key. So a shard gets a key once from a block, however common it is.
    """

    def block(rows, places, kinds, keys) -> pa.RecordBatch:
        order = np.argsort(keys)
        rows, places, kinds, keys = rows[order], places[order], kinds[order], keys[order]
        low = int(rows.min())
        rows = rows - low
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        known = np.minimum.reduceat(rows, first) < np.maximum.reduceat(rows, first)
        mark, known = first[known], np.repeat(known, np.diff(np.append(first, len(keys))))
        out: list[tuple] = []
        if known.any():
            sure = [keys[known].tobytes(), *(_small(x[known]) for x in (rows, places, kinds))]
            out.append((low % shards, True, low, *sure))
            kinds[mark] = 0
            known[mark] = False
            rows, places, kinds, keys = (x[~known] for x in (rows, places, kinds, keys))
        shard = ((keys >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(keys))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = [keys[a:b].tobytes(), *(_small(x[a:b]) for x in (rows, places, kinds))]
            out.append((int(shard[a]), False, low, *part))
        kinds_ = [pa.int32(), pa.bool_(), pa.int64(), *[pa.binary()] * 4]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds_, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["shard", "known", "low", "keys", "rows", "places", "kinds"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            text, place, kind, key = units_of(batch.column("text"))
            if not len(key):
                continue
            rows = batch.column("row").to_numpy()[text]
            held.append((rows, place, kind, key))
            if sum(len(h[0]) for h in held) >= BLOCK:
                yield block(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
        if held:
            yield block(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


PLAIN = "row long, first_word int, n_words int, key long, window boolean"


def _plain(rows, places, kinds, keys) -> Iterator[pa.RecordBatch]:
    step = 1 << 16
    for a in range(0, len(keys), step):
        kind = kinds[a : a + step]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[a : a + step]),
                pa.array(places[a : a + step].astype(np.int32)),
                pa.array((kind >> 1).astype(np.int32)),
                pa.array(keys[a : a + step].view(np.int64)),
                pa.array(kind == 2 * WINDOW),
            ],
            ["row", "first_word", "n_words", "key", "window"],
        )


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    keys = np.frombuffer(row["keys"], _U)
    rows, places, kinds = (_wide(row[c], len(keys)) for c in ("rows", "places", "kinds"))
    return rows + row["low"], places, kinds, keys


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units whose keys are in several rows; the rows of a shard come one after the other."""

    def close(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows, places, kinds, keys = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys)
        in_order = keys[order]
        first = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1]))
        row = rows[order]
        again = np.minimum.reduceat(row, first) < np.maximum.reduceat(row, first)
        again |= np.minimum.reduceat(kinds[order], first) == 0
        again = order[np.repeat(again, np.diff(np.append(first, len(keys))))]
        again = again[kinds[again] > 0]
        yield from _plain(rows[again], places[again], kinds[again], keys[again])

    shard, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["known"]:
                yield from _plain(*_unpacked(row))
                continue
            if held and row["shard"] != shard:
                yield from close(held)
                held = []
            shard = row["shard"]
            held.append(_unpacked(row))
    if held:
        yield from close(held)


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows near the repeated ones (``hits``): they lead to the true ends of what is shared."""
    for batch in batches:
        words = words_of(batch.column("text"))
        hits = batch.column("hits")
        text = np.repeat(np.arange(len(hits)), hits.value_lengths().to_numpy())
        at, first = (hits.flatten().field(c).to_numpy().astype(np.int64) for c in ("at", "first"))
        order = np.lexsort((first, at, text))
        text, at, first = text[order], at[order], first[order]
        # Between windows of one origin that touch there is nothing to add.
        new = np.ones(len(at) + 1, bool)
        new[1:-1] = (np.diff(text) != 0) | (np.diff(at) > SELECT) | (np.diff(first) != 0)
        steps = np.arange(1, SELECT)
        place = np.concatenate([(at[new[:-1]][:, None] - steps).ravel(), (at[new[1:]][:, None] + steps).ravel()])
        where = np.concatenate([np.repeat(text[x], len(steps)) for x in (new[:-1], new[1:])])
        inside = (place >= 0) & (place + WINDOW <= np.diff(words.ptr)[where])
        place = place[inside] + words.ptr[where[inside]]
        near = np.zeros(len(words.hashes), bool)
        near[place] = True
        near[at + words.ptr[text]] = False
        at = np.flatnonzero(near)
        text = np.searchsorted(words.ptr, at, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row").take(pa.array(text)),
                pa.array((at - words.ptr[text]).astype(np.int32)),
                pa.array(np.full(len(at), WINDOW, np.int32)),
                pa.array(_window_keys(words.hashes, at).view(np.int64)),
            ],
            ["row", "first_word", "n_words", "key"],
        )


def _line_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines as texts of their own, each once per document."""
    for batch in batches:
        texts = batch.column("text")
        words = words_of(texts)
        if not len(words.hashes):
            continue
        data, offsets = text_bytes(texts)
        text, starts, sizes = _stretches(words, _stops_of(words, texts)[0])
        key = _stretch_keys(words, starts, sizes).view(np.int64)
        wanted = [set(w) for w in batch.column("wanted").to_pylist()]
        rows: tuple[list, list] = ([], [])
        for i, k in enumerate(key.tolist()):
            if k in wanted[text[i]]:
                wanted[text[i]].remove(k)
                a, b = words.starts[starts[i]], words.ends[starts[i] + sizes[i] - 1]
                rows[0].append(k)
                rows[1].append(data[offsets[text[i]] + a : offsets[text[i]] + b].tobytes().decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string())], ["doc_id", "text"])


def _near_lines(docs: DataFrame, units: DataFrame) -> DataFrame:
    """Rows (key, root): components of similar lines; every line that meets another in a band takes part in the exact join."""
    lines = units.where("size(bands) > 0")
    bands = lines.select("key", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("band")
    met = keep(bands.join(keep(shared), "band").select("key").distinct())
    met = lines.select("key", "row").join(met, "key").groupBy("key").agg(F.min("row").alias("row"))
    wanted = keep(met.groupBy(F.col("row").alias("want")).agg(F.collect_list("key").alias("wanted")))
    texts = docs.join(wanted, F.col("row") == F.col("want")).select("text", "wanted")
    texts = keep(texts.mapInArrow(_line_texts, "doc_id long, text string"))
    release(wanted)
    return jaccard_components(texts).select(F.col("doc_id").alias("key"), F.col("component_id").alias("root"))


def _islands(units: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Stretches [begin, end] of sorted units that touch."""
    out: list[list[int]] = []
    for begin, end in units:
        if out and begin <= out[-1][1] + GAP:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def _sources(begin: int, end: int, units: list[tuple]) -> list[tuple[int, int, int | None]]:
    """(begin, end, first document) of the parts of an island; parts below ``LEAST_WORDS`` words go with their neighbour."""
    cuts = [u for i, u in enumerate(units) if not i or u[3] != units[i - 1][3]]
    ends = [u[0] for u in cuts[1:]] + [end]
    parts: list[list] = []
    for (a, _, doc, _), b in zip(cuts, ends, strict=True):
        if parts and min(b - a, parts[-1][1] - parts[-1][0]) < LEAST_WORDS:
            parts[-1][1] = b
        else:
            parts.append([a, b, Counter()])
        parts[-1][2][doc] += b - a
    return [(a, b, tally.most_common(1)[0][0]) for a, b, tally in parts]


def passages_of(units: list[tuple]) -> list[tuple]:
    """(begin, end, first document, removed) of one row's repeated units, sorted (begin, end, first document, its row, copy?).

    Copies alone decide what is removed, so that a first occurrence stays whatever it touches. A run of copies below
    ``LEAST_WORDS`` words counts with what surrounds it. The first document is None where it is the row's own.
    """
    copies = [u[:4] for u in units if u[4]]
    gone = [(a, b) for a, b in _islands(u[:2] for u in copies) if b - a >= LEAST_WORDS]
    out = []
    at = 0
    for a, b in gone:
        while at < len(copies) and copies[at][0] < a:
            at += 1
        low = at
        while at < len(copies) and copies[at][0] < b:
            at += 1
        out += [(*part, True) for part in _sources(a, b, copies[low:at])]
    k = 0
    for a, b in _islands(u[:2] for u in units):
        while k < len(gone) and gone[k][0] < b:
            if gone[k][0] - a >= LEAST_WORDS:
                out.append((a, gone[k][0], None, False))
            a = max(a, gone[k][1])
            k += 1
        if b - a >= LEAST_WORDS:
            out.append((a, b, None, False))
    return out


def _merged(row, begin, end, first) -> np.ndarray:
    """Where stretches of units begin that are next to each other, touch and have one first row."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (first[1:] != first[:-1]) | (begin[1:] > end[:-1] + GAP)
    return np.flatnonzero(new)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of rows whose units come one after the other, sorted by where they begin and end."""

    def close(out: list, row, units: list) -> None:
        for a, b, first, removed in passages_of(units):
            out.append((row, a, b - a, first if removed else row, removed))

    def made(out: list) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.bool_()]
        names = ["row", "first_word", "n_words", "first_row", "removed"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    row, units = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        out: list[tuple] = []
        columns = [batch.column(c).to_numpy() for c in ("row", "first_word", "end", "first_row")]
        at = _merged(*columns)
        ends = np.maximum.reduceat(columns[2], at)
        lists = [columns[0][at].tolist(), columns[1][at].tolist(), ends.tolist(), columns[3][at].tolist()]
        for r, a, b, first in zip(*lists, strict=True):
            if r != row:
                close(out, row, units)
                row, units = r, []
            units.append((a, b, first, first, first != r))
        yield made(out)
    out = []
    close(out, row, units)
    yield made(out)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, first_word, n_words, first_doc_id, removed), a row per passage and document."""
    spark = setup(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Stored, so that a row has one number wherever it is read. The numbers are in the order in which documents come first.
    docs = docs.withColumn("read", F.monotonically_increasing_id()).sort(F.col("doc_id").asc_nulls_last(), "read")
    docs = keep(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")))
    lines = keep(docs.mapInArrow(_units, UNITS))
    made = mark()
    roots = keep(_near_lines(docs, lines))
    release_since(made, roots)
    several = roots.groupBy("root").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("root")
    roots = keep(roots.join(several, "root").select("key", "root"))
    similar = keep(lines.select("row", "first_word", "n_words", "key").join(roots.select("key"), "key"))
    release(lines)

    # From here on only units whose keys repeat or that are similar lines.
    dealt = docs.select("row", "text").mapInArrow(_deal(max(parts, docs.count() // SHARD)), DEALT)
    dealt = dealt.repartition(parts, "shard").sortWithinPartitions("shard")
    some = keep(dealt.mapInArrow(_repeated, PLAIN))
    drawn = some.where("window")
    origin = F.min(F.when(F.col("window"), F.col("row"))).alias("first")
    seen = keep(some.groupBy("key").agg(F.min("row").alias("lo"), F.max("row").alias("hi"), origin))
    hits = drawn.select("key", "row", "first_word").join(seen.select("key", "first"), "key")
    hits = hits.groupBy(F.col("row").alias("want"))
    hits = keep(hits.agg(F.collect_list(F.struct(F.col("first_word").alias("at"), "first")).alias("hits")))
    found = docs.join(hits, F.col("row") == F.col("want")).select("row", "text", "hits")
    columns = ["row", "first_word", "n_words", "key"]
    more = keep(found.mapInArrow(_around, "row long, first_word int, n_words int, key long"))
    release(hits)
    other = more.select("key", "row").union(similar.select("key", "row"))
    spans = seen.drop("first").union(other.select("key", F.col("row").alias("lo"), F.col("row").alias("hi")))
    span = (F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # Similar lines count as one, from the first row of any of them.
    groups = spans.join(roots, "key").groupBy("root").agg(*span).where("lo < hi").select("root", F.col("lo").alias("first"))
    groups = keep(roots.join(groups, "root").select("key", "first"))
    known = spans.groupBy("key").agg(*span).join(groups, "key", "left").where("first is not null or lo < hi")
    known = keep(known.select("key", F.coalesce("first", "lo").alias("first_row")))
    units = some.select(columns).union(more.select(columns)).union(similar.select(columns))
    flagged = units.join(known, "key").select(
        "row",
        F.col("first_word").cast("long").alias("first_word"),
        (F.col("first_word") + F.col("n_words")).cast("long").alias("end"),
        "first_row",
    )
    flagged = flagged.repartition(parts, "row").sortWithinPartitions("row", "first_word", "end")
    found = keep(flagged.mapInArrow(_judged, FOUND))
    ids = docs.select("row", "doc_id")
    first = docs.select(F.col("row").alias("first_row"), F.col("doc_id").alias("first_doc_id"))
    found = found.join(ids, "row").join(first, "first_row")
    return found.select("doc_id", "first_word", "n_words", "first_doc_id", "removed")


FOUND = "row long, first_word long, n_words long, first_row long, removed boolean"
