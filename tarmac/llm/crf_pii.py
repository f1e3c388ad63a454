"""Personal data in whole texts: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field labels every word of a text (other, email, ip, card, phone); runs of words
with one label are added as spans, without the words that a base span touches. Its features are shapes of the word and of its neighbours, its weights
are fitted to a small labelled table by maximum likelihood on the driver (the table has at most ``LABELLED_ROWS``
rows), and texts are decoded by Viterbi in numpy batches.

Decoding skips words that cannot be anything but "other": where that label leads by more than any two transitions can make
up, the best path takes it. That is exact, and leaves short stretches to decode.

Null counts as the empty text. Repeated rows give repeated result rows. Columns other than those named are
ignored or, in ``redact``, passed through.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from itertools import islice, takewhile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.store import setup

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
LABELLED_ROWS = 50_000
REMEMBERED, FORMS = 150_000, 50_000
LONGEST_REMEMBERED = 64
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile(r"[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AT_WORD = re.compile(r"[(\[]at[)\]]")
ADDRESS = re.compile(r"(@|[(\[]at[)\]])[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"(?<![0-9.])[0-9]{1,3}(\.[0-9]{1,3}){3}(?![0-9.])")
EDGE = "\"'()[]{}<>,;:!?."

Span = tuple[str, int, int]


# ---- base spans ----------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # A match is the whole run of local characters before an @, and a domain after it.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    if "@" in text:
        spans += [("email", a, b) for a, b in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                spans.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m[0])) <= 15:
                    spans.append(("phone", *m.span()))
    return spans


# ---- the labelled table --------------------------------------------------------------------

SCHEMA_LABELLED = "sequence long, position long, word string, label string"


def labelled_table(seed: int = 7, sequences: int = 900) -> pd.DataFrame:
    """Invented sentences: filler words, personal data in several spellings, and numbers that are none."""
    r = random.Random(seed)
    filler = "the of and in house river call me at my new number is write to please order page from une de der und los".split()

    def digits(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    def word() -> str:
        w = "".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 9))) if r.random() < 0.6 else r.choice(filler)
        w = w.capitalize() if r.random() < 0.15 else w
        return w + r.choice(",.;") if r.random() < 0.12 else w

    def card() -> str:
        body = r.choice("345") + digits(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def no_card(n: int) -> str:
        number = digits(n)
        return number if not luhn(number) else number[:-1] + str((int(number[-1]) + 1) % 10)

    def email() -> list[str]:
        name = r.choice(["", word().strip(",.;") + "."]) + word().strip(",.;") + digits(r.choice([0, 0, 2]))
        host = r.choice(["mail", "post", "example", "web" + digits(1)]) + "." + r.choice(["com", "org", "de", "example.com"])
        return [r.choice([f"{name}@{host}", f"{name}(at){host}", f"{name}[at]{host}", f"mailto:{name}@{host}"])]

    def ip() -> list[str]:
        parts = ".".join(str(r.randint(0, 255)) for _ in range(4))
        return [parts + r.choice(["", "", ":8080", "/24"])]

    def phone() -> list[str]:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice([[f"+1 ({a}) {b}-{c}"], [f"({a}) {b}-{c}"], [f"{a}-{b}-{c}"], [f"+49 {a} {b}{c}"], [f"+33{a}{b}{c}"]])[0].split()

    def cards() -> list[str]:
        c = card()
        return r.choice([[c], [c[:4], c[4:8], c[8:12], c[12:]], ["-".join((c[:4], c[4:8], c[8:12], c[12:]))]])

    def nothing() -> list[str]:
        return [
            r.choice(
                [
                    digits(r.choice([1, 2, 3, 4, 4, 5, 6, 8])),
                    f"{digits(1)}.{digits(1)}.{digits(2)}",
                    f"{digits(2)}.{digits(2)}",
                    f"{digits(4)}-{digits(2)}-{digits(2)}",
                    f"{digits(1)},{digits(3)},{digits(3)}",
                    f"${digits(2)}.{digits(2)}",
                    f"{digits(2)}%",
                    f"v{digits(1)}.{digits(1)}",
                    "".join(r.choice("0123456789abcdef") for _ in range(r.choice([16, 20, 32, 40]))),
                    f"password={digits(3)}ab{digits(4)}",
                    "AKIA" + "".join(r.choice("ABCDEFGHIJ234567") for _ in range(16)),
                    "|",
                    "(" + word().strip(",.;") + ")",
                    "@" + word().strip(",.;"),
                    digits(r.choice([21, 24])),
                    no_card(r.choice([13, 16, 16, 16, 19])),
                    f"{digits(1)}.0",
                    word().strip(",.;") + r.choice([".", ",", ""]) + r.choice("*&%#!+-=_~") * r.randint(1, 4),
                    r.choice("*&%#!+-=_~|.") * r.randint(1, 4),
                    f"{word()}-{word()}",
                    f"{word().strip(',.;')}.{word()}",
                ]
            )
        ]

    rows = []
    makers = {"email": email, "ip": ip, "card": cards, "phone": phone, "other": nothing}
    for s in range(sequences):
        sequence: list[tuple[str, str]] = []
        for _ in range(r.randint(1, 3)):
            sequence += [(word(), "other") for _ in range(r.randint(1, 5))]
            kind = r.choice(["other", "other", "other", "other", *KINDS])
            item = makers[kind]()
            if r.random() < 0.2:
                item[-1] += r.choice(",.")
            sequence += [(w, kind) for w in item]
        sequence += [(word(), "other") for _ in range(r.randint(0, 3))]
        rows += [(s, i, w, k) for i, (w, k) in enumerate(sequence)]
    return pd.DataFrame(rows, columns=["sequence", "position", "word", "label"])


# ---- features and model --------------------------------------------------------------------


def shape(word: str) -> tuple[str, ...]:
    """The features of a word."""
    if word.isalpha():
        return ("alpha", "upper" if word[0].isupper() else "lower")
    core = word.strip(EDGE) or word
    out, run, before = [], 0, ""
    for c in core:
        k = "d" if c in "0123456789" else "x" if c.isalpha() else c if c.isascii() else "u"
        if k == before:
            run += 1
            if k == "d" and run <= 4:
                out.append(k)
            continue
        out.append(k)
        before, run = k, 1
    form = "".join(out[:24])
    count = sum(c in "0123456789" for c in core)
    marks = [f"has {c}" for c in "@+-.:/=%$|" if c in core]
    if AT_WORD.search(core):
        marks.append("at word")
    if word[:1] == "(":
        marks.append("opens")
    digits = re.sub("[^0-9]", "", core)
    if 13 <= count <= 19 and luhn(digits):
        marks.append("luhn")
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}([:/][0-9]+)?", core):
        marks.append("four parts")
    mixed = "digits only" if count == len(core) else "digits" if count else "no digits"
    return ("form " + form, "digits " + str(min(count, 20)), mixed, *marks)


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, features: dict[str, int], own, left, right, moves):
        self.features, self.own, self.left, self.right, self.moves = features, own, left, right, moves
        k = len(LABELS)
        gain = max(
            float(moves[a, x] + moves[x, b] - moves[a, 0] - moves[0, b])
            for a in range(k)
            for b in range(k)
            for x in range(1, k)
        )
        edge = float((np.abs(moves).max()) * 2)
        self.lead = max(gain, edge, 0.0)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.forms: dict[tuple[str, ...], int] = {}
        self.vectors = np.zeros((3, 64, len(LABELS)))

    def form_of(self, word: str) -> int:
        """Number of the word's feature set; sets are few, words many."""
        key = shape(word)
        number = self.forms.get(key)
        if number is None:
            number = self.forms[key] = len(self.forms)
            if number >= self.vectors.shape[1]:
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)], axis=1)
            at = [self.features[f] for f in key if f in self.features]
            for k, table in enumerate((self.own, self.left, self.right)):
                self.vectors[k, number] = table[at].sum(axis=0)
        if len(word) <= LONGEST_REMEMBERED:
            self.known[word] = number
        return number

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of feature sets, good until the next call, which may forget all of them."""
        if len(self.known) >= REMEMBERED or len(self.forms) >= FORMS:
            self._reset()
        known = self.known
        return np.fromiter(
            (known[w] if w in known else self.form_of(w) for w in words), np.int64, count=len(words)
        )

    def scores(self, forms: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Label scores of words; ``begins``: where texts begin."""
        own, left, right = self.vectors
        e = own[forms]
        inner = np.ones(len(forms), bool)
        inner[begins] = False
        at = np.flatnonzero(inner)
        e[at] += left[forms[at - 1]]
        e[at - 1] += right[forms[at]]
        return e

    def decode(self, e: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The best label of every word."""
        labels = np.zeros(len(e), np.int64)
        open_ = e[:, 0] - e[:, 1:].max(axis=1) <= self.lead
        at = np.flatnonzero(open_)
        if not len(at):
            return labels
        first = np.zeros(len(e), bool)
        first[begins] = True
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | first[at[1:]]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        order = np.argsort(-sizes, kind="stable")
        ends = np.append(first[1:], True)
        for group in np.array_split(order, max(1, len(order) // 4096)):
            self._viterbi(e, at, starts[group], sizes[group], first, ends, labels)
        return labels

    def _viterbi(self, e, at, starts, sizes, first, ends, labels) -> None:
        """Stretches of descending size, all at once; outside them the label is "other" or the text ends."""
        k = len(LABELS)
        begin = at[starts]
        score = e[begin] + np.where(first[begin][:, None], 0.0, self.moves[0])
        back = np.zeros((int(sizes[0]), len(starts), k), np.int8)
        for t in range(1, int(sizes[0])):
            n = int(np.searchsorted(-sizes, -t, side="left"))
            step = score[:n, :, None] + self.moves
            back[t, :n] = step.argmax(axis=1)
            score[:n] = step.max(axis=1) + e[begin[:n] + t]
        last = begin + sizes - 1
        score += np.where(ends[last][:, None], 0.0, self.moves[:, 0])
        label = score.argmax(axis=1)
        for t in range(int(sizes[0]) - 1, -1, -1):
            n = int(np.searchsorted(-sizes, -t, side="left"))
            labels[begin[:n] + t] = label[:n]
            if t:
                label[:n] = back[t, np.arange(n), label[:n]]


def train(table: pd.DataFrame, rounds: int = 120, penalty: float = 2e-3) -> Field:
    """Fit the weights by gradient steps on the penalised likelihood of the labelled sequences."""
    if len(table) > LABELLED_ROWS:
        raise ValueError(f"the labelled table has more than {LABELLED_ROWS} rows")
    table = table.sort_values(["sequence", "position"])
    shapes = [shape(w) for w in table["word"]]
    features = {f: i for i, f in enumerate(sorted({f for s in shapes for f in s}))}
    label = table["label"].map({x: i for i, x in enumerate(LABELS)}).to_numpy()
    rows = table.groupby("sequence").indices.values()
    length, k = max(len(r) for r in rows), len(LABELS)
    place = np.full((len(rows), length), -1)
    for i, r in enumerate(rows):
        place[i, : len(r)] = r
    real = place >= 0
    x = np.zeros((len(table), len(features)))
    for i, s in enumerate(shapes):
        x[i, [features[f] for f in s]] = 1.0
    # Features of the word, of the one before and of the one after, side by side.
    sides = [x, np.zeros_like(x), np.zeros_like(x)]
    for r in rows:
        sides[1][r[1:]], sides[2][r[:-1]] = x[r[:-1]], x[r[1:]]
    z = np.concatenate(sides, axis=1)
    gold = np.eye(k)[label]
    pairs = np.zeros((k, k))
    for r in rows:
        np.add.at(pairs, (label[r[:-1]], label[r[1:]]), 1.0)

    w, moves = np.zeros((z.shape[1], k)), np.zeros((k, k))
    speed = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, moves)]
    for step in range(1, rounds + 1):
        e = np.where(real[..., None], (z @ w)[np.maximum(place, 0)], 0.0)
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0]
        for t in range(1, length):
            go = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + e[:, t]
            forward[:, t] = np.where(real[:, t, None], go, forward[:, t - 1])
        for t in range(length - 2, -1, -1):
            go = np.logaddexp.reduce(moves + (e[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(real[:, t + 1, None], go, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        single = np.exp(forward + backward - total[:, None, None])
        expected = np.zeros((len(table), k))
        expected[place[real]] = single[real]
        double = np.zeros((k, k))
        for t in range(1, length):
            p = forward[:, t - 1, :, None] + moves + (e[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
            double += (np.exp(p) * real[:, t, None, None]).sum(axis=0)
        n = len(rows)
        for values, slope, (mean, square) in (
            (w, z.T @ (gold - expected) / n - penalty * w, speed[0]),
            (moves, (pairs - double) / n - penalty * moves, speed[1]),
        ):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            values += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    f = len(features)
    return Field(features, w[:f], w[f : 2 * f], w[2 * f :], moves)


# ---- spans of whole texts ------------------------------------------------------------------


def find_spans(texts: list[str], field: Field) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    words = [WORD.findall(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    forms = field.numbers([w for ws in words for w in ws])
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    labels = field.decode(field.scores(forms, begins), begins) if len(forms) else forms
    at = 0
    for text, size in zip(texts, sizes, strict=True):
        own = labels[at : at + size]
        at += size
        base = base_spans(text)
        yield base, _added(text, own, base) if own.any() else []


def _stands_alone(label: str, piece: str) -> bool:
    """Whether what base spans leave of a word is personal data by itself."""
    if label == "email":
        return bool(ADDRESS.search(piece))
    return bool(FOUR_PARTS.search(piece)) if label == "ip" else len(DIGIT.findall(piece)) >= 7


def _added(text: str, labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of words of one label. Words that base spans touch are cut out; a run ends with an email or ip."""
    runs: list[list[int]] = []
    taken = sorted((a, b) for _, a, b in base)
    open_ = -2  # word that the last run may go on from
    next_ = 0
    for i, m in enumerate(WORD.finditer(text)):
        if not labels[i]:
            continue
        label, (a, b) = int(labels[i]), m.span()
        while next_ < len(taken) and taken[next_][1] <= a:
            next_ += 1
        over = [t for t in takewhile(lambda t: t[0] < b, islice(taken, next_, None)) if t[1] > a]
        if over:
            for x, y in [*over, (b, b)]:
                if a < x and _stands_alone(LABELS[label], text[a:x]):
                    runs.append([label, a, x])
                a = max(a, y)
            continue
        if runs and label == runs[-1][0] and open_ == i - 1:
            runs[-1][2] = b
        else:
            runs.append([label, a, b])
        whole = (ADDRESS if label == 1 else FOUR_PARTS).search(text, a, b) if label <= 2 else None
        open_ = -2 if whole else i
    spans = []
    for label, a, b in runs:
        while a < b and text[a] in EDGE and not (label == 4 and text[a] == "("):
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        address = "@" in text[a:b] or AT_WORD.search(text[a:b])
        if LABELS[label] == "email" and not address:
            continue
        if a < b:
            spans.append((LABELS[label], a, b))
    return spans


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _batches(batches: Iterator[pd.DataFrame], field: Field):
    for batch in batches:
        for at in range(0, len(batch), 64):
            part = batch.iloc[at : at + 64]
            texts = [t if isinstance(t, str) else "" for t in part["text"]]
            yield part, texts, list(find_spans(texts, field))


def fitted(spark: SparkSession, labelled: DataFrame | None = None) -> Field:
    """The field fitted to a labelled table (columns as in ``SCHEMA_LABELLED``), by default the invented one."""
    if labelled is None:
        labelled = spark.createDataFrame(labelled_table(), SCHEMA_LABELLED)
    return train(labelled.limit(LABELLED_ROWS + 1).toPandas())


def personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per document; columns as in ``RESULT``."""
    field = fitted(setup(docs.sparkSession), labelled)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, _, found in _batches(batches, field):
            counts = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS}
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"].astype("Int64").to_numpy(),
                    **counts,
                    "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found],
                    "spans": [joined(b + more) for b, more in found],
                }
            ).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, RESULT)


def covered(text: str, spans: list[Span]) -> str:
    """The text with a placeholder for each span; of overlapping spans the first one names it."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by placeholders; a null text stays null."""
    field = fitted(setup(docs.sparkSession), labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                given = part.column(at).to_pylist()
                texts = [t or "" for t in given]
                clean = [
                    None if old is None else covered(t, b + more)
                    for old, t, (b, more) in zip(given, texts, find_spans(texts, field), strict=True)
                ]
                columns = [*part.columns]
                columns[at] = pa.array(clean, pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, docs.schema)
