"""BPE encoding and decoding of whole texts by walking a trie of distinct words.

BPE has an optimal-substructure property: the encoding of a prefix ends in exactly one token, and what precedes that
token is the encoding of the shorter prefix. So one state per trie node, its last token, is enough: it is the token t for
which the last token of the prefix without t and t would not have been merged in any other way. The words of a batch
are inserted into a trie, a depth-first walk gives every node its last token once, however many words
share the prefix, and a word's encoding is read off backwards. The last symbol of a word carries the end-of-word mark and so
is a separate leaf below the prefix.

Null and empty texts have no tokens and decode to the empty text. Repeated rows give repeated result rows. Columns
other than doc_id and text are ignored. A tokenizer file with other parts than those handled here is refused.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tarmac.llm.store import setup

# What a worker remembers over its tasks: bytes of encodings (an entry weighs ENTRY besides its contents; fewer where other
# stages share the worker), none of longer stretches; trie nodes before the trie starts anew; judged pairs of tokens.
REMEMBERED, REMEMBERED_IN_STAGES = 256 << 20, 64 << 20
ENTRY, LONGEST_REMEMBERED = 200, 64
TRIE_NODES = 300_000
PAIRS = 1_000_000
LETTERS_STAY = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    symbols = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [symbols[b] for b in range(256)]


class TrieEncoder:
    """Encodings of words, sharing the work of common prefixes."""

    def __init__(self, model: dict):
        self.end = model["end_of_word_suffix"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocabulary.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = self.vocabulary[a], self.vocabulary[b]
            self.rank[left, right] = rank
            self.parts.setdefault(self.vocabulary[a + b], (left, right))
        self.made_at = {token: self.rank[pair] for token, pair in self.parts.items()}
        self.symbols = byte_symbols()
        # A symbol with the end mark is one character of its own.
        self.closing = {c: chr(0xE000 + b) for b, c in enumerate(self.symbols)}
        self._compatible: dict[tuple[int, int], bool] = {}
        self._build_endings()
        self._reset()

    def forget(self) -> None:
        self._compatible.clear()
        self._reset()

    def _build_endings(self) -> None:
        """An automaton over token spellings; each state knows the tokens that end there, longest first."""
        self.next: list[dict[str, int]] = [{}]
        made: list[int] = [-1]
        depth = [0]
        for token, i in self.vocabulary.items():
            bare = token.removesuffix(self.end)
            spelling = bare if bare == token else bare[:-1] + self.closing[bare[-1]]
            state = 0
            for c in spelling:
                following = self.next[state].get(c)
                if following is None:
                    following = self.next[state][c] = len(self.next)
                    self.next.append({})
                    made.append(-1)
                    depth.append(depth[state] + 1)
                state = following
            made[state] = i
        self.fail = [0] * len(self.next)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        queue = [0]
        for state in queue:
            own = ((made[state], depth[state]),) if made[state] >= 0 else ()
            self.ending[state] = own + (self.ending[self.fail[state]] if state else ())
            for c, following in self.next[state].items():
                if state:
                    self.fail[following] = self._go(self.fail[state], c)
                queue.append(following)

    def _go(self, state: int, c: str) -> int:
        while True:
            following = self.next[state].get(c)
            if following is not None:
                return following
            if not state:
                return 0
            state = self.fail[state]

    def _reset(self) -> None:
        # A node is the prefix up to it: its last token, the node before that token, its automaton state.
        self.children: dict[tuple[int, str], int] = {}
        self.last: list[int] = [-1]
        self.before: list[int] = [-1]
        self.state: list[int] = [0]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens apart when their texts stand side by side."""
        key = (left, right)
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) > PAIRS:
                self._compatible.clear()
            known = self._compatible[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Undo the merges nearest the border, the latest first, looking for one across it that came earlier."""
        limit = len(self.rank) + 1
        while self.rank.get((left, right), limit) >= limit:
            made_left, made_right = self.made_at.get(left, -1), self.made_at.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                limit, left = made_left, self.parts[left][1]
            else:  # of equal merges the one further left comes first
                limit, right = made_right + 1, self.parts[right][0]
        return False

    def _step(self, path: list[int], state: int) -> tuple[int, int]:
        """Last token of the prefix one longer than ``path`` (nodes of the shorter ones), and the node before it."""
        n, last, known = len(path), self.last, self._compatible
        for token, size in self.ending[state]:
            node = path[n - size]
            if node == 0:
                return token, node
            left = last[node]
            apart = known.get((left, token))
            if apart or (apart is None and self.compatible(left, token)):
                return token, node
        raise ValueError("no token ends the prefix")

    def _tokens(self, token: int, node: int) -> list[int]:
        ids = [token]
        while node > 0:
            ids.append(self.last[node])
            node = self.before[node]
        return ids[::-1]

    def encode(self, words: list[str]) -> dict[str, list[int]]:
        """Insert the words in order (a depth-first order of the trie) and read their encodings."""
        result: dict[str, list[int]] = {}
        path, spelling = [0], ""
        children, states = self.children, self.state
        for word in sorted(words):
            inner, shared = word[:-1], 0
            for a, b in zip(spelling, inner, strict=False):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            for c in inner[shared:]:
                above = path[-1]
                node = children.get((above, c))
                if node is None:
                    state = self._go(states[above], c)
                    token, at = self._step(path, state)
                    node = children[above, c] = len(states)
                    self.last.append(token)
                    self.before.append(at)
                    states.append(state)
                path.append(node)
            spelling = inner
            closing = self._go(states[path[-1]], self.closing[word[-1]])
            result[word] = self._tokens(*self._step(path, closing))
            if len(states) > TRIE_NODES:
                self._reset()
                path, spelling = [0], ""
                children, states = self.children, self.state
        return result


class Tokenizer:
    """Encoding and decoding as the tokenizer file prescribes."""

    def __init__(self, spec: dict):
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        splits = [s["type"] for s in spec["pre_tokenizer"]["pretokenizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or splits != ["Split", "ByteLevel"]:
            raise ValueError(f"tokenizer parts not handled: {steps}, {splits}")
        if spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError("a decoder or post-processor is not handled")
        self.space = regex.compile(spec["normalizer"]["normalizers"][1]["pattern"]["Regex"])
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # With this pattern ASCII letters alone are one word, spelt as they are.
        self.letters_stay = self.words.pattern == LETTERS_STAY
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.markers = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.trie = TrieEncoder(spec["model"])
        self.names = self.trie.names | {i: t for t, i in self.special.items()}
        self.symbol_of = self.trie.symbols
        self.bound = REMEMBERED
        self.forget()

    def forget(self) -> None:
        """Drop what was remembered of earlier texts."""
        self.encoded: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}
        self.size = 0
        self.trie.forget()

    def normalise(self, text: str) -> str:
        # White space only separates, so that runs of it need no replacing. Lower-casing goes character by
        # character: a capital sigma never becomes the final form.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _spelling(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return "".join([self.symbol_of[b] for b in word.encode("utf-8", "replace")])

    def _words_of(self, chunk: str) -> list[str]:
        return [self._spelling(w) for w in self.words.findall(chunk)]

    def learn(self, chunks: set[str], decode: bool) -> tuple[dict[str, bytes], dict[str, str]]:
        """Encodings, and with ``decode`` decoded texts, of stretches without white space that are not remembered."""
        new = list(chunks.difference(self.decoded if decode else self.encoded))
        if not new:
            return {}, {}
        parts = {c: (c,) if self.letters_stay and c.isascii() and c.isalpha() else self._words_of(c) for c in new}
        ids = self.trie.encode(list({w for p in parts.values() for w in p}))
        encoded, decoded = {}, {}
        name_of = self.names.__getitem__
        for chunk, spellings in parts.items():
            tokens = ids[spellings[0]] if len(spellings) == 1 else [i for w in spellings for i in ids[w]]
            encoded[chunk] = pack(f"<{len(tokens)}I", *tokens)
            if decode:
                decoded[chunk] = " ".join(map(name_of, tokens))
        return encoded, decoded

    def _remember(self, encoded: dict[str, bytes], decoded: dict[str, str]) -> None:
        if self.size > self.bound:
            self.encoded, self.decoded, self.size = {}, {}, 0
        for chunk, ids in encoded.items():
            if len(chunk) <= LONGEST_REMEMBERED:
                self.encoded[chunk] = ids
                self.size += ENTRY + len(chunk) + len(ids)
                if chunk in decoded:
                    self.decoded[chunk] = decoded[chunk]
                    self.size += ENTRY + len(decoded[chunk])

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """Stretches of ordinary text and special tokens."""
        if "<|" not in text:
            yield False, text
            return
        for k, piece in enumerate(self.markers.split(text)):
            if piece:
                yield bool(k % 2), piece

    def split(self, text: str) -> list[str]:
        text = self.normalise(text)
        if SEPARATORS.search(text):  # white space for str.split, not for the tokenizer
            return [c for c in self.space.split(text) if c]
        return text.split()

    def encode_batch(self, texts: list[str], decode: bool = True) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian 32-bit integers, and the decoded text (empty unless ``decode``)."""
        for first in range(0, len(texts), 64):
            some = [
                [(special, p if special else self.split(p)) for special, p in self.pieces(text)]
                for text in texts[first : first + 64]
            ]
            chunks = {w for parts in some for special, p in parts if not special for w in p}
            fresh, spelled = self.learn(chunks, decode)
            fresh_or_known = {c: self.encoded[c] for c in chunks.difference(fresh)} | fresh
            ids_of = fresh_or_known.__getitem__
            text_of = ({c: self.decoded[c] for c in chunks.difference(spelled)} | spelled if decode else {}).__getitem__
            for parts in some:
                ids, spoken = [], []
                for special, p in parts:
                    if special:
                        ids.append(np.array([self.special[p]], "<u4").tobytes())
                        spoken.append(p)
                    else:
                        ids += map(ids_of, p)
                        if decode:
                            spoken += map(text_of, p)
                yield b"".join(ids), " ".join(filter(None, spoken)) if decode else ""
            self._remember(fresh, spelled)


@cache
def load(path: str) -> Tokenizer:
    with open(path, encoding="utf-8") as file:
        return Tokenizer(json.load(file))


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per document (columns as in ``SCHEMA``); ``path``: the tokenizer file, present on every worker."""
    setup(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(path)
        tokenizer.bound = REMEMBERED
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            rows = [
                (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(spoken.encode()).hexdigest())
                for ids, spoken in tokenizer.encode_batch(texts)
            ]
            frame = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield frame

    return docs.select("doc_id", "text").mapInPandas(run, SCHEMA)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, lang, source, n_tokens, ids) of ``docs``."""
    setup(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        tokenizer.bound = REMEMBERED_IN_STAGES
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x, _ in tokenizer.encode_batch(texts, decode=False)]
                ptr = np.cumsum([0, *map(len, ids)])
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "lang", "source")),
                        pa.array(np.diff(ptr), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), flat),
                    ],
                    ["doc_id", "lang", "source", "n_tokens", "ids"],
                )

    columns = docs.select("doc_id", "lang", "source", "text")
    types = {f.name: f.dataType.simpleString() for f in columns.schema}
    schema = f"doc_id {types['doc_id']}, lang {types['lang']}, source {types['source']}, n_tokens long, ids array<int>"
    return columns.mapInArrow(run, schema)
