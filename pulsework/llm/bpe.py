"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A sequence of tokens is what merging would
give exactly if every two neighbours are: so all neighbouring pairs of all proposals are tested
together, in arrays, and only words with a failing pair are merged step by step.

The vocabulary file has the tokenizers library's JSON form: byte-level pre-tokenizer, no
normalizer. It is read on the driver, checked against a size bound, and broadcast.

Defined results: a null or empty text has no tokens and decodes to an empty text; repeated rows
give repeated results; other columns than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.llm.text import per_slice

# How byte-level BPE cuts text before merging, and the file size that is safe to broadcast.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
MAX_VOCABULARY_BYTES = 64 << 20
_BYTES = 256
# Words up to this many bytes are merged together in arrays, longer ones with a queue each.
_SHORT = 48
# Bytes of text encoded at once: as single words they take some fifteen times as much.
_AT_ONCE = 1 << 20


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(_BYTES) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(_BYTES + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Tables of one vocabulary. Tokens are numbered inside by the step that makes them, bytes first."""

    def __init__(self, raw: str, keep_words: int = 200_000) -> None:
        spec = json.loads(raw)
        if spec.get("normalizer") or spec["model"]["type"] != "BPE":
            raise ValueError("only byte-level BPE without a normalizer is supported")
        chars = _byte_chars()
        vocab = {bytes(chars[c] for c in text): i for text, i in spec["model"]["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        pairs = [tuple(bytes(chars[c] for c in side) for side in m) for m in merges]
        self._special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self._special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for text, i in [*vocab.items(), *((t.encode(), i) for t, i in self._special.items())]:
            self.token_bytes[i] = text
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self._special)) + ")") if self._special else None
        step = {bytes([b]): b for b in range(_BYTES)}
        left, right = list(range(_BYTES)), list(range(_BYTES))
        joins: dict[tuple[int, int], int] = {}
        for a, b in pairs:
            if a + b in step:
                raise ValueError("a token is made by two merges")
            joins[step[a], step[b]] = step[a + b] = len(step)
            left.append(step[a])
            right.append(step[b])
        self._joins = joins
        self._ids = np.array([vocab[t] for t in step], np.int64)
        width = np.int64(len(step))
        keys = np.array([a * width + b for a, b in joins], np.int64)
        order = np.argsort(keys)
        self._keys, self._made, self._width = keys[order], np.array([*joins.values()], np.int64)[order], width
        self._lefts, self._rights = np.array(left), np.array(right)
        made = np.arange(_BYTES, len(step))
        sound = np.ones(len(step), bool)
        sound[_BYTES:] = self._compatible(self._lefts[made], self._rights[made], made)
        for token in range(_BYTES, len(step)):
            sound[token] &= sound[left[token]] and sound[right[token]]
        self._grow_trie({text: i for text, i in step.items() if sound[i]})
        self._shown = Texts([b"%d," % i for i in range(size)])
        self._bytes = Texts(self.token_bytes)
        self._keep_words = keep_words
        self._forget()

    @property
    def step_ids(self) -> np.ndarray:
        """The id of the token that each step makes, bytes first and then in the order of the merges."""
        return self._ids

    @property
    def special_ids(self) -> dict[str, int]:
        return self._special

    def _grow_trie(self, tokens: dict[bytes, int]) -> None:
        """Tokens that merging can make, as sorted edges (node and byte) with the nodes they lead to.

        A node has few edges, so a table of all bytes would be nearly empty, and a hundred times as large in each worker.
        """
        nodes, edges, ends = {b"": 0}, {}, {}
        for text, token in tokens.items():
            for i in range(1, len(text) + 1):
                if text[:i] not in nodes:
                    nodes[text[:i]] = len(nodes)
                    edges[nodes[text[: i - 1]] * _BYTES + text[i - 1]] = nodes[text[:i]]
            ends[nodes[text]] = token
        self._edges = np.array(sorted(edges), np.int64)
        self._below = np.array([edges[e] for e in self._edges.tolist()], np.int64)
        self._ends = np.full(len(nodes), -1, np.int32)
        self._ends[[*ends]] = [*ends.values()]

    def _forget(self) -> None:
        self._known: dict[str | int, int] = {}
        self._flat, self._sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbours: would merging leave the boundary between them?

        Undoes the later of the two tokens again and again, as merging made the earlier ones
        first; the boundary falls if the tokens then beside it merge before the undone step.
        A tie goes to the boundary, as merging works from the left.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max) if limit is None else limit
        while len(at):
            key = a * self._width + b
            place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            falls = (self._keys[place] == key) & (self._made[place] < limit)
            good[at[falls]] = False
            on = ~falls & ((a >= _BYTES) | (b >= _BYTES))
            a, b, at = a[on], b[on], at[on]
            later = a > b
            limit = np.where(later, a, b + 1)
            a, b = np.where(later, self._rights[a], a), np.where(later, b, self._lefts[b])
        return good

    def _propose(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match in all words at once: tokens in word order, and each token's word."""
        size, token = np.zeros(len(raw), np.int64), np.full(len(raw), -1, np.int64)
        stop = np.repeat(ends, ends - starts)
        at, node, depth = np.arange(len(raw)), np.zeros(len(raw), np.int64), 0
        while len(at):
            key = node * _BYTES + raw[at + depth]
            place = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
            goes = self._edges[place] == key
            at, node = at[goes], self._below[place[goes]]
            depth += 1
            found = self._ends[node]
            size[at[found >= 0]], token[at[found >= 0]] = depth, found[found >= 0]
            inside = at + depth < stop[at]
            at, node = at[inside], node[inside]
        word, at, tokens, words = np.arange(len(starts)), starts, [], []
        while len(at):
            tokens.append(token[at])
            words.append(word)
            at = at + size[at]
            more = at < ends[word]
            at, word = at[more], word[more]
        order = np.argsort(np.concatenate(words), kind="stable")
        return np.concatenate(tokens)[order], np.concatenate(words)[order]

    def _merge_all(self, tokens: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many short words: in each round the earliest rule of every word, leftmost first."""
        done_tokens, done_words = [], []
        while len(tokens):
            key = tokens[:-1] * self._width + tokens[1:]
            place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            rule = np.where((self._keys[place] == key) & (words[:-1] == words[1:]), self._made[place], self._width)
            rule = np.append(rule, self._width)
            begins = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
            first = np.minimum.reduceat(rule, begins)
            each = np.repeat(first, np.diff(np.append(begins, len(words))))
            over = each == self._width
            done_tokens.append(tokens[over])
            done_words.append(words[over])
            hit = np.flatnonzero((rule == each) & ~over)
            hit = hit[np.append(True, words[hit][1:] != words[hit][:-1])] if len(hit) else hit
            tokens[hit] = rule[hit]
            keep = ~over
            keep[hit + 1] = False
            tokens, words = tokens[keep], words[keep]
        words = np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return np.concatenate(done_tokens)[order], words[order]

    def _merge(self, word: bytes) -> list[int]:
        """Exact merging: always the earliest rule, leftmost first."""
        tokens = list(word)
        after, before = [*range(1, len(tokens)), -1], list(range(-1, len(tokens) - 1))
        queue = [
            (made, i, tokens[i], tokens[i + 1])
            for i in range(len(tokens) - 1)
            if (made := self._joins.get((tokens[i], tokens[i + 1]))) is not None
        ]
        heapq.heapify(queue)
        while queue:
            made, i, left, right = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != left or j < 0 or tokens[j] != right:
                continue
            tokens[i], tokens[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (made := self._joins.get((tokens[x], tokens[y]))) is not None:
                    heapq.heappush(queue, (made, x, tokens[x], tokens[y]))
        return [t for t in tokens if t >= 0]

    def learn(self, words: set[str | int]) -> None:
        """Encode words not met before, together; an integer stands for a special token."""
        if len(self._known) > self._keep_words:
            self._forget()
        new = list(words.difference(self._known))
        special = [w for w in new if isinstance(w, int)]
        new = [w for w in new if not isinstance(w, int)]
        if new:
            self._add(new, *self._encode_words([w.encode() for w in new]))
        if special:
            self._add(special, np.array(special), np.arange(len(special)))

    def _add(self, words: list[str | int], ids: np.ndarray, owner: np.ndarray) -> None:
        self._known.update(zip(words, range(len(self._known), len(self._known) + len(words))))
        self._flat = np.concatenate([self._flat, ids.astype(np.int32)])
        self._sizes = np.concatenate([self._sizes, np.bincount(owner, minlength=len(words))])

    def _encode_words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        tokens, owner = self._propose(raw, ends - sizes, ends)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        bad = ~self._compatible(tokens[inner], tokens[inner + 1])
        failed = np.zeros(len(texts), bool)
        failed[owner[inner[bad]]] = True
        short = failed & (sizes <= _SHORT)
        parts = [(tokens[~failed[owner]], owner[~failed[owner]])]
        if short.any():
            byte_owner = np.repeat(np.arange(len(texts)), sizes)
            some = short[byte_owner]
            parts.append(self._merge_all(raw[some].astype(np.int64), byte_owner[some]))
        for i in np.flatnonzero(failed & ~short).tolist():
            merged = np.array(self._merge(texts[i]))
            parts.append((merged, np.full(len(merged), i)))
        owner = np.concatenate([o for _, o in parts])
        order = np.argsort(owner, kind="stable")
        return self._ids[np.concatenate([t for t, _ in parts])[order]], owner[order]

    def _words(self, text: str) -> list[str | int]:
        """Pieces of a text; a special token is the number of its id instead of a piece."""
        if self._cut is None or not any(t in text for t in self._special):
            return _PIECES.findall(text)
        out: list[str | int] = []
        for i, part in enumerate(self._cut.split(text)):
            out.extend([self._special[part]] if i % 2 else _PIECES.findall(part))
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one offset more than texts)."""
        words = [self._words(text) if text else [] for text in texts]
        self.learn(set().union(*words))
        pieces = np.cumsum([0, *map(len, words)])
        code = np.fromiter((c for one in words for c in map(self._known.__getitem__, one)), np.int64, pieces[-1])
        sizes = self._sizes[code]
        offsets = np.append(0, np.cumsum(sizes))
        starts = np.cumsum(self._sizes) - self._sizes
        ids = self._flat[np.repeat(starts[code] - offsets[:-1], sizes) + np.arange(offsets[-1])]
        return ids, offsets[pieces]

    def shown(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return self._shown.of(ids)[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return self._bytes.of(ids).decode("utf-8", "replace")


class Texts:
    """Byte strings by number, to be joined many at a time."""

    def __init__(self, texts: list[bytes], at_once: int = 1 << 18) -> None:
        self._sizes = np.array([len(t) for t in texts])
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._flat = np.frombuffer(b"".join(texts), np.uint8)
        self._at_once = at_once

    def of(self, numbers: np.ndarray) -> bytes:
        out = []
        for i in range(0, len(numbers), self._at_once):
            part = numbers[i : i + self._at_once]
            sizes = self._sizes[part]
            ends = np.cumsum(sizes)
            out.append(self._flat[np.repeat(self._starts[part] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(raw: str) -> Encoder:
    return Encoder(raw)


def special_id(path: str, content: str) -> int:
    """The id of a special token of the vocabulary file."""
    with open(path, encoding="utf-8") as file:
        return next(t["id"] for t in json.load(file)["added_tokens"] if t["content"] == content)


def share_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file for all executors; its size is checked, as a broadcast must stay small."""
    with open(path, encoding="utf-8") as file:
        raw = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(raw)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens`` and ``ids``: the ids of the whole text."""
    shared = share_vocabulary(docs.sparkSession, vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = encoder(shared.value).encode(batch.column(1).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return pa.record_batch([batch.column(0), pa.array(np.diff(offsets), pa.int64()), lists], names)

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    names = [id_col, "n_tokens", "ids"]
    return rows.mapInArrow(per_slice(work, text_col, _AT_ONCE), f"`{id_col}` {_kind(rows, id_col)}, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``; null ids give a null text."""
    shared = share_vocabulary(encoded.sparkSession, vocabulary)

    def run(batches):
        for batch in batches:
            decoder = encoder(shared.value)
            texts = [None if ids is None else decoder.decode(np.array(ids, np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    rows = encoded.select(F.col(id_col), F.col(ids_col))
    return rows.mapInArrow(run, f"`{id_col}` {_kind(rows, id_col)}, text string")


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, decode the ids, and report both by their digests.

    Columns: ``id_col``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas),
    ``decoded_sha256`` (the decoded text in UTF-8) and ``same``, whether the text came back.
    """
    shared = share_vocabulary(docs.sparkSession, vocabulary)
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "same"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, texts = encoder(shared.value), batch.column(1).to_pylist()
        ids, offsets = coder.encode(texts)
        each = [ids[a:b] for a, b in zip(offsets, offsets[1:])]
        back = [coder.decode(i) for i in each]
        return pa.record_batch(
            [
                batch.column(0),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array([hashlib.sha256(coder.shown(i)).hexdigest() for i in each], pa.string()),
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string()),
                pa.array([b == (t or "") for b, t in zip(back, texts)], pa.bool_()),
            ],
            names,
        )

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(
        per_slice(work, text_col, _AT_ONCE),
        f"`{id_col}` {_kind(rows, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean",
    )
