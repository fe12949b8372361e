"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of ``k`` word edits is split into ``k + 1`` pieces: wherever the item
stands with at most ``k`` edits, at least one piece stands unchanged. All pieces are searched at
once; every hit names a stretch of text, which Myers' bit-parallel distance then verifies.

The items are a stated query set against all rows. They are sent to the executors in blocks of
bounded size, so any number of items works.

Defined results: null and empty texts and items match nothing; repeated items match each on their
own; repeated documents give repeated results; items shorter than ``least_words`` are not searched,
as a few words can stand anywhere by chance (a parameter; by default all are searched).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.llm.text import per_slice, plain_words

MAX_BLOCK_BYTES = 8 << 20


def myers(pattern: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """Least word edits between the pattern and any stretch of the text, and the last word of the first such stretch.

    One integer holds the differences between neighbouring cells of a column, a bit per word of the pattern.
    """
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    places: dict[bytes, int] = {}
    for i, word in enumerate(pattern):
        places[word] = places.get(word, 0) | 1 << i
    up, down, score, best, end = full, 0, size, size, -1
    for at, word in enumerate(text):
        equal = places.get(word, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        plus, minus = down | (~(across | up) & full), up & across
        score += 1 if plus & top else -1 if minus & top else 0
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (~(vertical | plus) & full), plus & vertical
        if score < best:
            best, end = score, at
    return best, end


@dataclass
class Item:
    number: int
    words: list[bytes]
    budget: int

    def pieces(self) -> Iterator[tuple[int, list[bytes]]]:
        """``budget + 1`` pieces as even as possible, with the place of their first word."""
        count = self.budget + 1
        for i in range(count):
            start, end = i * len(self.words) // count, (i + 1) * len(self.words) // count
            yield start, self.words[start:end]


class Searcher:
    """The pieces of a block of items in one Aho-Corasick automaton over text with single spaces."""

    def __init__(self, items: list[tuple[int, str | None]], error_rate: float, least_words: int) -> None:
        self._items: list[Item] = []
        places: dict[str, list[tuple[int, int]]] = {}
        for number, text in items:
            words = plain_words(text)
            if len(words) < max(1, least_words):
                continue
            item = Item(number, words, min(int(len(words) * error_rate), len(words) - 1))
            self._items.append(item)
            for start, piece in item.pieces():
                key = " " + b" ".join(piece).decode() + " "
                places.setdefault(key, []).append((len(self._items) - 1, start))
        self._automaton = ahocorasick.Automaton()
        for key, owners in places.items():
            self._automaton.add_word(key, (key.count(" ") - 1, owners))
        if places:
            self._automaton.make_automaton()
        self._empty = not places

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """Item, edits, and first and last word of the stretch, once per item: the fewest edits, then the first."""
        words = plain_words(text)
        if self._empty or not words:
            return []
        joined = " " + b" ".join(words).decode() + " "
        stretches: dict[int, list[tuple[int, int]]] = {}
        counted = word = 0
        for end, (size, owners) in self._automaton.iter(joined):
            word += joined.count(" ", counted, end)
            counted = end
            for owner, start in owners:
                item = self._items[owner]
                first = word - size - start - item.budget
                stretches.setdefault(owner, []).append((max(0, first), first + len(item.words) + 2 * item.budget))
        out = []
        for owner, ranges in stretches.items():
            item, best = self._items[owner], None
            for first, last in _merged(ranges):
                edits, end = myers(item.words, words[first : last + 1])
                if edits <= item.budget and (best is None or edits < best[0]):
                    # The same distance from the back gives where the stretch begins.
                    reached = words[first : first + end + 1]
                    _, back = myers(item.words[::-1], reached[::-1])
                    best = (edits, first + end - back, first + end)
            if best:
                out.append((item.number, *best))
        return sorted(out)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str | None]]]:
    """The items, streamed to the driver partition by partition and cut into blocks of bounded size."""
    block, size = [], 0
    for number, text in items.select(id_col, text_col).toLocalIterator():
        grown = len(text.encode()) if text else 0
        if block and size + grown > block_bytes:
            yield block
            block, size = [], 0
        block.append((number, text))
        size += grown
    if block:
        yield block


def _shared(docs: DataFrame, block: list, error_rate: float, least_words: int):
    shared = docs.sparkSession.sparkContext.broadcast((block, error_rate, least_words))
    made: list[Searcher] = []

    def searcher() -> Searcher:
        if not made:
            made.append(Searcher(*shared.value))
        return made[0]

    return searcher


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.2,
    least_words: int = 1,
    block_bytes: int = MAX_BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item found in it: ids, ``edits``, ``first_word``, ``last_word`` (inclusive).

    The budget of an item is ``error_rate`` of its words, rounded down. Words are runs of ASCII letters
    and digits and non-ASCII characters, A-Z in lower case.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = [rows.schema["doc_id"].dataType, items.schema[item_id_col].dataType]
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, edits long, first_word long, last_word long"
    names = ["doc_id", "item_id", "edits", "first_word", "last_word"]
    found = None
    for block in item_blocks(items, item_id_col, item_text_col, block_bytes):
        searcher = _shared(docs, block, error_rate, least_words)

        def work(batch: pa.RecordBatch, searcher=searcher) -> pa.RecordBatch:
            hits = [searcher().find(t) for t in batch.column(1).to_pylist()]
            owner = pa.array([i for i, h in enumerate(hits) for _ in h], pa.int64())
            flat = [h for one in hits for h in one]
            numbers = pa.array([h[0] for h in flat], pa.int64() if kinds[1].typeName() == "long" else None)
            rest = [pa.array([h[i] for h in flat], pa.int64()) for i in (1, 2, 3)]
            return pa.record_batch([batch.column(0).take(owner), numbers, *rest], names)

        part = rows.mapInArrow(per_slice(work, "text"), schema)
        found = part if found is None else found.unionAll(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.2,
    least_words: int = 1,
    block_bytes: int = MAX_BLOCK_BYTES,
) -> DataFrame:
    """The documents in which no item is found, all columns unchanged; each block of items filters once."""
    at = docs.columns.index(text_col)
    for block in item_blocks(items, item_id_col, item_text_col, block_bytes):
        searcher = _shared(docs, block, error_rate, least_words)

        def work(batch: pa.RecordBatch, searcher=searcher) -> pa.RecordBatch:
            return batch.filter(pa.array([not searcher().find(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(per_slice(work, text_col), docs.schema)
    return docs
