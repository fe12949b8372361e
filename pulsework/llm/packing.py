"""Vector bin packing: examples into sequences under limits on tokens, segments and loss-bearing tokens at the same time.

An example is a list of parts, each a text that bears loss or not (a document is one part that does; the turns of a
conversation are parts of which the answers do). Its ids and an end id are cut where a limit demands it. What is
left of it is an item with a demand in three dimensions. A sequence is filled by the item that fits and has the largest dot
product of its demand and the sequence's free space, each relative to the limits and weighted by the demand of all
items. If none fits, an item is cut to fill the rest. So sequences are full but for ``slack`` tokens, unless a limit
on segments or loss stops them first.

Each task packs the rows it reads in windows of bounded size and carries what is not packed into the next window. There is
no shuffle; a task's last sequence alone is cut at powers of two, which need no padding. A lost task repeats to the same rows, as
numbers of sequences depend on the partition alone.

Defined results: null or empty texts, no parts and null parts give an example with only the end id; a null id stays null; a null ``loss`` is
false; repeated rows are examples of their own; a text of any length is cut, whole; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pulsework.llm import bpe
from pulsework.llm.token_ids import token_ids

PARTS = "array<struct<text: string, loss: boolean>>"


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 512
    loss: int = 1024
    #: Free tokens for which no example is cut.
    slack: int = 4

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit must be at least 1")


@dataclass
class Item:
    """A run of ids of one example: ``loss`` counts its loss-bearing tokens up to each place (one value more than ids)."""

    owner: object
    total: int
    start: int
    ids: np.ndarray
    loss: np.ndarray

    @property
    def bearing(self) -> int:
        return int(self.loss[-1] - self.loss[0])

    def cut(self, tokens: int, loss: int) -> tuple[Item | None, Item | None]:
        """The longest beginning within ``tokens`` and ``loss``, and the rest."""
        at = min(tokens, int(np.searchsorted(self.loss, self.loss[0] + loss, "right")) - 1)
        at = min(at, len(self.ids))
        head = Item(self.owner, self.total, self.start, self.ids[:at], self.loss[: at + 1]) if at else None
        rest = Item(self.owner, self.total, self.start + at, self.ids[at:], self.loss[at:]) if at < len(self.ids) else None
        return head, rest


class _Pool:
    """Items by demand. Equal demands are one class, so that a choice is one pass over few classes."""

    def __init__(self, items: list[Item], limits: Limits) -> None:
        self.limits = limits
        self._members: dict[tuple[int, int], list[Item]] = {}
        for item in reversed(items):
            self._members.setdefault((len(item.ids), item.bearing), []).append(item)
        self._classes = sorted(self._members, reverse=True)
        self._tokens, self._loss = (np.array([c[i] for c in self._classes], np.int64) for i in (0, 1))
        self._place = {c: i for i, c in enumerate(self._classes)}
        self._here = np.ones(len(self._classes), bool)
        self.tokens, self.count = sum(len(i.ids) for i in items), len(items)
        # Weights: what all items demand of each limit.
        self._weight = np.array([self.tokens / limits.tokens, self.count / limits.segments, sum(i.bearing for i in items) / limits.loss])

    def take(self, tokens: int, segments: int, loss: int) -> Item | None:
        """The item that fits and has the largest dot product with the free space; ties: the first in order of demand."""
        fits = self._here & (self._tokens <= tokens) & (self._loss <= loss)
        if segments < 1 or not fits.any():
            return None
        limits, weight = self.limits, self._weight
        dot = self._tokens * (weight[0] * tokens / limits.tokens**2) + self._loss * (weight[2] * loss / limits.loss**2)
        dot += weight[1] * segments / limits.segments**2
        return self._pop(int(np.argmax(np.where(fits, dot, -1.0))))

    def largest(self) -> Item | None:
        """The item with the most tokens, to be cut."""
        return self._pop(int(np.argmax(self._here))) if self.count else None

    def _pop(self, place: int) -> Item:
        members = self._members[self._classes[place]]
        item = members.pop()
        self._here[place] = bool(members)
        self.tokens, self.count = self.tokens - len(item.ids), self.count - 1
        return item

    def put(self, item: Item) -> None:
        kind = (len(item.ids), item.bearing)
        if kind not in self._place:
            at = int(np.searchsorted([-c[0] for c in self._classes], -kind[0]))
            self._classes.insert(at, kind)
            self._members[kind] = []
            self._tokens, self._loss = np.insert(self._tokens, at, kind[0]), np.insert(self._loss, at, kind[1])
            self._here = np.insert(self._here, at, False)
            self._place = {c: i for i, c in enumerate(self._classes)}
        self._members[kind].append(item)
        self._here[self._place[kind]] = True
        self.tokens, self.count = self.tokens + len(item.ids), self.count + 1

    def rest(self) -> list[Item]:
        return [item for kind in self._classes for item in reversed(self._members[kind])]


def fill(items: list[Item], limits: Limits, keep: int) -> tuple[list[list[Item]], list[Item]]:
    """Sequences of ``items``, and the items left once fewer than ``keep`` tokens remain (0: all are packed).

    With ``keep`` at 0 the last sequence may be short.
    """
    pool, done = _Pool(items, limits), []
    while pool.count and pool.tokens >= keep:
        sequence, free, segments, loss = [], limits.tokens, limits.segments, limits.loss
        while (item := pool.take(free, segments, loss)) is not None:
            sequence.append(item)
            free, segments, loss = free - len(item.ids), segments - 1, loss - item.bearing
        if free > limits.slack and segments and pool.count:
            head, rest = pool.largest().cut(free, loss)
            if head:
                sequence.append(head)
            if rest:
                pool.put(rest)
        done.append(sequence)
    return done, pool.rest()


def at_powers(sequence: list[Item], limits: Limits) -> list[list[Item]]:
    """A short last sequence as sequences of 512, 256, ... tokens, the powers of two in its length."""
    size, out, queue = sum(len(i.ids) for i in sequence), [], list(sequence)
    if limits.tokens - size <= limits.slack:
        return [sequence]
    while size:
        need = 1 << (size.bit_length() - 1)
        size -= need
        part = []
        while need:
            head, rest = queue.pop(0).cut(need, limits.loss)
            part.append(head)
            need -= len(head.ids)
            if rest:
                queue.insert(0, rest)
        out.append(part)
    return out


def _items(owner: object, parts: list[dict] | None, coder, end: int) -> Item:
    parts = [p for p in parts or [] if p]
    ids = [coder.of(p["text"]) for p in parts]
    bears = [bool(p["loss"]) for p in parts]
    # The end id bears loss if the last part does.
    flat = np.concatenate([*ids, np.array([end], np.uint32)]).astype("<u4")
    marks = np.repeat([*bears, bears[-1] if bears else False], [*map(len, ids), 1])
    return Item(owner, len(flat), 0, flat, np.append(0, np.cumsum(marks)))


def _slices(batch: pa.RecordBatch, limit: int) -> Iterator[list[tuple]]:
    """Rows whose texts have at most ``limit`` bytes together; a longer one comes alone."""
    lists = batch.column(1)
    sizes = np.asarray(pc.fill_null(pc.binary_length(pc.struct_field(lists.flatten(), 0)), 0), np.int64)
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64))
    part = np.append(0, np.cumsum(sizes))[ends] // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield list(zip(batch.column(0).slice(a, b - a).to_pylist(), lists.slice(a, b - a).to_pylist()))


def pack(
    examples: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    parts_col: str = "parts",
    limits: Limits = Limits(),
    end: int = 0,
    window: int = 1 << 20,
) -> DataFrame:
    """Pieces of all examples and where they stand. ``parts_col`` is of the type ``PARTS``.

    Columns: ``id_col``, ``start`` (ids of the example before the piece), ``length``, ``loss_tokens``, ``ids`` (32-bit little-endian),
    ``doc_tokens`` (ids of the whole example, end included), ``sequence_id``, ``offset`` in the sequence, and ``padded_to``, the
    sequence's length: its tokens if these are a power of two, else the limit.
    """
    shared = bpe.share_vocabulary(examples.sparkSession, vocabulary)
    rows = examples.select(F.col(id_col).alias("id"), F.col(parts_col).cast(PARTS).alias("parts"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "loss_tokens", "ids", "doc_tokens", "sequence_id", "offset", "padded_to"]
    kinds = [to_arrow_type(rows.schema["id"].dataType), *[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 4]

    def run(batches) -> Iterator[pa.RecordBatch]:
        coder, number = token_ids(shared.value), TaskContext.get().partitionId() << 33
        pool: list[Item] = []
        waiting, out = 0, []

        def emit(sequences: list[list[Item]]) -> None:
            nonlocal number
            for sequence in sequences:
                size, at = sum(len(i.ids) for i in sequence), 0
                padded = size if size & (size - 1) == 0 else limits.tokens
                for i in sequence:
                    out.append((i.owner, i.start, len(i.ids), i.bearing, i.ids.tobytes(), i.total, number, at, padded))
                    at += len(i.ids)
                number += 1

        def ready() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out.clear()
            return batch

        for batch in batches:
            for some in _slices(batch, 1 << 20) if batch.num_rows else ():
                for owner, parts in some:
                    item = _items(owner, parts, coder, end)
                    while len(item.ids) > limits.tokens or item.bearing > limits.loss:
                        head, item = item.cut(limits.tokens, limits.loss)
                        if len(head.ids) == limits.tokens:
                            emit([[head]])
                        else:
                            pool.append(head)
                            waiting += len(head.ids)
                    if len(item.ids) == limits.tokens:
                        emit([[item]])
                    else:
                        pool.append(Item(owner, item.total, item.start, item.ids.copy(), item.loss.copy()))
                        waiting += len(item.ids)
                    if waiting >= window or len(pool) >= window >> 4:
                        done, pool = fill(pool, limits, keep=waiting // 8)
                        waiting = sum(len(i.ids) for i in pool)
                        emit(done)
                    if len(out) >= 1 << 12:
                        yield ready()
        done, _ = fill(pool, limits, keep=0)
        emit(done[:-1])
        emit(at_powers(done[-1], limits) if done else [])
        if out:
            yield ready()

    schema = (
        f"id {kind}, start long, length long, loss_tokens long, ids binary, doc_tokens long, sequence_id long, offset long, padded_to long"
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def document_parts(text: Column) -> Column:
    """A document as one part that bears loss."""
    return F.array(F.struct(F.coalesce(text.cast("string"), F.lit("")).alias("text"), F.lit(True).alias("loss")))
