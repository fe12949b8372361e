"""Spelling variants: words one edit apart, found in K-d trees over letter counts.

A word's letter counts are a point. One inserted or deleted letter moves it by 1 in one dimension, one replaced letter by
1 up and 1 down in two: the L1 distance is at most two. For each word length there is a tree of letter counts;
a word is looked up in the tree of its own length (replaced letters) and in that of the next length (inserted
letters), and parts of a tree whose box lies too far off are left out. What stays within the distance is compared letter by letter.

Trees are fitted on a bounded sample of the vocabulary (``SAMPLE`` words, told by their hash) and broadcast. Their leaves are cells;
every word is dealt to its own cell and, as a question, to every cell within reach. A cell's words and questions are
dealt in blocks of bounded size, each pair of blocks to one task, which grows a tree of its own with small leaves. So the
sample decides the sizes of cells only, not the result: no pair is lost.

Defined results: a null or empty text has no words; for a null id the text before the colon is empty; repeated rows count as
often as they stand there; words of any length are compared; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.llm.text import by_bytes
from pulsework.session import new_work_dir

#: Words of the vocabulary that trees are fitted on, about; and words aimed at for a cell.
SAMPLE = 50_000
CELL = 4_000
#: Bytes of a block of a cell's words and of its questions, each word with its 90 counts.
WORD_BLOCK, QUESTION_BLOCK = 8 << 20, 32 << 20

# In Latin-1 each letter is one byte: A-Z become a-z, letters from U+00C0 on stay, all else parts words.
_RUNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_DIMS = 26 + 0x40
_DIM = np.array([b - 97 if 97 <= b <= 122 else b - 0xC0 + 26 if b >= 0xC0 else 0 for b in range(256)])


@dataclass(frozen=True)
class Rules:
    #: A word of every ``every`` by hash loses a letter.
    every: int = 199
    least_letters: int = 6
    least_count: int = 5
    #: How many times as frequent a form must be.
    ratio: int = 5


def letter_runs(text: str | None) -> list[bytes]:
    """Words in Latin-1, one byte per letter, in their order."""
    return text.encode("latin-1", "replace").translate(_RUNS).split() if text else []


def damaged(start: int, run: bytes, every: int) -> bytes:
    """The run without a letter if its hash says so; ``start`` is the CRC-32 of what stands before it."""
    code = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if code % every:
        return run
    at = code % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id_col: str, text_col: str, rules: Rules) -> DataFrame:
    """``word`` and ``n``, how often it stands in all texts."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in found], pa.string())
            batch = pa.record_batch([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])
            found.clear()
            return batch

        for batch in by_bytes(batches, "text"):
            for owner, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{'' if owner is None else owner}:".encode())
                # Shorter runs cannot become words.
                for one, n in Counter(w for w in letter_runs(text) if len(w) >= rules.least_letters).items():
                    found[damaged(start, one, rules.every)] += n
            if len(found) > 200_000:
                yield counted()
        yield counted()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter((F.col("n") >= rules.least_count) & (F.char_length("word") >= rules.least_letters))


def letters(words: list[str]) -> np.ndarray:
    """The letters of words of one length, a row of bytes per word."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    count = len(rows)
    flat = _DIM[rows] + np.arange(count)[:, None] * _DIMS
    return np.bincount(flat.ravel(), minlength=count * _DIMS).reshape(count, _DIMS).astype(np.int32)


class Tree:
    """A K-d tree over letter counts: splits and, per leaf, the numbers of the points it was grown from."""

    def __init__(self, points: np.ndarray, leaf_size: int) -> None:
        #: Per node: dimension (-1 for a leaf), cut (to the left: at most this count), left and right node or number of the leaf.
        self.nodes: list[tuple[int, int, int, int]] = []
        self.leaves: list[np.ndarray] = []
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:
            here, parent, side = todo.pop()
            if parent >= 0:
                node = list(self.nodes[parent])
                node[2 + side] = len(self.nodes)
                self.nodes[parent] = tuple(node)
            dim, cut = self._split(points[here]) if len(here) > leaf_size else (-1, 0)
            if dim < 0:
                self.nodes.append((-1, 0, len(self.leaves), 0))
                self.leaves.append(here)
                continue
            low = points[here, dim] <= cut
            todo += [(here[~low], len(self.nodes), 1), (here[low], len(self.nodes), 0)]
            self.nodes.append((dim, cut, 0, 0))

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int]:
        """The dimension that varies most, at its median; (-1, 0) if all points are the same."""
        dim = int(np.argmax(points.var(axis=0)))
        values = points[:, dim]
        cut = int(np.median(values))
        if cut >= values.max():
            cut = int(values.max()) - 1
        return (dim, cut) if values.min() <= cut else (-1, 0)

    def reached(self, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves whose box can be reached from a point by adding ``up`` and taking away ``down`` at most, with these points."""
        none = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)), none, none, {}, {})]
        while todo:
            at, who, added, taken, low, high = todo.pop()
            dim, cut, left, right = self.nodes[at]
            if dim < 0:
                yield left, who
                continue
            value = points[who, dim]
            more = np.maximum(value - cut, 0) - (np.maximum(value - high[dim], 0) if dim in high else 0)
            near = taken + more <= down
            if near.any():
                todo.append((left, who[near], added[near], (taken + more)[near], low, high | {dim: cut}))
            more = np.maximum(cut + 1 - value, 0) - (np.maximum(low[dim] - value, 0) if dim in low else 0)
            near = added + more <= up
            if near.any():
                todo.append((right, who[near], (added + more)[near], taken[near], low | {dim: cut + 1}, high))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.count_nonzero(a != b, axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Is a row of ``long`` that of ``short`` with one more letter? The equal beginning and end must cover the short one."""
    size = short.shape[1]
    begin = np.logical_and.accumulate(short == long[:, :size], axis=1).sum(axis=1)
    end = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return begin + end >= size


def search(words: list[str], asked: list[str], at_once: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of ``asked`` and ``words`` one edit apart. All ``words`` have one length, all ``asked`` the same or one less."""
    mine, questions = letters(words), letters(asked)
    # Squared distances of counts are exact in these types, and a matrix product gives many at once.
    kind = np.float32 if mine.shape[1] < 2_000 else np.float64
    points = letter_counts(mine)
    same = mine.shape[1] == questions.shape[1]
    tree = Tree(points, 64)
    floats = points.astype(kind)
    squares = (floats * floats).sum(axis=1)
    for begin in range(0, len(asked), at_once):
        part = questions[begin : begin + at_once]
        counts = letter_counts(part)
        other = counts.astype(kind)
        for leaf, who in tree.reached(counts, 1, 1 if same else 0):
            here = tree.leaves[leaf]
            near = (other[who] ** 2).sum(axis=1)[:, None] + squares[here] - 2 * (other[who] @ floats[here].T)
            # With these lengths a squared distance of 2 (1) is an L1 distance of 2 (1).
            i, j = np.nonzero(near == (2 if same else 1))
            if len(i):
                a, b = part[who[i]], mine[here[j]]
                good = one_replaced(a, b) if same else one_inserted(a, b)
                yield who[i[good]] + begin, here[j[good]]


def _written(df: DataFrame, label: str) -> DataFrame:
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes).tolist():
        yield size, np.flatnonzero(sizes == size)


def fitted(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, Tree]:
    """A tree per word length from about ``sample`` words at most; a length without one is a single cell."""
    part = -(-words.count() // sample) or 1
    some = words.filter(F.pmod(F.xxhash64("word"), F.lit(part)) == 0).select("word").toArrow().column(0).to_pylist()
    trees = {}
    for size, here in _by_length(some):
        trees[size] = Tree(letter_counts(letters([some[i] for i in here])), max(8, cell // part))
        trees[size].leaves = []  # places are all that is broadcast
    return trees


def _dealt(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Each word in its own cell, and as a question in all cells within one edit: ``size``, ``leaf``, ``asks``, ``word``, ``n``."""
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def reached(size: int, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        tree = shared.value.get(size)
        return tree.reached(points, up, down) if tree else iter([(0, np.arange(len(points)))])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "word", 1 << 20):
            words = batch.column(0).to_pylist()
            for size, here in _by_length(words):
                points = letter_counts(letters([words[i] for i in here]))
                for length, up, down, asks in ((size, 0, 0, 0), (size, 1, 1, 1), (size + 1, 1, 0, 1)):
                    for leaf, who in reached(length, points, up, down):
                        rows = pa.array(here[who])
                        fixed = [pa.array(np.full(len(who), v, np.int32)) for v in (length, leaf, asks)]
                        yield pa.record_batch(
                            [*fixed, batch.column(0).take(rows), batch.column(1).take(rows)], ["size", "leaf", "asks", "word", "n"]
                        )

    return words.select("word", "n").mapInArrow(run, "size int, leaf int, asks int, word string, n long")


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL, block: int = WORD_BLOCK, asked: int = QUESTION_BLOCK) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for all pairs one edit apart, in both directions."""
    dealt = _written(_dealt(words, fitted(words, sample, cell)), "cells")
    weight = F.char_length("word") + 4 * _DIMS
    sizes = dealt.groupBy("size", "leaf").agg(
        F.ceil(F.sum(F.when(F.col("asks") == 0, weight)) / block).cast("int").alias("blocks"),
        F.ceil(F.sum(F.when(F.col("asks") == 1, weight)) / asked).cast("int").alias("turns"),
    )
    # A cell without words answers nothing.
    placed = dealt.join(sizes.filter("blocks is not null"), ["size", "leaf"])
    own, code = F.col("asks") == 0, F.xxhash64("word")
    blocks = F.when(own, F.array(F.pmod(code, "blocks").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    turns = F.when(own, F.sequence(F.lit(0), F.col("turns") - 1)).otherwise(F.array(F.pmod(code, "turns").cast("int")))
    placed = placed.select("size", "leaf", "asks", "word", "n", F.explode(blocks).alias("block"), "turns", "blocks").select(
        "size", "leaf", "asks", "word", "n", "block", F.explode(turns).alias("turn")
    )

    def run(table: pa.Table) -> pa.Table:
        asks = np.asarray(table["asks"]) == 1
        word, n = table["word"].to_pylist(), np.asarray(table["n"])
        mine, questions = np.flatnonzero(~asks), np.flatnonzero(asks)
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        if len(mine):
            names = [word[i] for i in mine]
            size = len(names[0])
            for length, here in _by_length([word[i] for i in questions]):
                some = questions[here]
                for a, b in search(names, [word[i] for i in some]):
                    a, b = some[a], mine[b]
                    rows.append((a, b))
                    if length < size:
                        rows.append((b, a))
        left = np.concatenate([a for a, _ in rows]) if rows else np.zeros(0, np.int64)
        right = np.concatenate([b for _, b in rows]) if rows else np.zeros(0, np.int64)
        words = pa.array(word, pa.string())
        return pa.table([words.take(pa.array(left)), words.take(pa.array(right)), pa.array(n[right])], ["word", "near", "near_n"])

    return placed.groupBy("size", "leaf", "block", "turn").applyInArrow(run, "word string, near string, near_n long")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the texts.

    ``form`` is the most frequent word one edit apart (ties: the first in code-point order) if it is ``ratio`` times as
    frequent, and ``root`` the last word on the way from form to form.
    """
    words = _written(vocabulary(docs, id_col, text_col, rules), "words")
    # The least of (-n, word): the most frequent, then the first.
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.n") >= F.col("n") * rules.ratio
    forms = _written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    links = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    # Each step multiplies the count by the ratio, so the longest way is short; every round doubles what it covers.
    most, steps = forms.agg(F.max("form_n")).first()[0] or 0, 1
    while rules.least_count * rules.ratio ** (steps + 1) <= most:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        links = _written(links.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root")), "roots")
        steps *= 2
    return forms.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
