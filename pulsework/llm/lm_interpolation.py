"""Language-model scoring by deleted interpolation.

Maximum-likelihood estimates of word trigrams, bigrams and unigrams and a uniform one are mixed. The
weights depend on how often the context occurs (one set per power of two of its count) and are learned by
expectation-maximisation on documents that the counts leave out. Scores then use the counts of all
training documents.

The counts grow with the corpus and never meet in one place. Documents are packed into blocks; a
block asks for each of its distinct n-grams once, in messages dealt by ranges of the n-gram's hash;
the messages of a range are its counts as well as its questions. So an n-gram with a third of all
occurrences is one entry per block. Words are told apart by 64-bit hashes, longer n-grams by so many bits that one in a million of
them shares its hash with another, at any size of the corpus.

Defined results: a null or empty text is its end token alone; a null id is folded like an empty one;
repeated rows are scored each and count each; without training tokens every estimate but the uniform one is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsework.llm.text import WordHashes, by_bytes, lower_words, mix
from pulsework.session import new_work_dir

_BEGIN, _END = np.uint64(0x5BF0A8B1457695A3), np.uint64(0xC3A5C85C97CB3127)
_FIT, _TUNE, _HELD = 0, 1, 2
_LEVELS = (1, 2, 3)
_CONTEXTS = 128


def _packed(array: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, so that equal high bytes lie together."""
    planes = np.ascontiguousarray(array.view(np.uint8).reshape(len(array), -1).T) if len(array) else array
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(raw: bytes, dtype: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(dtype).ravel() if len(flat) else np.zeros(0, dtype)


def fold(id_col: Column) -> Column:
    """Remainder by 7 of the CRC-32 of the id as text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 7


class Stream:
    """The n-grams of a block: two begin marks, the words and an end for each document, in one row."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, width: int) -> None:
        whole = sizes + 2
        ends = np.cumsum(whole)
        self.starts = ends - whole
        row = np.full(ends[-1] if len(ends) else 0, _BEGIN)
        inner = np.ones(len(row), bool)
        inner[self.starts] = inner[self.starts + 1] = False
        row[inner] = words
        self.scored = np.flatnonzero(inner)
        two = mix(row[:-1] * np.uint64(0x9E3779B97F4A7C15) + row[1:] + np.uint64(2))
        three = mix(two[:-1] * np.uint64(0x9E3779B97F4A7C15) + row[2:] + np.uint64(3))
        not_first = np.ones(len(row), bool)
        not_first[self.starts] = False
        later = np.flatnonzero(not_first)
        self._places = {1: later, 2: later, 3: self.scored}
        cut = np.uint64(64 - width)
        self._values = {1: row[later], 2: two[later - 1] >> cut, 3: three[self.scored - 2] >> cut}
        self._size = len(row)

    def distinct(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(self._values[level], return_counts=True)
        return keys, counts

    def spread(self, level: int, found: np.ndarray) -> np.ndarray:
        """A value per distinct n-gram, to the place where each occurrence ends."""
        _, which = np.unique(self._values[level], return_inverse=True)
        out = np.zeros(self._size, np.int64)
        out[self._places[level]] = found[which]
        return out


def _pack_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``block``, ``kind``, ``ids``, ``sizes``, ``words`` (local numbers) and ``hashes``: whole documents of one kind."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        task, number, hashes = TaskContext.get().partitionId(), 0, WordHashes()
        for batch in by_bytes(batches, "text", block_bytes):
            texts, kinds = batch.column(2).to_pylist(), batch.column(1).to_numpy()
            for kind in (_FIT, _TUNE, _HELD):
                rows = np.flatnonzero(kinds == kind)
                if not len(rows):
                    continue
                parts = [np.append(hashes.of(lower_words(texts[i])), _END) for i in rows.tolist()]
                distinct, local, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
                # Frequent words get small numbers, which compress well.
                order = np.argsort(-times, kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                distinct, local = distinct[order], place[local]
                sizes = np.array([len(p) for p in parts], np.int64)
                ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), batch.column(0).take(pa.array(rows)))
                yield pa.record_batch(
                    [
                        pa.array([task << 32 | number], pa.int64()),
                        pa.array([kind], pa.int32()),
                        ids,
                        pa.array([_packed(sizes)], pa.binary()),
                        pa.array([_packed(local.astype(np.uint32))], pa.binary()),
                        pa.array([_packed(distinct)], pa.binary()),
                        pa.array([len(local)], pa.int64()),
                    ],
                    ["block", "kind", "ids", "sizes", "words", "hashes", "n_tokens"],
                )
                number += 1

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"block long, kind int, ids array<{kind}>, sizes binary, words binary, hashes binary, n_tokens long"
    )


def _stream(sizes: bytes, words: bytes, hashes: bytes, width: int) -> Stream:
    return Stream(_unpacked(hashes, np.uint64)[_unpacked(words, np.uint32)], _unpacked(sizes, np.int64), width)


def _ask(blocks: DataFrame, bits: int, width: int) -> DataFrame:
    """One message per block, level and hash range: the distinct n-grams there and how often each occurs."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, kind, sizes, words, hashes in zip(*(c.to_pylist() for c in batch.columns)):
                stream = _stream(sizes, words, hashes, width)
                for level in _LEVELS:
                    keys, counts = stream.distinct(level)
                    size = 64 if level == 1 else width
                    part = (keys >> np.uint64(size - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(keys)).tolist()
                    ranges = list(zip(cuts, cuts[1:]))
                    yield pa.record_batch(
                        [
                            pa.array([block] * len(ranges), pa.int64()),
                            pa.array([kind] * len(ranges), pa.int32()),
                            pa.array([level] * len(ranges), pa.int32()),
                            pa.array([int(part[a]) for a, _ in ranges], pa.int64()),
                            pa.array([_packed(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in ranges], pa.binary()),
                            pa.array([_packed(counts[a:b].astype(np.uint32)) for a, b in ranges], pa.binary()),
                        ],
                        ["block", "kind", "level", "part", "keys", "counts"],
                    )

    columns = blocks.select("block", "kind", "sizes", "words", "hashes")
    return columns.mapInArrow(run, "block long, kind int, level int, part long, keys binary, counts binary")


_ANSWER = "block long, kind int, level int, part long, counts binary, fit_counts binary, n_words long, n_fit_words long"


def _answer(
    key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Adds up a range's n-grams over all training blocks and answers each block in the order it asked.

    The last row, without a block, holds how many distinct words of the range occur in training.
    """
    level, part = key[0].as_py(), key[1].as_py()
    blocks, kinds, keys, counts = [], [], [], []
    for batch in batches:
        blocks += batch.column(0).to_pylist()
        kinds += batch.column(1).to_pylist()
        keys += [np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64) for k in batch.column(4).to_pylist()]
        counts += [_unpacked(c, np.uint32) for c in batch.column(5).to_pylist()]
    sizes = [len(k) for k in keys]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    kind = np.repeat(np.array(kinds), sizes)
    each = np.concatenate(counts).astype(np.float64)
    fit = np.bincount(which[kind == _FIT], each[kind == _FIT], len(distinct)).astype(np.int64)
    train = fit + np.bincount(which[kind == _TUNE], each[kind == _TUNE], len(distinct)).astype(np.int64)
    asked = np.split(which, np.cumsum(sizes)[:-1])
    real = distinct != _BEGIN
    words = [int(np.count_nonzero((c > 0) & real)) if level == 1 else 0 for c in (train, fit)]
    last = len(blocks)
    yield pa.record_batch(
        [
            pa.array([*blocks, None], pa.int64()),
            pa.array([*kinds, None], pa.int32()),
            pa.array([level] * (last + 1), pa.int32()),
            pa.array([part] * (last + 1), pa.int64()),
            pa.array([*(_packed(train[a].astype(np.uint64)) for a in asked), None], pa.binary()),
            pa.array([*(_packed(fit[a].astype(np.uint64)) if k == _TUNE else None for a, k in zip(asked, kinds)), None], pa.binary()),
            pa.array([0] * last + words[:1], pa.int64()),
            pa.array([0] * last + words[1:], pa.int64()),
        ],
        ["block", "kind", "level", "part", "counts", "fit_counts", "n_words", "n_fit_words"],
    )


def _estimates(stream: Stream, answers: list[dict], tokens: int) -> tuple[np.ndarray, ...]:
    """Count of the word, context number, and the trigram, bigram and unigram estimates at each scored place."""
    counts = {}
    for level in _LEVELS:
        parts = sorted((a["part"], a["counts"]) for a in answers if a["level"] == level)
        counts[level] = stream.spread(level, np.concatenate([_unpacked(raw, np.uint64) for _, raw in parts]))
    at = stream.scored
    word, pair, triple = counts[1][at], counts[2][at], counts[3][at]
    before, before_two = counts[1][at - 1], counts[2][at - 1]
    p3 = triple / np.maximum(before_two, 1)
    p2 = pair / np.maximum(before, 1)
    p1 = word / max(tokens, 1)
    size = np.where(before_two > 0, before_two, before)
    power = np.minimum(np.frexp(size.astype(np.float64))[1], _CONTEXTS // 2 - 1)
    return word, power + np.where(before_two > 0, _CONTEXTS // 2, 0), p3, p2, p1


def learn_weights(places: DataFrame, uniform: float, rounds: int) -> np.ndarray:
    """Weights (trigram, bigram, unigram, uniform) per context number, by expectation-maximisation.

    ``places`` holds context numbers and estimates of held-out places, packed by block. A round adds up
    each estimate's share per context in the tasks; only these few sums reach the driver. One
    pseudo-count spread over the four keeps weights above 0.
    """
    weights = np.full((_CONTEXTS, 4), 0.25)
    for _ in range(rounds):

        def run(batches, weights=weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros((_CONTEXTS, 4))
            for batch in batches:
                for context, estimates in zip(*(c.to_pylist() for c in batch.columns)):
                    number = np.frombuffer(context, np.uint8).astype(np.int64)
                    shares = weights[number]
                    shares[:, :3] *= np.frombuffer(estimates, np.float32).reshape(3, -1).T
                    shares[:, 3] *= uniform
                    shares /= shares.sum(axis=1, keepdims=True)
                    for i in range(4):
                        total[:, i] += np.bincount(number, shares[:, i], _CONTEXTS)
            yield pa.record_batch(
                [pa.array(np.arange(_CONTEXTS), pa.int32()), *(pa.array(total[:, i]) for i in range(4))],
                ["context", "a", "b", "c", "d"],
            )

        sums = places.mapInArrow(run, "context int, a double, b double, c double, d double").groupBy("context")
        total = np.zeros((_CONTEXTS, 4))
        for row in sums.agg(*(F.sum(c).alias(c) for c in "abcd")).collect():
            total[row["context"]] = row["a"], row["b"], row["c"], row["d"]
        weights = (total + 0.25) / (total.sum(axis=1, keepdims=True) + 1.0)
    return weights


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_remainder: int = 2,
    tune_remainder: int = 3,
    rounds: int = 8,
    block_bytes: int = 10 << 20,
    range_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per document: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Scores are log10 probabilities of the whole text. ``base_score`` is add-one smoothed unigrams.
    Documents whose fold is ``held_remainder`` take no part in learning; those of ``tune_remainder``
    are left out of the counts while the weights are learned on them.
    """
    spark = docs.sparkSession
    remainder = fold(F.col(id_col))
    kind = F.when(remainder == held_remainder, _HELD).when(remainder == tune_remainder, _TUNE).otherwise(_FIT)
    rows = docs.select(
        F.col(id_col).alias("id"), kind.alias("kind"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    folder = new_work_dir(spark, "lm")
    _pack_blocks(rows, block_bytes).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = dict(blocks.groupBy("kind").agg(F.sum("n_tokens")).collect())
    fit_tokens = sizes.get(_FIT, 0)
    train_tokens = fit_tokens + sizes.get(_TUNE, 0)
    # A range holds about as many n-grams as range_bytes / 8, at any size of the corpus.
    ranges = -(-sum(sizes.values()) * 8 // range_bytes)
    bits = max(0, int(ranges - 1).bit_length()) if ranges else 0
    width = min(64, 20 + max(1, sum(sizes.values())).bit_length())
    _ask(blocks, bits, width).groupBy("level", "part").applyInArrow(_answer, _ANSWER).write.parquet(f"{folder}/answers")
    answers = spark.read.parquet(f"{folder}/answers")
    words = answers.agg(F.sum("n_words"), F.sum("n_fit_words")).first()
    train_words, fit_words = words[0] or 0, words[1] or 0

    def told(rows: DataFrame, counts: str) -> DataFrame:
        """The blocks with what they asked for."""
        one = rows.groupBy("block").agg(F.collect_list(F.struct("level", "part", F.col(counts).alias("counts"))).alias("answers"))
        return blocks.join(one, "block")

    left_out = told(answers.filter(F.col("kind") == _TUNE), "fit_counts").filter(F.col("kind") == _TUNE)

    def tune(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stream = _stream(row["sizes"], row["words"], row["hashes"], width)
                _, context, *estimates = _estimates(stream, row["answers"], fit_tokens)
                packed = np.stack(estimates).astype(np.float32).tobytes()
                columns = [pa.array([context.astype(np.uint8).tobytes()]), pa.array([packed])]
                yield pa.record_batch(columns, ["contexts", "estimates"])

    left_out = left_out.select("sizes", "words", "hashes", "answers")
    left_out.mapInArrow(tune, "contexts binary, estimates binary").write.parquet(f"{folder}/places")
    weights = learn_weights(spark.read.parquet(f"{folder}/places"), 1.0 / (fit_words + 1), rounds)
    uniform = 1.0 / (train_words + 1)

    def score(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("kind", "sizes", "words", "hashes", "answers")}
                stream = _stream(row["sizes"], row["words"], row["hashes"], width)
                word, context, p3, p2, p1 = _estimates(stream, row["answers"], train_tokens)
                mixed = weights[context]
                chance = mixed[:, 0] * p3 + mixed[:, 1] * p2 + mixed[:, 2] * p1 + mixed[:, 3] * uniform
                base = np.log10((word + 1) / (train_tokens + train_words + 1))
                tokens = _unpacked(row["sizes"], np.int64)
                begin = np.cumsum(tokens) - tokens
                yield pa.record_batch(
                    [
                        batch.column("ids")[i].values,
                        pa.array([row["kind"] == _HELD] * len(tokens), pa.bool_()),
                        pa.array(tokens),
                        pa.array(np.add.reduceat((word > 0).astype(np.int64), begin)),
                        pa.array(np.full(len(tokens), train_tokens, np.int64)),
                        pa.array(np.add.reduceat(base, begin)),
                        pa.array(np.add.reduceat(np.log10(chance), begin)),
                    ],
                    [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    joined = told(answers.filter(F.col("block").isNotNull()), "counts")
    return joined.select("kind", "ids", "sizes", "words", "hashes", "answers").mapInArrow(
        score,
        f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double",
    )
