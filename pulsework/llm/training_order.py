"""Training order: every sequence gets a global slot from a keyed permutation, and shards hold slots in order.

Texts or token ids are cut into sequences of fixed length. Sequences are numbered in the order of the scan;
a Feistel network with cycle-walking permutes the numbers ``0 .. n-1`` onto themselves, and shard
``s`` holds the slots from ``s * per_shard`` on. A record has a fixed size, so a reader can begin
at any slot.

The order needs no sort and no table of random numbers, and is the same for the same rows and key.

Defined results: a null or empty text or list of ids is one sequence with only the end id; a null id is
stored as -1 with a flag; repeated rows are sequences of their own; an empty table makes no shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsework.llm import bpe
from pulsework.llm.shared_files import open_path, write_new
from pulsework.llm.text import by_bytes, mix
from pulsework.llm.token_ids import TokenIds, token_ids
from pulsework.session import discard

# Record head: document id, its part, tokens in use, 1 if the id is null.
_HEAD = np.dtype([("doc", "<i8"), ("part", "<i4"), ("used", "<u4"), ("null", "<u4"), ("pad", "<u4")])
_ROUNDS = 6
# 0xFF stands in no UTF-8 text.
BYTE_END = 255


def permute(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """The slot of each number below ``count``: a bijection of ``0 .. count-1``.

    The Feistel network works on the smallest even number of bits that holds ``count``; what falls
    outside goes through it again until it falls inside, which ends as the network is a bijection.
    """
    half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mix(np.arange(1, _ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key & (2**64 - 1)))
    out = numbers.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> half, out[walk] & mask
        for round_key in keys:
            left, right = right, left ^ (mix(right ^ round_key) & mask)
        out[walk] = left << half | right
        walk = walk[out[walk] >= np.uint64(count)]
    return out.astype(np.int64)


def _ids(values: pa.Array, coder: TokenIds | None) -> Iterator[np.ndarray]:
    """The ids of each text or list."""
    if coder:
        yield from map(coder.of, values.to_pylist())
        return
    for value in values:
        value = value.as_py()
        yield np.frombuffer(value.encode(), np.uint8) if isinstance(value, str) else np.array(value or [], np.int64)


def _cut(
    batch: pa.RecordBatch, length: int, dtype: np.dtype, end: int, coder: TokenIds | None
) -> tuple[np.ndarray, np.ndarray]:
    """Heads and tokens of the sequences of a batch; the end id follows each document and fills its last sequence."""
    heads, rows = [], []
    for doc, tokens in zip(batch.column(0).to_pylist(), _ids(batch.column(1), coder)):
        if len(tokens) and not 0 <= tokens.min() <= tokens.max() <= np.iinfo(dtype).max:
            raise ValueError(f"an id does not fit {dtype}")
        count = len(tokens) // length + 1
        flat = np.full(count * length, end, dtype)
        flat[: len(tokens)] = tokens
        head = np.zeros(count, _HEAD)
        head["doc"], head["null"] = (-1, 1) if doc is None else (doc, 0)
        head["part"] = np.arange(count)
        head["used"] = np.minimum(length, len(tokens) + 1 - np.arange(count) * length)
        heads.append(head)
        rows.append(flat.reshape(count, length))
    return np.concatenate(heads), np.concatenate(rows)


def materialise(
    docs: DataFrame,
    folder: str,
    key: int,
    id_col: str = "doc_id",
    value_col: str = "text",
    length: int = 512,
    per_shard: int = 1 << 16,
    dtype: str = "uint8",
    end: int = BYTE_END,
    vocabulary: str | None = None,
) -> str:
    """Write all sequences of ``docs`` as shards below ``folder``; returns the path of the manifest.

    ``value_col`` holds texts, whose ids are their UTF-8 bytes or, with a ``vocabulary`` file, their tokens, or
    arrays of token ids. The job fails if an id does not fit ``dtype``. With a vocabulary texts are encoded once,
    into compressed blocks of whole sequences below ``folder``, which are dealt and then deleted.
    Else ``docs`` must be a scan of files (or of a written table): it is read once for the sizes of its
    partitions and once for their content, and the job fails should they differ. What the driver
    holds is one number per partition.
    """
    spark, kind = docs.sparkSession, np.dtype(dtype)
    record = _HEAD.itemsize + length * kind.itemsize
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(value_col).alias("value"))
    texts = rows.schema["value"].dataType.typeName() == "string"
    if vocabulary and not texts:
        raise ValueError("a vocabulary is for texts")
    words = bpe.share_vocabulary(spark, vocabulary) if vocabulary else None

    def joined(heads: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        raw = np.empty((len(heads), record), np.uint8)
        raw[:, : _HEAD.itemsize] = heads.view(np.uint8).reshape(len(heads), -1)
        raw[:, _HEAD.itemsize :] = tokens.view(np.uint8).reshape(len(heads), -1)
        return raw

    def encode(batches) -> Iterator[pa.RecordBatch]:
        partition, at, codec = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        for batch in by_bytes(batches, "value", _BLOCK):
            if batch.num_rows:
                raw = joined(*_cut(batch, length, kind, end, token_ids(words.value)))
                block = codec.compress(raw.tobytes())
                yield pa.RecordBatch.from_pylist([{"p": partition, "at": at, "n": len(raw), "block": block}], schema=_BLOCKS)
                at += len(raw)

    if words:
        blocks = f"{folder}/blocks"
        encoded = rows.mapInArrow(encode, "p int, at long, n long, block binary")
        encoded.write.option("compression", "uncompressed").parquet(blocks)
        sizes = dict(spark.read.parquet(blocks).groupBy("p").agg(F.sum("n").alias("n")).collect())
    else:
        size = F.octet_length("value") if texts else F.size("value")
        sequences = F.floor(F.coalesce(F.greatest(size, F.lit(0)), F.lit(0)) / length) + 1
        sizes = dict(
            rows.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(sequences).cast("long").alias("n")).collect()
        )
    places, total = {}, 0
    for partition in sorted(sizes):
        places[partition] = (total, sizes[partition])
        total += sizes[partition]
    if not total:
        spark.createDataFrame([], _MANIFEST).write.parquet(f"{folder}/manifest")
        return f"{folder}/manifest"
    shared = spark.sparkContext.broadcast(places)

    def by_shard(raw: np.ndarray, at: int, codec: zstandard.ZstdCompressor) -> pa.RecordBatch:
        slots = permute(np.arange(at, at + len(raw)), total, key)
        shard = slots // per_shard
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1)).tolist() + [len(order)]
        parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        return pa.record_batch(
            [
                pa.array([int(shard[p[0]]) for p in parts], pa.int64()),
                pa.array([slots[p].tobytes() for p in parts], pa.binary()),
                pa.array([codec.compress(raw[p].tobytes()) for p in parts], pa.binary()),
            ],
            ["shard", "slots", "records"],
        )

    def deal_blocks(batches) -> Iterator[pa.RecordBatch]:
        codec, reader = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            for partition, at, block in zip(*(batch.column(i) for i in range(3))):
                raw = np.frombuffer(reader.decompress(block.as_py()), np.uint8).reshape(-1, record)
                yield by_shard(raw, shared.value[partition.as_py()][0] + at.as_py(), codec)

    def deal(batches) -> Iterator[pa.RecordBatch]:
        at, left = shared.value.get(TaskContext.get().partitionId(), (0, 0))
        codec = zstandard.ZstdCompressor(level=3)
        for batch in by_bytes(batches, "value") if texts else batches:
            if not batch.num_rows:
                continue
            raw = joined(*_cut(batch, length, kind, end, None))
            left -= len(raw)
            if left < 0:
                break
            yield by_shard(raw, at, codec)
            at += len(raw)
        if left:
            raise ValueError("the partitions differ between two scans; write the input to a table first")

    def write(
        number: tuple[pa.Scalar, ...], frames: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        first = number[0].as_py() * per_shard
        count = min(per_shard, total - first)
        out, filled = np.zeros((count, record), np.uint8), np.zeros(count, bool)
        codec = zstandard.ZstdDecompressor()
        for batch in frames:
            for slots, records in zip(batch.column(1), batch.column(2)):
                here = np.frombuffer(slots.as_py(), np.int64) - first
                out[here] = np.frombuffer(codec.decompress(records.as_py()), np.uint8).reshape(len(here), record)
                filled[here] = True
        if not filled.all():
            raise ValueError(f"shard {number[0]} has slots without a sequence")
        uri = write_new(folder, f"shard-{number[0].as_py():08d}", ".bin", [memoryview(out).cast("B")])
        names = ["shard", "path", "first_slot", "n_slots", "length", "dtype"]
        values = [number[0].as_py(), uri, first, count, length, dtype]
        yield pa.RecordBatch.from_pylist([dict(zip(names, values))], schema=pa.schema(list(zip(names, _KINDS))))

    if words:
        rows, deal = spark.read.parquet(blocks).select("p", "at", "block"), deal_blocks
    dealt = rows.mapInArrow(deal, "shard long, slots binary, records binary")
    dealt.groupBy("shard").applyInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    if words:
        discard(spark, blocks)
    return f"{folder}/manifest"


# Bytes of text in a block of encoded sequences.
_BLOCK = 4 << 20
_BLOCKS = pa.schema([("p", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("block", pa.binary())])
_MANIFEST = "shard long, path string, first_slot long, n_slots long, length long, dtype string"
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def read_slots(
    spark: SparkSession, manifest: str, first_slot: int = 0, end_slot: int | None = None, at_once: int = 1 << 13,
    most_tasks: int = 10_000,
) -> DataFrame:
    """Sequences from ``first_slot`` to before ``end_slot``: ``slot``, ``shard``, ``doc_id``, ``part``, ``n_tokens``, ``ids``.

    Shards outside are not opened, and within a shard reading begins at the slot's place. ``ids`` are the ids in use, as
    stored bytes in the shard's dtype. One task reads a shard in order of slots.
    """
    shards = spark.read.parquet(manifest).filter(F.col("first_slot") + F.col("n_slots") > first_slot)
    if end_slot is not None:
        shards = shards.filter(F.col("first_slot") < end_slot)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                kind, length = np.dtype(row["dtype"]), row["length"]
                layout = np.dtype([("head", _HEAD), ("ids", kind, (length,))])
                begin = max(first_slot, row["first_slot"])
                stop = row["first_slot"] + row["n_slots"]
                stop = stop if end_slot is None else min(stop, end_slot)
                system, path = open_path(row["path"])
                with system.open_input_file(path) as file:
                    file.seek((begin - row["first_slot"]) * layout.itemsize)
                    for at in range(begin, stop, at_once):
                        count = min(at_once, stop - at)
                        found = np.frombuffer(file.read(count * layout.itemsize), layout, count)
                        head, used = found["head"], found["head"]["used"].tolist()
                        ids = [one[:n].tobytes() for one, n in zip(found["ids"], used)]
                        yield pa.record_batch(
                            [
                                pa.array(np.arange(at, at + count)),
                                pa.array(np.full(count, row["shard"]), pa.int64()),
                                pa.array(head["doc"], mask=head["null"] == 1),
                                pa.array(head["part"]),
                                pa.array(used, pa.int64()),
                                pa.array(ids, pa.binary()),
                            ],
                            ["slot", "shard", "doc_id", "part", "n_tokens", "ids"],
                        )

    # One task for each shard; adaptive execution would join the small rows of the manifest into one.
    tasks = max(1, min(shards.count(), most_tasks))
    return shards.repartition(tasks).mapInArrow(
        run, "slot long, shard long, doc_id long, part int, n_tokens long, ids binary"
    )
