"""Near duplicates by ProbMinHash over weighted word shingles.

A text's shingles are its runs of five words, weighted by how often they stand in it. Each
shingle is a Poisson process of that rate whose events fall on random components; a component
keeps the shingle that reaches it first, and a text stops once no later event can matter. Two
sketches agree in a component with the probability Jaccard similarity of the texts. Bands of four
components propose candidates, which are verified exactly.

Links form classes (connected components). Within a band's bucket every text is first compared with
one leader, the text with the most company over all its bands, which in a group of near copies is
the one they stem from. Texts that are linked to one leader have one label, and only texts with different labels are compared from
then on: first each with the nearest one in its bucket, then, after labels have grown by these links, all with all. So a large group
costs a few comparisons per text but for those that are similar to no other, and no link between different classes is
lost. Crowded buckets are dealt in blocks, and each pair of blocks is compared in arrays by one task. Components are found once, at the
end, among labels.

Defined results: equal texts are one class; a text with fewer than five words is one shingle; a null text or one
without words is a class of its own; rows of one id are one document, also if their texts differ: each text is compared
for itself, and what is linked to one of them is in the document's class; a row with a null id has a null class. An empty table gives no rows;
texts of any length are compared whole; columns of the input may have any names.
A pair at the limit of 0.8 is missed by all 32 bands with a probability of 5e-8, and passed over for
too many differing bits of 1,024 with one of 1.5e-5, whatever the length of the texts: a component's bit depends on
the component too, so bits are independent even if one shingle wins many of them. Verification compares shingles by 32-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pulsework.llm.text import WordHashes, by_bytes, grams, lower_words, mix
from pulsework.session import discard, new_work_dir

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Near:
    similarity: float = 0.8
    words: int = 5
    bands: int = 32
    rows: int = 4
    #: Components of the second sketch, of which a bit each is kept; only texts that share a band get one.
    fine: int = 1024
    #: Most bits that differ. A pair at 0.8 differs in 102 on average, with a deviation of 9.6.
    most_bits: int = 144
    #: Rows of a block of a crowded bucket.
    block: int = 4096


def weighted_shingles(text: str | None, hashes: WordHashes, words: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(grams(hashes.of(lower_words(text)), words) >> np.uint64(32), return_counts=True)


def sketches(items: list[np.ndarray], weights: list[np.ndarray], size: int) -> np.ndarray:
    """ProbMinHash of many texts at once, each with at least one shingle: one row of ``size`` shingle hashes per text."""
    counts = np.array([len(i) for i in items])
    item, weight = np.concatenate(items), np.concatenate(weights).astype(np.float64)
    doc = np.repeat(np.arange(len(items)), counts)
    reached = np.full(len(items) * size, np.inf)
    first = np.zeros(len(items) * size, np.uint64)
    worst = np.full(len(items), np.inf)
    time, at, step = np.zeros(len(item)), np.arange(len(item)), 0
    while len(at):
        step += 1
        draw = mix(item[at] + np.uint64(step * int(_GOLDEN) % 2**64))
        wait = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53)
        time[at] += wait / weight[at]
        slot = doc[at] * size + (mix(draw ^ _GOLDEN) % np.uint64(size)).astype(np.int64)
        np.minimum.at(reached, slot, time[at])
        won = reached[slot] == time[at]
        first[slot[won]] = item[at[won]]
        live = np.unique(doc[at])
        worst[live] = reached.reshape(-1, size)[live].max(axis=1)
        at = at[time[at] < worst[doc[at]]]
    return first.reshape(-1, size)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Sum over common shingles i of 1 / sum over j of max(x_j / x_i, y_j / y_i).

    In order of x_j / y_j the larger ratio is the first text's from i on, and the second's before.
    Without repeated shingles this is the share of common shingles.
    """
    if len(a) == x.sum() and len(b) == y.sum():
        place = np.minimum(np.searchsorted(a, b), len(a) - 1)
        common = int(np.count_nonzero(a[place] == b))
        return common / (len(a) + len(b) - common)
    union = np.union1d(a, b)
    left, right = np.zeros(len(union)), np.zeros(len(union))
    left[np.searchsorted(union, a)], right[np.searchsorted(union, b)] = x, y
    with np.errstate(divide="ignore"):
        ratio = np.where(right > 0, left / np.maximum(right, 1e-300), np.inf)
    order = np.argsort(ratio)
    left, right, ratio = left[order], right[order], ratio[order]
    begin = np.searchsorted(ratio, ratio)
    above = left.sum() - np.append(0, np.cumsum(left))[begin]
    below = np.append(0, np.cumsum(right))[begin]
    both = (left > 0) & (right > 0)
    return float(np.sum(1.0 / (above[both] / left[both] + below[both] / right[both])))


def _marks(sketch: np.ndarray) -> np.ndarray:
    """A bit per component, packed into bytes.

    It depends on the component too: else all components that one shingle wins would differ, or agree, together.
    """
    place = mix(np.arange(1, sketch.shape[1] + 1, dtype=np.uint64) * _GOLDEN)
    return np.packbits((mix(sketch ^ place) & np.uint64(1)).astype(np.uint8), axis=1)


def _pack(items: np.ndarray, counts: np.ndarray) -> bytes:
    return items.astype(np.uint32).tobytes() + counts.astype(np.uint32).tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = len(raw) // 8
    return np.frombuffer(raw, np.uint32, size), np.frombuffer(raw, np.uint32, size, size * 4)


def _written(df: DataFrame, label: str, passing: list[str] | None = None) -> DataFrame:
    """A table in the shared folder: computed once, and the lineage ends there. ``passing`` notes what can go in the end."""
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    if passing is not None:
        passing.append(path)
    return df.sparkSession.read.parquet(path)


def _band_keys(found: list[tuple[np.ndarray, np.ndarray]], near: Near) -> np.ndarray:
    """A row per text with the key of each band, which depends on the band too."""
    sketch = sketches([items for items, _ in found], [weights for _, weights in found], near.bands * near.rows)
    parts = sketch.reshape(len(found), near.bands, near.rows)
    keys = np.broadcast_to(np.arange(1, near.bands + 1, dtype=np.uint64), (len(found), near.bands))
    for i in range(near.rows):
        keys = mix(keys * _GOLDEN + parts[:, :, i])
    return keys


def _sketch_table(docs: DataFrame, near: Near) -> DataFrame:
    """``node``, ``id``, ``keys`` (one per band) of each distinct text with words."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_bytes(batches, "text", 1 << 20):
            found = [weighted_shingles(t, hashes, near.words) for t in batch.column(2).to_pylist()]
            keep = [i for i, (items, _) in enumerate(found) if len(items)]
            if not keep:
                continue
            keys = _band_keys([found[i] for i in keep], near)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.astype(np.int64).ravel()), near.bands)
            rows = pa.array(keep)
            yield pa.record_batch(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    lists.cast(pa.list_(pa.int64())),
                ],
                ["node", "id", "keys"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    sketched = docs.select("node", "id", "text").mapInArrow(run, f"node binary, id {kind}, keys array<bigint>")
    # Equal texts have equal sketches, so any of them will do.
    return sketched.groupBy("node").agg(F.min("id").alias("id"), F.first("keys").alias("keys"))


def _shingled(docs: DataFrame, near: Near) -> DataFrame:
    """``node``, its packed weighted shingles, ``marks``, a bit per component of the second sketch, and its bands' keys."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in by_bytes(batches, "text", 1 << 20):
            found = [weighted_shingles(t, hashes, near.words) for t in batch.column(1).to_pylist()]
            sketch = sketches([mix(i ^ _GOLDEN) for i, _ in found], [w for _, w in found], near.fine)
            marks = pa.array([row.tobytes() for row in _marks(sketch)], pa.binary())
            packed = pa.array([_pack(*one) for one in found], pa.binary())
            keys = pa.array([row.tobytes() for row in _band_keys(found, near)], pa.binary())
            yield pa.record_batch([batch.column(0), packed, marks, keys], ["node", "packed", "marks", "keys"])

    return docs.select("node", "text").mapInArrow(run, "node binary, packed binary, marks binary, keys binary")


def _verified(pairs: DataFrame, shingled: DataFrame, near: Near) -> DataFrame:
    """The pairs ``a``, ``b`` that are similar.

    Both joins are plain, so a text with a third of all pairs is split among tasks.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        last, one = None, None
        for batch in batches:
            found = []
            for packed_a, packed_b in zip(batch.column(2), batch.column(3)):
                if packed_a != last:
                    last, one = packed_a, _unpack(packed_a.as_py())
                found.append(probability_jaccard(*one, *_unpack(packed_b.as_py())))
            similar = pa.array(np.array(found) >= near.similarity)
            yield pa.record_batch([batch.column(i).filter(similar) for i in (0, 1)], ["a", "b"])

    left, right = (shingled.select(F.col("node").alias(n), F.col("packed").alias(f"packed_{n}")) for n in "ab")
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "packed_a", "packed_b")
    return joined.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``least``, the smallest id it is connected to, of all ids in ``a``, ``b``.

    Alternating large-star and small-star steps, each written to the shared folder, until a step changes no link; then
    every component is a star around its smallest id.
    """
    spark = edges.sparkSession
    links, before, old = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), None, None
    while True:
        both = links.select("hi", "lo").unionAll(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        nearest = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.join(nearest, "hi").filter(F.col("lo") > F.col("hi")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = large.unionAll(nearest.filter("hi > m").select("hi", F.col("m").alias("lo")))
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi")
        stars = (
            small.filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionAll(smallest.select("hi", F.col("m").alias("lo"))).distinct()
        )
        # What is written tells by itself whether anything has changed.
        seen = Observation()
        code = F.xxhash64("hi", "lo")
        stars = stars.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(code).alias("x"), F.bit_xor(F.xxhash64(code)).alias("y"))
        path = new_work_dir(spark, "links")
        stars.write.parquet(path)
        links, now = spark.read.schema(stars.schema).parquet(path), tuple(seen.get.values())
        if old:
            discard(spark, old)
        if now == before:
            break
        before, old = now, path
    return links.select(F.col("hi").alias("id"), F.col("lo").alias("least")).unionAll(
        links.select(F.col("lo").alias("id"), F.col("lo").alias("least")).distinct()
    )


def _node(text: Column) -> Column:
    """Tells texts apart, in 16 bytes; empty for a text without words, which equals no other."""
    digest = F.substring(F.unhex(F.sha2(text, 256)), 1, 16)
    return F.when(F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), digest).otherwise(F.lit(b""))


def _alike(pairs: DataFrame, near: Near) -> DataFrame:
    """``a`` and ``b`` of the pairs whose ``marks_a`` and ``marks`` differ in few bits."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, near.fine // 64) for i in (2, 3)
            )
            few = pa.array(np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64) <= near.most_bits)
            yield pa.record_batch([batch.column(i).filter(few) for i in (0, 1)], ["a", "b"])

    return pairs.select("a", "b", "marks_a", "marks").mapInArrow(run, "a binary, b binary")


def _distances(marks: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Differing bits between rows ``begin`` to ``end`` and all rows."""
    return np.bitwise_count(marks[begin:end, None, :] ^ marks[None, :, :]).sum(axis=2, dtype=np.int32)


def _pairs_of(marks: np.ndarray, label: np.ndarray, own: np.ndarray, most: int, nearest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a block, or between the two blocks that ``own`` tells apart, with different labels and at most ``most`` differing bits.

    With ``nearest`` each row only with the one that differs least.
    """
    count, two = len(marks), bool((own != own[0]).any())
    step = max(1, (1 << 18) // count)
    for begin in range(0, count, step):
        end = min(count, begin + step)
        far = _distances(marks, begin, end)
        far[label[begin:end, None] == label[None, :]] = most + 1
        if two:
            far[own[begin:end, None] == own[None, :]] = most + 1
        if nearest:
            j = far.argmin(axis=1)
            i = np.flatnonzero(far[np.arange(end - begin), j] <= most)
            yield i + begin, j[i]
        else:
            i, j = np.nonzero(far <= most)
            once = i + begin < j
            yield i[once] + begin, j[once]


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows in order of their bucket and pair of blocks, each of these with one task."""
    return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")


def _per_group(work: Callable[[pa.Table, list[int]], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on whole groups of sorted rows, with the places where they begin and end, for mapInArrow."""

    def cuts(table: pa.Table) -> list[int]:
        group = np.stack([np.asarray(table[c]).astype(np.int64) for c in ("key", "p", "q")])
        return [0, *(np.flatnonzero((np.diff(group, axis=1) != 0).any(axis=0)) + 1).tolist(), table.num_rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last group, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            places = cuts(table)
            if len(places) > 2:
                yield work(table.slice(0, places[-2]), places[:-1])
            held = table.slice(places[-2]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield work(table, cuts(table))

    return run


def _binary(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


_MIXED = "key bigint, p int, q int, own int, label bigint, node binary, marks binary"


def _mixed(placed: DataFrame, near: Near) -> DataFrame:
    """Rows of the buckets that hold several labels, dealt over the pairs of blocks ``p``, ``q`` with their ``own`` block."""
    label = F.xxhash64("label.node")
    mixed = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(label).alias("low"), F.max(label).alias("high"))
    blocks = F.ceil(F.col("n") / near.block).cast("int")
    rows = placed.join(mixed.filter("low < high").select("key", blocks.alias("blocks")), "key")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(own, i).alias("p"), F.greatest(own, i).alias("q")))
    rows = rows.select("key", own.alias("own"), label.alias("label"), "node", "marks", F.explode(others).alias("pair"))
    return rows.select("key", F.col("pair.p").alias("p"), F.col("pair.q").alias("q"), "own", "label", "node", "marks")


def _groups(table: pa.Table, places: list[int], near: Near, nearest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers of all groups of a table."""
    marks = _binary(table["marks"], np.uint64, near.fine // 64)
    label, own = np.asarray(table["label"]), np.asarray(table["own"])
    for begin, end in zip(places, places[1:]):
        if end - begin > 1 and (label[begin:end] != label[begin]).any():
            for i, j in _pairs_of(marks[begin:end], label[begin:end], own[begin:end], near.most_bits, nearest):
                yield i + begin, j + begin


def _nearest_pairs(placed: DataFrame, near: Near) -> DataFrame:
    """Each text with the nearest of another label in its bucket, by their marks: distinct pairs ``a`` < ``b``."""

    def work(table: pa.Table, places: list[int]) -> pa.RecordBatch:
        found, nodes = list(_groups(table, places, near, True)), table["node"].combine_chunks()
        ends = [np.concatenate([pair[k] for pair in found]) if found else np.zeros(0, np.int64) for k in (0, 1)]
        return pa.record_batch([nodes.take(pa.array(end)) for end in ends], ["a", "b"])

    pairs = _grouped(_mixed(placed, near)).mapInArrow(_per_group(work), "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _remaining_edges(placed: DataFrame, shingled: DataFrame, near: Near) -> DataFrame:
    """Links ``a``, ``b`` between all texts of a bucket that have different labels.

    First the rows are told that have any candidate by their marks; only those meet their shingles. Then each group is compared exactly,
    pairs that differ least first, and of texts that are linked already by a chain of links no more pairs are compared. So a group gives at most a row per
    text, however many pairs it holds.
    """

    def candidates(table: pa.Table, places: list[int]) -> pa.RecordBatch:
        hit = np.zeros(table.num_rows, bool)
        for i, j in _groups(table, places, near, False):
            hit[i] = hit[j] = True
        rows = pa.array(np.flatnonzero(hit))
        return pa.record_batch([table[c].combine_chunks().take(rows) for c in table.column_names], table.column_names)

    def compared(table: pa.Table, places: list[int]) -> pa.RecordBatch:
        label, nodes = np.asarray(table["label"]), table["node"].combine_chunks()
        marks, packed = _binary(table["marks"], np.uint64, near.fine // 64), table["packed"]
        keys, bucket = _binary(table["keys"], np.int64, near.bands), np.asarray(table["key"])
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        parent: dict[int, int] = {}
        left, right, group = [], [], -1

        def top(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def shingles(row: int) -> tuple[np.ndarray, np.ndarray]:
            if row not in known:
                known[row] = _unpack(packed[row].as_py())
            return known[row]

        for i, j in _groups(table, places, near, False):
            here = int(np.searchsorted(places, i[0], "right")) if len(i) else group
            if here != group:
                known, group = {}, here
            # Of all buckets that two texts share, that of their first common band alone compares them.
            first = (keys[i] == keys[j]).argmax(axis=1)
            mine = keys[i, first] == bucket[i]
            i, j = i[mine], j[mine]
            far = np.bitwise_count(marks[i] ^ marks[j]).sum(axis=1, dtype=np.int64)
            for k in np.argsort(far, kind="stable").tolist():
                a, b = int(i[k]), int(j[k])
                x, y = top(int(label[a])), top(int(label[b]))
                if x != y and probability_jaccard(*shingles(a), *shingles(b)) >= near.similarity:
                    parent[max(x, y)] = min(x, y)
                    left.append(a)
                    right.append(b)
        return pa.record_batch([nodes.take(pa.array(end, pa.int64())) for end in (left, right)], ["a", "b"])

    some = _grouped(_mixed(placed, near)).mapInArrow(_per_group(candidates), _MIXED)
    full = some.join(shingled.select("node", "packed", "keys"), "node").select(
        "key", "p", "q", "own", "label", "node", "marks", "packed", "keys"
    )
    return _grouped(full).mapInArrow(_per_group(compared), "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: Near = Near()) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and ``class_id``, the smallest id of its class."""
    return _classed(docs, id_col, text_col, near).select(F.col("id").alias(id_col), "class_id")


def _rank(node: str, company: str) -> Column:
    return F.struct(F.col(company).alias("company"), F.xxhash64(node).alias("code"), F.col(node).alias("node"))


def _larger(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (``node``, ``label``), where linked labels ``x``, ``y`` have taken over the larger of the two.

    Each label takes the largest that it is linked to. Two that end up the same are linked to it, so equal labels always mean
    connected texts, though not all connected texts have equal ones.
    """
    both = links.select("x", "y").unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    best = both.groupBy(F.col("x.node").alias("old")).agg(F.max("y").alias("best"))
    joined = labels.withColumn("old", F.col("label.node")).join(best, "old", "left")
    return joined.select("node", F.greatest("label", F.coalesce("best", "label")).alias("label"))


def _lifted(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The different labels ``x``, ``y`` of linked texts."""
    for text, label in (("a", "x"), ("b", "y")):
        edges = edges.join(labels.select(F.col("node").alias(text), F.col("label").alias(label)), text)
    return edges.filter("x.node != y.node").select("x", "y")


def _classed(docs: DataFrame, id_col: str, text_col: str, near: Near) -> DataFrame:
    """``id``, ``node`` and ``class_id`` of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", _node(F.col("text")).alias("node"), "text")
    worded = rows.filter(F.col("id").isNotNull() & (F.octet_length("node") > 0))
    passing: list[str] = []
    nodes = _written(_sketch_table(worded, near), "nodes", passing)
    banded = nodes.select("node", F.explode("keys").alias("key"))
    crowded = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = _written(banded.join(crowded, "key"), "shared", passing)
    # Company: how many texts share a band with a text, over all bands.
    company = _written(shared.groupBy("node").agg(F.sum("n").alias("company")), "company", passing)
    shingled = _written(_shingled(worded.join(company.hint("merge"), "node", "left_semi").dropDuplicates(["node"]), near), "shingled", passing)
    marked = company.join(shingled.select("node", "marks"), "node")
    placed = _written(shared.select("key", "node").join(marked, "node"), "placed", passing)
    # First turn: each text with the leader of each of its buckets.
    leader = placed.groupBy("key").agg(F.max(F.struct("company", F.xxhash64("node").alias("code"), "node", "marks")).alias("lead"))
    led = placed.join(leader, "key").filter(F.col("node") != F.col("lead.node"))
    led = led.select(F.col("lead.node").alias("a"), F.col("node").alias("b"), F.col("lead.marks").alias("marks_a"), "marks")
    edges = _written(_verified(_alike(led, near).distinct(), shingled, near), "edges", passing)
    labels = company.select("node", _rank("node", "company").alias("label"))
    labels = _larger(labels, _lifted(edges, labels))
    # A leader may have taken over another's label: one step further.
    ahead = labels.select(F.col("node").alias("old"), F.col("label").alias("ahead"))
    labels = labels.withColumn("old", F.col("label.node")).join(ahead, "old").select("node", F.greatest("label", "ahead").alias("label"))
    labels = _written(labels, "labels", passing)
    # Second turn: each with the nearest of another label. Third turn: all that still have different ones.
    more = _written(_verified(_nearest_pairs(placed.join(labels, "node"), near), shingled, near), "edges", passing)
    labels = _written(_larger(labels, _lifted(more, labels)), "labels", passing)
    last = _written(_remaining_edges(placed.join(labels, "node"), shingled, near), "edges", passing)
    edges = edges.unionAll(more).unionAll(last)
    lifted = _lifted(edges, labels).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    classes = labels.select("node", F.col("label.node").alias("root"))
    several = worded.groupBy("id").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first != last")
    several = _written(several.select("id", "first"), "several", passing)
    if not several.isEmpty():
        lifted = lifted.unionAll(_same_ids(worded, several, labels))
    links = _written(lifted.distinct(), "lifted", passing)
    if not links.isEmpty():
        merged = components(links).select(F.col("id").alias("root"), F.col("least").alias("top"))
        known = nodes.select("node").join(classes, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        classes = known.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    named = nodes.select("node", "id").join(classes, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    named = _written(named, "named")
    for path in passing:
        discard(docs.sparkSession, path)
    least = named.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    classed = named.join(least, "root", "left").select("node", F.coalesce("class_id", "id").alias("class_id"))
    found = rows.select("id", "node").join(classed, "node", "left")
    return found.select("id", "node", F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id"))


def _same_ids(worded: DataFrame, several: DataFrame, labels: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between the labels of an id's different texts; a text without a label stands for itself."""
    links = worded.join(several, "id").select(F.col("first").alias("a"), F.col("node").alias("b"))
    for end in "ab":
        label = labels.select(F.col("node").alias(end), F.col("label.node").alias("label"))
        links = links.join(label, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    return links.filter("a != b").select("a", "b")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: Near = Near()) -> DataFrame:
    """One row of each class, the one with the smallest id, all columns unchanged; rows with a null id stay.

    If that id has several texts, each of them stays once.
    """
    first = _classed(docs, id_col, text_col, near).filter(F.col("class_id") == F.col("id"))
    kept = _written(first.select(F.col("id").alias("kept_id"), F.col("node").alias("kept_node")).distinct(), "kept")
    # Input columns stay in a struct, so their names meet none of those used here.
    known = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), _node(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("node")
    )
    one = known.join(kept, (F.col("id") == F.col("kept_id")) & (F.col("node") == F.col("kept_node")), "left_semi")
    stay = known.filter(F.col("id").isNull())
    return one.dropDuplicates(["id", "node"]).unionAll(stay).select("row.*")
