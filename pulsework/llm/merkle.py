"""Merkle manifest of a dataset: a leaf per row, a tree per group, a tree over the groups' roots, and a proof per leaf.

A leaf's place in its group is its rank, and the bits of the rank are columns. Blocks of ``2 ** bits`` leaves are rolled
up by grouping away one digit column after the other; each step nests the nodes of the step before into a struct with
their hash. The tops of the blocks are ranks of the next tier, until one block holds a group. On the way down every
block meets the path above its top in one grouping, and nested transforms and one explode emit the proofs of its leaves.

No task holds more than one block of a group: ranks come from range partitions and the number of rows before each, so
a group with a third of all rows is spread like the others. Ranks and tiers are tables in the shared folder.

Defined results: the order is by key, nulls first, then by leaf; a null group is the first group; rows that are equal in all
leaf fields are leaves of their own; empty texts are values of zero bytes; a lone leaf is its group's root, and a lone group's root the
dataset's; an empty table gives no rows. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsework.session import discard, new_work_dir

#: Digits that a block groups away: 256 leaves, about 100 KB.
BITS = 8
_PATH = "array<struct<left: string, right: string>>"
# monotonically_increasing_id counts from 0 in the lower 33 bits of each partition.
_PLACE = (1 << 33) - 1


def field(value: Column) -> Column:
    """A value with its length, so that no two rows of values read the same: ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to; the path's steps go from the leaf upwards."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(path: Column) -> Column:
    """The hashes beside the path, concatenated from the leaf upwards."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


class _Tables:
    """Tables in the shared folder that end the lineage; those of finished steps can be deleted."""

    def __init__(self, spark) -> None:
        self._spark, self._folder, self._count = spark, new_work_dir(spark, "merkle"), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self._count += 1
        path = f"{self._folder}/{self._count}"
        df.write.parquet(path)
        return self._spark.read.parquet(path)

    def drop(self) -> None:
        discard(self._spark, self._folder)


def _ranked(tables: _Tables, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in their ``grp`` by ``order`` and ``n``, the rows of the group; no window over a group."""
    by = [F.asc_nulls_first(c) for c in ("grp", *order)]
    placed = tables.keep(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).select(
            "*",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("place"),
        )
    )
    # A group has at most one run per partition.
    runs = placed.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    group = Window.partitionBy("grp")
    before = F.sum("size").over(group.orderBy("part")) - F.col("size")
    runs = runs.select("grp", "part", (before - F.col("first")).alias("shift"), F.sum("size").over(group).alias("n"))
    return placed.join(runs, ["grp", "part"]).select(
        *rows.columns, (F.col("place") + F.col("shift")).alias("rank"), "n"
    )


def _rolled_up(rows: DataFrame, bits: int) -> DataFrame:
    """``grp``, ``n``, ``block`` and ``node``, the nested struct of the block, from ``grp``, ``n``, ``rank``, ``node``."""
    digits = [F.shiftright("rank", k).bitwiseAND(F.lit(1)).cast("int").alias(f"d{k}") for k in range(bits)]
    rows = rows.select("grp", "n", F.shiftright("rank", bits).alias("block"), *digits, "node")
    # One shuffle: every grouping below keeps the block among its keys.
    rows = rows.repartition("grp", "block")
    for k in range(bits):
        keys = ["grp", "n", "block", *(f"d{i}" for i in range(k + 1, bits))]
        pair = F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "node")))
        rows = rows.groupBy(*keys).agg(F.transform(pair, lambda one: one["node"]).alias("kids"))
        left, right = F.get("kids", F.lit(0))["hash"], F.get("kids", F.lit(1))["hash"]
        # While several nodes remain in the group, a node alone in its run is hashed too.
        both = F.when(F.col("n") > (1 << k), F.sha2(F.concat(left, F.coalesce(right, F.lit(""))), 256)).otherwise(left)
        rows = rows.select(*keys, F.struct(both.alias("hash"), "kids").alias("node"))
    return rows


def _tiers(tables: _Tables, ranked: DataFrame, bits: int) -> list[DataFrame]:
    """Blocks of the leaves, blocks of their tops, and so on until every group is one block."""
    tiers = []
    while True:
        blocks = tables.keep(_rolled_up(ranked, bits))
        tiers.append(blocks)
        if (blocks.agg(F.max("n")).first()[0] or 0) <= 1 << bits:
            return tiers
        above = F.shiftright(F.col("n") + ((1 << bits) - 1), bits)
        ranked = blocks.select(
            "grp", above.alias("n"), F.col("block").alias("rank"), F.struct(F.col("node.hash").alias("hash")).alias("node")
        )


def _emitted(blocks: DataFrame, bits: int) -> DataFrame:
    """From ``grp``, ``n``, ``block``, ``node``, ``path``, ``top``: ``grp``, ``rank``, ``node``, ``path``, ``top`` of the block's leaves."""

    def step(level: int, upper: Column) -> Column:
        kids = upper["node"]["kids"]

        def child(node: Column, place: Column) -> Column:
            beside = F.struct(
                F.when(place == 1, F.get(kids, F.lit(0))["hash"]).otherwise("").alias("left"),
                F.when(place == 0, F.coalesce(F.get(kids, F.lit(1))["hash"], F.lit(""))).otherwise("").alias("right"),
            )
            longer = F.concat(F.array(beside), upper["path"])
            path = F.when(F.col("n") > (1 << level), longer).otherwise(upper["path"])
            return F.struct(node.alias("node"), path.alias("path"))

        return F.transform(kids, child)

    nodes = F.array(F.struct("node", "path"))
    for k in reversed(range(bits)):
        nodes = F.flatten(F.transform(nodes, partial(step, k)))
    out = blocks.select("grp", "block", "top", F.posexplode(nodes).alias("place", "leaf"))
    rank = F.shiftleft("block", bits) + F.col("place")
    return out.select("grp", rank.alias("rank"), F.col("leaf.node").alias("node"), F.col("leaf.path").alias("path"), "top")


def _met(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Each block with the path above its top: both are rows of one grouping by the block."""
    top = above.schema["top"].dataType.simpleString()
    node = blocks.schema["node"].dataType.simpleString()
    rows = blocks.select("grp", "block", "n", "node", F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast(top).alias("top"))
    paths = above.select(
        "grp", F.col("rank").alias("block"), F.lit(None).cast("long").alias("n"), F.lit(None).cast(node).alias("node"), "path", "top"
    )
    some = [F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "top")]
    return rows.unionAll(paths).groupBy("grp", "block").agg(*some)


def manifest(leaves: DataFrame, group: str, key: str, leaf: str, bits: int = BITS) -> tuple[DataFrame, "_Tables"]:
    """All columns of ``leaves`` and ``subroot``, ``root`` and ``path`` (left and right hash per step), and the work tables.

    ``leaf`` is the hash of the row, ``group`` a string, ``key`` what orders a group. The result reads the work tables: delete
    them with ``drop()`` once it is written.
    """
    tables, passing = _Tables(leaves.sparkSession), _Tables(leaves.sparkSession)
    # A group as a string that is never null: the null group comes first, the others in the order of their bytes.
    grp = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit(""))
    rows = leaves.select(
        grp.alias("grp"), F.col(key).alias("key"), F.col(leaf).alias("leaf"), F.struct(*map(_quoted, leaves.columns)).alias("item")
    )
    ranked = _ranked(passing, passing.keep(rows), ["key", "leaf"])
    tiers = _tiers(tables, ranked.select("grp", "n", "rank", F.struct(F.col("leaf").alias("hash"), "item").alias("node")), bits)
    passing.drop()  # the first tier holds all leaves
    # The groups' roots are the leaves of one more tree.
    roots = tiers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("node.hash").alias("hash"))
    named = _ranked(tables, roots, ["key"])
    upper = _tiers(
        tables, named.select("grp", "n", "rank", F.struct("hash", F.struct(F.col("key").alias("name")).alias("item")).alias("node")), bits
    )
    found = _emitted(upper[-1].select("*", F.array().cast(_PATH).alias("path"), F.col("node.hash").alias("top")), bits)
    for blocks in reversed(upper[:-1]):
        found = _emitted(_met(blocks, found), bits)
    found = found.select(
        F.col("node.item.name").alias("grp"),
        F.lit(0).cast("long").alias("rank"),
        "path",
        F.struct(F.col("node.hash").alias("subroot"), F.col("top").alias("root")).alias("top"),
    )
    for blocks in reversed(tiers):
        found = _emitted(_met(blocks, found), bits)
    return found.select("node.item.*", "top.subroot", "top.root", "path"), tables


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def document_manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Per row of documents: ``doc_id``, ``leaf``, ``folded_leaf``, ``subroot``, ``root``, ``path``.

    ``folded_leaf`` is the leaf with 1 added to ``n_chars`` in rows where 7 divides the CRC-32 of the id, else the leaf:
    a check of the proofs, which must then fail.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    values = {name: F.col(name) for name in fields}
    more = values | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaf = leaf_hash(list(values.values()))
    leaves = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), leaf.alias("leaf"),
                         F.when(tampered, leaf_hash(list(more.values()))).alias("changed"))
    found, _ = manifest(leaves, "lang", "doc_id", "leaf", bits)
    return found.select("doc_id", "leaf", F.coalesce("changed", "leaf").alias("folded_leaf"), "subroot", "root", "path")
