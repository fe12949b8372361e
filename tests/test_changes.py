"""Tables merged when they are read: equal to upserts one after the other, and a load writes its own rows only."""

import os
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsework import changes, sinks
from pulsework.operators import merge
from pulsework.operators.changelog import LOAD, UpsertRule, merged
from pulsework.operators.latest import latest_by_key
from pulsework.plans.catalog import streams
from pulsework.streaming import read_state, upsert_latest

KV = "k string, g int, v string, w string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_after_the_other(loads, rule):
    cols = list(rule.update_cols) if rule.update_cols is not None else None
    return reduce(
        lambda t, s: merge.upsert(t, s, list(rule.keys), cols, rule.newer_by, null_safe=rule.null_safe), loads[1:], loads[0]
    )


def log(loads):
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn(LOAD, F.lit(i).cast("long")) for i, df in enumerate(loads)])


load = st.dictionaries(
    st.sampled_from(["a", "b", "c", None]),
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("xyz"), st.sampled_from("xyz")),
    max_size=4,
)
RULES = [
    UpsertRule(("k",)),
    UpsertRule(("k",), ("v",)),
    UpsertRule(("k",), ("v",), "g"),
    UpsertRule(("k",), None, "g"),
    UpsertRule(("k",), ("v",), "g", null_safe=True),
    UpsertRule(("k",), ()),
]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=st.lists(load, min_size=1, max_size=4), rule=st.sampled_from(RULES), cut=st.integers(1, 3))
def test_merged_log_equals_a_chain_of_upserts(spark, loads, rule, cut):
    """Also with any beginning of the log folded: the aggregate is associative."""
    frames = [spark.createDataFrame([(k, *v) for k, v in one.items()], KV) for one in loads]
    want = rows(one_after_the_other(frames, rule))
    assert rows(merged(log(frames), rule)) == want
    folded = [merged(log(frames[:cut]), rule), *frames[cut:]]
    assert rows(merged(log(folded), rule)) == want


def files(spark, name):
    table = changes.log_of(spark, name)
    return {os.path.basename(f) for f in spark.table(table).inputFiles()}


@pytest.mark.parametrize("rule", RULES[2:5])
def test_a_load_writes_its_rows_and_folding_changes_no_result(spark, folder, unique, rule):
    name = unique("playbooks")
    base = spark.range(500).selectExpr("string(id) k", "int(id % 5) g", "'t' v", "'t' w")
    first = base.unionByName(spark.createDataFrame([(None, 1, "n", "n"), ("null guard", None, "t", "t")], KV))
    second = spark.createDataFrame([("1", 9, "s", "s"), ("2", 1, "s", "s"), ("null guard", 5, "s", "s"), (None, 3, "s", "s")], KV)
    third = spark.createDataFrame([("1", 8, "u", "u"), ("new", 8, "u", "u")], KV)
    assert changes.append_changes(first, name, rule, folder) == 0
    before = files(spark, name)
    for number, source in enumerate((second, third), 1):
        assert changes.append_changes(source, name, rule, folder) == number
    assert before < files(spark, name), "files of earlier loads stay as they are"
    log_rows = spark.table(changes.log_of(spark, name))
    assert log_rows.filter(f"{LOAD} > 0").count() == 6
    want = rows(one_after_the_other([first, second, third], rule))
    assert rows(spark.table(name)) == want
    changes.fold_changes(spark, name, folder)
    assert rows(spark.table(name)) == want
    assert rows(spark.table(changes.log_of(spark, name)).groupBy(LOAD).count()) == [(2, len(want))]
    fourth = spark.createDataFrame([("1", 9, "z", "z"), ("new", 9, "z", "z")], KV)
    changes.append_changes(fourth, name, rule, folder)
    assert rows(spark.table(name)) == rows(one_after_the_other([first, second, third, fourth], rule))


def test_published_tables_are_taken_over(spark, folder, unique):
    name, rule = unique("users"), UpsertRule(("k",), ("v",), "g")
    first = spark.createDataFrame([("a", 1, "t", "t"), ("b", 1, "t", "t")], KV)
    sinks.publish(first, name, folder)
    assert changes.log_of(spark, name) is None
    source = spark.createDataFrame([("a", 2, "s", "s")], KV)
    changes.append_changes(source, name, rule, folder)
    assert rows(spark.table(name)) == [("a", 2, "s", "t"), ("b", 1, "t", "t")]
    with pytest.raises(ValueError):
        changes.append_changes(source, name, UpsertRule(("k",)), folder)


def test_folding_by_itself_layout_and_copies(spark, folder, unique):
    name, rule = unique("touches"), UpsertRule(("k", "w"), None, "g")
    for i in range(7):
        source = spark.createDataFrame([("a", i, str(i), "x"), (f"k{i}", 1, "s", "y")], KV)
        changes.append_changes(source, name, rule, folder, partition_by=["w"], fold_after=3)
    assert len({r[0] for r in spark.table(changes.log_of(spark, name)).select(LOAD).distinct().collect()}) < 3
    assert rows(spark.table(name)) == sorted([("a", 6, "6", "x"), *((f"k{i}", 1, "s", "y") for i in range(7))])
    assert any("w=x" in f for f in spark.table(changes.log_of(spark, name)).inputFiles())
    assert spark.sql(f"SHOW TABLES LIKE '{name}__*'").count() == 2


def test_expiry_folds(spark, folder, unique):
    name, rule = unique("seen"), UpsertRule(("k",), None, "t")
    old = spark.sql("SELECT 'a' k, timestamp'2024-01-01' t UNION ALL SELECT 'b', timestamp'2024-01-01' UNION ALL SELECT 'c', NULL")
    changes.append_changes(old, name, rule, folder)
    changes.append_changes(spark.sql("SELECT 'a' k, timestamp'2024-06-01' t"), name, rule, folder)
    changes.expire_changes(spark, name, "t", "2024-07-01", root=folder)
    assert [r.k for r in spark.table(name).orderBy("k").collect()] == ["a", "c"]


def test_merging_combines_before_the_shuffle(spark):
    plan = merged(spark.createDataFrame([("a", 1, "v", "w", 0)], f"{KV}, {LOAD} long"), RULES[2])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max_by" in text and "Join" not in text and "Window" not in text


def stream_in(spark, folder, batches, **more):
    """Each batch arrives as a file; the job is started anew for it."""
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/arriving")
        stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arriving")
        upsert_latest(stream, f"{folder}/state", f"{folder}/checkpoint", ["k"], ["g"], "g", **more)


def test_stream_batch_writes_what_it_brings(spark, folder):
    first = spark.range(1000).selectExpr("string(id) k", "1 g", "'t' v", "'t' w")
    some = spark.range(10).selectExpr("string(id * 7) k", "2 g", "'s' v", "'s' w")
    stream_in(spark, folder, [first, some], update_cols=["v"])
    assert spark.read.parquet(f"{folder}/state/batch=1").count() == 10
    state = read_state(spark, f"{folder}/state")
    assert state.count() == 1000 and state.filter("v = 's' AND g = 2 AND w = 't'").count() == 10


def test_stream_state_equals_upserts_of_the_batches(spark, folder):
    """Stale rows, equal guards, NULL guards and keys; folded on the way, which drops merged folders."""
    batches = [
        spark.createDataFrame(b, KV)
        for b in (
            [("a", 1, "1", "1"), ("b", None, "1", "1"), (None, 1, "n", "1")],
            [("a", 3, "2", "2"), ("a", 2, "x", "x"), ("b", 5, "2", "2")],
            [("a", 3, "z", "z"), ("c", 1, "3", "3"), (None, 2, "n", "3")],
            [("a", 2, "old", "old"), ("c", 2, "4", "4")],
            [("c", 1, "5", "5"), ("d", 1, "5", "5")],
        )
    ]
    stream_in(spark, folder, batches, update_cols=["v"], fold_after=1)
    newest = [latest_by_key(b, ["k"], ["g"]) for b in batches]
    assert rows(read_state(spark, f"{folder}/state")) == rows(one_after_the_other(newest, RULES[2]))
    left = sorted(f for f in os.listdir(f"{folder}/state") if "=" in f)
    assert left == ["batch=3", "batch=4", "upto=2", "upto=3"]
    with pytest.raises(ValueError):
        upsert_latest(batches[0], folder, folder, ["k"], ["g"], "v")


def test_query_takes_each_part_as_one_batch_however_many_files_it_has(spark, folder, monkeypatch):
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(streams, "new_work_dir", lambda spark, label: f"{folder}/{label}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(4).write.parquet(f"{folder}/events.parquet")
    try:
        streams.stream_latest_upsert(spark, folder)
        parts = [len([f for f in os.listdir(f"{folder}/stream/arriving/part={n}") if f.endswith(".parquet")]) for n in range(3)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert min(parts) > 1
    assert sorted(f for f in os.listdir(f"{folder}/stream/checkpoint/commits") if f.isdigit()) == ["0", "1", "2"]
