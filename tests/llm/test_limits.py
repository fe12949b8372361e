"""Inputs that once took too long, addresses as hosts, and columns with the names that operators use inside."""

import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from pulsework.llm import bpe, host_rules, licence_scan, probminhash, secret_scan, url_lists
from pulsework.llm.catalog import VOCABULARY
from pulsework.llm.shipping import ship
from pulsework.llm.text import WordHashes, plain_words

TEXT = " ".join(f"w{i}" for i in range(80))


def test_indented_blank_lines_and_repeated_headers_are_scanned_in_linear_time():
    begun = time.perf_counter()
    secret_scan.secret_spans("a" * 24 + ("\n" + " " * 6) * 200 + ".")
    secret_scan.secret_spans("b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAAAMwAAAAtzc2gt\n" * 3000)
    assert time.perf_counter() - begun < 3


def test_repeated_notices_are_chained_in_linear_time():
    templates = tuple((k, tuple(v)) for k, v in licence_scan.TEMPLATES.items())
    scanner = licence_scan.Scanner(templates, tuple(licence_scan.PHRASES.items()), 4, 0.8)
    words = plain_words((licence_scan.TEMPLATES[templates[0][0]][0] + " ") * 20_000)
    begun = time.perf_counter()
    assert len(scanner.spans(words)) == 20_000
    assert time.perf_counter() - begun < 3


def test_an_address_has_no_parent_domains(spark):
    urls = ["http://1.2.3.4/x", "http://[::ffff:1.2.3.4]/x", "http://a.b.com/x"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(url_lists.keys_of(F.col("url")).alias("k")).collect()
    assert [r.k for r in got] == [
        ["1.2.3.4/x", "1.2.3.4"], ["[::ffff:1.2.3.4]/x", "[::ffff:1.2.3.4]"], ["a.b.com/x", "a.b.com", "b.com"]
    ]


def test_clashing_names(spark):
    ship(spark)
    names = ["_id", "_own", "_digest", "_host", "_rate", "_bad", "_found", "_url", "_at", "_best", "_row", "row", "id", "node"]
    docs = spark.createDataFrame([(i, TEXT, "a") for i in (1, 2, 3)], "doc_id long, text string, source string")
    docs = docs.withColumns({n: F.lit(n) for n in names})
    kept = probminhash.keep_one(docs).collect()
    assert [r.doc_id for r in kept] == [1] and all(kept[0][n] == n for n in names) and len(kept[0]) == 3 + len(names)
    judged = host_rules.judge(host_rules.measure(docs))
    assert set(names) <= set(judged.columns) and judged.filter("kept").count() == 3
    times = docs.select("*", F.lit("http://1.2.3.4/x").alias("url"), F.timestamp_seconds("doc_id").alias("fetched_at"))
    entries = spark.sql("SELECT 'block' list, '3.4' key, 'add' action, timestamp'1960-01-01' at")
    found = url_lists.evaluate(times, entries).collect()
    assert len(found) == 3 and not any(r.blocked for r in found) and all(r[n] == n for r in found for n in names)


def test_one_id_for_two_texts_links_both(spark):
    ship(spark)
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(1, TEXT), (1, other), (2, TEXT + " x"), (3, other + " x"), (4, "quite another text of a few words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_what_workers_keep_between_stages_is_small():
    """Workers live on from stage to stage, so tables and known words of all of them lie beside the executor's heap."""
    with open(VOCABULARY, encoding="utf-8") as file:
        coder = bpe.Encoder(file.read())
    assert sum(a.nbytes for a in vars(coder).values() if isinstance(a, np.ndarray)) < 16 << 20
    tracemalloc.start()
    hashes = WordHashes()
    for i in range(0, 400_000, 1000):
        hashes.of([b"word-%d" % j for j in range(i, i + 1000)])
    assert tracemalloc.get_traced_memory()[1] < 32 << 20
    for i in range(0, 400_000, 10_000):
        coder.learn({f"w{j}" for j in range(i, i + 10_000)})
    assert tracemalloc.get_traced_memory()[1] < 96 << 20
    tracemalloc.stop()
