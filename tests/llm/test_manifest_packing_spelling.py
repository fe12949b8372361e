"""The Merkle manifest, packing and spelling variants against brute force, and the stated results of edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsework.llm import merkle, packing, spelling
from pulsework.llm.catalog import QUERIES, VOCABULARY
from pulsework.llm.shipping import ship
from pulsework.llm.token_ids import TokenIds

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = "grp string, key long, leaf string, item long, rank long, n long, part int, word string, id long, parts long, root string"


def with_clashes(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3, 4, 5, "z", 6, 7, "r") for r in rows], f"{SCHEMA}, {CLASHING}")


@pytest.fixture(scope="module")
def vocabulary():
    with open(VOCABULARY, encoding="utf-8") as file:
        return file.read()


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """The root, and for each leaf its steps: siblings to the left and to the right."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            steps[i].append((nodes[place - 1], "") if place % 2 else ("", nodes[place + 1] if place + 1 < len(nodes) else ""))
        nodes = [hashed(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [place // 2 for place in at]
    return nodes[0], steps


def brute_manifest(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = hashed(*map(field, (doc_id, source, lang, n_chars, text)))
        more = None if n_chars is None else n_chars + 1
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        folded = hashed(*map(field, (doc_id, source, lang, more, text))) if tampered else leaf
        groups[lang].append((doc_id, leaf, folded))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = []
    for lang in order:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(tree([leaf for _, leaf, _ in groups[lang]]))
    root, upper = tree([subroot for subroot, _ in trees])
    out = []
    for lang, (subroot, steps), above in zip(order, trees, upper):
        for (doc_id, leaf, folded), path in zip(groups[lang], steps):
            for left, right in [*path, *above]:
                folded = hashed(left, folded, right)
            proof = hashed(*(left + right for left, right in [*path, *above]))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return Counter(out)


def manifest_rows(docs, bits):
    found = merkle.document_manifest(docs, bits)
    folded = merkle.fold(F.col("folded_leaf"), F.col("path"))
    proof = F.sha2(merkle.siblings(F.col("path")), 256)
    rows = found.select("doc_id", "leaf", "subroot", "root", proof, folded, folded == F.col("root")).collect()
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("bits", [1, 3])
def test_manifest_in_small_blocks(spark, bits):
    """Blocks of 2 and 8 leaves: several tiers, short last runs, lone leaves and groups."""
    draw = random.Random(bits)
    langs = ["en"] * 37 + ["de"] * 16 + ["é"] * 5 + [None] * 3 + ["zz", ""]
    rows = [(draw.randrange(40), f"t{i}\u0000é" * (i % 3), lang, "s", i) for i, lang in enumerate(langs)]
    rows += [(None, None, None, None, None), (7, "long " * 20_000, "en", None, None), rows[0], rows[0]]
    draw.shuffle(rows)
    assert manifest_rows(with_clashes(spark, rows), bits) == brute_manifest(rows)


def test_manifest_of_few_rows(spark):
    assert not manifest_rows(with_clashes(spark, []), 8)
    one = [(3, "a", "en", "s", 1)]
    got = manifest_rows(with_clashes(spark, one), 8)
    assert got == brute_manifest(one)
    assert next(iter(got))[1] == next(iter(got))[3], "a lone leaf is the root"
    many = [(i, "", f"l{i}", "s", 2**63 - 1) for i in range(9)]
    assert manifest_rows(with_clashes(spark, many), 2) == brute_manifest(many)


def test_manifest_deals_a_large_group(spark):
    """Ranks come without a window over the group, and proofs without a join of leaves."""
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars")
    )
    found = merkle.document_manifest(rows, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    assert manifest_rows(rows, 4) == brute_manifest([tuple(r) for r in rows.collect()])


def test_ids_are_the_library(vocabulary):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder = TokenIds(vocabulary)
    texts = ["".join(random.Random(i).choices("ab '\n  é1٣<|endoftext|>中", k=60)) for i in range(300)]
    for text in [*texts, " " * 300_000 + "a", "a" * 100_000, "", "<|endoftext|>"]:
        assert coder.of(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert coder.of(None).tolist() == []


def check_packed(rows, expected, limits):
    """Pieces cover each example once and in order, sequences are gapless and within all limits."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == expected.keys()
    for owner, ids in expected.items():
        parts = sorted(pieces[owner], key=lambda r: r.start)
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist() == ids
        assert all(r.doc_tokens == len(ids) and r.length == len(r.ids) // 4 > 0 for r in parts)
    wasted = 0
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        size = sum(r.length for r in parts)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert size <= limits.tokens and len(parts) <= limits.segments and sum(r.loss_tokens for r in parts) <= limits.loss
        assert {r.padded_to for r in parts} == {size if bin(size).count("1") == 1 else limits.tokens}
        wasted += parts[0].padded_to - size
    return wasted


def test_packing_of_documents(spark, vocabulary):
    ship(spark)
    draw = random.Random(4)
    texts = {i: " ".join(f"w{draw.randrange(900)}" for _ in range(int(draw.paretovariate(0.7)))) for i in range(700)}
    texts |= {800: None, 801: "", 802: "é " * 40_000, 803: " " * 200_000}
    docs = with_clashes(spark, [(i, t, "en", "s", 1) for i, t in texts.items()])
    coder = TokenIds(vocabulary)
    expected = {i: [*coder.of(t).tolist(), 0] for i, t in texts.items()}
    for limits, window in ((packing.Limits(), 1 << 20), (packing.Limits(256, 20, 256), 4000)):
        packed = packing.pack(docs.withColumn("parts", packing.document_parts(F.col("text"))), VOCABULARY, limits=limits, window=window)
        wasted = check_packed(packed.collect(), expected, limits)
        assert wasted <= 0.02 * sum(map(len, expected.values()))
    assert packing.pack(docs.limit(0).withColumn("parts", packing.document_parts(F.col("text"))), VOCABULARY).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (5, "a b"), (5, "a b")], "doc_id long, text string")
    rows = packing.pack(twice.withColumn("parts", packing.document_parts(F.col("text"))), VOCABULARY).collect()
    assert sorted((r.doc_id or 0) for r in rows if r.start == 0) == [0, 5, 5]


def test_packing_of_conversations(spark, vocabulary):
    """Only answers bear loss; the limit on loss binds before that on tokens."""
    ship(spark)
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "text", (F.col("role") == "assistant").alias("loss")))),
        lambda one: F.struct(one["text"].alias("text"), one["loss"].alias("loss")),
    )
    talks = turns.groupBy(F.col("conv_id").cast("string").alias("doc_id")).agg(parts.alias("parts"))
    odd = spark.createDataFrame([("a", None), ("b", []), ("c", [None, (None, None)])], f"doc_id string, parts {packing.PARTS}")
    talks = talks.unionByName(odd)
    coder = TokenIds(vocabulary)
    expected, bearing = {}, 0
    for r in talks.collect():
        known = [p for p in r.parts or [] if p]
        expected[r.doc_id] = [i for p in known for i in coder.of(p["text"]).tolist()] + [0]
        bearing += sum(len(coder.of(p["text"])) for p in known if p["loss"]) + bool(known and known[-1]["loss"])
    for limits in (packing.Limits(1024, 8, 300), packing.Limits(512, 3, 512), packing.Limits(64, 2, 1)):
        rows = packing.pack(talks, VOCABULARY, limits=limits).collect()
        check_packed(rows, expected, limits)
        assert sum(r.loss_tokens for r in rows) == bearing
    with pytest.raises(ValueError):
        packing.Limits(loss=0)


def test_dot_product_balances_the_limits():
    """Items heavy in tokens and items heavy in loss share sequences."""

    def item(tokens, loss):
        marks = np.append(0, np.cumsum(np.arange(tokens) < loss))
        return packing.Item(0, tokens, 0, np.zeros(tokens, np.uint32), marks)

    items = [item(90, 10) for _ in range(50)] + [item(10, 10) for _ in range(50)] + [item(50, 50) for _ in range(20)]
    done, rest = packing.fill(items, packing.Limits(200, 8, 80, slack=0), keep=0)
    assert not rest
    assert len(done) <= 1.15 * max(sum(len(i.ids) for i in items) / 200, sum(i.bearing for i in items) / 80)


def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows, rules):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in [*(text or ""), " "]:
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                at = code % len(run)
                counts[run[:at] + run[at + 1 :] if code % rules.every == 0 else run] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= rules.least_letters and n >= rules.least_count}
    near = {w: [v for v in words if edits(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= rules.ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.fixture(scope="module")
def misspelt(spark):
    ship(spark)
    draw = random.Random(9)
    base = ["".join(draw.choices("abcdeé÷ÿ", k=draw.choice((3, 4, 5, 9)))) for _ in range(60)]
    rows = []
    for i in range(150):
        words = [draw.choice(base[: 1 + draw.randrange(60)]) for _ in range(40)]
        for k in range(0, 40, 5):
            w = words[k]
            at = draw.randrange(len(w))
            words[k] = draw.choice((w[:at] + w[at + 1 :], w[:at] + "a" + w[at:], w[:at] + "b" + w[at + 1 :], w.upper()))
        rows.append((i % 140, draw.choice((" ", "-", "0", "中")).join(words), "en", "s", 1))
    rows += [(None, rows[0][1], None, None, None), (1, None, None, None, None), (2, "", None, None, None)]
    rows += [(900 + i, "q" * 50_000 + " " + "q" * 50_001, "en", "s", 1) for i in range(3)]
    return with_clashes(spark, rows)


def test_variants_against_brute_force(misspelt):
    rules = spelling.Rules(every=7, least_letters=3, least_count=2, ratio=2)
    got = spelling.group_variants(misspelt, rules=rules).collect()
    want = brute_variants(misspelt.select("doc_id", "text").collect(), rules)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert max(r.n_near for r in got) > 5 and any(r.root not in (r.word, r.form) for r in got)


def test_near_words_in_small_cells(misspelt):
    """Small cells and blocks: words are dealt over many tasks, each pair is still found once."""
    rules = spelling.Rules(every=7, least_letters=3, least_count=1, ratio=2)
    words = spelling.vocabulary(misspelt, "doc_id", "text", rules).filter("length(word) < 99")
    known = {r.word: r.n for r in words.collect()}
    rows = spelling.near_words(words, sample=100, cell=20, block=4000, asked=8000).collect()
    got = Counter((r.word, r.near, r.near_n) for r in rows)
    assert got == Counter((a, b, known[b]) for a in known for b in known if edits(a, b))


def test_variants_of_no_words(spark):
    ship(spark)
    assert spelling.group_variants(with_clashes(spark, [])).count() == 0
    assert spelling.group_variants(with_clashes(spark, [(1, "a b", "en", "s", 1)])).count() == 0


def test_tree_reaches_all_within_one_edit():
    draw = np.random.default_rng(3)
    points = draw.integers(0, 3, (500, spelling._DIMS)).astype(np.int32) * (np.arange(spelling._DIMS) < 8)
    found = spelling.Tree(points, 8)
    assert sorted(np.concatenate(found.leaves).tolist()) == list(range(500))
    pairs = {(int(w), int(i)) for leaf, who in found.reached(points, 1, 1) for w in who for i in found.leaves[leaf]}
    away = points[:, None, :].astype(int) - points[None]
    near = (np.maximum(away, 0).sum(2) <= 1) & (np.maximum(-away, 0).sum(2) <= 1)
    assert {(int(a), int(b)) for a, b in zip(*np.nonzero(near))} <= pairs
    assert len(pairs) < 0.8 * 500 * 500
    same = np.ones((40, spelling._DIMS), np.int32)
    assert len(spelling.Tree(same, 8).leaves) == 1


def test_queries_return_the_stated_columns(spark):
    columns = {
        "op11_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
        "op12_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op13_spelling_variants": "word form root n n_near form_n",
    }
    for name, want in columns.items():
        assert set(want.split()) <= set(QUERIES[name](spark, SF_DIR).columns)
