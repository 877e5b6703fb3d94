import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tradeledger.llm import jaccard_join, sparse_suffix
from tradeledger.llm.components import connected_components

from . import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least_ids(vertices, links):
    parent = {v: v for v in vertices}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in vertices}


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)] + [(8, 8), (7, 200), (200, 7)]
    got = connected_components(spark.createDataFrame(path + star, "a long, b long").repartition(4))
    expected = least_ids({v for e in path + star for v in e}, path + star)
    assert {r["vertex"]: r["component"] for r in got.collect()} == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


@pytest.fixture(scope="module")
def crowd():
    """Exact copies, a large group of near copies that differ from each other, passages and chains."""
    rng = corpus.seeded(11)
    base = corpus.words(rng, 120, 10_000)
    rows = corpus.awkward(rng)
    n = 0

    def add(found):
        nonlocal n
        n += 1
        text = " ".join(found)
        rows.append((n, text.upper() if rng.random() < 0.2 else text, "en", "s", len(text)))

    for _ in range(90):
        copy = list(base)
        for _ in range(rng.randrange(0, 5)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
        add(copy)
    for _ in range(30):
        add(base)
    passage = corpus.words(rng, 40, 10_000)
    for _ in range(40):
        add(corpus.words(rng, 60, 10_000) + passage + corpus.words(rng, rng.randrange(5, 60), 10_000))
    chain = corpus.words(rng, 150, 10_000)
    for i in range(12):
        chain = list(chain)
        chain[5 + 11 * i] = f"link{i}"
        add(chain)
    for size in (1, 2, 4, 5, 6):
        add(corpus.words(rng, size, 3))
        add(corpus.words(rng, size, 3))
    return rows


def test_components_against_brute_force(spark, crowd):
    docs = corpus.frame(spark, crowd)
    got = {r["doc_id"]: r for r in jaccard_join.near_duplicates(docs).collect()}
    sets = {r[0]: shingles(r[1]) for r in crowd if r[0] is not None}
    links = []
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    expected = least_ids(ids, links)
    assert {i: got[i]["component_id"] for i in ids} == expected
    assert {i: got[i]["n_shingles"] for i in ids} == {i: len(sets[i]) for i in ids}
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    stay = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert stay - {None} == {i for i in ids if expected[i] == i}


def test_filters_never_drop_a_similar_pair():
    rng = np.random.default_rng(3)
    rarity = rng.integers(0, 50, (2, jaccard_join.SKETCH)).astype(np.uint32)
    seen = 0
    for _ in range(400):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = a[rng.random(len(a)) < rng.uniform(0.75, 1)]
        b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, int(rng.integers(0, 6))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        seen += 1
        prefixes = [jaccard_join._ordered(x, 0, rarity)[: jaccard_join.prefix_length(len(x))] for x in (a, b)]
        assert len(np.intersect1d(*prefixes))
        assert jaccard_join.may_be_similar(prefixes[0], len(a), prefixes[1], len(b), rarity)
        assert jaccard_join.similar(a, b, rarity)
    assert seen > 100


def test_no_document_and_nothing_shared(spark):
    assert jaccard_join.near_duplicates(corpus.frame(spark, [], corpus.SCHEMA)).count() == 0
    rows = [(1, "a b c d e f g", "en", "s", 1), (2, "h i j k l m n", "en", "s", 1), (3, None, None, None, None)]
    got = jaccard_join.near_duplicates(corpus.frame(spark, rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 2), (3, 3)}


def brute_repeats(rows):
    """Words of each document inside a run of MIN_WORDS that an earlier document has."""
    first, covered = {}, defaultdict(set)
    size = sparse_suffix.MIN_WORDS
    for doc_id, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        found = WORD.findall(text or "")
        for i in range(len(found) - size + 1):
            window = tuple(found[i : i + size])
            if first.setdefault(window, doc_id) != doc_id:
                covered[doc_id].update(range(i, i + size))
    return covered


@pytest.fixture(scope="module")
def passages():
    rng = corpus.seeded(12)
    shared = [corpus.words(rng, size, 10_000) for size in (49, 50, 51, 80, 200)]
    rows = corpus.awkward(rng)
    for i in range(60):
        text = corpus.words(rng, rng.randrange(0, 90), 10_000)
        for p in rng.sample(shared, rng.randrange(0, 3)):
            text = text + p + corpus.words(rng, rng.randrange(0, 40), 10_000)
        rows.append((i, " ".join(text), "en", "s", 1))
    rows += [(300 + i, " ".join(shared[4]), "en", "s", 1) for i in range(30)]
    return rows


def test_repeats_against_brute_force(spark, passages):
    docs = corpus.frame(spark, passages)
    got = defaultdict(set)
    for r in sparse_suffix.repeated_passages(docs).collect():
        assert r["of_doc"] < r["doc_id"] and r["n_words"] == r["end"] - r["start"] >= 50
        got[r["doc_id"]].update(range(r["start"], r["end"]))
    assert got == brute_repeats(passages)


def test_cutting_leaves_the_first_copy_and_clean_documents(spark, passages):
    docs = corpus.frame(spark, passages, extra=False)
    cut = sparse_suffix.remove_repeats(docs)
    assert cut.columns == docs.columns
    expected = brute_repeats(passages)
    got = {r["doc_id"]: r for r in cut.collect()}
    for doc_id, text, *_ in passages:
        found = WORD.findall(text or "")
        left = [w for i, w in enumerate(found) if i not in expected.get(doc_id, ())]
        if doc_id in expected:
            assert (doc_id in got) == bool(left)
            if left:
                assert WORD.findall(got[doc_id]["text"]) == left
                assert got[doc_id]["n_chars"] == len(got[doc_id]["text"])
        else:
            assert got[doc_id]["text"] == text
    assert sparse_suffix.remove_repeats(docs.limit(0)).count() == 0


def test_a_key_over_many_tasks_meets_across_them():
    """The walk sees one key in three tasks; edges bring the three first documents together."""
    rng = np.random.default_rng(5)
    own = rng.integers(1, 2**63, 60).astype(np.uint64)
    left, right = sparse_suffix._contexts(own, np.array([5]))

    def task(ids):
        part = (np.full(len(ids), 9), np.array(ids), np.full(len(ids), 5, int), left.repeat(len(ids), 0), right.repeat(len(ids), 0))
        rows = [r for b in sparse_suffix._neighbours([sparse_suffix._suffix_batch([part])]) for r in b.to_pylist()]
        return [r for r in rows if r["edge"]], {r["doc_id"] for r in rows if not r["edge"]}

    edges, inside = zip(*[task(ids) for ids in ([4, 9], [2, 7], [3])], strict=True)
    table = pa.Table.from_pylist([e for part in edges for e in part]).to_pandas()
    across = set(sparse_suffix._across(table[["key", "doc_id", "start", "left", "right"]])["doc_id"])
    assert set().union(*inside) | across == {3, 4, 7, 9}


def test_repeats_among_edited_copies_in_any_order(spark):
    """Every holder of a passage is listed, though the key's first document has it edited on either side."""
    rng = corpus.seeded(14)
    rows = []
    for p in range(12):
        passage = corpus.words(rng, 50, 10_000)
        for i in range(30):
            own = list(passage)
            if i < 8 or rng.random() < 0.4:
                own[rng.choice([0, 1, 2, 3, 45, 47, 48, 49])] = f"edit{p}x{i}"
            text = corpus.words(rng, rng.randrange(0, 30), 10_000) + own + corpus.words(rng, rng.randrange(0, 30), 10_000)
            rows.append((p + 100 * i, " ".join(text), "en", "s", 1))
    rng.shuffle(rows)
    got = defaultdict(set)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # keys go on in other batches
    try:
        for r in sparse_suffix.repeated_passages(corpus.frame(spark, rows)).collect():
            assert r["of_doc"] < r["doc_id"]
            got[r["doc_id"]].update(range(r["start"], r["end"]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_repeats(rows)


def test_rows_that_share_a_doc_id_but_no_text(spark):
    rng = corpus.seeded(21)
    passage = " ".join(f"p{i}" for i in range(80))
    other = " ".join(corpus.words(rng, 100))
    rows = [
        (1, f"first {passage} end", "en", "s", 1), (2, f"start {passage} tail", "en", "s", 1), (2, None, "en", "s", None),
        (2, other, "en", "s", 1), (3, f"x {passage}", "en", "s", 1), (3, None, None, None, None), (None, passage, "en", "s", 1),
    ]
    docs = corpus.frame(spark, rows)
    got = sorted(((r["doc_id"], r["text"]) for r in sparse_suffix.remove_repeats(docs).collect()), key=repr)
    assert len(got) == len(rows)
    kept = {t for d, t in got if d == 2}
    assert None in kept and other in kept
    assert {t for d, t in got if d == 3} == {None, "x "}
    assert (1, f"first {passage} end") in got and (None, passage) in got
