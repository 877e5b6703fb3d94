import zlib

import numpy as np
import pyarrow as pa
import pytest

from tradeledger.llm import queries, quality_trees, textbytes

from . import corpus


def test_statistics_of_plain_texts():
    texts = ["Ab cd!\nAb cd!\n\nx1 é", None, "", "one two three four five one two three four five six", "\n \n"]
    (_, data, offsets), = textbytes.runs(pa.array(texts))
    found = quality_trees.statistics(data, offsets)
    assert found.shape == (5, len(quality_trees.STATISTICS))
    first = dict(zip(quality_trees.STATISTICS, found[0], strict=True))
    size = len(texts[0].encode())
    assert first["log_chars"] == pytest.approx(np.log1p(len(texts[0])))
    assert first["log_words"] == pytest.approx(np.log1p(6))
    assert first["distinct_words"] == pytest.approx(4 / 6)
    assert first["marked_words"] == pytest.approx(2 / 6)
    assert first["log_lines"] == pytest.approx(np.log1p(3))
    assert first["distinct_lines"] == pytest.approx(2 / 3)
    assert first["upper_share"] == pytest.approx(2 / size)
    assert not found[1].any() and not found[2].any()
    windows = dict(zip(quality_trees.STATISTICS, found[3], strict=True))["distinct_windows"]
    assert windows == pytest.approx(6 / 7)


def test_runs_do_not_change_statistics():
    rng = corpus.seeded(4)
    texts = [corpus.prose(rng, rng.randrange(0, 80)) for _ in range(40)]
    whole = [quality_trees.statistics(d, o) for _, d, o in textbytes.runs(pa.array(texts))]
    parts = [quality_trees.statistics(d, o) for _, d, o in textbytes.runs(pa.array(texts), limit=100)]
    assert len(parts) > 5
    np.testing.assert_allclose(np.concatenate(whole), np.concatenate(parts))


def sums(rows, gradient, weight, mask):
    g, h = gradient[mask].sum(), weight[mask].sum()
    return g * g / (h + quality_trees.RIDGE), h


def test_the_best_split_is_that_of_all_splits_tried():
    rng = np.random.default_rng(7)
    rows = np.round(rng.normal(size=(300, 4)), 1)
    gradient, weight = rng.normal(size=300), rng.uniform(0.1, 0.25, 300)
    edges = quality_trees.bin_edges(rows, 16)
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T, strict=True)])
    node = rng.integers(0, 2, 300)
    which, where, gain = quality_trees.best_splits(binned + np.arange(4) * 16, node, 2, 16, gradient, weight)
    for k in range(2):
        best = -np.inf
        whole, _ = sums(rows, gradient, weight, node == k)
        for f in range(4):
            for edge in edges[f]:
                left, h1 = sums(rows, gradient, weight, (node == k) & (rows[:, f] <= edge))
                right, h2 = sums(rows, gradient, weight, (node == k) & (rows[:, f] > edge))
                if min(h1, h2) >= quality_trees.LEAST_WEIGHT:
                    best = max(best, left + right - whole)
        assert gain[k] == pytest.approx(best)
        edge = edges[which[k]][where[k]]
        left, _ = sums(rows, gradient, weight, (node == k) & (rows[:, which[k]] <= edge))
        right, _ = sums(rows, gradient, weight, (node == k) & (rows[:, which[k]] > edge))
        assert left + right - whole == pytest.approx(best)


def test_flat_arrays_walk_like_a_tree_and_learn_an_interaction():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(2000, 5))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 3] > -0.2)).astype(float)
    forest = quality_trees.grow(rows[:1500], labels[:1500], trees=25, depth=3)
    inner = 7

    def walk(row):
        total = forest.base
        for t in range(25):
            node = 0
            while node < inner:
                at = t * inner + node
                node = 2 * node + (2 if row[forest.feature[at]] > forest.threshold[at] else 1)
            total += forest.value[t * 8 + node - inner]
        return total

    np.testing.assert_allclose(forest.margins(rows[:50]), [walk(r) for r in rows[:50]])
    assert ((forest.scores(rows[1500:]) > 0.5) == labels[1500:]).mean() > 0.95


def test_one_class_or_none_gives_the_base_rate():
    rows = np.zeros((4, 3))
    assert quality_trees.grow(rows, np.ones(4)).scores(rows) == pytest.approx([0.9] * 4)
    assert quality_trees.grow(rows[:0], np.zeros(0)).scores(rows) == pytest.approx([0.5] * 4)


def test_documents_without_and_with_labels(spark):
    data = corpus.awkward(corpus.seeded())
    labels = spark.createDataFrame([(900, 1, 0), (904, 0, 0), (905, 1, 0), (905, 0, 0), (None, 1, 1), (901, None, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = corpus.frame(spark, data)
    forest = quality_trees.fit(docs, labels)
    got = quality_trees.predict(docs, forest).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in data)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert quality_trees.predict(corpus.frame(spark, []), quality_trees.fit(corpus.frame(spark, []), labels)).count() == 0


def test_held_out_documents_are_told_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op13_quality_trees(spark, sf_dir).collect()}
    quality = {r["doc_id"]: r["quality"] for r in queries.table(spark, sf_dir, "labels").collect()}
    assert len(got) == 1000
    for doc_id, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert r["predicted"] == (r["score"] >= 0.7)
    some = [d for d in got if got[d]["held_out"] and quality.get(d) is not None]
    assert len(some) > 60
    assert sum(got[d]["predicted"] == quality[d] for d in some) >= 0.97 * len(some)
