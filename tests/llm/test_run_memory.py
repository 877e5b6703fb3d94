"""Hashing a worker's batch takes memory for a run of texts at a time, not for the batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tradeledger.llm import jaccard_join, textbytes


def test_sets_of_a_large_batch_take_little_memory(monkeypatch):
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(300)) for i in range(2500)])
    monkeypatch.setattr(textbytes, "_powers", {})
    tracemalloc.start()
    sets = [tokens for _, tokens in jaccard_join._sets(texts.slice(0, 3))]
    n = sum(len(tokens) for _, tokens in jaccard_join._sets(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2500 * 296 and [len(x) for x in sets] == [296] * 3
    assert peak < 32 << 20
    assert np.array_equal(next(jaccard_join._sets(texts.slice(2, 1)))[1], sets[2])


def test_powers_grow_by_need(monkeypatch):
    monkeypatch.setattr(textbytes, "_powers", {})
    for n in (0, 1, 2, 3, 1000, 70_000, 5):
        got = textbytes.powers(3, n)
        assert len(got) == n and all(int(got[i]) == pow(3, i, 1 << 64) for i in range(0, n, 997))
    assert len(textbytes._powers[3]) < 200_000
