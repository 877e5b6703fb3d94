"""Sampling by regions of the lattice: exact masses, draws that no other text changes, a small search."""

import math
import time
from collections import Counter

import pytest

from tradeledger.llm import queries, sentencepiece_sampling


@pytest.fixture(scope="module")
def lattice():
    return sentencepiece_sampling.Lattice(queries.tokenizer_path("piece_bpe_32k.model"))


def test_draws_do_not_depend_on_the_batch(lattice):
    texts = ["the cat sat", "", "a🙂b", "the cat sat", "words of a text " * 50]
    seeds = ["1", "2", "3", "1", "5"]
    together = lattice.sample_all(texts, 3, seeds)
    alone = [sentencepiece_sampling.Lattice(queries.tokenizer_path("piece_bpe_32k.model")).sample(*x) for x in zip(texts, [3] * 5, seeds)]
    assert [[(ids.tolist(), logp, share) for ids, logp, share in one] for one in together] == alone
    assert alone[0] == alone[3]


def test_later_draws_and_all_of_few(lattice):
    """The second draw is as often a segmentation as its share of what the first has left."""
    everything = {tuple(ids): math.exp(logp) for ids, logp, _ in lattice.sample("the c", 9999, "x")}
    assert len(everything) > 3 and abs(sum(everything.values()) - 1) < 1e-9
    n, seen = 3000, Counter()
    for seed in range(n):
        seen[tuple(lattice.sample("the c", 2, str(seed))[1][0])] += 1
    for ids, p in everything.items():
        second = sum(q * p / (1 - q) for other, q in everything.items() if other != ids)
        assert abs(seen[ids] / n - second) < 4 * math.sqrt(second / n) + 2e-3


def test_texts_of_new_words_take_little_time(lattice):
    """About 1 MB of mostly new words; drawing edge by edge took over 16 s a MB."""
    texts = [" ".join(f"w{i}ord{j}ing" for j in range(500)) for i in range(160)]
    begin = time.process_time()
    for a, b in sentencepiece_sampling._slices(texts):
        for text, found in zip(texts[a:b], lattice.sample_all(texts[a:b], 3, [str(i) for i in range(a, b)]), strict=True):
            assert lattice.model.decode(found[0][0].tolist()) == text and len(found) == 3
    assert time.process_time() - begin < 8
