import re
from collections import Counter

import numpy as np
import pytest

from tradeledger.llm import bit_tables, collocations

from . import corpus


def plainly(rows, least, top, absorbed=80):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for m in range(1, 5):
                for i in range(len(found) - m + 1):
                    counts[lang, tuple(found[i : i + m])] += 1
    longer = Counter()
    for (lang, words), a in counts.items():
        if a >= least:
            for width in range(2, len(words)):
                for i in range(len(words) - width + 1):
                    key = lang, words[i : i + width]
                    longer[key] = max(longer[key], a)
    found = {}
    for (lang, words), a in counts.items():
        if len(words) < 2 or a < least or 100 * longer[lang, words] >= absorbed * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, x[2].decode(), -x[1], x[3], x[4], totals[lang], -x[0])
        for lang, some in found.items()
        for rank, x in enumerate(sorted(some)[:top], 1)
    )


def rows():
    rng = corpus.seeded(11)
    made = corpus.awkward(rng)
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 60)):
            parts.append(rng.choice(["new york", "New York City", "in the", "of the", "é", "a", "the", "x" * 40, "to be or not"]))
            parts.append(rng.choice([" ", "  ", "\t", ", ", ".\n", "\x0b", "\r\n", "", "; "]))
        text = "".join(parts)
        made.append((i, text, rng.choice(["en", "fr", None, "und"]), "s", len(text)))
    return made + made[20:40]


@pytest.mark.parametrize(("least", "top", "hot"), [(30, 2000, 1_000_000), (5, 2000, 40), (8, 7, 1)])
def test_phrases_are_those_of_plain_counting(spark, least, top, hot, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 500)
    data = rows()
    made = collocations.collocations(corpus.frame(spark, data), least, top, hot=hot)
    got = sorted(tuple(r) for r in made.collect())
    assert got == plainly(data, least, top)
    assert len(got) > 5


@pytest.mark.parametrize("parts", [False, True])
def test_quicksort_finds_every_frequent_prefix(parts):
    rng = np.random.default_rng(2)
    keys = rng.integers(1, 6, (3000, 4)).astype(np.int64) * 7919
    keys[rng.random(3000) < 0.3, 3] = 0
    weights = rng.integers(1, 4, 3000)
    counts = Counter()
    for row, w in zip(keys.tolist(), weights.tolist(), strict=True):
        for m in range(1, 5):
            if row[m - 1]:
                counts[tuple(row[:m])] += w
    got = {}
    for length, at, n in collocations.sort_suffixes(keys, weights, 12, parts):
        for i, x in zip(at.tolist(), n.tolist(), strict=True):
            assert tuple(keys[i, :length]) not in got
            got[tuple(keys[i, :length].tolist())] = x
    wanted = {k: v for k, v in counts.items() if v >= 12}
    assert {k: v for k, v in got.items() if v >= 12} == wanted
    if parts:
        assert {k: v for k, v in got.items() if len(k) < 4} == {k: v for k, v in counts.items() if len(k) < 4}


def test_nothing_to_sort():
    assert not list(collocations.sort_suffixes(np.zeros((0, 4), np.int64), np.zeros(0, np.int64), 3))


def test_an_empty_table(spark):
    assert collocations.collocations(corpus.frame(spark, [])).count() == 0


def test_bit_tables_hold_every_id(spark):
    ids = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    df = spark.createDataFrame([(int(i),) for i in ids[:2000]], "id long")
    table = bit_tables.bit_table(df, bit_tables.wanted_bits(2000))
    assert bit_tables.contains(table, ids[:2000]).all()
    assert bit_tables.contains(table, ids[2000:]).mean() < 0.02
    assert 0 < bit_tables.filled(table) < 0.02
