import math
import textwrap
from collections import Counter
from datetime import date

import numpy as np
import public_tokenizers
import pytest

from tradeledger.llm import license_scan, multi_index, queries, sentencepiece_sampling, url_lists

from . import corpus

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))


# ---- licences ---------------------------------------------------------------

def brute_edits(template, words):
    best = len(template)
    for a in range(len(words) + 1):
        row = list(range(len(template) + 1))
        for w in words[a:]:
            new = [row[0] + 1]
            for k, t in enumerate(template):
                new.append(min(row[k + 1] + 1, new[k] + 1, row[k] + (t != w)))
            row = new
            best = min(best, row[-1])
    return best


def test_closest_stretch_against_brute_force():
    rng = corpus.seeded(20)
    for _ in range(200):
        template = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
        words = [rng.choice("abcd") for _ in range(rng.randrange(0, 12))]
        edits, begin, end = license_scan.closest(template, words)
        assert edits == brute_edits(template, words)
        assert 0 <= begin <= end <= len(words)


def test_licences_are_named_and_others_are_not(spark):
    rows = corpus.awkward(corpus.seeded(21)) + [
        (1, "some words\nReleased under the MIT License.\nmore", "en", "s", 1),
        (2, "Licensed under the Apache License, Version 2.0.", "en", "s", 1),
        (3, "This work is licensed under the GNU General Public License, version 3.\nx\nLicensed under CC BY-NC 4.0.", "en", "s", 1),
        (4, "My driving licence expired and the copyright office was closed.", "en", "s", 1),
        (5, license_scan.TEMPLATES["ISC"][0].replace("any purpose", "all purposes"), "en", "s", 1),
        (6, "GNU General Public License " + "filler words " * 4000, "en", "s", 1),
    ]
    got = [(r["doc_id"], r["block"], r["license"], r["n_different"]) for r in license_scan.scan(corpus.frame(spark, rows)).collect()]
    assert sorted(got) == [
        (1, 0, "MIT", 0), (2, 0, "Apache-2.0", 0), (3, 0, "GPL-3.0", 0), (3, 1, "CC-BY-NC-4.0", 0),
        (4, 0, None, None), (5, 0, "ISC", 2), (6, 0, None, None),
    ]
    assert license_scan.scan(corpus.frame(spark, [], corpus.SCHEMA)).count() == 0


def test_wrapped_and_dual_headers_are_named_whole(spark):
    wrapped = {name: textwrap.fill(license_scan.TEMPLATES[name][-1], 72) for name in ("MIT", "BSD-3-Clause", "ISC", "GPL-2.0")}
    short = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 A. Body\n\n" + wrapped["MIT"] + "\n\nother text", "en", "s", 1),
        (2, textwrap.indent(wrapped["BSD-3-Clause"], " * "), "en", "s", 1),
        (3, "Copyright A. Body\n" + textwrap.indent(wrapped["ISC"], "# "), "en", "s", 1),
        (4, short + "\n" + wrapped["MIT"] + "\nplain words", "en", "s", 1),
        (5, wrapped["GPL-2.0"] + "\n" + wrapped["GPL-2.0"].replace("version 2", "version 3").replace("n; e", "n, e"), "en", "s", 1),
    ]
    got = [(r["doc_id"], r["license"]) for r in license_scan.scan(corpus.frame(spark, rows)).orderBy("doc_id", "block").collect() if r["license"]]
    assert got == [
        (1, "MIT"), (2, "BSD-3-Clause"), (3, "ISC"), (4, "Apache-2.0"), (4, "MIT"), (5, "GPL-2.0"), (5, "GPL-3.0"),
    ]


# ---- segmentations ----------------------------------------------------------

@pytest.fixture(scope="module")
def lattice():
    return sentencepiece_sampling.Lattice(PIECES)


def test_segmentations_spell_the_text_and_differ(lattice):
    for text in ["the cat sat", " two  spaces \n漢字🙂", "x", "ab\tc", "a" * 300, "long text of words " * 200]:
        got = lattice.sample(text, 4, "seed")
        assert len({tuple(ids) for ids, _, _ in got}) == len(got)
        for ids, logp, inclusion in got:
            assert lattice.model.decode(ids) == text
            assert logp <= 1e-9 and 0 < inclusion <= 1


def test_draws_follow_the_probabilities(lattice):
    n = 4000
    first, inclusion, p = Counter(), Counter(), {}
    for seed in range(n):
        got = lattice.sample("abc", 2, str(seed))
        first[tuple(got[0][0])] += 1
        for ids, logp, share in got:
            inclusion[tuple(ids)] += 1 / share
            p[tuple(ids)] = math.exp(logp)
    for ids, share in p.items():
        assert abs(first[ids] / n - share) < 4 * math.sqrt(share / n) + 1e-3
        if share > 0.01:
            assert abs(inclusion[ids] / n - 1) < 0.1
    assert lattice.sample("abc", 2, "k") == lattice.sample("abc", 2, "k")
    everything = lattice.sample("ab", 99, "k")
    assert all(share == 1 for _, _, share in everything)
    assert abs(sum(math.exp(logp) for _, logp, _ in everything) - 1) < 1e-6


def test_round_trip_of_a_table(spark):
    rows = [(1, 0, "user", "hello there"), (1, 1, "bot", None), (2, 0, None, ""), (None, None, "user", "x y"), (1, 0, "user", "hello there")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, sample string, text string")
    encoded = sentencepiece_sampling.encode(turns, PIECES, ("conv_id", "turn"))
    got = sentencepiece_sampling.decode(encoded, PIECES).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in got)
    twice = [tuple(r["ids"]) for r in got if r["conv_id"] == 1 and r["turn"] == 0]
    assert len(twice) == 6 and len(set(twice)) == 3
    assert sentencepiece_sampling.encode(turns.limit(0), PIECES, ("conv_id", "turn")).count() == 0


def test_the_query_takes_every_whole_document(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    got = queries.op3_sentencepiece_sampling(spark, sf_dir).select("doc_id", "round_trip").collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert all(r["round_trip"] for r in got)


# ---- lists with dates ---------------------------------------------------------

ENTRIES = "kind string, entry string, action string, category string, event string, at date"


def test_entries_count_when_they_are_active(spark):
    d = lambda n: date(2024, 1, n)
    entries = spark.createDataFrame(
        [
            ("domain", "bad.example", "block", "spam", "add", d(5)), ("domain", "bad.example", "block", "spam", "remove", d(10)),
            ("domain", "bad.example", "block", "spam", "add", d(20)), ("domain", "bad.example", "block", "spam", "add", d(20)),
            ("prefix", "bad.example/ok", "allow", "reviewed", "add", d(7)),
            ("domain", "both.example", "block", "x", "add", d(3)), ("domain", "both.example", "block", "x", "remove", d(3)),
            (None, "all", "block", "x", "add", d(1)),
        ],
        ENTRIES,
    )
    visits = [
        (1, "http://bad.example/a", d(4)), (2, "http://www.bad.example:80/a", d(5)), (3, "http://BAD.example/a", d(10)),
        (4, "https://u@bad.example/ok/x?y", d(8)), (5, "http://bad.example/ok", d(6)), (6, "http://bad.example", d(25)),
        (7, "http://notbad.example/", d(25)), (8, None, d(5)), (9, "http://bad.example/", None), (10, "no url", d(5)),
        (11, "http://both.example/", d(3)), (2, "http://www.bad.example:80/a", d(5)),
    ]
    captures = spark.createDataFrame(visits, "page_id long, url string, fetched_at date").selectExpr("*", "'x' AS rule", "1 AS slice")
    got = url_lists.judged(captures, entries).collect()
    assert len(got) == len(visits)
    assert {r["page_id"] for r in got if r["blocked"]} == {2, 5, 6}
    assert {r["page_id"]: r["rule"] for r in got if r["rule"]} == {
        2: "bad.example", 4: "bad.example/ok", 5: "bad.example", 6: "bad.example"
    }
    assert url_lists.judged(captures.limit(0), entries).count() == 0
    assert not any(r["blocked"] for r in url_lists.judged(captures, entries.limit(0)).collect())


# ---- vectors ----------------------------------------------------------------

def test_links_against_brute_force(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16))
    vectors = np.concatenate([c + rng.normal(0, s, (12, 16)) for c, s in zip(centres, np.linspace(0.02, 0.3, 40), strict=True)])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    rows += [(600 + i, rows[3][1], 0) for i in range(50)]
    odd = [
        (700, None, 0), (701, [0.0] * 16, 0), (702, [float("nan")] * 16, 0), (703, [None] * 16, 0), (704, [1.0] * 3, 0),
        (705, [float("inf")] + [1.0] * 15, 0), (706, [], 0), (None, rows[0][1], 0),
    ]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS n", "2 AS cell")
    got = multi_index.near_vectors(df.repartition(5), codes=8).collect()
    assert len(got) == len(rows) + len(odd)
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    by_id = {r["vec_id"]: r for r in got if r["vec_id"] is not None}
    found = np.array([by_id[i]["n_links"] for i in ids])
    assert (found <= near.sum(1)).all()
    assert found.sum() >= 0.98 * near.sum()
    assert {by_id[600 + i]["component_id"] for i in range(50)} == {by_id[3]["component_id"]}
    for r in odd:
        if r[0] is not None:
            assert (by_id[r[0]]["n_links"], by_id[r[0]]["component_id"], by_id[r[0]]["kept"]) == (0, r[0], True)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in by_id.values())
    assert multi_index.near_vectors(df.limit(0)).count() == 0


def test_visits_come_from_all_rows_and_are_not_capped():
    few = np.array([[k, 3, 1] for k in range(20)])
    assert multi_index.needed_visits(few, 4096) == 4096  # too few to tell
    far = np.array([[k, 3, 100] for k in range(60)] + [[60 + k, 900, 1] for k in range(60)])
    assert multi_index.needed_visits(far, 4096) == 900  # small groups count as well, and above 512 visits
    never = np.array([[k, 4097, 1] for k in range(60)])
    assert multi_index.needed_visits(never, 4096) == 4096


def test_pairs_too_rare_for_a_sample_are_all_found(spark, monkeypatch):
    """Few probes have a partner among many rows: no cell may be left out then."""
    rng = np.random.default_rng(15)
    one = rng.normal(size=(600, 16))
    two = one + rng.normal(0, 0.2, one.shape)
    vectors = np.concatenate([one, two])
    monkeypatch.setattr(multi_index, "SAMPLE", 100)
    monkeypatch.setattr(multi_index, "PROBES", 30)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = multi_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), codes=64)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    assert {r["vec_id"]: r["n_links"] for r in got.collect()} == dict(enumerate(near.sum(1).tolist()))


def test_vectors_of_several_lengths_and_sizes(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1e200, 1e198]), (3, [1e-200, 1e-203]), (4, [0.0, 1.0]), (5, [3.0, 4.0, 0.0]), (6, [3.0, 4.01, 0.0]),
        (7, [-3.0, 4.0, 0.0]), (8, [2.0]), (9, [5.0]), (10, [-5.0]), (11, [1.0, 1.0, 1.0, 1.0]), (12, []), (13, None),
        (1, None), (5, [3.0, 4.0, 0.0]),
    ]
    found = multi_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found.collect())
    assert got == [
        (1, 0, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4), (5, 2, 5), (5, 2, 5), (6, 2, 5), (7, 0, 7), (8, 1, 8), (9, 1, 8),
        (10, 0, 10), (11, 0, 11), (12, 0, 12), (13, 0, 13),
    ]
