import re

import numpy as np
import pyarrow as pa
import pytest

from tradeledger.llm import quality_rules, textbytes

from . import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_of_runs_are_those_of_the_pattern():
    texts = ["a b", None, "", "  x\x0b\x1cy \n", "tail", "É b c", "z"]
    for at, data, offsets in textbytes.runs(pa.array(texts), limit=8):
        found = textbytes.find_words(data, offsets)
        raw = data.tobytes()
        for d in range(len(offsets) - 1):
            span = range(found.first[d], found.first[d + 1])
            got = [raw[found.start[i] : found.end[i]].decode() for i in span]
            assert got == WORD.findall(texts[at + d] or "")


def test_hashes_depend_on_content_alone():
    texts = pa.array(["One two one", "x ONE", "onetwo"])
    (_, data, offsets), = textbytes.runs(texts)
    found = textbytes.find_words(data, offsets)
    folded = textbytes.word_hashes(found, fold=True)
    exact = textbytes.word_hashes(found, fold=False)
    assert folded[0] == folded[2] == folded[4]
    assert len({exact[0], exact[2], exact[4]}) == 3
    assert folded[5] not in folded[:5]
    assert len(textbytes.shingle_hashes(folded[:3])) == 1
    assert len(textbytes.shingle_hashes(np.arange(7, dtype=np.uint64))) == 3


def repeated(found):
    windows = {}
    for i in range(len(found) - 4):
        windows.setdefault(tuple(found[i : i + 5]), []).append(i)
    return len({i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)})


def test_measures_against_brute_force(spark):
    rng = corpus.seeded()
    rows = corpus.awkward(rng)
    for i in range(40):
        found = corpus.words(rng, rng.randrange(1, 60), vocabulary=rng.choice([2, 5, 200]))
        text = "".join(w + rng.choice([" ", "\n", "\t ", " #* ", "\n\n"]) for w in found)
        rows.append((i, text, "en", "s", len(text)))
    got = quality_rules.measures(corpus.frame(spark, rows)).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"]]
        found = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert r["n_words"] == len(found)
        assert r["word_chars"] == sum(map(len, found))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeated(found)
        failed = len(found) < 10 or 100 * repeated(found) > 20 * len(found)
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and not r["broken_rules"])


def test_nothing_gives_nothing_and_no_python_runs(spark):
    df = quality_rules.measures(corpus.frame(spark, [], corpus.SCHEMA))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", [r.name for r in quality_rules.RULES])
def test_every_rule_is_a_range(name):
    rule = next(r for r in quality_rules.RULES if r.name == name)
    assert rule.least is not None or rule.most is not None
