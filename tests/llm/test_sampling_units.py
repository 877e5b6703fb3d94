"""Units of the lattice: cuts that no piece crosses, lattices that come back are kept, rows decoded together."""

import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tradeledger.llm import queries, sentencepiece_sampling

MODEL = queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return sentencepiece_sampling.Lattice(MODEL)


def test_no_piece_crosses_a_cut(lattice):
    texts = ["the cat sat 1995-12-31", "", "a\nb  c", "漢字🙂x", "ffc3105535f423f352535e"]
    codes, begins, cuts, _ = lattice._cuts(texts)
    whole = "".join(map(chr, codes))
    assert begins.tolist() == [0, 23, 23, 30, 35, 58]
    for cut in cuts.tolist():
        if cut not in begins:
            for a in range(max(0, cut - lattice.longest), cut):
                assert not any(whole[a:b] in lattice.pieces for b in range(cut + 1, cut + lattice.longest))
    assert len(cuts) > 30


def test_units_that_come_back_are_learned_once(lattice, monkeypatch):
    """Common words among ever new ones: they used to be forgotten with the others."""
    monkeypatch.setattr(sentencepiece_sampling, "MEMORY", 4000)
    made = sentencepiece_sampling.Lattice(MODEL)
    learned, learn = [], made._learn
    monkeypatch.setattr(made, "_learn", lambda codes, lengths: learned.append(len(lengths)) or learn(codes, lengths))
    for i in range(40):
        text = "common words " * 40 + "".join(chr(97 + (i * 7 + j * j) % 26) for j in range(900))
        (found,) = made.sample_all([text], 2, [str(i)])
        assert [x[0].tolist() for x in found] == [x[0] for x in lattice.sample(text, 2, str(i))]
    assert made.nodes < 4000 + 1500 and sum(learned) < 40 * 10
    names = Counter(made._known.tolist())
    assert max(names.values()) == 1 and np.all(np.diff(made._known.astype(object)) > 0)


def test_rows_are_decoded_as_by_the_decoder():
    coder, spelling = sentencepiece.SentencePieceProcessor(model_file=MODEL), sentencepiece_sampling.Spelling(MODEL)
    rng, size = random.Random(3), coder.get_piece_size()
    gap = coder.piece_to_id("▁")
    draws = [lambda: rng.randrange(size), lambda: rng.randrange(260), lambda: gap]
    rows = [[rng.choice(draws)() for _ in range(rng.randrange(6))] for _ in range(5000)]
    rows += [coder.encode(x) for x in ("", " a  b ", "漢字🙂\n", "▁ ▁", "plain words")]
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    got = list(spelling.texts(np.array(sum(rows, []), np.int32), ends))
    assert got == [coder.decode(x) if x else "" for x in rows]


def test_one_worker_a_task_encodes_and_decodes(spark, sf_dir):
    rows = spark.createDataFrame(
        [(1, "hello  there"), (1, "hello  there"), (2, None), (3, ""), (None, "x y 漢字🙂\n"), (4, "plain " * 3000)], "doc_id long, text string"
    )
    apart = sentencepiece_sampling.decode(sentencepiece_sampling.encode(rows, MODEL, ("doc_id",)), MODEL)
    together = sentencepiece_sampling.encode_and_decode(rows, MODEL, ("doc_id",))
    assert together.schema == apart.schema
    assert sorted(map(repr, together.collect())) == sorted(map(repr, apart.collect()))
    plan = queries.op3_sentencepiece_sampling(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
