import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tradeledger.llm import packing
from tradeledger.llm.byte_bpe import ByteBpe
from tradeledger.llm.textbytes import runs

from . import corpus

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers(tokenizer):
    rng = corpus.seeded(2)
    texts = [
        "", None, "it's don't ''s 'super we'll x'y l'eau d'une 's", " 's", "  two  spaces \n\n x", "end  \n", "\t\ttab",
        "漢字 mix ‘q’", "a<|endoftext|>b", " nb x", "12ab34 ,,,. !?", "'re're've 'l", "a\n'll", " ",
    ]
    texts += ["".join(rng.choice(" ' \n\tabsétmdrvl12.,'’ ") for _ in range(rng.randrange(60))) for _ in range(1500)]
    coder = ByteBpe(PATH, memory=500)
    for at, data, offsets in runs(pa.array(texts), limit=2000):
        ids, bounds = coder.encode_run(data, offsets)
        for d in range(len(offsets) - 1):
            expected = tokenizer.encode(texts[at + d] or "", add_special_tokens=False).ids
            assert ids[bounds[d] : bounds[d + 1]].tolist() == expected


def test_every_id_lies_in_one_piece(spark, tokenizer):
    rng = corpus.seeded(3)
    rows = corpus.awkward(rng) + [(i, corpus.prose(rng, rng.randrange(1, 900)), "en", "s", 1) for i in range(60)]
    got = packing.pack(corpus.frame(spark, rows), PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    times = Counter(r[0] for r in rows)
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == times[doc_id] * len(ids)
        for r in pieces:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.SIZE


def test_packs_hold_the_histogram_and_little_padding():
    rng = corpus.seeded(4)
    histogram = Counter(min(1023, int(rng.expovariate(1 / 300)) + 1) for _ in range(20_000))
    groups = packing.pack_histogram(dict(histogram))
    held = Counter()
    for g in groups:
        assert sum(g.lengths) <= packing.SIZE
        for n in g.lengths:
            held[n] += g.count
    assert held == histogram
    room = sum(g.count for g in groups) * packing.SIZE
    assert sum(n * c for n, c in histogram.items()) / room > 0.99
    ranks = defaultdict(list)
    for length, low, high, _, _ in packing.slots(groups):
        ranks[length].append((low, high))
    for length, spans in ranks.items():
        assert [a for a, _ in sorted(spans)] == [0, *[b for _, b in sorted(spans)][:-1]]
        assert max(b for _, b in spans) == histogram[length]


def test_no_documents(spark):
    assert packing.pack(corpus.frame(spark, [], corpus.SCHEMA), PATH).count() == 0
