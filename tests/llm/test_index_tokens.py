from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tradeledger.llm import jaccard_join

from . import corpus


def test_common_phrases_make_no_index_and_near_copies_share_a_token(spark):
    """Texts with a phrase in common are not compared with each other; near copies with it always meet."""
    rng = corpus.seeded(5)
    phrase = corpus.words(rng, 20, 10**6)
    rows, copies = [], {}
    for i in range(300):
        own = corpus.words(rng, 50, 10**6) + phrase + corpus.words(rng, 50, 10**6)
        rows.append((2 * i, " ".join(own), "en", "s", 0))
        if i < 20:
            own[rng.randrange(len(own))] = f"edit{i}"
            rows.append((2 * i + 1, " ".join(own), "en", "s", 0))
            copies[2 * i] = 2 * i + 1
    info = jaccard_join.described(corpus.frame(spark, rows)).cache()
    ids = {r["doc_id"]: r["set_id"] for r in info.collect()}
    index = defaultdict(set)
    common = jaccard_join.common_tokens(info).cache()
    for r in common.filter("indexed").collect():
        index[r["set_id"]].add(r["token"])
    assert all(index[ids[a]] & index[ids[b]] for a, b in copies.items())
    # texts without a copy may have an index token now and then
    met = jaccard_join.shared_tokens(common)
    compared = met.filter("set_id <> pivot").select("set_id", "pivot").distinct().count()
    assert compared < 2 * len(copies)
    assert info.agg(F.max(F.size("prefix"))).first()[0] < 40


def test_signatures_never_tell_similar_sets_apart(spark):
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(3)]
    for found in list(sets):
        sets.append(np.unique(np.concatenate([found[:280], rng.integers(0, 2**63, 12).astype(np.uint64)])))
    rows = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "set_id long, tokens binary")
    signs = {r["set_id"]: r[1:] for r in jaccard_join.signatures(rows).collect()}
    for i in signs:
        for j in signs:
            differ = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(signs[i], signs[j], strict=True))
            assert differ <= len(np.setxor1d(sets[i], sets[j]))
            assert (differ <= 70) == (i % 3 == j % 3)
