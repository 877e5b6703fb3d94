import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeledger.llm import fill_middle

from . import corpus


def plainly(doc_id, text, rate=100, suffix_first=50, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize(
    ("members", "kinds"),
    [
        ([0], {"ArrayPart"}),
        (range(0, 200_000), {"RunPart"}),
        (range(0, 196_608, 3), {"BitmapPart"}),
        (range(0, 300_000, 1000), {"ArrayPart"}),
        ([0, *range(65_530, 65_600), *range(131_072, 196_608, 2), 400_000], {"ArrayPart", "RunPart", "BitmapPart"}),
    ],
)
def test_select_gives_the_kth_member(members, kinds):
    members = list(members)
    found = fill_middle.OffsetSet(np.array(members, np.int64))
    assert {type(p).__name__ for p in found.parts} == kinds
    assert found.size == len(members)
    for k in {0, 1, len(members) // 2, len(members) - 1, *random.Random(3).sample(range(len(members)), min(200, len(members)))}:
        if k < len(members):
            assert found.select(k) == members[k]
    with pytest.raises(IndexError):
        found.select(len(members))


def rows():
    rng = corpus.seeded(5)
    made = corpus.awkward(rng)
    pieces = ["a", "é", "\n", "\n\n", "word ", "€uro\n", "<P", "<S", ">", "P>", "\r\n", "😀", "<"]
    for i in range(150):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 40)))
        made.append((i, text, "en", "s", len(text)))
    made += [
        (500, "\n" * 70_000 + "x", "en", "s", 1), (501, "a\n" * 90_000, "en", "s", 1), (502, "has <M> in it\n" * 3, "en", "s", 1),
        (503, "no line feed", "en", "s", 1), (504, "x<\n<S\n", "en", "s", 1),
    ]
    return made


@pytest.mark.parametrize(("rate", "suffix_first"), [(100, 50), (40, 0), (100, 100)])
def test_forms_are_those_of_plain_code_and_can_be_undone(spark, rate, suffix_first):
    data = rows()
    made = fill_middle.rearrange(corpus.frame(spark, data), rate=rate, suffix_first=suffix_first)
    made = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in made.collect()]
    wanted = [(r[0], *plainly(r[0], r[1], rate, suffix_first), r[1] or "") for r in data]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert {"plain", "psm" if suffix_first < 100 else "spm"} <= {r[2] for r in got}


def test_an_empty_table(spark):
    assert fill_middle.rearrange(corpus.frame(spark, [])).count() == 0
