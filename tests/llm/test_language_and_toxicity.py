import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeledger.llm import language_id, toxicity

from . import corpus

SYLLABLES = {"aa": ["tho", "wer", "ing"], "bb": ["çéa", "lou", "eux"], "cc": ["sch", "ung", "ßpf"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def languages():
    rng = corpus.seeded(5)
    rows = [(i, sentence(rng, lang, rng.randrange(5, 80)), lang, "s", 1) for i, lang in enumerate(list(SYLLABLES) * 60)]
    return rows


def test_network_learns_and_holds(spark, languages):
    docs = corpus.frame(spark, languages + corpus.awkward(corpus.seeded(6)))
    learn = docs.filter(~language_id.held_out() & F.col("lang").isin(*SYLLABLES))
    model = language_id.train(language_id.training_windows(learn, windows=40), steps=150, batch=32)
    assert model.languages == sorted(SYLLABLES)
    got = language_id.predict(docs, model).collect()
    assert len(got) == docs.count()
    true = {r[0]: r[2] for r in languages}
    held = {r["doc_id"] for r in docs.filter(language_id.held_out()).select("doc_id").collect()}
    seen = [r for r in got if r["doc_id"] in held and r["doc_id"] in true]
    assert np.mean([r["lang_pred"] == true[r["doc_id"]] for r in seen]) > 0.95
    by_id = {r["doc_id"]: r for r in got}
    for nothing in (900, 901, 902):
        assert (by_id[nothing]["lang_pred"], by_id[nothing]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert not {900, 901, 902} & {r["doc_id"] for r in kept.select("doc_id").collect()}


def test_backpropagation_against_differences():
    rng = np.random.default_rng(0)
    p = language_id._fresh(rng, 3, 2)
    codes = rng.integers(0, 256, (6, 2))
    weight = rng.normal(size=(6, 2, 3))

    def loss():
        return (language_id._run(p, codes)[0] * weight).sum()

    grads = language_id._back(p, codes, language_id._run(p, codes)[1], weight)
    for name in ("gates", "candidate", "table"):
        for at in [(0, 0), (1, 2), (2, 1)] if name != "table" else [(codes[0, 0], 1), (codes[3, 1], 7)]:
            old = p[name][at]
            p[name][at] = old + 1e-6
            up = loss()
            p[name][at] = old - 1e-6
            down = loss()
            p[name][at] = old
            assert abs((up - down) / 2e-6 - grads[name][at]) < 1e-4


def test_reader_agrees_with_the_training_pass():
    model = language_id.train([("x", "abcabc"), ("y", "zyzyzy")], steps=3, batch=4)
    data = np.frombuffer(b"hello wide world", np.uint8)
    got = language_id.Reader(model).sums(data, np.array([0, len(data)]))
    there = language_id._run(model.forward, data[:, None].astype(int))[0][:, 0]
    back = language_id._run(model.backward, data[::-1, None].astype(int))[0][::-1, 0]
    logits = there @ model.forward["output"] + back @ model.backward["output"] + model.bias
    share = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    assert np.allclose(got[0], share.sum(0), atol=1e-3)


def test_no_language_learned(spark):
    docs = corpus.frame(spark, corpus.awkward(corpus.seeded(6)))
    model = language_id.train([])
    assert {r["lang_pred"] for r in language_id.predict(docs, model).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0


def brute_segments(scores):
    """The definition: take the best segment of all, then the same left and right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            total = sum(scores[a:b])
            if total > 0 and (best is None or total > best[2] or (total == best[2] and b - a < best[1] - best[0])):
                best = (a, b, total)
    if best is None:
        return []
    a, b, total = best
    left, right = brute_segments(scores[:a]), brute_segments(scores[b:])
    return [*left, best, *[(x + b, y + b, t) for x, y, t in right]]


def test_maximal_segments_against_the_definition():
    rng = corpus.seeded(7)
    for _ in range(300):
        scores = np.array([rng.choice([-3.1, -1.07, -0.53, 1.013, 2.029, 4.11]) * (1 + rng.random() / 100) for _ in range(rng.randrange(0, 14))])
        got = toxicity.maximal_segments(scores)
        expected = brute_segments(list(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert np.allclose([t for *_, t in got], [t for *_, t in expected])


@pytest.fixture(scope="module")
def labelled(spark):
    rng = corpus.seeded(8)
    bad = ["scoundrel", "vilestem", "nastyword"]
    rows, labels = [], []
    for i in range(240):
        found = corpus.words(rng, rng.randrange(20, 120))
        found = ["".join(chr(97 + int(c)) for c in w[1:]) + "x" for w in found]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                found.insert(rng.randrange(len(found)), rng.choice(bad) if rng.random() < 0.6 else "vilest" + rng.choice("abcdefgh"))
        rows.append((i, " ".join(found), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    awkward = corpus.awkward(rng)
    docs = corpus.frame(spark, rows + awkward)
    labels += [(None, 1, 1), (900, 1, None), (5, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {r[0]: r[2] for r in labels if r[0] is not None}


def test_toxic_documents_are_found(spark, labelled):
    docs, labels, true = labelled
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.predict(docs, model).collect()}
    seen = [i for i in range(240)]
    wrong = [i for i in seen if (got[i]["score"] >= 0.5) != (true[i] == 1)]
    assert len(wrong) <= 5
    for nothing in (900, 901, 902):
        assert 0 <= got[nothing]["score"] < 0.5 and got[nothing]["n_passages"] == 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i in (0, 4, 8):
        for p in got[i]["passages"]:
            assert any(w in texts[i][p["start"] : p["end"]] for w in ("scoundrel", "vilest", "nastyword"))
    kept = toxicity.keep_civil(docs, model)
    assert kept.columns == docs.columns
    gone = set(texts) - {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert gone == {i for i, r in got.items() if r["score"] >= 0.5}


def test_without_labels_or_documents(spark, labelled):
    docs, labels, _ = labelled
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.predict(docs, none).collect()} == {0.0}
    assert toxicity.predict(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_statistic_is_the_best_over_any_number_of_segments():
    model = toxicity.Model(decay=1.0, scale=0.01)
    rng = corpus.seeded(10)
    for _ in range(200):
        n = rng.randrange(100, 100_000)
        sums = [rng.random() * 8 for _ in range(rng.randrange(0, 30))]
        top = sorted(sums, reverse=True)
        over = [
            sum(x - np.log(0.01 * n) + np.log(k + 1) for k, x in enumerate(top[:r])) for r in range(len(top) + 1)
        ]
        assert abs(toxicity._statistic(sums, n, model) - max(over)) < 1e-6
    level = np.log(0.01 * 50_000)
    assert toxicity._statistic([level - 0.1], 50_000, model) == 0
    assert 14 < toxicity._statistic([level - 0.1] * 10, 50_000, model) < 14.2


def test_a_long_text_with_many_moderate_segments_scores(spark, labelled):
    docs, labels, _ = labelled
    model = toxicity.fit(docs, labels)
    word = max((w for w in model.tokens if not w.endswith("*")), key=model.tokens.get)
    strength = model.decay * model.tokens[word]
    n = int(np.exp(strength + 0.1) / model.scale) + 1  # one such segment alone is what chance gives
    gap = max(1, n // 60)
    filler = ["qqq"] * n
    for at in range(0, n, gap):
        filler[at] = word
    clean = toxicity.predict(corpus.frame(spark, [(1, " ".join(["qqq"] * n), "en", "s", 1)]), model).first()
    many = toxicity.predict(corpus.frame(spark, [(1, " ".join(filler), "en", "s", 1)]), model).first()
    assert many["score"] > max(0.5, clean["score"])


def test_numerals_are_no_letters():
    assert not any(language_id._has_letter(x) for x in ("", "² ½ Ⅷ ①", "12_3 -", "%"))
    assert language_id._has_letter("½ é") and language_id._has_letter("字")


def test_places_of_tokens_where_lower_case_is_longer():
    for text in ("Ab İİ cd İx", "plain text", "İ"):
        lowered = [m[0] for m in toxicity.TOKEN.finditer(text.lower())]
        places = toxicity._places(text)
        assert len(places) == len(lowered)
        assert all(0 <= b < e <= len(text) for b, e in places)
        assert all(x[0] in text[b:e].lower() for (b, e), x in zip(places, lowered, strict=True))
