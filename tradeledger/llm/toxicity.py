"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens are lower-cased runs of letters. Their log-odds between toxic and clean labelled
documents carry Dirichlet priors taken from the counts of the whole corpus. One linear
scan over a text's token scores finds every maximal segment; extreme-value statistics
of such segments turn scores into significance, sums of significant segments into one
statistic for the document, and a logistic curve fitted to labelled documents into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.checkpoints import cut
from tradeledger.llm.language_id import held_out
from tradeledger.llm.textbytes import SHORT_RUN, find_words, runs, shingle_hashes, word_hashes
from tradeledger.llm.worker_memory import parts, released

# Bounds of the model: labelled documents of each class it learns from, and tokens it knows.
MOST_LABELLED = 20_000
MOST_TOKENS = 50_000
# Stems stand for inflected forms: beginnings of so many letters, longest first.
STEMS = (6, 5, 4)
PRIOR_WEIGHT = 200.0
LEAST_Z = 3.0
HIGHEST, LOWEST, UNKNOWN = 5.0, -1.0, -0.25
FLUSH = 400_000
TOKEN = re.compile(r"[^\W\d_]+")
COUNTS = "feature string, background long, toxic long, clean long"
SCORES = (
    "doc_id long, score double, n_passages int, passages array<struct<start:int,end:int,score:double>>"
)


@dataclass
class Model:
    """Token scores (stems end in ``*``) and the parameters that calibrate segments and documents."""

    tokens: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    scale: float = 1.0
    slope: float = 0.0
    offset: float = -math.inf


class TokenScores(dict):
    """Scores by token, filled on demand: its own, else its longest known stem's."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, token: str) -> float:
        found = self.known.get(token)
        for k in STEMS:
            if found is None and len(token) >= k:
                found = self.known.get(token[:k] + "*")
        found = UNKNOWN if found is None else found
        if len(self) > 500_000:
            self.clear()
        self[token] = found
        return found


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, sum) of a sequence, in order, in linear time.

    Only positive scores start or end a segment, so the scan visits those alone. A segment
    joins the nearest earlier one whose total before it is lower, if that one's total
    after it is lower too; links to that earlier segment keep the search amortised.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        begin, left, right = i, total[i], total[i + 1]
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((begin, i + 1, left, right, j))
                break
            begin, left, j_next = stack[j][0], stack[j][2], stack[j][4]
            del stack[j:]
            j = j_next
    return [(b, e, r - l) for b, e, l, r, _ in stack]


def _statistic(sums: list[float], n: int, model: Model) -> float:
    """The best normalised sum over the r highest segments, for any r; 0 without evidence."""
    best, total = 0.0, 0.0
    for r, x in enumerate(sorted(sums, reverse=True), 1):
        total += model.decay * x - math.log(model.scale * n) + math.log(r)
        best = max(best, total)
    return best


def _segments(text: str, known: TokenScores) -> tuple[int, list[tuple[int, int, float]]]:
    tokens = TOKEN.findall(text.lower())
    scores = np.fromiter(map(known.__getitem__, tokens), float, len(tokens))
    if not len(scores) or scores.max() <= 0:
        return len(tokens), []
    return len(tokens), maximal_segments(scores)


def _places(text: str) -> list[tuple[int, int]]:
    """Where each token of the lower-cased text lies in the text; a few letters get longer in lower case."""
    lowered = text.lower()
    spans = [m.span() for m in TOKEN.finditer(lowered)]
    if len(lowered) == len(text):
        return spans
    upto = np.cumsum([len(c.lower()) for c in text])
    return [(int(np.searchsorted(upto, b, "right")), int(np.searchsorted(upto, e - 1, "right")) + 1) for b, e in spans]


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, toxic) of up to ``most`` labelled documents of each class, copies taken once.

    Only ids outside the held-out fifth. A document with contradicting labels counts as
    toxic. Of documents that share the smallest hash of their 5-word shingles, under
    either of two orders, one stays: copies would repeat the words of one text.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    dice = F.xxhash64("doc_id", F.lit("labelled"))
    sample = cut(
        known.filter("toxic = 1").orderBy(dice, "doc_id").limit(most)
        .union(known.filter("toxic = 0").orderBy(dice, "doc_id").limit(most))
    )

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, data, offsets in runs(batch.column("text"), SHORT_RUN):
                words = find_words(data, offsets)
                hashes = word_hashes(words, fold=True)
                for d in range(len(offsets) - 1):
                    s = shingle_hashes(hashes[words.first[d] : words.first[d + 1]]).view(np.int64)
                    found.append((int(s.min()), int(s.max())) if len(s) else (0, 0))
            first, second = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("toxic").cast(pa.int32()),
                 pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                names=["doc_id", "toxic", "first", "second"],
            )

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most 2 * most rows
    marked = texts.select("doc_id", "toxic", "text").mapInArrow(
        released(marks), "doc_id long, toxic int, first long, second long"
    )
    once = marked.groupBy("first", "toxic").agg(F.min(F.struct("doc_id", "second")).alias("one"))
    once = once.select("toxic", "one.*").groupBy("second", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return cut(once.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (0, *STEMS)
    tables = [[Counter() for _ in kinds] for _ in range(3)]

    def flush() -> pa.RecordBatch:
        names, columns = [], [[], [], []]
        for at, k in enumerate(kinds):
            background = tables[0][at]
            names += [f"{w}*" for w in background] if k else list(background)
            columns[0] += background.values()
            for c in (1, 2):
                columns[c] += map(tables[c][at].__getitem__, background)
        for part in tables:
            for counter in part:
                counter.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array(c, pa.int64()) for c in columns]],
            names=["feature", "background", "toxic", "clean"],
        )

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                if not text:
                    continue
                words = set(TOKEN.findall(text.lower()))
                for k, counters in zip(kinds, zip(*tables, strict=True), strict=True):
                    seen = {w[:k] for w in words if len(w) >= k} if k else words
                    counters[0].update(seen)
                    if toxic is not None:
                        counters[1 if toxic else 2].update(seen)
            if len(tables[0][0]) > FLUSH:
                yield flush()
    yield flush()


def count_features(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """In how many documents each token and stem occurs: all, sampled toxic and sampled clean ones."""
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "toxic")
    counts = rows.mapInArrow(released(_count), COUNTS)
    return counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("background", "toxic", "clean")])


def _log_odds(counts: DataFrame) -> tuple[DataFrame, float]:
    """delta and z of each feature that labelled documents have; and the tokens of the clean ones."""
    words = counts.filter(~F.col("feature").endswith("*"))
    n = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("background", "toxic", "clean")]).first()
    prior = 0.5 + PRIOR_WEIGHT * F.col("background") / max(n["background"], 1)

    def odds(column: str):
        rest = max(n[column], 1) + PRIOR_WEIGHT - F.col(column)
        return F.log((F.col(column) + prior) / rest)

    found = counts.filter("toxic + clean > 0").select(
        "feature", "toxic", "clean",
        (odds("toxic") - odds("clean")).alias("delta"),
        F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)).alias("spread"),
    )
    return found.withColumn("z", F.col("delta") / F.col("spread")), float(max(n["clean"], 1))


def _decay(tokens: dict[str, tuple[float, int]], clean: float) -> float:
    """The positive root of E[exp(x * score)] = 1 over the tokens of clean documents."""
    scores = np.array([s for s, _ in tokens.values()])
    share = np.array([(n + 0.5) / clean for _, n in tokens.values()])
    rest = max(0.0, 1 - share.sum())
    low, high = 1e-3, 50.0
    for _ in range(60):
        x = (low + high) / 2
        if (share * np.exp(np.minimum(x * scores, 500))).sum() + rest * math.exp(x * UNKNOWN) > 1:
            high = x
        else:
            low = x
    return low


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Learn token scores and calibration. Without examples of both classes every score is 0."""
    sample = labelled_sample(docs, labels, most)
    odds, clean = _log_odds(cut(count_features(docs, sample)))
    odds = cut(odds)
    strong = odds.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(MOST_TOKENS).collect()
    if not strong:
        return Model()
    stems = [r["feature"] for r in strong if r["feature"].endswith("*")]
    # words under a toxic stem that clean documents use as well have a score of their own
    under = F.lit(False)
    for k in STEMS:
        mine = [s[:-1] for s in stems if len(s) == k + 1]
        if mine:
            under = under | F.substring("feature", 1, k).isin(mine)
    own = odds.filter(under & (F.col("clean") >= 3)).orderBy(F.desc("clean"), "feature").limit(MOST_TOKENS).collect()
    known = {r["feature"]: (float(np.clip(r["delta"], LOWEST, HIGHEST)), r["clean"]) for r in [*own, *strong]}
    model = Model({w: s for w, (s, _) in known.items()}, _decay({w: x for w, x in known.items() if x[0] > 0}, clean))
    return _calibrate(docs, sample, model)


def _calibrate(docs: DataFrame, sample: DataFrame, model: Model) -> Model:
    """The scale of the extreme-value law from clean examples, then the logistic curve from all."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(model.tokens)
        for batch in batches:
            rows = [_segments(t or "", known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.int32()), pa.array([n for n, _ in rows], pa.int64()),
                 pa.array([[s for _, _, s in x] for _, x in rows], pa.list_(pa.float64()))],
                names=["toxic", "n", "sums"],
            )

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")
    rows = texts.mapInArrow(released(found), "toxic int, n long, sums array<double>").collect()  # at most 2 * most rows
    clean = [x for r in rows if not r["toxic"] for x in r["sums"]]
    tokens = sum(r["n"] for r in rows if not r["toxic"])
    level = float(np.median(clean)) if clean else HIGHEST
    model.scale = (sum(x >= level for x in clean) + 1) / max(tokens, 1) * math.exp(min(model.decay * level, 500))
    y = np.array([r["toxic"] for r in rows], float)
    if y.min(initial=1) == y.max(initial=0) or not len(y):
        return model
    x = np.array([_statistic(r["sums"], max(r["n"], 1), model) for r in rows]) / 10
    a, b = 1.0, -1.0
    for _ in range(200):  # Newton steps, slightly regularised
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p)
        g = np.array([((p - y) * x).sum() + 0.01 * a, (p - y).sum() + 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / max(np.abs(step).max(), 1e-9))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    model.slope, model.offset = float(a) / 10, float(b)
    return model


def _score(sums: list[float], n: int, model: Model) -> float:
    if model.offset == -math.inf:
        return 0.0
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, model.slope * _statistic(sums, max(n, 1), model) + model.offset))))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Score and significant passages of each document, one row in, one row out.

    Passages are character ranges of the text whose expected number by chance, in a clean
    text of that length, is below 1. Only doc_id and text are read. Null and empty texts
    have no passage; their score is that of no evidence.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(model.tokens)
        for batch in batches:
            scores, passages = [], []
            for text in batch.column("text").to_pylist():
                n, found = _segments(text or "", known)
                scores.append(_score([s for _, _, s in found], n, model))
                strong = [x for x in found if model.decay * x[2] > math.log(model.scale * n)]
                if strong:
                    places = _places(text)
                    strong = [{"start": places[b][0], "end": places[e - 1][1], "score": s} for b, e, s in strong]
                passages.append(strong)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64()),
                 pa.array([len(p) for p in passages], pa.int32()), pa.array(passages, kind)],
                names=["doc_id", "score", "n_passages", "passages"],
            )

    return docs.select("doc_id", "text").mapInArrow(released(label), SCORES)


def keep_civil(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """The documents that score below ``most``; columns unchanged.

    Null and empty texts are scored like texts without evidence; rows are judged by their text alone,
    so repeated rows stay or go together.
    """

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenScores(model.tokens)
        for batch in parts(batches):
            found = [_segments(t or "", known) for t in batch.column("text").to_pylist()]
            keep = [_score([s for _, _, s in x], n, model) < most for n, x in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(released(sift), docs.schema)
