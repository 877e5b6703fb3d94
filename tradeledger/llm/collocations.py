"""Phrases whose words keep together, mined by sorting suffixes of at most four words.

Words and pairs are counted first, combined in the tasks before they are shuffled. Suffixes
whose leading words are frequent are then routed by these, so a task has all suffixes of
its leading words, and sorted there by multikey three-way quicksort: each partition of equal
suffixes is a phrase and its size the count. Partitions smaller than the least count are left
unsorted, for no phrase in them can be frequent.

A pair with very many suffixes is spread by all four words; its phrases of three words are then
counted in parts that are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeledger.llm.bit_tables import bit_table, contains, wanted_bits
from tradeledger.llm.checkpoints import cut
from tradeledger.llm.textbytes import Words, mix, runs, word_hashes

LONGEST = 4
LEAST_COUNT = 30
TOP = 2000
# A phrase goes where a longer one that holds it has this share of its count, in percent.
ABSORBED = 80
UNKNOWN_LANGUAGE = "und"
# Pairs with so many occurrences are spread over tasks.
HOT = 1_000_000
# Suffixes that a task sorts at a time, and rows that it combines before they are shuffled.
CHUNK = 1_000_000
KEYS = ("w1", "w2", "w3", "w4")
SUFFIX = ", ".join(f"{k} long" for k in KEYS)

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _language_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _words_of(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: words, their keys, the piece each lies in and the document it is of.

    A key is a hash of the word and the document's language, never 0.
    """
    languages = batch.column("lang").to_pylist()
    marks = {x: _language_hash(x) for x in set(languages)}
    marks = np.array([marks[x] for x in languages], np.uint64)
    for at, data, offsets in runs(batch.column("text")):
        solid = ~_GAP[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        start = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]])[: len(solid)] | solid & edge[:-1])
        end = np.flatnonzero(solid & (np.concatenate([~solid[1:], [True]])[: len(solid)] | edge[1:])) + 1
        first = np.searchsorted(start, offsets)
        words = Words(data, start, end, first, offsets)
        document = at + np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        keys = mix(word_hashes(words, fold=True) ^ marks[document])
        keys[keys == 0] = 1
        piece = np.cumsum(_BREAK[data] | edge[:-1])[start]
        yield words, keys, piece, document


def _with_language(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, key, word, n) of every word of every language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            for words, keys, _, document in _words_of(batch):
                found, at, n = np.unique(keys, return_index=True, return_counts=True)
                raw = _LOWER[words.data].tobytes()
                spans = zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)
                texts = pa.array([raw[a:b] for a, b in spans], pa.binary()).view(pa.string())
                of = pa.array([languages[d] for d in document[at].tolist()], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [of, pa.array(found.view(np.int64)), texts, pa.array(n)], names=["lang", "key", "word", "n"]
                )

    rows = _with_language(docs).mapInArrow(count, "lang string, key long, word string, n long")
    return rows.groupBy("lang", "key", "word").agg(F.sum("n").alias("n"))


def _pair_ids(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    second = second.view(np.uint64)
    return first.view(np.uint64) ^ ((second << np.uint64(1)) | (second >> np.uint64(63)))


def _pair_id() -> Column:
    return F.expr("w1 ^ (shiftleft(w2, 1) | shiftrightunsigned(w2, 63))")


class _Combiner:
    """Equal rows of keys met in a task are added up, CHUNK rows at a time."""

    def __init__(self, width: int):
        self.width, self.held, self.size = width, [], 0

    def add(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(rows)
        self.size += len(rows)
        if self.size >= CHUNK:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        rows = np.concatenate(self.held) if self.held else np.zeros((0, self.width), np.uint64)
        self.held, self.size = [], 0
        mark = np.zeros(len(rows), np.uint64)
        for k in range(self.width):
            mark = mix(mark + rows[:, k])
        _, at, n = np.unique(mark, return_index=True, return_counts=True)
        columns = [pa.array(np.ascontiguousarray(rows[at, k]).view(np.int64)) for k in range(self.width)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n)], names=[*KEYS[: self.width], "n"])


def pair_counts(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(w1, w2, n) of neighbours in a piece, both in the bit table of frequent words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combine = _Combiner(2)
        for batch in batches:
            for _, keys, piece, _ in _words_of(batch):
                good = contains(frequent, keys)
                at = np.flatnonzero(good[:-1] & good[1:] & (piece[:-1] == piece[1:]))
                yield from combine.add(np.stack([keys[at], keys[at + 1]], axis=1))
        yield combine.flush()

    rows = _with_language(docs).mapInArrow(count, "w1 long, w2 long, n long")
    return rows.groupBy("w1", "w2").agg(F.sum("n").alias("n"))


def suffixes(docs: DataFrame, pairs: np.ndarray, hot: np.ndarray) -> DataFrame:
    """(w1..w4, n, hot) of suffixes of three or four words whose neighbours are all in the table of pairs.

    w4 is 0 where the piece, or the run of frequent pairs, ends before. Equal ones are combined.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combine = _Combiner(LONGEST)

        def marked(batch: pa.RecordBatch) -> pa.RecordBatch:
            first, second = (batch.column(k).to_numpy() for k in ("w1", "w2"))
            return batch.append_column("hot", pa.array(contains(hot, _pair_ids(first, second))))

        for batch in batches:
            for _, keys, piece, _ in _words_of(batch):
                linked = (piece[:-1] == piece[1:]) & contains(pairs, _pair_ids(keys[:-1], keys[1:]))
                linked = np.concatenate([linked, np.zeros(2, bool)])
                at = np.flatnonzero(linked[:-1] & linked[1:])
                keys = np.concatenate([keys, np.zeros(2, np.uint64)])
                fourth = np.where(linked[np.minimum(at + 2, len(linked) - 1)], keys[at + 3], np.uint64(0))
                yield from map(marked, combine.add(np.stack([keys[at], keys[at + 1], keys[at + 2], fourth], axis=1)))
        yield marked(combine.flush())

    return _with_language(docs).mapInArrow(emit, f"{SUFFIX}, n long, hot boolean")


def sort_suffixes(
    keys: np.ndarray, weights: np.ndarray, least: int, parts: bool = False
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort: (words, pointers, counts) of the partitions of equal suffixes.

    ``keys`` has a row for each suffix, 0 where it ended; ``weights`` says how often it occurs.
    All open partitions are split in one pass over arrays: less than, equal to and greater than the key
    of their middle suffix. Equal ones go on with the next key, the others with the same one.
    Partitions lighter than ``least`` are abandoned; with ``parts`` only among the last keys,
    because other tasks may have more of shorter phrases.
    """
    depth_end = keys.shape[1]
    pointers = np.arange(len(keys))
    begin, depth = np.zeros(min(1, len(keys)), np.int64), np.zeros(min(1, len(keys)), np.int64)
    while len(pointers):
        sizes = np.diff(np.append(begin, len(pointers)))
        at = np.repeat(np.arange(len(begin)), sizes)
        value = keys[pointers, depth[at]]
        pivot = value[begin + sizes // 2][at]
        side = (value >= pivot).astype(np.int8) + (value > pivot)
        part = 3 * at + side
        counts = np.bincount(part, minlength=3 * len(begin))
        before = np.cumsum(counts) - counts
        place = np.empty(len(pointers), np.int64)
        for s in range(3):
            mine = side == s
            run = np.cumsum(mine) - 1
            first = run[begin] - mine[begin] + 1
            place[mine] = before[part[mine]] + (run - first[at])[mine]
        order = np.empty_like(pointers)
        order[place] = pointers
        live = counts > 0
        begin, sizes = before[live], counts[live]
        equal = (np.flatnonzero(live) % 3) == 1
        depth = np.repeat(depth, 3)[live]
        weight = np.add.reduceat(weights[order], begin)
        first = order[begin]
        present = keys[first, depth] != 0
        done = equal & present & ((weight >= least) | parts)
        for length in range(1, depth_end + 1):
            mine = done & (depth + 1 == length)
            if mine.any():
                yield length, first[mine], weight[mine]
        keep = (weight >= least) | (parts & (depth + equal < depth_end - 1))
        keep &= ~equal | (present & (depth + 1 < depth_end))
        depth = (depth + equal)[keep]
        pointers = order[np.repeat(keep, sizes)]
        sizes = sizes[keep]
        begin = np.cumsum(sizes) - sizes


def long_phrases(rows: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(w1..w4, n) of phrases of three and four words, w4 being 0 for three, that occur often enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sort(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            for hot in (0, 1):
                some = rows[rows[:, LONGEST + 1] == hot]
                for length, at, n in sort_suffixes(some[:, :LONGEST], some[:, LONGEST], least, parts=bool(hot)):
                    if length > 2:
                        found = some[at, :LONGEST]
                        found[:, length:] = 0
                        yield pa.RecordBatch.from_arrays([*map(pa.array, found.T), pa.array(n)], names=[*KEYS, "n"])

        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in (*KEYS, "n")]
            new = np.stack([*columns, batch.column("hot").to_numpy(zero_copy_only=False).astype(np.int64)], axis=1)
            if size + len(new) >= CHUNK and len(new):
                # cut where the leading words change, so that a chunk has all suffixes of its leading words
                lead = new[:, :2]
                last = np.concatenate([held[-1][-1:, :2] if held else lead[:1], lead])
                change = np.flatnonzero((last[1:] != last[:-1]).any(axis=1))
                if len(change):
                    held.append(new[: change[-1]])
                    yield from sort(held)
                    held, size, new = [], 0, new[change[-1] :]
            held.append(new)
            size += len(new)
        if held:
            yield from sort(held)

    route = F.when(F.col("hot"), F.xxhash64(*KEYS)).otherwise(F.xxhash64("w1", "w2"))
    routed = rows.withColumn("route", route).repartition("route").sortWithinPartitions("route", "w1", "w2").drop("route")
    found = routed.mapInArrow(count, f"{SUFFIX}, n long").groupBy(*KEYS).agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= least)


def frequent_phrases(docs: DataFrame, words: DataFrame, least: int = LEAST_COUNT, hot: int = HOT) -> DataFrame:
    """(w1..w4, n) of all phrases of one to four words that occur ``least`` times; absent words are 0."""
    often = words.filter(F.col("n") >= least)
    none = F.lit(0).cast("long")
    known = often.select(F.col("key").alias("id"))
    pairs = cut(pair_counts(docs, bit_table(known, wanted_bits(known.count()))).filter(F.col("n") >= least))
    ids = pairs.select(_pair_id().alias("id"), "n")
    table = bit_table(ids, wanted_bits(ids.count()))
    spread = bit_table(ids.filter(F.col("n") >= hot), wanted_bits(0))
    longer = long_phrases(suffixes(docs, table, spread), least)
    single = often.select(F.col("key").alias("w1"), none.alias("w2"), none.alias("w3"), none.alias("w4"), "n")
    double = pairs.select("w1", "w2", none.alias("w3"), none.alias("w4"), "n")
    return cut(single.union(double).union(longer))


def _length() -> Column:
    return F.when(F.col("w3") == 0, 2).when(F.col("w4") == 0, 3).otherwise(4)


def _named(columns: list[Column | str], names: list[str]) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(columns, names, strict=True)])


def _span(first: int, upto: int) -> list[Column]:
    """The keys of the words first..upto-1 of a phrase, filled up with 0."""
    inside = [F.col(k) for k in KEYS[first:upto]]
    return inside + [F.lit(0).cast("long")] * (LONGEST - len(inside))


def _scored(phrases: DataFrame) -> DataFrame:
    """w1..w4, a, l, r and score of every phrase of two words or more, by its lowest-scoring cut."""
    long_ = phrases.filter("w2 <> 0").select(*KEYS, F.col("n").alias("a"), _length().alias("m"))
    first, rest = [f"l{i}" for i in range(1, 5)], [f"r{i}" for i in range(1, 5)]
    cuts = []
    for m in range(2, LONGEST + 1):
        for k in range(1, m):
            struct = _named([F.lit(k), *_span(0, k), *_span(k, m)], ["k", *first, *rest])
            cuts.append(F.when(F.col("m") == m, struct))
    cuts = long_.select(*KEYS, "a", F.inline(F.array_compact(F.array(*cuts))))
    left = phrases.select(*[F.col(k).alias(n) for k, n in zip(KEYS, first, strict=True)], F.col("n").alias("l"))
    right = phrases.select(*[F.col(k).alias(n) for k, n in zip(KEYS, rest, strict=True)], F.col("n").alias("r"))
    parted = cuts.join(left, first).join(right, rest)
    # a product may pass 64 bits, so it is a decimal
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = parted.groupBy(*KEYS).agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select(*KEYS, "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))


def _absorbed(phrases: DataFrame, share: int) -> DataFrame:
    """(w1..w4, longer): the highest count of a longer phrase that holds the phrase."""
    long_ = phrases.filter("w3 <> 0").withColumn("m", _length())
    inside = []
    for m in range(3, LONGEST + 1):
        for width in range(2, m):
            for at in range(m - width + 1):
                inside.append(F.when(F.col("m") == m, _named(_span(at, at + width), list(KEYS))))
    parts = long_.select(F.col("n").alias("longer"), F.inline(F.array_compact(F.array(*inside))))
    return parts.groupBy(*KEYS).agg(F.max("longer").alias("longer"))


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, absorbed: int = ABSORBED, hot: int = HOT
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases.

    Texts are split at ``.,;:!?`` and line ends into pieces, A-Z read as a-z; a null lang is
    ``und``. Null, empty and blank texts have no words, repeated rows count each time,
    and an empty table has no phrase. Ties in score go by count, then by the phrase's
    bytes. Only lang and text are read. Words are compared by 64-bit hashes.
    """
    words = cut(word_counts(docs))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = words.filter(F.col("n") >= least).select("key", "lang", "word")
    phrases = frequent_phrases(docs, words, least, hot)
    kept = _scored(phrases).join(_absorbed(phrases, absorbed), list(KEYS), "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a"))
    )
    placed = kept.join(often.select(F.col("key").alias("w1"), "lang"), "w1")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # ties stay until the words are known
    ahead = cut(placed.withColumn("place", F.rank().over(by_score)).filter(F.col("place") <= top).drop("place"))
    spelled = ahead.select("*", F.posexplode(F.array(*KEYS)).alias("pos", "key")).filter("key <> 0")
    spelled = spelled.join(often.select("key", "word"), "key")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
    whole = spelled.groupBy("lang", *KEYS, "a", "l", "r", "score").agg(phrase.alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = whole.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
