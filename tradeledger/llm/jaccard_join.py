"""Near duplicates by the Jaccard similarity of 5-word shingles, through two prefix filters.

Tokens are 64-bit hashes of shingles. Of each set the first tokens in the order of the hashes are
looked at: n - ceil(t n) + n / EXTRA of n, so two sets of similarity t or more have n / EXTRA tokens
or more in common there. Within these first tokens the rare ones come first, by exact counts
of the sets that have them, and all but the last n / EXTRA - 1 of those that another set has as
well are the set's index. Two similar sets share an index token. A set whose own tokens are most of
its first ones has no index at all, and tokens that very many sets have come last: so few pairs
are made of common phrases. Pairs are then counted exactly. After the first links the same is done with
whole sets and the tokens that another component has as well: of those a set needs t n, or it is done.

Documents with equal sets are one vertex throughout. In a bucket of vertices that share an
index token, a first round compares each with a pivot; then only vertices that are still in
different components are compared with each other. So a group of k near copies costs k
comparisons and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeledger.llm.checkpoints import cut
from tradeledger.llm.components import connected_components
from tradeledger.llm.textbytes import SHORT_RUN, find_words, mix, runs, shingle_hashes, word_hashes
from tradeledger.llm.worker_memory import released

# Similarity as a fraction of integers: 100 * shared >= PERCENT * union.
PERCENT = 80
# One in so many tokens is looked at beyond those that one common token needs.
EXTRA = 10
SKETCH = 1 << 17
BITS = 1 << 24
# First pivots are the smallest ids after one of these masks, so buckets do not all have the same pivot.
MASKS = (0x0, 0x5DEECE66D1234567)
# Sets of a block, when the pairs of a large group are compared.
BLOCK = 64
# 64-bit words of a set's signature: which bits an odd number of its tokens have.
SIGNS = 8
# Further rounds with pivots before all pairs across components are compared.
ROUNDS = 2


def prefix_length(n: np.ndarray | int, percent: int = PERCENT):
    return n - (-(-percent * n // 100)) + 1


def extra(n: np.ndarray | int):
    """Tokens that similar sets have in common among their first ones, where the smaller one has n."""
    return np.maximum(1, n // EXTRA)


def reach(n: int, percent: int = PERCENT) -> int:
    """How many first tokens of a set of n are looked at."""
    return prefix_length(n, percent) + int(extra(n)) - 1


def _spot(tokens: np.ndarray, row: int) -> np.ndarray:
    return ((tokens >> np.uint64(20 * row + 3)) & np.uint64(SKETCH - 1)).astype(np.int64)


def _ordered(tokens: np.ndarray, order: int = 0, rarity: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct tokens, rearranged by the counts of their buckets, rare first; as they are without counts."""
    if rarity is None:
        return tokens
    return tokens[np.argsort(_rank(tokens, rarity, order), kind="stable")]


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Index and sorted distinct shingles of each text."""
    for at, data, offsets in runs(texts, SHORT_RUN):
        words = find_words(data, offsets)
        hashes = word_hashes(words, fold=True)
        for d in range(len(offsets) - 1):
            yield at + d, np.unique(shingle_hashes(hashes[words.first[d] : words.first[d + 1]]))


def _set_id(tokens: np.ndarray) -> int:
    total = int(mix(tokens).sum(dtype=np.uint64)) + len(tokens) * 0x9E3779B97F4A7C15
    return int(mix(np.array([total % (1 << 64)], np.uint64)).view(np.int64)[0])


def described(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, set_id and, for the first text of a set in each task, its first tokens."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, ids, prefixes = [], [], []
            for _, tokens in _sets(batch.column("text")):
                n = len(tokens)
                sizes.append(n)
                ids.append(_set_id(tokens) if n else None)
                new = n and ids[-1] not in seen
                if new:
                    seen.add(ids[-1])
                    if len(seen) > 1_000_000:
                        seen.clear()
                prefixes.append(_ordered(tokens)[: reach(n, percent)].view(np.int64) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_id", "prefix"],
            )

    schema = "doc_id long, n_shingles long, set_id long, prefix array<long>"
    return docs.select("doc_id", "text").mapInArrow(released(describe), schema)


def bit_table(ids: DataFrame) -> np.ndarray:
    """A bitmap of BITS bits with those of the ids set; its size is fixed, so it may go to every task."""
    words = BITS // 64
    rows = ids.groupBy(F.pmod("id", F.lit(words)).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(id div {words}, 64) as int))")).alias("bits")
    )
    found = rows.toArrow()
    table = np.zeros(words, np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table


def in_table(table: np.ndarray, value: int) -> bool:
    # ``div`` truncates towards zero, as int() of the quotient does not for large values
    quotient = abs(value) // len(table) * (1 if value >= 0 else -1)
    return bool((int(table[value % len(table)]) >> (quotient % 64)) & 1)


def _rank(tokens: np.ndarray, rarity: np.ndarray | None, order: int = 0) -> np.ndarray:
    """Places in the order: how common the token's bucket is, then its hash; the hash alone without counts."""
    if rarity is None:
        return tokens
    return (rarity[order][_spot(tokens, order)].astype(np.uint64) << np.uint64(32)) | (tokens >> np.uint64(32))


def least_shared(n_a: int, n_b: int, percent: int = PERCENT) -> int:
    """How many tokens similar sets of these sizes share at least."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def may_be_similar(
    a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, rarity: np.ndarray | None = None, percent: int = PERCENT
) -> bool:
    """Whether two prefixes under one order leave room for enough shared tokens.

    Up to the place where the shorter-reaching prefix ends, both prefixes hold all tokens of
    their sets; a token there that the other lacks is missing from the other set.
    """
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    rank_a, rank_b = _rank(a, rarity), _rank(b, rarity)
    end = min(rank_a[-1], rank_b[-1])
    a, b = a[rank_a < end], b[rank_b < end]
    shared = len(np.intersect1d(a, b, assume_unique=True))
    needed = least_shared(n_a, n_b, percent)
    return len(a) - shared <= n_a - needed and len(b) - shared <= n_b - needed


def sets_of(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """(set_id, tokens) once for each set whose bit is set; tokens are sorted 64-bit numbers."""

    def packed(ids: list[int], sets: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["set_id", "tokens"])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, sets, size = [], [], 0
            for _, tokens in _sets(batch.column("text")):
                if not len(tokens):
                    continue
                mark = _set_id(tokens)
                if mark in seen or not in_table(table, mark):
                    continue
                seen.add(mark)
                ids.append(mark)
                sets.append(tokens.tobytes())
                size += len(sets[-1])
                if size > 8 << 20:
                    yield packed(ids, sets)
                    ids, sets, size = [], [], 0
            yield packed(ids, sets)

    return docs.select("text").mapInArrow(released(give), "set_id long, tokens binary").dropDuplicates(["set_id"])


def similar(a: np.ndarray, b: np.ndarray, rarity: np.ndarray | None = None, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity: by their prefixes, then by the exact count."""
    first, second = (_ordered(x, 0, rarity)[: prefix_length(len(x), percent)] for x in (a, b))
    if not may_be_similar(first, len(a), second, len(b), rarity, percent):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of set ids that are similar; ``sets`` are (set_id, tokens).

    Sets are sent to blocks and not to pairs. A set goes with the smallest set it is paired with,
    such a cluster is cut into blocks of about BLOCK sets, and the pairs of two blocks are looked
    at together, after the sets that they name. So in a large group a set travels once for
    each block of the group, and a task holds two blocks.
    """
    partners = pairs.select(F.col("a").alias("v"), F.col("b").alias("w")).union(
        pairs.select(F.col("b").alias("v"), F.col("a").alias("w"))
    )
    clusters = partners.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("cluster"))
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    block = F.xxhash64("cluster", F.pmod(F.xxhash64("v"), F.col("blocks")))
    blocks = cut(clusters.join(sizes, "cluster").select("v", block.alias("block")))
    keyed = pairs
    for side in ("a", "b"):
        keyed = keyed.join(blocks.select(F.col("v").alias(side), F.col("block").alias(f"block_{side}")), side)
    ends = [F.least("block_a", "block_b"), F.greatest("block_a", "block_b")]
    keyed = cut(keyed.select(F.xxhash64(*ends).alias("key"), "a", "b"))
    needed = keyed.select("key", F.explode(F.array("a", "b")).alias("set_id")).distinct()
    sent = needed.join(sets, "set_id").select(
        "key", F.lit(False).alias("pair"), F.col("set_id").alias("a"), F.lit(None).cast("long").alias("b"), "tokens"
    )
    asked = keyed.select("key", F.lit(True).alias("pair"), "a", "b", F.lit(None).cast("binary").alias("tokens"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            keys, pair = batch.column("key").to_pylist(), batch.column("pair").to_pylist()
            a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
            tokens = batch.column("tokens")
            keep = np.zeros(len(keys), bool)
            for i in range(len(keys)):
                if keys[i] != key:
                    key, held = keys[i], {}
                if not pair[i]:
                    held[a[i]] = np.frombuffer(tokens[i].as_py(), np.uint64)
                else:
                    keep[i] = a[i] in held and b[i] in held and similar(held[a[i]], held[b[i]], percent=percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    work = sent.union(asked).repartition("key").sortWithinPartitions("key", "pair")
    return cut(work.mapInArrow(released(walk), "a long, b long"))


def _pairs(rows: DataFrame, other: str) -> DataFrame:
    return rows.select(F.least("set_id", other).alias("a"), F.greatest("set_id", other).alias("b")).distinct()


def _masked() -> Column:
    return F.when(F.pmod("token", F.lit(2)) == 0, F.lit(MASKS[0])).otherwise(F.lit(MASKS[1]))


def _least_partner(percent: int) -> str:
    """Tokens of the smallest set that may be similar to one of n; so many are in common at least, too."""
    return f"(({percent} * n + 99) div 100)"


def _ranked(common: DataFrame, needed: str) -> DataFrame:
    """(token, set_id, n, indexed) of the sets that have ``needed`` tokens or more in common with others.

    ``common`` are (token, set_id, n, size) among which similar sets have ``needed`` in common. So a set with fewer
    is similar to none, and where the rarest are indexed, all but the last ``needed`` - 1, similar sets have an
    indexed one in common.
    """
    of_set = Window.partitionBy("set_id")
    ranked = common.withColumn("place", F.row_number().over(of_set.orderBy("size", "token")))
    ranked = ranked.withColumn("spare", F.count(F.lit(1)).over(of_set) - F.expr(needed))
    indexed = (F.col("place") <= F.col("spare") + 1).alias("indexed")
    return ranked.filter("spare >= 0").select(*[c for c in common.columns if c != "size"], indexed)


def common_tokens(info: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, set_id, n, indexed) of the first tokens that two or more sets have; similar sets have an indexed one in common.

    All sets of a token meet once, in one shuffle of three numbers for each first token; what another set has as
    well goes on to its set.
    """
    tokens = info.filter(F.col("prefix").isNotNull()).select(
        "set_id", F.col("n_shingles").alias("n"), F.explode("prefix").alias("token")
    )
    of_token = Window.partitionBy("token")
    met = tokens.select(
        "token", "set_id", "n", F.min("set_id").over(of_token).alias("low"), F.max("set_id").over(of_token).alias("high"),
        F.count(F.lit(1)).over(of_token).alias("size"),
    ).filter("low < high")
    # several tasks may have sent a set
    met = met.select("token", "set_id", "n", "size").repartition("set_id").dropDuplicates(["set_id", "token"])
    return _ranked(met, f"greatest(1, {_least_partner(percent)} div {EXTRA})")


def shared_tokens(common: DataFrame) -> DataFrame:
    """(token, set_id, pivot) of indexed tokens that two or more sets have."""
    value = F.col("set_id").bitwiseXOR(_masked())
    of_token = Window.partitionBy("token")
    met = common.filter("indexed").select("token", "set_id")
    met = met.withColumn("low", F.min(value).over(of_token)).withColumn("high", F.max(value).over(of_token))
    pivot = F.col("low").bitwiseXOR(_masked()).alias("pivot")
    return met.filter("low < high").select("token", "set_id", pivot)


def whole_tokens(sets: DataFrame) -> DataFrame:
    """(token, set_id, n) of all tokens of the sets."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, packed = (batch.column(c).slice(at, 500) for c in ("set_id", "tokens"))
                tokens = [np.frombuffer(x.as_py(), np.int64) for x in packed]
                sizes = np.array([len(x) for x in tokens])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), pa.array(np.repeat(ids.to_numpy(), sizes)), pa.array(np.repeat(sizes, sizes))],
                    names=["token", "set_id", "n"],
                )

    return sets.select("set_id", "tokens").mapInArrow(released(give), "token long, set_id long, n long")


def _open(rows: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(token, set_id, n, component, indexed): whole sets' tokens that a set of another component has as well.

    What only copies of a set have is done when they are joined. A set that has less than the similarity asks for
    in common with other components is done as well, and its pairs with it.
    """
    joined = rows.select("token", "set_id", "n").join(labels.withColumnRenamed("vertex", "set_id"), "set_id", "left")
    placed = joined.select("token", "set_id", "n", F.coalesce("component", "set_id").alias("component"))
    of_token = Window.partitionBy("token")
    placed = placed.withColumn("low", F.min("component").over(of_token)).withColumn("high", F.max("component").over(of_token))
    placed = placed.withColumn("size", F.count(F.lit(1)).over(of_token)).filter("low < high").drop("low", "high")
    return _ranked(placed, _least_partner(percent))


def signatures(sets: DataFrame) -> DataFrame:
    """(set_id, s0, s1, ...): a signature has a bit for each token, and an even number of tokens cancel out.

    So two signatures differ in no more bits than the sets differ in tokens.
    """
    names = [f"s{i}" for i in range(SIGNS)]

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = np.zeros((batch.num_rows, SIGNS), np.int64)
            for row, packed in enumerate(batch.column("tokens")):
                spots = mix(np.frombuffer(packed.as_py(), np.uint64)) % np.uint64(64 * SIGNS)
                odd = np.bincount(spots.astype(np.int64), minlength=64 * SIGNS).astype(np.uint8) & 1
                signs[row] = np.packbits(odd, bitorder="little").view(np.int64)
            columns = [pa.array(np.ascontiguousarray(signs[:, i])) for i in range(SIGNS)]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), *columns], names=["set_id", *names])

    return sets.mapInArrow(released(give), f"set_id long, {', '.join(f'{name} long' for name in names)}")


def _worth_comparing(percent: int) -> Column:
    """Whether two sets (the second with ``_2``) are in different components and their signatures allow for the similarity."""
    differ = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"s{i}_2"))) for i in range(1, SIGNS)), F.bit_count(F.col("s0").bitwiseXOR(F.col("s0_2"))))
    least = F.greatest(differ, F.abs(F.col("n") - F.col("n_2")))
    return (F.col("component") != F.col("component_2")) & (least * (100 + percent) <= (F.col("n") + F.col("n_2")) * (100 - percent))


def _open_pairs(placed: DataFrame, turn: int, percent: int = PERCENT) -> DataFrame:
    """In each bucket: a member drawn for the token, with those of other components.

    The draw differs from token to token. A set that shares many tokens with its group meets as many
    pivots, so one that is linked with a fair part of the group is soon joined to it.
    """
    others = [c for c in placed.columns if c != "token"]
    draw = F.xxhash64("token", "set_id", F.lit(turn))
    found = placed.groupBy("token").agg(F.min(F.struct(draw.alias("draw"), *others)).alias("drawn"))
    pivots = found.select("token", *[F.col(f"drawn.{c}").alias(f"{c}_2") for c in others])
    return _pairs(placed.join(pivots, "token").filter(_worth_comparing(percent)), "set_id_2")


def _all_open_pairs(placed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """In each bucket: all pairs of sets in different components that may be similar."""
    other = placed.select("token", *[F.col(c).alias(f"{c}_2") for c in placed.columns if c != "token"])
    met = placed.join(other, "token").filter("set_id < set_id_2")
    return _pairs(met.filter(_worth_comparing(percent)), "set_id_2")


def linked_sets(docs: DataFrame, info: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(vertex, component) of all sets that are linked with another one."""
    members = cut(shared_tokens(common_tokens(info, percent)))
    sets = cut(sets_of(docs, bit_table(members.select(F.col("set_id").alias("id")))))
    pairs = cut(_pairs(members.filter("set_id <> pivot"), "pivot"))
    links = verified(pairs, sets, percent)
    labels = connected_components(links)
    rows, signs = whole_tokens(sets), cut(signatures(sets))
    for turn in range(ROUNDS + 1):
        rows = cut(_open(rows, labels, percent))
        placed = rows.filter("indexed").drop("indexed").join(signs, "set_id")
        new = _open_pairs(placed, turn, percent) if turn < ROUNDS else _all_open_pairs(placed, percent)
        new = cut(new.join(pairs, ["a", "b"], "left_anti"))
        if new.isEmpty():
            continue
        links = cut(links.union(verified(new, sets, percent)))
        pairs = cut(pairs.union(new))
        labels = connected_components(links)
    return labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of each document, one row in, one row out.

    Words are runs other than ASCII white space, A-Z read as a-z; a document's set is its
    distinct 5-word shingles, or its whole sequence if it has fewer words. component_id is
    the smallest doc_id that links reach. Null, empty and blank texts have no shingle and are
    their own component. Repeated doc_ids count as one vertex of each of their sets; a null
    doc_id is never a component's id unless all of the component's are null. Only doc_id
    and text are read. Words and sets are compared by 64-bit hashes.
    """
    info = cut(described(docs, percent))
    labels = linked_sets(docs, info, percent)
    rows = info.select("doc_id", "n_shingles", "set_id").join(
        labels.withColumnRenamed("vertex", "set_id"), "set_id", "left"
    )
    rows = rows.withColumn("component", F.coalesce("component", "set_id"))
    smallest = rows.groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return rows.join(smallest.filter("component is not null"), "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without those whose component has a smaller doc_id; columns unchanged.

    Rows that repeat a doc_id stay or go together.
    """
    gone = near_duplicates(docs, percent).filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
