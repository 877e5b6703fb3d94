"""Near-duplicate vectors through an inverted multi-index.

Each half of a unit vector has a codebook of its own; the product of both is a grid of
cells. A vector lies in one cell and is compared with the vectors of the cells nearest to
it, visited in the order of their summed distances (multi-sequence order), as far as random
probes, compared with all vectors, say is needed for the target recall. Pairs found are verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.checkpoints import cut
from tradeledger.llm.components import connected_components

LEAST_COSINE = 0.95
# Bounds of the fit: vectors sampled for codebooks, and those compared with all vectors to measure recall.
SAMPLE = 20_000
PROBES = 2_000
CODES = 64
TARGET_RECALL = 0.995
# With fewer pairs, or fewer probes that have any, recall can't be told, and no cell is left out for its rank.
LEAST_MEASURED = 50
BLOCK = 2_000
BATCH = 1_000


@dataclass
class Index:
    """Codebooks of both halves and the number of cells a vector visits."""

    halves: tuple[np.ndarray, np.ndarray]
    visits: int
    least: float

    @property
    def dimension(self) -> int:
        return sum(h.shape[1] for h in self.halves)

    def visited(self, unit: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The cells of each vector in visiting order, home first; -1 where no near vector can lie.

        Cell (i, j) of the ranked codes comes after all (i', j') with i' <= i and j' <= j, so the
        first ``visits`` have (i+1)(j+1) <= visits. A neighbour within the cosine is at most
        sqrt(2 - 2 cosine) away; a cell whose border planes are farther off is left out.
        """
        visits = visits or self.visits
        ranked, dist, gaps = [], [], []
        at = 0
        for book in self.halves:
            part = unit[:, at : at + book.shape[1]]
            at += book.shape[1]
            d = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)[None, :]
            order = np.argsort(d, axis=1, kind="stable")[:, :visits]
            near = np.take_along_axis(d, order, 1)
            apart = np.sqrt(np.maximum(((book[order] - book[order[:, :1]]) ** 2).sum(2), 1e-12))
            ranked.append(order)
            dist.append(near)
            gaps.append(((near - near[:, :1]) / (2 * apart)) ** 2)
        i, j = np.divmod(np.arange(ranked[0].shape[1] * ranked[1].shape[1]), ranked[1].shape[1])
        use = (i + 1) * (j + 1) <= visits
        i, j = i[use], j[use]
        total = dist[0][:, i] + dist[1][:, j]
        order = np.argsort(total, axis=1, kind="stable")[:, :visits]
        cells = ranked[0][:, i] * len(self.halves[1]) + ranked[1][:, j]
        out = gaps[0][:, i] + gaps[1][:, j] > 2 - 2 * self.least + 1e-6
        return np.take_along_axis(np.where(out, -1, cells), order, 1)


def _codebook(points: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres of the points; fewer when there are fewer different points."""
    different = np.unique(points, axis=0)
    book = different[rng.permutation(len(different))[:codes]].copy()
    for _ in range(12):
        d = (book * book).sum(1)[None, :] - 2 * points @ book.T
        own = d.argmin(1)
        counts = np.bincount(own, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, own, points)
        book[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return book


def _units(column: pa.Array, dimension: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    # the largest component becomes 1 first, so that no square is lost or too large
    values = values / np.abs(values).max(axis=1, keepdims=True, initial=0)
    return values / np.sqrt((values * values).sum(1))[:, None]


def fit(sample: np.ndarray, least: float = LEAST_COSINE, codes: int = CODES) -> Index:
    """Codebooks from unit vectors; every cell is visited but those where no near vector can lie."""
    rng = np.random.default_rng(7)
    half = max(1, sample.shape[1] // 2)
    halves = (_codebook(sample[:, :half], codes, rng), _codebook(sample[:, half:], codes, rng))
    return Index(halves, len(halves[0]) * len(halves[1]), least)


def _ranks(index: Index, probes: np.ndarray) -> np.ndarray:
    """At which visit each probe comes to each cell; one more than there are cells where it never does."""
    n = len(index.halves[0]) * len(index.halves[1])
    ranks = np.full((len(probes), n), n + 1, np.int32)
    for at in range(0, len(probes), 100):
        for k, cells in enumerate(index.visited(probes[at : at + 100], n), at):
            ranks[k, cells[cells >= 0]] = np.flatnonzero(cells >= 0) + 1
    return ranks


def needed_visits(found: np.ndarray, cells: int, target: float = TARGET_RECALL) -> int:
    """The fewest visits that find ``target`` of all pairs, and of a probe's pairs on average.

    ``found`` has rows of probe, visit and pairs. All cells where pairs are too few or the target isn't reached.
    """
    if len(found) == 0 or found[:, 2].sum() < LEAST_MEASURED or len(np.unique(found[:, 0])) < LEAST_MEASURED:
        return cells
    _, which = np.unique(found[:, 0], return_inverse=True)
    share = found[:, 2] / np.bincount(which, found[:, 2])[which]
    reached = np.ones(cells, bool)
    for weight in (found[:, 2], share):
        recall = np.cumsum(np.bincount(found[:, 1], weight, cells + 2))[1 : cells + 1] / weight.sum()
        reached &= recall >= target - 1e-12
    return int(reached.argmax()) + 1 if reached.any() else cells


def _measure(index: Index, single: DataFrame, total: int, target: float = TARGET_RECALL) -> int:
    """Compare random probes with every vector, a block at a time, and tell the visits needed."""
    dice = F.pmod(F.xxhash64("vec_id", F.lit("probe")), F.lit(1 << 30)) / float(1 << 30)
    drawn = single.filter(dice < PROBES / max(total, 1)).select("vec_id", "embedding").toArrow()
    cells = len(index.halves[0]) * len(index.halves[1])
    if drawn.num_rows == 0:
        return cells
    ids = drawn.column("vec_id").to_numpy()
    probes = _units(drawn.column("embedding").combine_chunks(), index.dimension)
    ranks = _ranks(index, probes)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                units = _units(part.column("embedding"), index.dimension)
                home = index.visited(units, 1)[:, 0]
                d, q = np.nonzero(units @ probes.T >= index.least)
                other = part.column("vec_id").to_numpy()[d] != ids[q]
                d, q = d[other], q[other]
                codes, n = np.unique(q * (cells + 2) + ranks[q, home[d]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes // (cells + 2), pa.int64()), pa.array(codes % (cells + 2), pa.int64()), pa.array(n, pa.int64())],
                    names=["probe", "visit", "n"],
                )

    pairs = single.select("vec_id", "embedding").mapInArrow(near, "probe long, visit long, n long")
    found = pairs.groupBy("probe", "visit").agg(F.sum("n").alias("n")).toArrow()
    return needed_visits(np.stack([found.column(c).to_numpy() for c in ("probe", "visit", "n")], 1), cells, target)


def _is_valid() -> Column:
    numbers = F.col("embedding")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = numbers.isNotNull() & finite & F.exists(numbers, lambda x: x != 0) & F.col("vec_id").isNotNull()
    return F.coalesce(valid, F.lit(False))


def _components(q: np.ndarray, d: np.ndarray, n_q: int, n_d: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels of both sides of a bipartite graph, equal within a component."""
    left, right = np.arange(n_q), np.full(n_d, n_q)
    while True:
        np.minimum.at(right, d, left[q])
        new = left.copy()
        np.minimum.at(new, q, right[d])
        if (new == left).all():
            return left, right
        left = new


def _linked(index: Index):
    """A task's function over rows sorted by (cell, block, query): each query against its block.

    Yields, for each vector with a link in a batch of queries: one vector of its local
    component, and the number of vectors newly linked with it. A pair that both sides
    visit is counted on each side's own visit, any other pair on the only visit there is.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            cells = batch.column("cell").to_numpy() * (1 << 31) + batch.column("block").to_numpy()
            query = batch.column("query").to_numpy(zero_copy_only=False)
            units = _units(batch.column("embedding"), index.dimension)
            names = ("vec_id", "copies", "home")
            plain = np.stack([batch.column(c).to_numpy() for c in names], 1) if batch.num_rows else np.zeros((0, 3), int)
            changes = np.flatnonzero((cells[1:] != cells[:-1]) | (query[1:] != query[:-1])) + 1
            bounds = [0, *changes.tolist(), len(cells)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if a == b:
                    continue
                if not query[a]:
                    old = block if key == cells[a] and block is not None else (plain[:0], units[:0])
                    key, block = cells[a], (np.concatenate([old[0], plain[a:b]]), np.concatenate([old[1], units[a:b]]))
                elif key == cells[a]:
                    for at in range(a, b, BATCH):
                        found = _pairs_of(index, plain[at : min(at + BATCH, b)], units[at : min(at + BATCH, b)], *block)
                        if found is not None:
                            yield found

    return compare


def _pairs_of(index: Index, queries, query_units, data, data_units) -> pa.RecordBatch | None:
    q, d = np.nonzero(query_units @ data_units.T >= index.least)
    other = queries[q, 0] != data[d, 0]
    q, d = q[other], d[other]
    if not len(q):
        return None
    use_d = np.unique(d)
    visited = np.zeros((len(use_d), len(index.halves[0]) * len(index.halves[1]) + 1), bool)
    # a cell left out is -1, the last column
    np.put_along_axis(visited, index.visited(data_units[use_d]), True, 1)
    mutual = visited[np.searchsorted(use_d, d), queries[q, 2]]
    more_q = np.bincount(q, data[d, 1], len(queries)).astype(np.int64)
    more_d = np.bincount(d[~mutual], queries[q[~mutual], 1], len(data)).astype(np.int64)
    left, right = _components(q, d, len(queries), len(data))
    use_q = np.unique(q)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([queries[use_q, 0], data[use_d, 0]])),
            pa.array(np.concatenate([queries[left[use_q], 0], queries[right[use_d], 0]])),
            pa.array(np.concatenate([more_q[use_q], more_d[use_d]])),
        ],
        names=["a", "b", "n"],
    )


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE, codes: int = CODES) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector, one row in, one row out.

    n_links counts the other vectors found with a cosine of ``least`` or more; component_id is
    the smallest vec_id that links reach; kept says whether that is the vector itself. Vectors
    that are null, zero, or hold a null or non-finite number link with nothing, and so do
    those without vec_id. Vectors of one length are compared with each other and with no others;
    each length gets an index of its own. Equal vectors are
    compared once and counted as often as they occur. Rows that repeat a vec_id count as vectors of
    their own in n_links, and share what either is linked with where their vectors are equal or linked. An
    empty table gives an empty result. Only vec_id and embedding are read.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    marked = rows.withColumn("length", F.when(_is_valid(), F.size("embedding")))
    # one row a length
    lengths = [r["length"] for r in marked.filter("length > 0").groupBy("length").count().filter("count > 1").collect()]
    among = F.coalesce(F.col("length").isin(lengths), F.lit(False))
    found = marked.filter(~among).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for length in sorted(lengths):
        found = found.union(_near_of_length(marked.filter(F.col("length") == length), length, least, codes))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _near_of_length(valid: DataFrame, length: int, least: float, codes: int) -> DataFrame:
    """vec_id, n_links and component_id of valid vectors of one length."""
    grouped = valid.groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    members = cut(valid.join(grouped, "embedding").select("vec_id", "first", "copies"))
    single = cut(grouped.select(F.col("first").alias("vec_id"), "embedding", "copies"))
    total = single.count()
    dice = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = single.filter(dice < SAMPLE / max(total, 1)).select("vec_id", "embedding").toArrow().sort_by("vec_id")
    if sample.num_rows == 0:
        sample = single.orderBy("vec_id").limit(1).select("vec_id", "embedding").toArrow()
    index = fit(_units(sample.column("embedding").combine_chunks(), length), least, codes)
    index.visits = _measure(index, single, total)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                cells = index.visited(_units(part.column("embedding"), index.dimension))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cells[:, 0].astype(np.int64)), pa.array([c[c >= 0] for c in cells], pa.list_(pa.int64()))],
                    names=["vec_id", "embedding", "copies", "home", "cells"],
                )

    placed = single.mapInArrow(
        assign, "vec_id long, embedding array<double>, copies long, home long, cells array<long>"
    )
    # a row for each cell of the grid: a cell with many vectors is split into blocks
    blocks = placed.groupBy(F.col("home").alias("cell")).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    )
    blocks = F.broadcast(cut(blocks))
    data = (
        placed.withColumn("cell", F.col("home")).join(blocks, "cell")
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("long"))
        .withColumn("query", F.lit(False))
    )
    queries = (
        placed.withColumn("cell", F.explode("cells")).join(blocks, "cell")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
        .withColumn("query", F.lit(True))
    )
    columns = ["cell", "block", "query", "vec_id", "copies", "home", "embedding"]
    work = data.select(*columns).union(queries.select(*columns)).repartition("cell", "block")
    found = cut(work.sortWithinPartitions("cell", "block", "query").mapInArrow(_linked(index), "a long, b long, n long"))
    counts = found.groupBy(F.col("a").alias("first")).agg(F.sum("n").alias("n"))
    labels = connected_components(found.select("a", "b")).withColumnRenamed("vertex", "first")
    return members.join(counts, "first", "left").join(labels, "first", "left").select(
        "vec_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "first").alias("component_id"),
    )
