"""Passages that repeat across documents, by a sparse suffix array over words.

Suffixes are kept where content selects them: at minimisers, the smallest of WINDOW
successive GRAM-word hashes. Any passage of MIN_WORDS words has, in all its copies, a
minimiser early enough that its next KEY words still lie in the passage. Suffixes are
sorted by those words, then by document; each window of MIN_WORDS words around the key is
settled by its hash: every document that has it but the smallest is listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeledger.llm.checkpoints import cut
from tradeledger.llm.jaccard_join import bit_table
from tradeledger.llm.textbytes import SHORT_RUN, find_words, mix, powers, runs, word_hashes
from tradeledger.llm.worker_memory import parts, released

MIN_WORDS = 50
GRAM = 6
WINDOW = 32
# A passage's first minimiser is at most LEFT words from its start, so KEY words follow inside it.
LEFT = WINDOW - 1
KEY = MIN_WORDS - LEFT
RIGHT = MIN_WORDS - KEY
_BASE = 0xD6E8FEB86659FD93
_UNBASE = pow(_BASE, -1, 1 << 64)

SUFFIX = "key long, doc_id long, pos int, left binary, right binary"
FOUND = "edge boolean, key long, doc_id long, start int, end int, of_doc long, left binary, right binary, open long"


def _spans_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` successive words."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_BASE, len(hashes)), dtype=np.uint64, out=sums[1:])
    n = len(hashes) - width + 1
    return mix((sums[width:] - sums[:n]) * powers(_UNBASE, n))


def selected(hashes: np.ndarray) -> np.ndarray:
    """Positions of the minimisers that have KEY words from there on."""
    grams = _spans_hash(hashes, GRAM)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    places = np.unique(windows.argmin(1) + np.arange(len(windows)))
    return places[places + KEY <= len(hashes)]


def _suffixes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_id, word hashes, positions and keys of each text of MIN_WORDS words or more."""
    ids = batch.column("doc_id").to_pylist()
    for at, data, offsets in runs(batch.column("text"), SHORT_RUN):
        words = find_words(data, offsets)
        hashes = word_hashes(words, fold=False)
        for d in range(len(offsets) - 1):
            own = hashes[words.first[d] : words.first[d + 1]]
            if len(own) >= MIN_WORDS and ids[at + d] is not None:
                places = selected(own)
                yield ids[at + d], own, places, _spans_hash(own, KEY)[places].view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(k, np.full(len(k), i, np.int64)) for i, _, _, k in _suffixes(batch)]
        if found:
            keys, ids = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["key", "doc_id"])


def _contexts(own: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers left of each position, nearest first, and right of its key; 0 outside the text."""
    numbers = np.concatenate([np.zeros(LEFT, np.uint32), (own >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.zeros(RIGHT, np.uint32)])
    left = numbers[places[:, None] + LEFT - 1 - np.arange(LEFT)[None, :]]
    right = numbers[places[:, None] + LEFT + KEY + np.arange(RIGHT)[None, :]]
    return left, right


def _rows_of(table: np.ndarray):
    """A task's function: the suffixes whose key may be shared, with their contexts."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = len(table)
        for batch in batches:
            parts, size = [], 0
            for doc_id, own, places, keys in _suffixes(batch):
                quotient = np.abs(keys) // words * np.sign(keys)
                shared = (table[keys % words] >> (quotient % 64)) & 1 == 1
                if shared.any():
                    keys, places = keys[shared], places[shared]
                    parts.append((keys, np.full(len(keys), doc_id), places, *_contexts(own, places)))
                    size += len(keys)
                if size > 20_000:
                    yield _suffix_batch(parts)
                    parts, size = [], 0
            if parts:
                yield _suffix_batch(parts)

    return give


def _suffix_batch(parts: list) -> pa.RecordBatch:
    keys, ids, places, left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(ids, pa.int64()), pa.array(places, pa.int32()), _binary(left), _binary(right)],
        names=["key", "doc_id", "pos", "left", "right"],
    )


def _binary(rows: np.ndarray) -> pa.Array:
    wide = rows.shape[1] * 4
    return pa.Array.from_buffers(pa.binary(wide), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(-1, width)


def _windows(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the MIN_WORDS-word windows around each key, by the words they take to the left; which lie in the text."""
    factors = powers(_BASE, LEFT + RIGHT)
    n = len(rows["key"])
    sums, inside = [], []
    for words, own in ((rows["left"], factors[:LEFT]), (rows["right"], factors[LEFT:])):
        total = np.zeros((n, words.shape[1] + 1), np.uint64)
        np.cumsum(mix(words.astype(np.uint64)) * own, axis=1, dtype=np.uint64, out=total[:, 1:])
        there = np.ones(total.shape, bool)
        np.logical_and.accumulate(words != 0, axis=1, out=there[:, 1:])
        sums.append(total)
        inside.append(there)
    keys = mix(rows["key"].astype(np.int64).view(np.uint64))
    return mix(keys[:, None] + sums[0] + sums[1][:, ::-1]), inside[0] & inside[1][:, ::-1]


def _settle(rows: dict[str, np.ndarray], seen: tuple[np.ndarray, np.ndarray]):
    """Spans of rows sorted by key and document that an earlier document has as well.

    ``seen`` has windows met before, sorted, and their smallest documents. Also given: for each row
    and window whether its document is the smallest so far, and the windows' hashes and smallest documents.
    """
    hashes, inside = _windows(rows)
    doc = np.broadcast_to(rows["doc_id"][:, None], inside.shape)[inside]
    unique, at, which = np.unique(hashes[inside], return_index=True, return_inverse=True)
    lowest = doc[at]
    if len(seen[0]) and len(unique):
        place = np.minimum(np.searchsorted(seen[0], unique), len(seen[0]) - 1)
        lowest = np.where(seen[0][place] == unique, np.minimum(seen[1][place], lowest), lowest)
    low = np.full(inside.shape, np.iinfo(np.int64).max)
    low[inside] = lowest[which]
    repeat = inside & (low < rows["doc_id"][:, None])
    listed = np.flatnonzero(repeat.any(1))
    most = LEFT - repeat[listed, ::-1].argmax(1)
    least = repeat[listed].argmax(1)
    # every window holds the key, so those of one suffix join into one span
    spans = pd.DataFrame({
        "doc_id": rows["doc_id"][listed], "start": rows["pos"][listed] - most, "end": rows["pos"][listed] - least + MIN_WORDS,
        "of_doc": np.where(repeat[listed], low[listed], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max),
    })
    return spans, inside & ~repeat, hashes, low


def _columns(batch: pa.RecordBatch, pos: str = "pos") -> dict[str, np.ndarray]:
    rows = {"key": batch.column("key").to_numpy(), "doc_id": batch.column("doc_id").to_numpy(), "pos": batch.column(pos).to_numpy()}
    return rows | {"left": _numbers(batch.column("left"), LEFT), "right": _numbers(batch.column("right"), RIGHT)}


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk sorted suffixes, with the windows of the key at hand and their smallest documents so far.

    Keys may go on in another batch or task: rows of a batch's last key, of a task's first and of a
    continued one go out as edges too, with the windows (bits of ``open``) for which they are the smallest.
    """
    schema = pa.schema([
        ("edge", pa.bool_()), ("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
        ("of_doc", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("open", pa.int64()),
    ])
    nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    seen, seen_key = nothing, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _columns(batch)
        first, last = rows["key"][0], rows["key"][-1]
        if seen_key is not None and seen_key != first:
            seen = nothing
        spans, smallest, hashes, low = _settle(rows, seen)
        n = len(spans)
        if n:
            nulls = [None] * n
            yield pa.RecordBatch.from_arrays(
                [pa.array([False] * n), pa.array(nulls, pa.int64()), pa.array(spans["doc_id"], pa.int64()),
                 pa.array(spans["start"], pa.int32()), pa.array(spans["end"], pa.int32()), pa.array(spans["of_doc"], pa.int64()),
                 pa.array(nulls, pa.binary()), pa.array(nulls, pa.binary()), pa.array(nulls, pa.int64())],
                schema=schema,
            )
        at_edge = rows["key"] == last
        if seen_key is None or seen_key == first:
            at_edge |= rows["key"] == first
        at = np.flatnonzero(at_edge & smallest.any(1))
        if len(at):
            bits = (smallest[at] * (np.int64(1) << np.arange(LEFT + 1))).sum(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([True] * len(at)), pa.array(rows["key"][at], pa.int64()), pa.array(rows["doc_id"][at], pa.int64()),
                 pa.array(rows["pos"][at], pa.int32()), pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.int64()),
                 _binary(rows["left"][at]), _binary(rows["right"][at]), pa.array(bits, pa.int64())],
                schema=schema,
            )
        mine = smallest & (rows["key"] == last)[:, None]
        old = seen if seen_key == last else nothing
        known, place = np.unique(np.concatenate([old[0], hashes[mine]]), return_index=True)
        seen, seen_key = (known, np.concatenate([old[1], low[mine]])[place]), last


def _across(edges: pd.DataFrame) -> pd.DataFrame:
    """One key's edge rows settled in memory; ``_across_tasks`` does the same on Spark."""
    edges = edges.sort_values(["doc_id", "start"])
    rows = {"key": edges["key"].to_numpy(), "doc_id": edges["doc_id"].to_numpy(), "pos": edges["start"].to_numpy()}
    rows |= {c: np.frombuffer(b"".join(edges[c]), np.uint32).reshape(len(edges), -1) for c in ("left", "right")}
    return _settle(rows, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))[0]


def _open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open windows of edge rows; one that a document repeats without a gap is one row."""
    for batch in batches:
        if batch.num_rows:
            rows = _columns(batch, "start")
            at, i = np.nonzero((batch.column("open").to_numpy()[:, None] >> np.arange(LEFT + 1)) & 1)
            hashes, doc, start = _windows(rows)[0][at, i].view(np.int64), rows["doc_id"][at], rows["pos"][at] - i
            order = np.lexsort((start, doc, hashes))
            hashes, doc, start = hashes[order], doc[order], start[order]
            new = np.ones(len(order), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + MIN_WORDS)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(order)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[first]), pa.array(doc[first], pa.int64()), pa.array(start[first], pa.int32()),
                 pa.array(start[last] + MIN_WORDS, pa.int32())],
                names=["window", "doc_id", "start", "end"],
            )


def _across_tasks(edges: DataFrame) -> DataFrame:
    """The spans of edge rows whose window has a smaller document in another batch or task."""
    edges = edges.select("key", "doc_id", "start", "left", "right", "open")
    windows = edges.mapInArrow(released(_open_windows), "window long, doc_id long, start int, end int")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("of_doc"), F.max("doc_id").alias("high"))
    least = least.filter("of_doc < high").drop("high")
    return windows.join(least, "window").filter("doc_id > of_doc").select("doc_id", "start", "end", "of_doc")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start, end, n_words and of_doc: word ranges that an earlier document has as well.

    A range joins overlapping repeats of MIN_WORDS words or more, whatever the order or
    partitioning of the rows; of_doc is the smallest doc_id met among the documents with a part of it. Of the copies of a passage the one with
    the smallest doc_id is not listed. Words are runs other than ASCII white space, compared
    exactly as written, by hashes. Repeats within one document, and texts whose doc_id is null,
    are left alone; rows that repeat a doc_id are one document. Shorter, empty and null
    texts have no repeat. Only doc_id and text are read.
    """
    texts = docs.select("doc_id", "text")
    keys = texts.mapInArrow(released(_keys), "key long, doc_id long").groupBy("key")
    shared = keys.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    table = bit_table(shared.select(F.col("key").alias("id")))
    suffixes = texts.mapInArrow(released(_rows_of(table)), SUFFIX)
    ordered = ["key", "doc_id", "pos"]
    found = cut(
        suffixes.repartitionByRange(*ordered).sortWithinPartitions(*ordered).mapInArrow(released(_neighbours), FOUND)
    )
    across = _across_tasks(found.filter("edge"))
    spans = found.filter("not edge").select("doc_id", "start", "end", "of_doc").union(across).distinct()
    before = Window.partitionBy("doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    begins = (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int")
    islands = spans.withColumn("begins", begins).withColumn("island", F.sum("begins").over(upto))
    return (
        islands.groupBy("doc_id", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("of_doc").alias("of_doc"))
        .select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "of_doc")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out of their texts; columns unchanged.

    The first copy of a passage stays. A column n_chars, if there is one, is the new length
    of a changed text. A document left without a word goes; others all stay. Null texts stay as
    they are. Of rows that repeat a doc_id with different texts, those with one of the texts (the one
    with the smallest hash) are looked at; the others are other documents by the same name and stay whole.
    """
    spare = "spans"
    while spare in docs.columns or f"{spare}_of" in docs.columns:
        spare += "_"
    of = f"{spare}_of"
    hashed = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("h"))
    several = hashed.groupBy("doc_id").agg(F.min("h").alias(of), F.max("h").alias("high")).filter(F.col(of) < F.col("high"))
    several = cut(several.drop("high"))
    plain = several.isEmpty()
    looked = docs
    if not plain:
        looked = docs.select("doc_id", "text").join(several, "doc_id", "left")
        looked = looked.filter(F.col(of).isNull() | F.coalesce(F.xxhash64("text") == F.col(of), F.lit(False)))
    spans = repeated_passages(looked).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(spare))
    names = docs.columns

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            ranges = batch.column(spare).to_pylist()
            table = batch.select(names)
            meant = batch.column(of).to_pylist()
            changed = [d for d, x in enumerate(ranges) if x and meant[d]]
            if not changed:
                yield table
                continue
            texts = table.column("text").to_pylist()
            lengths = table.column("n_chars").to_pylist() if "n_chars" in names else None
            keep = np.ones(len(texts), bool)
            for d in changed:
                raw = texts[d].encode()
                words = find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                at, left = 0, []
                for span in ranges[d]:
                    left.append(raw[at : words.start[span["start"]]])
                    at = words.start[span["end"]] if span["end"] < len(words.start) else len(raw)
                texts[d] = b"".join([*left, raw[at:]]).decode()
                keep[d] = bool(texts[d].strip(" \t\n\x0b\f\r"))
                if lengths is not None:
                    lengths[d] = len(texts[d])
            columns = {c: table.column(c) for c in names}
            columns["text"] = pa.array(texts, table.column("text").type)
            if lengths is not None:
                columns["n_chars"] = pa.array(lengths, table.column("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names).filter(pa.array(keep))

    joined = docs.join(spans, "doc_id", "left")
    meant = F.col("text").isNotNull()
    if not plain:
        joined = joined.join(several, "doc_id", "left")
        meant = meant & (F.col(of).isNull() | (F.xxhash64("text") == F.col(of)))
    return joined.select(*names, spare, meant.alias(of)).mapInArrow(released(cut_out), docs.schema)
