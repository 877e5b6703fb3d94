"""Packing by shortest pack first over the histogram of lengths.

Documents become token pieces of at most ``size``; a longer document is cut at
multiples of ``size``. The histogram of piece lengths (at most ``size`` numbers) is
all that reaches the driver. Lengths are placed longest first, each into the packs
with the most room, a whole group of equal packs at a time; a group is a pattern of
lengths and a count. Each piece then finds its slot by its rank among the pieces of
its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeledger.llm.byte_bpe import ByteBpe
from tradeledger.llm.checkpoints import cut
from tradeledger.llm.textbytes import SHORT_RUN, runs
from tradeledger.llm.worker_memory import released

SIZE = 1024
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """Pieces of each document's ids, closed by id 0: doc_id, start, length, ids_crc32, doc_tokens.

    Pieces cover each document once, in order; all but its last have ``size`` ids. A null
    or empty text is the closing id alone. Only doc_id and text are read. ``tokenizer``
    is the path of a byte-level BPE file for the library tokenizers.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = ByteBpe(tokenizer)
        for batch in batches:
            for at, data, offsets in runs(batch.column("text"), SHORT_RUN):
                ids, bounds = coder.encode_run(data, offsets)
                n = np.diff(bounds) + 1
                closed = np.full(n.sum(), END_ID, "<u4")
                closed[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
                parts = -(-n // size)
                owner = np.repeat(np.arange(len(n)), parts)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * size
                length = np.minimum(size, n[owner] - start)
                begin = (np.cumsum(n) - n)[owner] + start
                raw = memoryview(closed.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin, begin + length, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(n)).cast(pa.int64()).take(pa.array(owner)),
                        pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[owner]),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(released(pieces), PIECES)


@dataclass
class Group:
    """``count`` packs with the same lengths, in the order they were placed."""

    count: int
    lengths: tuple[int, ...]


def pack_histogram(histogram: dict[int, int], size: int = SIZE) -> list[Group]:
    """Shortest pack first: lengths longest first, each to the packs that hold least."""
    by_room: dict[int, list[Group]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, groups in by_room.items() if groups), default=0)
            if room < length:
                by_room.setdefault(size - length, []).append(Group(left, (length,)))
                break
            group = by_room[room].pop()
            placed = min(left, group.count)
            if placed < group.count:
                by_room[room].append(Group(group.count - placed, group.lengths))
            by_room.setdefault(room - length, []).append(Group(placed, (*group.lengths, length)))
            left -= placed
    return [g for room in sorted(by_room) for g in by_room[room]]


def slots(groups: list[Group]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset) of each slot of each pattern."""
    rank: dict[int, int] = {}
    found, sequence = [], 0
    for group in groups:
        offset = 0
        for length in group.lengths:
            low = rank.get(length, 0)
            rank[length] = low + group.count
            found.append((length, low, low + group.count, sequence, offset))
            offset += length
        sequence += group.count
    return found


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """One row per piece: token_pieces' columns, sequence_id and offset.

    Every id of every document lies in exactly one piece, and the pieces of a sequence
    fill it from offset 0 without gaps. A piece's rank among those of its length is the
    count in lower salts plus its row number within (length, salt), so a common
    length is dealt over many tasks. Repeated rows are packed as often as they occur;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    salts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = cut(
        token_pieces(docs, tokenizer, size).withColumn(
            "salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts))
        )
    )
    counts = pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    )
    histogram = {
        r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    found = slots(pack_histogram(histogram, size))
    # at most a few patterns per length: bounded by the square of ``size``, whatever the input
    places = spark.createDataFrame(
        found, "length long, low long, high long, first_sequence long, offset long"
    )
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("row", F.row_number().over(order))
        .join(counts, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("row") - 1)
    )
    slot = F.broadcast(places.withColumnRenamed("length", "slot_length"))
    placed = ranked.join(
        slot,
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset",
    )
