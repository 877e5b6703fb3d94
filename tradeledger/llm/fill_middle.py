"""Fill-in-middle: texts cut at two line ends and rearranged for infilling.

The places where a text may be cut (its start and the end of each line, as byte offsets) form a
compressed set in the manner of roaring bitmaps: offsets are parted by their high bits, and each
part is an array, a bitmap or a list of runs, whichever is smallest. Cumulative
cardinalities find the part that holds the k-th place; a select inside the part finds the place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.textbytes import runs

SEED = 7
# Of a hundred texts so many are rearranged, and of a hundred of these so many suffix first.
RATE = 100
SUFFIX_FIRST = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PART_BITS = 16
COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass
class ArrayPart:
    """Sorted offsets as 16-bit numbers."""

    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])


@dataclass
class BitmapPart:
    """One bit an offset, in 64-bit words, and how many bits are set before each word."""

    words: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[at : at + 1].view(np.uint8), bitorder="little")
        return 64 * at + int(np.flatnonzero(bits)[k - int(self.before[at])])


@dataclass
class RunPart:
    """First offset of each run of neighbours, and how many offsets lie before it."""

    starts: np.ndarray
    before: np.ndarray

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def _part(low: np.ndarray) -> ArrayPart | BitmapPart | RunPart:
    """The smallest form of a part's sorted distinct offsets."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    span = 1 << PART_BITS
    sizes = {"array": 2 * len(low), "bitmap": span // 8, "run": 4 * len(first)}
    smallest = min(sizes, key=sizes.__getitem__)
    if smallest == "array":
        return ArrayPart(low.astype(np.uint16))
    if smallest == "run":
        return RunPart(low[first].astype(np.uint16), first.astype(np.uint32))
    bits = np.zeros(span, np.uint8)
    bits[low] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    counts = np.bitwise_count(words).astype(np.int64)
    return BitmapPart(words, np.cumsum(counts) - counts)


class OffsetSet:
    """A set of offsets that gives its k-th smallest member."""

    def __init__(self, offsets: np.ndarray):
        """``offsets`` are sorted and distinct."""
        high = offsets >> PART_BITS
        edges = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[edges]
        self.before = edges
        ends = np.append(edges[1:], len(offsets))
        self.parts = [
            _part(offsets[a:b] & ((1 << PART_BITS) - 1)) for a, b in zip(edges.tolist(), ends.tolist(), strict=True)
        ]
        self.size = len(offsets)

    def select(self, k: int) -> int:
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.keys[at]) << PART_BITS) + self.parts[at].select(k - int(self.before[at]))


def boundaries(text: np.ndarray) -> OffsetSet:
    """Start of the text and the end of each line, the last one with or without a line feed."""
    ends = np.flatnonzero(text == 10) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return OffsetSet(np.concatenate([np.zeros(1, np.int64), ends]))


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def draws(seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits from the document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def rearrange(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """n, form, prefix_chars, middle_chars and output of each document, one row in, one row out.

    A line ends with its line feed; n counts lines. The cuts are two of the n + 1 places, drawn
    from the document's id, so copies of a row get the same cuts and a null doc_id draws as
    an empty one. Form is ``psm``, ``spm`` or, unchanged, ``plain``: for texts that are null or
    empty, contain one of the marks, or are not drawn. Only doc_id and text are read.
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            drawn = np.stack([batch.column(f"h{i}").to_numpy() for i in range(1, 5)], axis=1).tolist()
            for at, data, offsets in runs(batch.column("text")):
                n, form, prefix, middle, output = [], [], [], [], []
                for d, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    text = data[begin:end]
                    places = boundaries(text)
                    h1, h2, h3, h4 = drawn[at + d]
                    raw = text.tobytes()
                    n.append(places.size - 1)
                    if not raw or h3 % 100 >= rate or any(m in raw for m in marks):
                        form.append("plain")
                        prefix.append(None)
                        middle.append(None)
                        output.append(raw)
                        continue
                    first, second = (places.select(k) for k in sorted((h1 % places.size, h2 % places.size)))
                    prefix.append(_chars(text[:first]))
                    middle.append(_chars(text[first:second]))
                    head, body, tail = raw[:first], raw[first:second], raw[second:]
                    if h4 % 100 < suffix_first:
                        form.append("spm")
                        output.append(b"".join((marks[1], tail, marks[0], head, marks[2], body)))
                    else:
                        form.append("psm")
                        output.append(b"".join((marks[0], head, marks[1], tail, marks[2], body)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(n)), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     pa.array(output, pa.binary()).view(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return docs.select("doc_id", "text", *draws(seed)).mapInArrow(cut_up, COLUMNS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    A text that holds a mark is left plain, so each mark's first occurrence is the one put in.
    """

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(output, second, 1)
        rest = output.substr(F.length(head) + len(second) + 1, F.length(output))
        body = F.substring_index(rest, MIDDLE, 1)
        last = rest.substr(F.length(body) + len(MIDDLE) + 1, F.length(rest))
        return head.substr(F.lit(len(first) + 1), F.length(head)), body, last

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix_2, prefix_2, middle_2 = parts(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2))
        .otherwise(output)
    )
