"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time. It labels
every byte of a text with probabilities of the languages; a document's
probabilities are the means over its bytes. Gates and candidate are piecewise linear
(clipped), which keeps a step to a few passes over small arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.textbytes import runs
from tradeledger.llm.worker_memory import ROWS, released

# Bounds of the training sample: windows a language (about), and characters a window.
WINDOWS = 600
WINDOW_CHARS = 120
HIDDEN = 8
STEPS = 600
BATCH = 96
# Texts are read in segments of up to this many bytes, each from a zero state at both ends.
SEGMENT = 256
LANES = 2048
UNDETERMINED = "und"
PREDICTIONS = "doc_id long, lang_pred string, score double"
_WORDLIKE = re.compile(r"[^\W\d_]")


def _has_letter(text: str) -> bool:
    """Whether a character is a letter; numerals such as ½ or Ⅷ are none."""
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


@dataclass
class Model:
    """For each direction: input table (bytes x 3h), gates (h x 2h), candidate (h x h), output (h x languages)."""

    languages: list[str]
    forward: dict[str, np.ndarray]
    backward: dict[str, np.ndarray]
    bias: np.ndarray


def training_windows(docs: DataFrame, windows: int = WINDOWS, chars: int = WINDOW_CHARS) -> list[tuple[str, str]]:
    """About ``windows`` (lang, text) of each language, from places anywhere in the texts.

    Rows are chosen by a hash of doc_id at a rate that the language's count sets, so the
    sample's size doesn't grow with the table. Rows without text or lang are not used.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rates = rows.groupBy("lang").agg((F.lit(float(windows)) / F.count(F.lit(1))).alias("rate"))
    dice = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.length("text") - chars, F.lit(1))) + 1
    chosen = (
        # one row for each language
        rows.join(F.broadcast(rates), "lang")
        .filter(dice < F.col("rate"))
        .select("doc_id", "lang", F.col("text").substr(place.cast("int"), F.lit(chars)).alias("window"))
    )
    return [(r["lang"], r["window"]) for r in sorted(chosen.collect(), key=lambda r: (r["doc_id"], r["window"]))]


def _fresh(rng: np.random.Generator, hidden: int, languages: int) -> dict[str, np.ndarray]:
    scale = 1 / np.sqrt(hidden)
    table = rng.normal(0, 0.5, (256, 3 * hidden))
    table[:, :hidden] += 0.5
    table[:, hidden : 2 * hidden] += 0.3
    return {
        "table": table,
        "gates": rng.normal(0, 0.3 * scale, (hidden, 2 * hidden)),
        "candidate": rng.normal(0, scale, (hidden, hidden)),
        "output": rng.normal(0, scale, (hidden, languages)),
    }


def _run(p: dict[str, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, list]:
    """States of a padded batch (steps x lanes), and what the way back needs."""
    steps, lanes = codes.shape
    hidden = p["candidate"].shape[0]
    state = np.zeros((lanes, hidden))
    states, kept = np.empty((steps, lanes, hidden)), []
    for t in range(steps):
        given = p["table"][codes[t]]
        raw = given[:, : 2 * hidden] + state @ p["gates"]
        gate = np.clip(raw, 0, 1)
        reset, update = gate[:, :hidden], gate[:, hidden:]
        held = reset * state
        raw_new = given[:, 2 * hidden :] + held @ p["candidate"]
        new = np.clip(raw_new, -1, 1)
        kept.append((state, gate, (raw > 0) & (raw < 1), held, new, np.abs(raw_new) < 1))
        state = state + update * (new - state)
        states[t] = state
    return states, kept


def _back(p: dict[str, np.ndarray], codes: np.ndarray, kept: list, at_state: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of one direction; at_state is the loss's gradient at each state."""
    steps, lanes = codes.shape
    hidden = p["candidate"].shape[0]
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    at_input = np.empty((steps, lanes, 3 * hidden))
    carry = np.zeros((lanes, hidden))
    for t in reversed(range(steps)):
        state, gate, open_gate, held, new, open_new = kept[t]
        reset, update = gate[:, :hidden], gate[:, hidden:]
        d = at_state[t] + carry
        d_new = d * update * open_new
        d_held = d_new @ p["candidate"].T
        d_gate = np.concatenate([d_held * state, d * (new - state)], 1) * open_gate
        carry = d * (1 - update) + d_held * reset + d_gate @ p["gates"].T
        grads["candidate"] += held.T @ d_new
        grads["gates"] += state.T @ d_gate
        at_input[t, :, : 2 * hidden] = d_gate
        at_input[t, :, 2 * hidden :] = d_new
    flat, where = at_input.reshape(-1, 3 * hidden), codes.ravel()
    for k in range(3 * hidden):
        grads["table"][:, k] = np.bincount(where, flat[:, k], 256)
    return grads


def train(
    windows: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = 1
) -> Model:
    """Fit the network to windows of known language; every byte of a window has its language as label."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in windows})
    known = [(languages.index(lang), text.encode()) for lang, text in windows if text]
    model = Model(languages, _fresh(rng, hidden, len(languages)), _fresh(rng, hidden, len(languages)), np.zeros(len(languages)))
    if len(languages) < 2 or not known:
        return model
    by_language = [[raw for k, raw in known if k == which] for which in range(len(languages))]
    by_language = [x for x in by_language if x] if not all(by_language) else by_language
    sides = {"f": model.forward, "b": model.backward}
    first = {(s, k): np.zeros_like(v) for s, p in sides.items() for k, v in p.items()} | {("", ""): np.zeros(len(languages))}
    second = {k: v.copy() for k, v in first.items()}
    for step in range(1, steps + 1):
        labels = rng.integers(0, len(languages), batch)
        texts = [by_language[k][rng.integers(len(by_language[k]))] for k in labels]
        length = np.array([len(x) for x in texts])
        codes = np.zeros((length.max(), batch), np.intp)
        mask = np.arange(length.max())[:, None] < length[None, :]
        turned = codes.copy()
        for lane, raw in enumerate(texts):
            codes[: len(raw), lane] = np.frombuffer(raw, np.uint8)
            turned[: len(raw), lane] = np.frombuffer(raw, np.uint8)[::-1]
        there, kept_there = _run(model.forward, codes)
        back, kept_back = _run(model.backward, turned)
        # the backward state that has read bytes t.. of a lane is at step length-1-t
        mirror = np.clip(length[None, :] - 1 - np.arange(len(codes))[:, None], 0, None)
        lanes = np.arange(batch)[None, :]
        logits = there @ model.forward["output"] + back[mirror, lanes] @ model.backward["output"] + model.bias
        logits -= logits.max(2, keepdims=True)
        share = np.exp(logits)
        share /= share.sum(2, keepdims=True)
        error = share
        error[:, np.arange(batch), labels] -= 1
        error *= (mask / length[None, :] / batch)[:, :, None]
        error_back = error[mirror, lanes] * mask[:, :, None]
        gf = _back(model.forward, codes, kept_there, error @ model.forward["output"].T)
        gb = _back(model.backward, turned, kept_back, error_back @ model.backward["output"].T)
        gf["output"] = np.tensordot(there, error, ([0, 1], [0, 1]))
        gb["output"] = np.tensordot(back, error_back, ([0, 1], [0, 1]))
        grads = {("f", k): g for k, g in gf.items()} | {("b", k): g for k, g in gb.items()} | {("", ""): error.sum((0, 1))}
        norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for key, g in grads.items():
            g = g / max(1.0, norm)
            first[key] = 0.9 * first[key] + 0.1 * g
            second[key] = 0.99 * second[key] + 0.01 * g * g
            change = rate * first[key] / (1 - 0.9**step) / (np.sqrt(second[key] / (1 - 0.99**step)) + 1e-8)
            (model.bias if key == ("", "") else sides[key[0]][key[1]])[...] -= change
    return model


class Reader:
    """The network at work: label probabilities of every byte, lanes of similar length together."""

    def __init__(self, model: Model):
        self.languages = len(model.languages)
        self.sides = [
            tuple(np.ascontiguousarray(p[k].T.astype(np.float32)) for k in ("table", "gates", "candidate", "output"))
            for p in (model.forward, model.backward)
        ]
        self.bias = model.bias.astype(np.float32)[:, None]

    def sums(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text, the sum over its bytes of the languages' probabilities."""
        size = np.diff(offsets)
        parts = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(size)), parts)
        which = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = offsets[:-1][owner] + size[owner] * which // np.maximum(parts[owner], 1)
        end = offsets[:-1][owner] + size[owner] * (which + 1) // np.maximum(parts[owner], 1)
        order = np.argsort(begin - end, kind="stable")
        total = np.zeros((len(size), self.languages))
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            found = self._labels(data, begin[lanes], (end - begin)[lanes])
            np.add.at(total, owner[lanes], found.T)
        return total

    def _labels(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Sums over the lanes' bytes; lanes come longest first."""
        steps, lanes = int(length[0]), len(begin)
        live = np.searchsorted(-length, -np.arange(1, steps + 1), "right")
        logits = np.zeros((steps, self.languages, lanes), np.float32)
        for backward, (table, gates, candidate, output) in enumerate(self.sides):
            hidden = candidate.shape[0]
            state = np.zeros((hidden, lanes), np.float32)
            for t in range(steps):
                n = live[t]
                h = state[:, :n]
                at = begin[:n] + (length[:n] - 1 - t if backward else t)
                given = table.take(data[at], axis=1)
                gate = gates @ h
                gate += given[: 2 * hidden]
                np.clip(gate, 0, 1, out=gate)
                new = candidate @ (gate[:hidden] * h)
                new += given[2 * hidden :]
                np.clip(new, -1, 1, out=new)
                new -= h
                new *= gate[hidden:]
                h += new
                if backward:
                    logits[length[:n] - 1 - t, :, np.arange(n)] += (output @ h).T
                else:
                    logits[t, :, :n] = output @ h
        logits += self.bias
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        logits *= (np.arange(steps)[:, None] < length[None, :])[:, None, :]
        return logits.sum(0)


def _verdicts(reader: Reader, languages: list[str], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of each text; equal texts of a batch are read once."""
    coded = texts.cast(pa.large_string()).fill_null("").dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    different = coded.dictionary
    best = np.full(len(different), UNDETERMINED, object)
    score = np.zeros(len(different))
    has_letter = np.array([_has_letter(x) for x in different.to_pylist()], bool)
    for at, data, offsets in runs(different) if languages else ():
        sums = reader.sums(data, offsets)
        share = sums / np.maximum(sums.sum(1, keepdims=True), 1e-9)
        here = slice(at, at + len(share))
        best[here] = np.array(languages, object)[share.argmax(1)]
        score[here] = np.clip(share.max(1), 0, 1)
    best[~has_letter] = UNDETERMINED
    score[~has_letter] = 0
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return best[codes], score[codes]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each document, one row in, one row out.

    Only doc_id and text are read. A null text, or one without a letter, is ``und`` with
    score 0, and so is every text if the model has learned no language. Texts are read
    whole, in segments; equal texts get equal results whatever their rows.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            best, score = _verdicts(reader, model.languages, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(best, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(released(label), PREDICTIONS)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.35) -> DataFrame:
    """The documents whose language is determined with a score of ``least`` or more; columns unchanged.

    Null and empty texts, and those without a letter, have no language and go; rows are judged by their
    text alone, so repeated rows stay or go together.
    """

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            best, score = _verdicts(reader, model.languages, batch.column("text"))
            keep = (best != UNDETERMINED) & (score >= least)
            for at in range(0, batch.num_rows, ROWS):
                yield batch.slice(at, ROWS).filter(pa.array(keep[at : at + ROWS]))

    return docs.mapInArrow(released(sift), docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id, as text, divides by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
