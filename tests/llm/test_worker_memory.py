"""A worker's steps take memory for a part of a batch, and give back what they have freed."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tradeledger.llm import language_id, packing, sparse_suffix, textbytes, toxicity, worker_memory
from tradeledger.llm.queries import tokenizer_path


class Rows:
    """Takes the place of a DataFrame, and keeps the function of its tasks."""

    schema = None

    def select(self, *columns):
        return self

    def mapInArrow(self, step, schema):  # noqa: N802
        self.step = step
        return self


def documents(n=2500):
    texts = [" ".join(f"w{i % 700}x{j}" for j in range(300)) for i in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(texts)], ["doc_id", "text"])


def most_memory(step, batch):
    tracemalloc.start()
    rows = sum(out.num_rows for out in step(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return rows, peak


def test_suffixes_of_a_large_batch_take_little_memory(monkeypatch):
    batch = documents()
    monkeypatch.setattr(textbytes, "_powers", {})
    rows, peak = most_memory(sparse_suffix._keys, batch)
    assert rows > 2500 and peak < 40 << 20
    several = [x for at in range(0, 2500, 7) for x in sparse_suffix._suffixes(batch.slice(at, 7))]
    for a, b in zip(sparse_suffix._suffixes(batch), several, strict=True):
        assert a[0] == b[0] and all(np.array_equal(x, y) for x, y in zip(a[1:], b[1:], strict=True))


def test_tokens_come_in_short_runs(monkeypatch):
    sizes = []

    class Coder:
        def __init__(self, path):
            pass

        def encode_run(self, data, offsets):
            sizes.append(len(data))
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)

    monkeypatch.setattr(packing, "ByteBpe", Coder)
    rows = packing.token_pieces(Rows(), tokenizer_path("byte_bpe_50k.json"))
    assert sum(out.num_rows for out in rows.step(iter([documents()]))) == 2500
    assert max(sizes) <= textbytes.SHORT_RUN


@pytest.mark.parametrize("keep", [toxicity.keep_civil, language_id.keep_identified])
def test_kept_documents_are_handed_back_in_parts(monkeypatch, keep):
    batch = documents()
    monkeypatch.setattr(language_id, "Reader", lambda model: None)
    monkeypatch.setattr(
        language_id, "_verdicts", lambda reader, languages, texts: (np.array(["en"] * len(texts), object), np.arange(len(texts)) % 3 / 2)
    )
    model = toxicity.Model() if keep is toxicity.keep_civil else SimpleNamespace(languages=["en"])
    found = list(keep(Rows(), model).step(iter([batch])))
    assert max(x.num_rows for x in found) <= worker_memory.ROWS
    ids = [i for x in found for i in x.column("doc_id").to_pylist()]
    assert ids == [i for i in range(2500) if keep is toxicity.keep_civil or i % 3]


def test_what_a_task_freed_is_given_back(monkeypatch):
    calls = []
    monkeypatch.setattr(worker_memory, "give_back", lambda: calls.append(1))

    def step(batches):
        for batch in batches:
            assert not calls
            yield batch

    batch = documents(3)
    assert [x.num_rows for x in worker_memory.released(step)(iter([batch, batch]))] == [3, 3] and calls == [1]
    assert [x.num_rows for x in worker_memory.parts(iter([batch]), 2)] == [2, 1]
    worker_memory.give_back()
