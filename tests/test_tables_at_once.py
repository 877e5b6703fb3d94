"""Tables that are written at the same time: order of the results, errors, and that their jobs overlap."""

import threading

import pytest

from tradeledger.sources import sinks
from tradeledger.sources.schemas import TABLES
from tradeledger.star import Star


def test_order_and_errors():
    assert sinks.at_once(str.upper, "abcdefg") == list("ABCDEFG")
    assert sinks.at_once(str.upper, []) == []
    done = []

    def work(name):
        if name == "c":
            raise ValueError(name)
        done.append(name)

    with pytest.raises(ValueError, match="c"):
        sinks.at_once(work, "abc")


def test_star_tables_are_written_while_another_is(spark, tmp_path, monkeypatch):
    both, put = threading.Barrier(2, timeout=60), sinks._put_table
    first = threading.Semaphore(2)

    def waits(name, *rest):
        if first.acquire(blocking=False):
            both.wait()
        return put(name, *rest)

    monkeypatch.setattr(sinks, "_put_table", waits)
    path = str(tmp_path / "warehouse")
    sinks.write_star(Star.of(spark), path)
    assert [sinks.open_star(spark, path).table(name).count() for name in TABLES] == [0] * 9
    assert {r["table_name"] for r in sinks.stored_checks(spark, path).collect()} <= set(TABLES)
