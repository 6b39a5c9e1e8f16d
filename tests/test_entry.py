import importlib
import importlib.util
import sys

import pytest

import __spark_entry__ as entry
from lodestone.queries import QUERIES
from lodestone.runtime import intermediates

SMALLEST = "/root/testdata/sf0.001"


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {f"p{n}" for n in (2, 3, 5, 6)} <= {q[:2] for q in entry.queries() if q.endswith("_found")}


def test_works_without_the_optional_package(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("lodestone.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "lodestone.llm", None)
    again = importlib.reload(entry)
    assert "p6_found" in again.queries() and "p1_found" not in again.queries()
    monkeypatch.undo()
    importlib.reload(entry)


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and frame.columns == ["endpoint", "reason", "period", "orphans", "keys"]


def test_a_missing_library_is_an_error(monkeypatch):
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    for name in [m for m in sys.modules if m.startswith("lodestone.llm")]:
        monkeypatch.delitem(sys.modules, name)
    if importlib.util.find_spec("lodestone.llm"):
        with pytest.raises(ModuleNotFoundError):
            importlib.reload(entry)
    monkeypatch.undo()
    importlib.reload(entry)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_runs_on_the_smallest_tables(spark, name):
    with intermediates():
        frame = QUERIES[name](spark, SMALLEST)
        assert len(frame.collect()) >= 0 and len(set(frame.columns)) == len(frame.columns)
