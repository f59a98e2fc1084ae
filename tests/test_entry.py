"""The driver's entry with and without the text operators."""

import sys

import __spark_entry__ as driver
from rollcall.queries import CHECKS, QUERIES


def test_entry_lacks_only_the_text_operators_where_one_of_their_libraries_is_absent(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("rollcall.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    assert driver.queries() == QUERIES and driver.oracle_sql() == CHECKS
