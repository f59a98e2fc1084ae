"""Registered queries and their check SQL.

Feeds, lists and answers do not exist as tables, so each query first derives
them from the given tables: every row becomes one XML, CSV or Markdown record,
the operator under test parses it back, and the check SQL works the expected
values out of the table columns without any parsing.
"""

from rollcall.queries import (
    answers, consolidation, documents, feed, full_list, links, reports,
)

_MODULES = (feed, full_list, documents, links, answers, consolidation, reports)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
CHECKS = {name: sql for m in _MODULES for name, sql in m.CHECKS.items()}
