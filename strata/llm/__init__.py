"""Training-data operators: ten corpus operators, their queries and their SQL.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface, plus the thin ``opN_<name>`` query that
applies it to a whole table and derives the digest columns.
"""

from __future__ import annotations

from strata.llm import registry

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
