"""Driver-side helpers on column *names* (never on data).

Spark resolves column names case-insensitively by default, so every Python-side
comparison of names here is case-insensitive too.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

# Fixed value: header normalisation turns every run of characters outside
# A-Z, a-z, 0-9 into one underscore, trims underscores at both ends, upper-cases.
_NOT_ALNUM = re.compile(r"[^a-zA-Z0-9]+")


def normalize_name(name: str) -> str:
    """``"Price ($)"`` -> ``"PRICE"``, ``" yard-id "`` -> ``"YARD_ID"``."""
    return _NOT_ALNUM.sub("_", name).strip("_").upper()


def normalize_names(names: Sequence[str]) -> list[str]:
    """Normalise a header; raise if two names collide or one becomes empty."""
    out = [normalize_name(n) for n in names]
    empty = [names[i] for i, n in enumerate(out) if not n]
    if empty:
        raise ValueError(f"header names normalise to nothing: {empty!r}")
    seen: dict[str, list[str]] = {}
    for raw, new in zip(names, out):
        seen.setdefault(new, []).append(raw)
    clashes = {k: v for k, v in seen.items() if len(v) > 1}
    if clashes:
        raise ValueError(f"header names collide after normalisation: {clashes!r}")
    return out


def resolve_column(columns: Iterable[str], name: str) -> str | None:
    """The actual column matching ``name`` case-insensitively, or None."""
    low = name.lower()
    for c in columns:
        if c.lower() == low:
            return c
    return None


def resolve_columns(columns: Iterable[str], names: Iterable[str], what: str = "column") -> list[str]:
    """Resolve every name or raise naming all the missing ones."""
    cols = list(columns)
    found, missing = [], []
    for n in names:
        r = resolve_column(cols, n)
        (found if r is not None else missing).append(r if r is not None else n)
    if missing:
        raise ValueError(f"missing {what}(s) {missing!r}; available: {cols!r}")
    return found


def qcol(name: str):
    """A column by its exact name, even with dots, spaces or backticks in it."""
    from pyspark.sql import functions as F

    return F.col("`" + name.replace("`", "``") + "`")


def split_list(text: str | None) -> list[str]:
    """Split a comma list from config and trim each item: ``"a, b ,c"`` -> ``[a, b, c]``."""
    if text is None:
        return []
    return [p.strip() for p in text.split(",") if p.strip()]
