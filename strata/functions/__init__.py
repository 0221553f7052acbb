from strata.functions.names import (
    normalize_name,
    normalize_names,
    resolve_column,
    resolve_columns,
    split_list,
)
from strata.functions.values import as_timestamp

__all__ = [
    "normalize_name",
    "normalize_names",
    "resolve_column",
    "resolve_columns",
    "split_list",
    "as_timestamp",
]
