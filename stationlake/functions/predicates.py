"""The two "row carries station metadata" tests. They differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_info_strict(raw_flag: Column) -> Column:
    """SQL and message routes: the text is exactly ``false``."""
    return raw_flag == "false"


def has_info_lenient(missing: Column) -> Column:
    """DataFrame route, over the parsed boolean: anything not flagged missing."""
    return ~missing


def all_present(*columns: str) -> Column:
    """Every named column is non-NULL."""
    test = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        test = test & F.col(name).isNotNull()
    return test
