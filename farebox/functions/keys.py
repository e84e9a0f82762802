"""Key expressions: the trip surrogate key and integer date keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(cols: Sequence[str | Column], sep: str = "|") -> Column:
    """md5 of the ``sep``-joined text of ``cols``; a NULL part becomes ''.

    ``concat_ws`` would skip NULLs and shift the separators, so each part is
    coalesced to '' first. Numbers use Spark's text form (10.0 -> '10.0').
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
             for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def date_key(c: str | Column) -> Column:
    """Integer YYYYMMDD key of a date or timestamp (arithmetic, no text)."""
    d = F.col(c) if isinstance(c, str) else c
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
