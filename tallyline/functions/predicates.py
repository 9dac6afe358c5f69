"""Predicates over paired rows, addressed as ``old.<column>`` and ``new.<column>``.

``old`` is the row already in the table, ``new`` the row arriving from the source.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.dates import as_date

DEFAULT_REPROCESS_DAYS = 5


def keys_equal(keys: Sequence[str], left: str = "old", right: str = "new") -> Column:
    """Equality over every key column; null keys never match."""
    return reduce(operator.and_, [_field(left, k) == _field(right, k) for k in keys])


def differs(
    columns: Sequence[str],
    left: str = "old",
    right: str = "new",
    *,
    exclude: Sequence[str] = (),
    null_safe: bool = False,
) -> Column:
    """True where any of the columns (less ``exclude``) differs between the two rows.

    With plain inequality a change from or to null does not count as a difference;
    ``null_safe=True`` makes it count.
    """
    names = [c for c in columns if c not in set(exclude)]
    if not names:
        return F.lit(False)
    if null_safe:
        tests = [~_field(left, c).eqNullSafe(_field(right, c)) for c in names]
    else:
        tests = [F.coalesce(_field(left, c) != _field(right, c), F.lit(False)) for c in names]
    return reduce(operator.or_, tests)


def recent(column: str, as_of, days: int = DEFAULT_REPROCESS_DAYS, side: str = "old") -> Column:
    """True for rows dated within the last ``days`` days of ``as_of``."""
    return _field(side, column) >= F.date_sub(as_date(as_of), days)


def reprocess_days(as_of, start_load=None) -> int:
    """Width of the update window: back to ``start_load`` if given, else the default."""
    return (as_of - start_load).days if start_load else DEFAULT_REPROCESS_DAYS


def _field(side: str, name: str) -> Column:
    return F.col(f"{side}.`{name}`")
