"""Row rules: an ordered list of (name, condition that must hold)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_failing(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that does not hold (NULL counts as not holding), else NULL."""
    return F.coalesce(
        *[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules]
    )
