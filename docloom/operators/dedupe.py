"""Removal of repeated rows under an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.errors import RuleError
from docloom.functions.columns import require


def remove_duplicates(df: DataFrame, columns: Sequence[str], keep: str | bool = "first", order_by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """``keep``: "first", "last", or False for none of the repeated rows. Nulls equal each other and sort last.

    Ties under ``order_by`` are broken by all other columns, so the survivor does not depend on partitioning.
    """
    require(df, *columns, *order_by)
    if keep is False:
        n = F.count(F.lit(1)).over(Window.partitionBy(*columns))
        return df.withColumn("__n", n).where("__n = 1").drop("__n")
    if keep not in ("first", "last"):
        raise RuleError(f"keep is first, last or False, not {keep!r}")
    down = descending != (keep == "last")
    way = lambda c: (F.desc_nulls_last if down else F.asc_nulls_last)(c) if keep == "first" else (F.desc_nulls_first if down else F.asc_nulls_first)(c)
    rest = [c for c, kind in df.dtypes if c not in order_by and not kind.startswith(("map", "variant"))]
    window = Window.partitionBy(*columns).orderBy(*(way(c) for c in (*order_by, *rest)))
    return df.withColumn("__nth", F.row_number().over(window)).where("__nth = 1").drop("__nth")
