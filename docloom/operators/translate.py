"""Translation behind the chat port."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.columns import require
from docloom.functions.ports import Chat
from docloom.operators.embed import ask


def translate(df: DataFrame, columns: list[str], source: str, target: str, make: Callable[[], Chat], enabled: bool = True) -> DataFrame:
    """Per column ``original_c``, ``translated_c`` and ``c_language`` in place of c.

    Texts in the target language are copied, failed ones keep the original; rows without a language drop out. A text
    is translated once however many rows have it.
    """
    require(df, source, *columns)
    if not enabled:
        return df
    rows = df.where(F.col(source).isNotNull())
    for c in columns:
        texts = rows.where((F.col(source) != target) & F.col(c).isNotNull()).select(F.col(source).alias("source_language"), F.col(c).alias("text")).distinct().withColumn("target_language", F.lit(target))
        done = ask(texts, "translation", make, "__to").select(F.col("source_language").alias("__from"), F.col("text").alias("__text"), "__to")
        rows = rows.join(done, (F.col(source) == F.col("__from")) & (F.col(c) == F.col("__text")), "left")
        rows = rows.withColumns({f"translated_{c}": F.coalesce("__to", c), f"{c}_language": F.when((F.col(source) == target) | F.col("__to").isNotNull(), F.lit(target)).otherwise(F.col(source)), f"original_{c}": F.col(c)}).drop("__from", "__text", "__to", c)
    return rows
