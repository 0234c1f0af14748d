"""Load into a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame

BATCH_ROWS = 10_000


def load_jdbc(
    df: DataFrame, url: str, table: str, columns: list[str], properties: dict[str, str] | None = None
) -> None:
    """Truncate the table and insert in batches, keeping its definition and indexes.

    Every Spark partition opens one connection; ``numPartitions`` in ``properties`` bounds them.
    """
    options = {"url": url, "dbtable": table, "truncate": "true", "batchsize": str(BATCH_ROWS)}
    options.update(properties or {})
    df.select(*columns).write.format("jdbc").mode("overwrite").options(**options).save()
