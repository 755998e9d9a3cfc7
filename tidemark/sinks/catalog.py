"""Full replace in a catalog whose tables support it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import named
from tidemark.sinks.layout import laid_out


class CatalogStore:
    """Tables of one namespace, replaced through the catalog.

    Needs a catalog with an atomic create-or-replace (Iceberg, for one), set up in the
    caller's session. Spark's own session catalog refuses it for file formats; there,
    use :class:`~tidemark.sinks.versioned.VersionedStore`.
    """

    def __init__(self, spark: SparkSession, namespace: str, provider: str = "iceberg"):
        self.spark = spark
        self.namespace = namespace
        self.provider = provider

    def publish(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ) -> str:
        """Replace the table with ``df`` and return its full name.

        Rows are laid out by the partition columns first, as in the versioned store;
        ``options`` go to the writer.
        """
        table = f"{self.namespace}.{name}"
        writer = laid_out(df, partition_by).writeTo(table).using(self.provider)
        for key, value in (options or {}).items():
            writer = writer.option(key, value)
        if partition_by:
            writer = writer.partitionedBy(*[named(c) for c in partition_by])
        writer.createOrReplace()
        return table

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.namespace}.{name}")
