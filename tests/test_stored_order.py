"""Files whose ranges only meet at their ends."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.sinks.layout import laid_out


def ranges(folder, column):
    """Least, most and number of rows of each file by its statistics, in file order."""
    found = []
    for file in sorted(Path(folder).glob("part-*.parquet")):
        meta = pq.ParquetFile(file).metadata
        at = [c.name for c in pq.ParquetFile(file).schema].index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        if meta.num_rows:
            found.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    return found


@pytest.fixture
def rows(spark):
    # Every third row has the same value.
    return spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id") * 7919 % 6000).alias("v"))


@pytest.mark.parametrize("falling", [False, True])
def test_ranges_of_files_do_not_overlap(spark, tmp_path, rows, falling):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid_out(rows, [], ["-v" if falling else "v"], files=8).write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = ranges(tmp_path / "t", "v")
    assert len(found) == 8 and sum(n for *_, n in found) == 6000
    pairs = zip(found, found[1:], strict=False)
    assert all(a[0] >= b[1] if falling else a[1] <= b[0] for a, b in pairs)
    # The hot value is several files, as ties go by the rest of the row.
    assert max(n for *_, n in found) < 1500 and sum(a <= 700 <= b for a, b, _ in found) >= 2
    # The first rows are all in one file.
    read = spark.read.parquet(str(tmp_path / "t")).withColumn("file", F.input_file_name())
    first = read.orderBy(F.desc("v") if falling else "v", "id").limit(100)
    assert first.select("file").distinct().count() == 1
    for file in sorted((tmp_path / "t").glob("part-*.parquet")):
        values = pq.read_table(file)["v"].to_pylist()
        assert values == sorted(values, reverse=falling)


def test_folders_are_ordered_by_themselves(spark, tmp_path, rows):
    days = rows.withColumn("day", F.col("id") % 2)
    laid_out(days, ["day"], ["v"], files=6).write.partitionBy("day").parquet(str(tmp_path / "t"))
    for day in (0, 1):
        found = ranges(tmp_path / "t" / f"day={day}", "v")
        assert sum(n for *_, n in found) == 3000
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6000
