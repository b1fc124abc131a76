"""The file tree is written by many tasks."""

from pyspark.sql import DataFrameWriter

from registered import queries as registered


def test_page_files_are_written_by_all_cores(spark, monkeypatch):
    parts, write = [], DataFrameWriter.text
    monkeypatch.setattr(
        DataFrameWriter,
        "text",
        lambda self, *a, **b: parts.append(self._df.rdd.getNumPartitions()) or write(self, *a, **b),
    )
    registered.file_tree(spark, "/root/testdata/sf0.001")
    assert parts[0] >= spark.sparkContext.defaultParallelism
