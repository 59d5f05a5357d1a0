"""Shared-folder helpers: staged copies, and sources that change."""

import os

import pytest

from linfold.session import remove_path, shared_dir, stage_parquet
from linfold.sources.fixtures import embed_text_points


def test_stage_parquet_round_trip_and_remove(spark):
    df = spark.range(20).selectExpr("id", "id * 2.0 AS v")
    staged, path = stage_parquet(df, "t-stage")
    assert sorted(r.v for r in staged.collect()) == [2.0 * i for i in range(20)]
    remove_path(spark, path)
    assert not os.path.exists(path.replace("file:", ""))


def test_text_points_follow_their_source(spark, tmp_path):
    """Rows appended below a partition folder are read by the next call."""
    table = str(tmp_path / "embeddings.parquet")

    def add(first, n):
        spark.range(first, first + n).selectExpr(
            "id AS vec_id", "transform(sequence(1, 64), k -> CAST(id + k AS FLOAT)) AS embedding",
            "CAST(id % 10 AS INT) AS label", "1 AS p").write.mode("append").partitionBy("p").parquet(table)

    add(0, 5)
    assert embed_text_points(spark, str(tmp_path)).count() == 5
    add(5, 99)
    assert embed_text_points(spark, str(tmp_path)).count() == 104


def test_no_private_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
