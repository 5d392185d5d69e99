import os
import time

import pytest

from __spark_entry__ import queries
from salescast.staging import materialize, scope, scoped_folder, settled, shared_dir
from tests.conftest import SF


def stored(spark):
    root = f"{shared_dir(spark)}/salescast"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


@pytest.mark.parametrize("name", ["label_encode", "median_impute", "sales_lag_fill", "popularity_refresh", "published_daily",
                                  "data_profile", "date_coverage"])
def test_nothing_is_left_after_a_result_is_written(spark, tmp_path, name):
    before, kept = stored(spark), spark.sparkContext._jsc.getPersistentRDDs().size()
    with scope():
        queries()[name](spark, SF).write.parquet(str(tmp_path / name))
    assert spark.read.parquet(str(tmp_path / name)).count() > 0
    assert stored(spark) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_scopes_nest(spark):
    before = stored(spark)
    with scope():
        outer = materialize(spark.range(5).toDF("x"), "outer")
        with scope():
            inner = materialize(outer.where("x > 2"), "inner")
            assert inner.count() == 2 and len(stored(spark) - before) == 2
        assert len(stored(spark) - before) == 1 and outer.count() == 5
        spark.range(1).write.parquet(scoped_folder(spark, "own"))
    assert stored(spark) == before


def test_tables_on_the_way_go_and_the_settled_one_stays(spark):
    before = stored(spark)
    with scope():
        made = settled(spark, "end", lambda: materialize(spark.range(5).toDF("x"), "way").where("x > 1"))
        assert sorted(r.x for r in made.collect()) == [2, 3, 4]
        (left,) = stored(spark) - before
        assert left.startswith("end-")
    assert stored(spark) == before


def test_a_failed_query_leaves_nothing(spark):
    before = stored(spark)
    with pytest.raises(Exception, match="boom"), scope():
        materialize(spark.range(5), "kept")
        materialize(spark.range(5).selectExpr("raise_error('boom')"), "broken")
    assert stored(spark) == before


def test_the_shuffle_of_a_stored_table_goes_with_its_write(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for name in map(str, disk.getAllBlocks().mkString("\n").split("\n")) if name.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(key, "false")
    kept = spark.range(100_000).selectExpr("id % 997 AS k").groupBy("k").count()
    table = materialize(kept, "swept")
    deadline = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < deadline:  # files are removed behind the driver's back
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(key, "false") == setting
    assert table.count() == kept.count() == 997  # the frame itself can be run again


def test_a_stored_table_can_go_before_its_scope_ends(spark):
    from salescast.staging import removed

    before = stored(spark)
    with scope():
        first, second = (materialize(spark.range(5), "early") for _ in range(2))
        assert len(stored(spark) - before) == 2
        removed(first)
        assert len(stored(spark) - before) == 1 and second.count() == 5
    assert stored(spark) == before
