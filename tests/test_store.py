import pytest
from pyspark.sql import functions as F

from kinmart.sources.store import ConcurrentCommitError, TableStore
from kinmart.workspace import shared_dir, stage


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/store")


def values(df):
    return sorted(row[0] for row in df.collect())


def numbers(spark, *given):
    return spark.createDataFrame([(n,) for n in given], "n int")


def test_a_rebuild_replaces_a_table(spark, store):
    assert list(store) == [] and "a" not in store
    store.write("a", numbers(spark, 1, 2))
    store.write("a", numbers(spark, 3))
    assert values(store["a"]) == [3] and list(store) == ["a"]


def test_a_failed_run_leaves_the_last_good_output(spark, store):
    store.write("a", numbers(spark, 1))
    with pytest.raises(RuntimeError, match="late failure"):
        with store.transaction() as work:
            work.write("a", numbers(spark, 2))
            assert values(work["a"]) == [2] and values(store["a"]) == [1]
            raise RuntimeError("late failure")
    assert values(store["a"]) == [1]
    assert len(store.stale()) == 1


def test_a_failed_write_leaves_the_last_good_output(spark, store):
    store.write("a", numbers(spark, 1))
    broken = spark.range(4).select(F.raise_error(F.lit("bad row")).cast("int").alias("n"))
    with pytest.raises(Exception, match="bad row"):
        store.write("a", broken)
    assert values(store["a"]) == [1]


def test_tables_change_together(spark, store):
    with store.transaction() as work:
        work.write("a", numbers(spark, 1))
        assert "a" not in store
        work.write("b", numbers(spark, 2))
    assert sorted(store) == ["a", "b"]


def test_a_table_may_be_rebuilt_from_itself(spark, store):
    store.write("a", numbers(spark, 1))
    store.write("a", store["a"].select(F.col("n") + 1))
    assert store["a"].first()[0] == 2


def test_readers_keep_the_version_they_opened(spark, store):
    store.write("a", numbers(spark, 1))
    opened = store["a"]
    store.write("a", numbers(spark, 2))
    assert values(opened) == [1]


def test_pruning_removes_only_stale_versions(spark, store):
    for n in range(4):
        store.write("a", numbers(spark, n))
    store.write("b", numbers(spark, 9))
    assert store.prune(keep=3) == 2
    assert values(store["a"]) == [3] and values(store["b"]) == [9]
    assert store.prune() == 1 and store.prune() == 0
    assert values(store["a"]) == [3]


def test_two_writers_do_not_overwrite_each_other(spark, store):
    with pytest.raises(ConcurrentCommitError):
        with store.transaction() as slow:
            slow.write("a", numbers(spark, 1))
            store.write("b", numbers(spark, 2))
    assert list(store) == ["b"]


def test_same_input_gives_the_same_table(spark, store):
    store.write("a", numbers(spark, 3, 1, 2))
    first = values(store["a"])
    store.write("a", numbers(spark, 3, 1, 2))
    assert values(store["a"]) == first


def test_staging_uses_the_shared_folder_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(named.rstrip("/"))
    staged = stage(numbers(spark, 1), "numbers")
    assert values(staged) == [1] and staged.inputFiles()[0].startswith(named)


def test_rows_say_when_they_were_loaded(spark, store):
    first = store.write("a", numbers(spark, 1)).first()
    again = store.write("b", store["a"]).first()
    assert first.loaded_at is not None and again.loaded_at == first.loaded_at
    assert store.write("a", numbers(spark, 1)).first().loaded_at > first.loaded_at
