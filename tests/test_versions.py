import threading

import pytest

from salescast.sources import versions
from salescast.sources.versions import Conflict, current_version, expire, publish, read_published, update


def ids(df):
    return sorted(r.id for r in df.collect())


def test_versions_are_numbered_and_stay_readable(spark, tmp_path):
    root = str(tmp_path / "t")
    assert current_version(spark, root) == 0
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    for n in (1, 2, 3):
        publish(spark.range(n), root)
        assert current_version(spark, root) == n
    assert ids(read_published(spark, root)) == [0, 1, 2] and ids(read_published(spark, root, 1)) == [0]
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, 4)


def test_second_of_two_interleaved_writers_conflicts(spark, tmp_path):
    """Both read version 1; the one that commits later must not overwrite what it has not seen."""
    root = str(tmp_path / "t")
    publish(spark.range(3), root)
    seen = current_version(spark, root)
    first, second = read_published(spark, root, seen).where("id > 0"), read_published(spark, root, seen).where("id < 2")
    publish(first, root, expected=seen)
    with pytest.raises(Conflict):
        publish(second, root, expected=seen)
    assert ids(read_published(spark, root)) == [1, 2] and current_version(spark, root) == 2


def test_commit_between_check_and_commit_conflicts(spark, tmp_path):
    """A writer that passed the first check loses the number while it writes, and leaves nothing behind."""
    root = str(tmp_path / "t")
    publish(spark.range(1), root)

    def change(df):
        publish(spark.range(5), root)
        return df

    with pytest.raises(Conflict):
        update(spark, root, change)
    real = versions.current_version
    try:
        versions.current_version = lambda *a: 1
        with pytest.raises(Conflict, match="another writer"):
            publish(spark.range(9), root, expected=1)
    finally:
        versions.current_version = real
    assert ids(read_published(spark, root)) == [0, 1, 2, 3, 4]
    assert len(list((tmp_path / "t").glob("v-*"))) == 2


def test_updates_of_many_writers_are_all_kept(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.range(0), root)

    def add(n):
        while True:
            try:
                update(spark, root, lambda df: df.union(spark.range(n, n + 1)))
                return
            except Conflict:
                continue

    writers = [threading.Thread(target=add, args=(n,)) for n in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert ids(read_published(spark, root)) == [0, 1, 2, 3] and current_version(spark, root) == 5


def test_retention(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(1, 5):
        publish(spark.range(n), root)
    reader = read_published(spark, root, 3)
    assert expire(spark, root, keep=2) == [1, 2]
    assert len(list((tmp_path / "t").glob("v-*"))) == 2 and ids(reader) == [0, 1, 2]
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, 2)
    publish(spark.range(9), root)
    assert current_version(spark, root) == 5 and expire(spark, root) == [3, 4] and expire(spark, root) == []
    with pytest.raises(ValueError):
        expire(spark, root, keep=0)


def test_unfinished_commit_is_not_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    publish(spark.range(2), root)
    (tmp_path / "t" / versions.VERSIONS / f"{2:020d}").write_text("")
    monkeypatch.setattr(versions, "PATIENCE", 0.3)
    with pytest.raises(TimeoutError):
        read_published(spark, root)
