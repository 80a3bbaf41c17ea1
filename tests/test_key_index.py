"""Insert-or-ignore by the key index: what it reads, and what a kill leaves."""

import pytest
from conftest import comments_df

from burstwatch.sources import read_comments, store_comments
from burstwatch.sources.key_index import KeyIndex, folder_names
from burstwatch.sources.tables import comment_log, index_root


def rows(ids, day=0):
    return [(f"c{i}", f"v{i % 3}", "a", f"t{i}", 0.0, 86400 * day + i % 86400) for i in ids]


def stored(spark, path):
    return sorted(r.comment_id for r in read_comments(spark, path).collect())


def test_a_batch_reads_keys_in_proportion_to_itself(spark, tmp_path):
    """A hundred batches are stored; the next one opens a small part of their keys."""
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=256, max_runs=4, keys_per_bucket=100)
    keys = spark.range(0, 20_000).selectExpr("concat('c', id) AS key")
    index.build(keys)
    for b in range(3):
        index.add(spark.range(20_000 + 50 * b, 20_050 + 50 * b).selectExpr("concat('c', id) AS key"), f"t{b}")
    batch = spark.range(19_995, 20_005).selectExpr("concat('c', id) AS key", "id").cache()
    n = index._buckets()
    touched = [r[0] for r in batch.select(index._bucket(batch["key"], n)).distinct().collect()]
    read = spark.read.schema("key string").parquet(*index.paths_for(touched)).count()
    assert read <= 150 + 10 * 3 * 20_000 / 256 < 20_150 / 5  # its buckets and the runs
    assert index.absent(batch, "key").count() == 0
    more = spark.range(20_148, 20_158).selectExpr("concat('c', id) AS key", "id").cache()
    assert sorted(r.id for r in index.absent(more, "key").collect()) == list(range(20_150, 20_158))


def test_runs_move_into_buckets_that_grow(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=4, max_runs=3, keys_per_bucket=20)
    for b in range(7):
        index.add(spark.range(15 * b, 15 * b + 15).selectExpr("concat('k', id) AS key"), f"t{b}")
        assert len(folder_names(spark, f"{index.root}/runs")) < 3
    index.add(spark.range(1000, 1100).selectExpr("concat('k', id) AS key"), "large")
    assert index._buckets() == 16
    all_keys = spark.range(0, 1200).selectExpr("concat('k', id) AS key", "id").cache()
    assert sorted(r.id for r in index.absent(all_keys, "key").collect()) == [*range(105, 1000), *range(1100, 1200)]


def test_a_table_without_an_index_is_indexed_once(spark, tmp_path):
    from burstwatch.sources import write_comments

    path = str(tmp_path / "t")
    write_comments(comments_df(spark, rows(range(5))), path)
    added = store_comments(spark, path, comments_df(spark, rows(range(3, 8))))
    assert sorted(r.comment_id for r in added.collect()) == ["c5", "c6", "c7"]
    assert stored(spark, path) == [f"c{i}" for i in range(8)]


class Killed(Exception):
    pass


@pytest.mark.parametrize("where", ["rows are written", "before the table", "half of the table", "after the table", "before the end"])
def test_a_killed_insert_is_finished_once(spark, tmp_path, monkeypatch, where):
    path = str(tmp_path / "t")
    store_comments(spark, path, comments_df(spark, rows(range(4))))
    log = comment_log(spark, path)
    append = log.append

    def dying(new, token):
        if where == "half of the table":
            append(new.where("comment_id IN ('c4', 'c5')"), token)
        if where in ("after the table", "before the end"):
            append(new, token)
        if where != "before the end":
            raise Killed

    def no_end(keys, token):
        KeyIndex.add(log.index, keys, token)
        raise Killed

    log.append = dying
    if where == "before the end":
        log.index.add = no_end

    def prepare(new):
        if where == "rows are written":
            raise Killed
        return new

    batch = comments_df(spark, rows(range(2, 8)) + rows(range(100, 104), day=3)).cache()
    with pytest.raises(Killed):
        log.insert(batch, prepare)
    store_comments(spark, path, comments_df(spark, rows(range(6, 10))))
    store_comments(spark, path, batch)
    assert stored(spark, path) == sorted([f"c{i}" for i in range(10)] + [f"c{i}" for i in range(100, 104)])
    assert folder_names(spark, f"{index_root(path)}/pending") == []
