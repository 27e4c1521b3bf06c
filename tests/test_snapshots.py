"""Commits over several tables: all or nothing, also for a writer that is lost between two tables."""

import pytest

from lanefold.operators import snapshots
from lanefold.operators.snapshots import Conflict, Snapshots

KEYS = {"fit": ["s", "d"], "size": ["s"]}


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def fits(spark, *rows):
    return frame(spark, list(rows), "s long, d string, a int, b string")


def sizes(spark, *rows):
    return frame(spark, list(rows), "s long, n long")


def told(store, version=None):
    return {t: sorted(map(tuple, r.collect())) if (r := store.read(t, version)) is not None else None for t in KEYS}


@pytest.fixture
def store(spark, tmp_path):
    out = Snapshots(spark, str(tmp_path / "store"), KEYS, 4)
    assert out.commit({"fit": fits(spark, (1, "x", 1, "p"), (2, "x", 2, "q")), "size": sizes(spark, (1, 10))}) == 1
    return out


FIRST = {"fit": [(1, "x", 1, "p"), (2, "x", 2, "q")], "size": [(1, 10)]}


def test_upserts_and_old_versions(spark, store):
    assert told(store) == FIRST
    # only the supplied column changes, also to null; new keys and columns come in
    store.commit({"fit": frame(spark, [(1, "x", None), (3, "y", 9)], "s long, d string, a int"), "size": frame(spark, [(2, 2.5)], "s long, extra double")})
    assert told(store) == {"fit": [(1, "x", None, "p"), (2, "x", 2, "q"), (3, "y", 9, None)], "size": [(1, 10, None), (2, None, 2.5)]}
    assert told(store, 1) == FIRST and store.versions() == [1, 2]
    store.commit({"fit": frame(spark, [(1, "x", None), (3, "y", 9)], "s long, d string, a int")})
    assert told(store) == told(store, 2)  # a rerun gives the same rows
    store.commit({})
    assert told(store) == told(store, 2) and store.read("other") is None


def test_lost_between_two_tables(spark, store, monkeypatch):
    real = Snapshots._staged

    def lost(self, now, table, *rest):
        if table == "size":
            raise RuntimeError("lost")
        return real(self, now, table, *rest)

    change = {"fit": fits(spark, (1, "x", 5, "z")), "size": sizes(spark, (1, 11))}
    monkeypatch.setattr(Snapshots, "_staged", lost)
    with pytest.raises(RuntimeError, match="lost"):
        store.commit(change)
    monkeypatch.undo()
    assert told(Snapshots(spark, store.root, KEYS, 4)) == FIRST
    store.commit(change)
    want = {"fit": [(1, "x", 5, "z"), (2, "x", 2, "q")], "size": [(1, 11)]}
    assert told(store) == want
    assert store.expire(1) >= 1 and store.versions() == [2] and told(store) == want


@pytest.mark.parametrize(("rows", "said"), [([(1, "x", 5, "z", None), (1, "x", 6, "z", None)], "repeated: 1"), ([(None, "x", 5, "z", None)], "without a key: 1"), ([(7, "x", 5, "z", "bad"), (8, "x", 5, "z", "bad")], "with an error: 2")])
def test_rows_that_are_not_valid(spark, store, rows, said):
    bad = frame(spark, rows, "s long, d string, a int, b string, error string")
    with pytest.raises(ValueError, match=said):
        store.commit({"size": sizes(spark, (1, 99)), "fit": bad}, error="error")
    assert told(store) == FIRST and store.versions() == [1]


def test_conflicts(spark, store, monkeypatch):
    store.commit({"size": sizes(spark, (5, 5))}, base=1)
    with pytest.raises(Conflict):
        store.commit({"size": sizes(spark, (6, 6))}, base=1)
    real = Snapshots._staged

    def slow(self, now, table, *rest):
        out = real(self, now, table, *rest)
        monkeypatch.setattr(Snapshots, "_staged", real)
        Snapshots(spark, store.root, KEYS, 4).commit({"size": sizes(spark, (8, 8))})
        return out

    monkeypatch.setattr(Snapshots, "_staged", slow)
    with pytest.raises(Conflict, match="meanwhile"):
        store.commit({"size": sizes(spark, (7, 7))})
    assert told(store)["size"] == [(1, 10), (5, 5), (8, 8)]


def test_stream_batches_compaction_and_empty_tables(spark, store):
    for n, rows in enumerate(([(1, 1)], [(2, 2)], [])):
        store.commit({"size": sizes(spark, *rows)}, stream=("in", n))
    before = told(store)
    assert before["size"] == [(1, 1), (2, 2)]
    assert store.commit({"size": sizes(spark, (1, 77))}, stream=("in", 1)) == 4 and told(store) == before
    assert store.compact() == 5 and told(store) == before
    assert store.expire(1) == 3 and told(store) == before
    with pytest.raises(ValueError, match="no version"):
        store.read("size", 1)
    empty = Snapshots(spark, store.root + "-new", KEYS)
    assert empty.read("size") is None
    empty.commit({"size": sizes(spark)})
    assert empty.read("size").collect() == []
    assert snapshots.Conflict is Conflict
