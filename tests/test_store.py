"""Batches over several tables: all or nothing, one of two writers, and what is left of a writer that died."""

from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline.sources.store import Conflict, TableStore, Upsert
from ledgerline.sources.tables import TableSpec

SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType())])


class Dies(Exception):
    pass


@pytest.fixture
def opened(spark, tmp_path):
    return lambda: TableStore(spark, f"file://{tmp_path}/store", [TableSpec(n, SCHEMA, ("k",)) for n in "abcdef"])


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def held(store, name, version=None):
    return sorted((r.k, r.v) for r in store.read(name, version).collect())


def test_a_writer_that_dies_between_tables_changes_nothing(spark, opened):
    store = opened()
    assert store.version() == 0 and held(store, "a") == []
    assert store.commit(0, {n: Upsert(rows(spark, (1, n), (2, None))) for n in "abcdef"}) == 1
    for stop in "af":
        def staged(name, stop=stop):
            if name == stop:
                raise Dies

        with pytest.raises(Dies):
            store.commit(1, {n: Upsert(rows(spark, (1, "new"), (3, "x"))) for n in "abcdef"}, staged)
        fresh = opened()  # another process
        assert fresh.version() == 1 and all(held(fresh, n) == [(1, n), (2, None)] for n in "abcdef")
    assert len(store.clean()) == 2 and store.clean() == []
    assert store.commit(1, {"a": Upsert(rows(spark, (1, "new"), (3, "x")))}) == 2
    assert held(store, "a") == [(1, "new"), (2, None), (3, "x")] and held(store, "b") == [(1, "b"), (2, None)] and held(store, "a", 1) == [(1, "a"), (2, None)]
    assert store.manifest()["tables"]["a"]["rows"] == 3


def test_one_of_two_writers_is_told(spark, opened):
    one, two = opened(), opened()
    one.commit(0, {"a": Upsert(rows(spark, (1, "x")))})
    with pytest.raises(Conflict):
        two.commit(0, {"a": Upsert(rows(spark, (1, "y")))})
    # The other commits while this one is staging: the rename finds its number taken.
    with pytest.raises(Conflict):
        two.commit(1, {"b": Upsert(rows(spark, (1, "late")))}, lambda _: one.commit(1, {"b": Upsert(rows(spark, (1, "first")))}))
    assert held(two, "b") == [(1, "first")] and two.version() == 2


def test_what_a_batch_may_not_do(spark, opened):
    store = opened()
    store.commit(0, {"a": Upsert(rows(spark, (1, "x"), (2, None)))})
    for bad in (rows(spark, (None, "x")), rows(spark, (3, "x"), (3, "y"))):
        with pytest.raises(ValueError, match="key"):
            store.commit(1, {"b": Upsert(rows(spark, (1, "b"))), "a": Upsert(bad)})
    with pytest.raises(ValueError, match="can't change"):
        store.commit(1, {"a": Upsert(rows(spark, (2, "now")), immutable=True)})
    assert store.version() == 1 and held(store, "b") == []
    store.commit(1, {"a": Upsert(rows(spark, (2, None), (5, "z")), immutable=True), "b": Upsert(rows(spark))})
    assert held(store, "a") == [(1, "x"), (2, None), (5, "z")] and held(store, "b") == []
