"""Point reads of keyed tables: the same rows, from the buckets of the keys alone."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tokenloom.operators.tokenize import HashTokenizer
from tokenloom.plans import outputs
from tokenloom.settings import Workspace
from tokenloom.sources.keyed import BUCKET, LOOKED_UP_BY, is_keyed, keyed_sources, only, write_keyed
from tokenloom.streaming import rebuild

HASH = HashTokenizer()


@pytest.fixture(scope="module")
def keyed(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("keyed"))
    write_keyed(tables[1], folder, 32)
    assert is_keyed(spark, folder) and not is_keyed(spark, tables[0])
    return keyed_sources(spark, folder)


def files_read(df):
    """How many files the scans of a plan read, after it ran."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            found.append((node.toString(), node.metrics().get("numFiles").get().value()))
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_all_rows_are_there(tables, keyed):
    for name, df in tables[1].items():
        assert rows(keyed[name].drop(BUCKET)) == rows(df), name


@pytest.mark.parametrize("name", ["user", "user_order", "user_repay", "vt_token_cache"])
def test_lookups_read_the_buckets_of_their_keys(spark, tables, keyed, name):
    key = LOOKED_UP_BY[name]
    with Workspace(spark) as work:
        keys = work.keep(tables[1][name].select(key).dropna().distinct().orderBy(key).limit(2).union(tables[1][name].select(key).limit(0)))
        found = only(keyed[name], key, keys)
        read = [n for text, n in files_read(found) if BUCKET in text and "dynamicpruning" in text]
        assert read and max(read) <= 2
        assert rows(found) == rows(only(tables[1][name], key, keys))
        assert BUCKET not in found.columns


def test_lookups_by_another_column_read_all(spark, tables, keyed):
    keys = spark.createDataFrame([("dev-3",)], "device_id string")
    assert rows(only(keyed["user"], "device_id", keys)) == rows(only(tables[1]["user"], "device_id", keys))


def test_a_rebuild_from_keyed_tables_equals_the_bulk_load(spark, tables, keyed):
    ids = spark.createDataFrame([(i,) for i in range(1, 900, 97)], "order_id bigint")
    found = rows(rebuild.rebuild_rows("application", ids, keyed, HASH))
    assert found and found == rows(rebuild.rebuild_rows("application", ids, tables[1], HASH))
    users = spark.createDataFrame([(7,), (21,), (22,)], "user_id bigint")
    assert rows(rebuild.rebuild_rows("user_info", users, keyed, HASH)) == rows(rebuild.rebuild_rows("user_info", users, tables[1], HASH))


def test_bulk_outputs_ignore_the_bucket(tables, keyed):
    assert rows(outputs.loan_output(keyed)) == rows(outputs.loan_output(tables[1]))
    assert rows(outputs.id_mapping_output(keyed)) == rows(outputs.id_mapping_output(tables[1]))
    assert keyed["user"].filter(F.col(BUCKET).isNull()).count() == 0
