"""What queries leave on disk while they run, and when they are done."""

import os

from pyspark.sql import functions as F

from catalog import queries
from tokenloom.settings import Workspace, shared_folder
from tokenloom.sources.schemas import TARGET_KEYS


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def workspaces(spark):
    folder = shared_folder(spark)
    return {name for name in os.listdir(folder) if name.startswith("work-")} if os.path.isdir(folder) else set()


def test_kept_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    with Workspace(spark) as work:
        kept = work.keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
        assert not shuffle_files(spark) - before
        assert kept.agg(F.sum("count")).first()[0] == 1000


def test_rebuild_summary_holds_one_output_at_a_time(spark, monkeypatch):
    """Tables of an output that was compared, and what its rebuild kept on the way, are gone before the next one."""
    before, seen = workspaces(spark), []

    def rows(output, n):
        return spark.range(n).select(*[F.col("id").cast("string").alias(k) for k in TARGET_KEYS[output]])

    def again(c, output, keep=None):
        return (keep or Workspace(spark).keep)(rows(output, 6))

    compare = queries.digests.digest_differences

    def watched(*given):
        seen.append(len(workspaces(spark) - before))
        return compare(*given)

    monkeypatch.setattr(queries, "_all_rows", again)
    monkeypatch.setattr(queries, "_bulk_rows", lambda c, output: rows(output, 5 if output == "loan" else 6))
    monkeypatch.setattr(queries.digests, "digest_differences", watched)
    found = queries._rebuild_summary(type("C", (), {"spark": spark}))
    assert {(r.tbl, r.only_left, r.only_right, r.result) for r in found.collect()} == {
        *((t, 0, 0, "PASS") for t in ("user", "user_bankcard", "user_product", "application")), ("loan", 0, 1, "FAIL")
    }
    assert seen == [1] * 5 and workspaces(spark) == before


def test_counts_of_stored_outputs_hold_one_table_at_a_time(spark, monkeypatch):
    """Seven tables are written; each is counted, by its keys alone, and gone before the next one."""
    before, seen, moved = workspaces(spark), [], []

    def rows(output, low, high):
        keys = [F.col("id").cast("string").alias(k) for k in TARGET_KEYS[output]]
        return spark.range(low, high).select(*keys, F.lit("wide").alias("other"))

    def phased(output):
        return lambda src, phase="hit", tokenizer=None: rows(output, 0, 4) if phase == "hit" else rows(output, 3, 9)

    made = {"user": "user_output", "user_info": "user_info_output", "user_bankcard": "bankcard_rows", "application": "application_output"}
    for output, function in made.items():
        monkeypatch.setattr(queries.outputs, function, phased(output))
    for output, function in {"user_product": "product_output", "loan": "loan_output", "id_mapping": "id_mapping_output"}.items():
        monkeypatch.setattr(queries.outputs, function, lambda src, output=output: rows(output, 0, 7))
    count = queries.verify.table_counts

    def counted(tables, name):
        seen.append(len(workspaces(spark) - before))
        moved.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in tables.values())
        return count(tables, name)

    monkeypatch.setattr(queries.verify, "table_counts", counted)
    found = queries._progress_written(type("C", (), {"spark": spark, "src": None}))
    assert {(r.tbl, r.expected_cnt, r.actual_cnt, r.delta) for r in found.collect()} == {
        *((t, 9, 10, 6) for t in made), *((t, 7, 7, 0) for t in ("user_product", "loan", "id_mapping"))
    }
    assert seen == [1] * 7 and workspaces(spark) == before
    assert not any("other" in plan.split("Relation")[0] for plan in moved)
