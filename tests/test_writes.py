"""Writes, checks and the jobs end to end."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tokenloom import jobs
from tokenloom.operators import conform, upsert
from tokenloom.operators.tokenize import HashTokenizer
from tokenloom.plans import outputs, verify
from tokenloom.sources import sinks, tables as src_tables
from tokenloom.sources.schemas import TARGET_KEYS, TARGETS
from tokenloom.sources.sinks import KeyedTable

HASH = HashTokenizer()
KV = "k int, v string"


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    batch = spark.createDataFrame([(2, "B"), (3, "C")], KV)
    once = upsert.upsert_rows(target, batch, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")] == rows(upsert.upsert_rows(once, batch, ["k"]))


def test_keyed_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    assert table.read() is None
    table.upsert(spark.createDataFrame([(1, "a"), (2, "b")], KV), 0)
    table.upsert(spark.createDataFrame([(2, "B")], KV), 1)
    table.upsert(spark.createDataFrame([(2, "B")], KV), 1)
    table.apply(spark.createDataFrame([(3, "c")], KV), spark.createDataFrame([(1,), (3,)], "k int"), 2)
    assert rows(table.read()) == [(2, "B"), (3, "c")]
    assert rows(table.read(before=1)) == [(1, "a"), (2, "b")]
    later = KeyedTable(spark, str(tmp_path / "t"), ["k"], first_batch=3)
    later.upsert(spark.createDataFrame([(2, "late")], KV), 0)
    assert rows(table.read()) == [(2, "late"), (3, "c")]


def test_batches_are_folded_as_they_come(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FOLD", 2)
    table, model = KeyedTable(spark, str(tmp_path / "t"), ["k"], first_batch=1), {}
    schema, dice = "k int, v string", random.Random(2)
    for batch in range(12):
        if batch in (3, 6):
            continue  # a batch without rows of this table
        new, gone = {k: f"{batch}-{k}" for k in dice.sample(range(9), 3)}, dice.sample(range(9), 2)
        before = dict(model)
        for _ in range(2 if batch in (7, 8) else 1):  # a replay
            earlier = table.read(before=batch)
            assert ({} if earlier is None else dict(earlier.collect())) == before
            table.apply(spark.createDataFrame(sorted(new.items()), schema), spark.createDataFrame([(k,) for k in gone], "k int"), batch)
        model = {k: v for k, v in model.items() if k not in gone} | new
        assert dict(table.read().collect()) == model
    assert len(table.folders(0, 12)) <= 3
    left = [f for f in os.listdir(table.root) if f.startswith("batch_id=")]
    assert 0 < len(left) < 6  # what was folded is gone
    # a fold that broke off leaves no table and is done again
    os.makedirs(f"{table.root}/_folds/2/12.new-broken")
    table.upsert(spark.createDataFrame([(1, "last")], schema), 13)
    assert dict(table.read().collect()) == model | {1: "last"}


def test_a_late_batch_reads_as_many_folders_as_an_early_one(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    for number in range(10_000):
        os.makedirs(f"{table.root}/batch_id={number}")
    for size in (16, 256, 4096):
        for first in range(0, 10_000 - size + 1, size):
            os.makedirs(f"{table.root}/_folds/{size}/{first}")
    assert len(table.folders(0, 10)) == len(table.folders(0, 10_000)) == 10
    assert max(len(table.folders(0, n)) for n in range(4090, 4110)) <= 45


def test_a_bulk_load_is_a_new_version(spark, tmp_path):
    """Bulk, stream, bulk again: the second load counts. One that is not published does not."""
    path, one = str(tmp_path / "t"), lambda v: spark.createDataFrame([(1, v)], KV)
    first = KeyedTable(spark, path, ["k"]).new_version()
    first.upsert(one("bulk"), 0)
    assert KeyedTable(spark, path, ["k"]).read() is None
    first.publish()
    KeyedTable(spark, path, ["k"], first_batch=2).upsert(one("stream"), 0)
    assert rows(KeyedTable(spark, path, ["k"]).read()) == [(1, "stream")]
    second = KeyedTable(spark, path, ["k"]).new_version()
    second.upsert(one("again"), 0)
    assert rows(KeyedTable(spark, path, ["k"]).read()) == [(1, "stream")]
    second.publish()
    assert rows(KeyedTable(spark, path, ["k"]).read()) == [(1, "again")]
    keys = spark.createDataFrame([(2,)], "k int")
    assert KeyedTable(spark, path, ["k"]).read(keys=keys).count() == 0


def test_ids_of_batches_never_meet_and_replays_repeat_them(spark, tmp_path):
    from tokenloom.functions.ids import with_snowflake_ids

    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    made = {}
    for batch in (0, 1, 1, 2):  # batch 1 runs twice; more than 1,024 rows a task use up several milliseconds
        keys = spark.range(batch * 5000, batch * 5000 + 5000).withColumnRenamed("id", "k")
        df = with_snowflake_ids(keys, ["k"], table.id_start_ms(batch), partitions=2)
        found = {r.k: r.id for r in df.collect()}
        assert made.setdefault(batch, found) == found
        table.upsert(df, batch)
    every = [i for found in made.values() for i in found.values()]
    assert len(every) == len(set(every)) == 15_000


@pytest.mark.parametrize("data", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_materialize_refuses_bad_keys(spark, tmp_path, data):
    with pytest.raises(ValueError):
        sinks.materialize(spark.createDataFrame(data, KV), str(tmp_path / "m"), ["k"])
    assert sinks.materialize(spark.createDataFrame([(1, "a")], KV), str(tmp_path / "m"), ["k"]).count() == 1
    with pytest.raises(ValueError):  # a bad result leaves the good table as it was
        sinks.materialize(spark.createDataFrame(data, KV), str(tmp_path / "m"), ["k"])
    assert rows(spark.read.parquet(str(tmp_path / "m"))) == [(1, "a")]


def test_mysql_statement():
    sql = sinks.mysql_upsert_sql("loan", ["a", "b", "c"], ["a"])
    assert sql == "INSERT INTO `loan` (`a`, `b`, `c`) VALUES (%s, %s, %s) ON DUPLICATE KEY UPDATE `b` = VALUES(`b`), `c` = VALUES(`c`)"


def test_jdbc_upsert_batches_and_retries(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        import json
        import uuid

        class Connection:
            failed = False

            def cursor(self):
                return self

            def executemany(self, sql, batch):
                if not self.failed:
                    self.failed = True
                    raise OSError("gone away")
                with open(f"{folder}/{uuid.uuid4()}.json", "w") as f:
                    json.dump(batch, f)

            commit = rollback = close = lambda self: None

        return Connection()

    sinks.jdbc_upsert(spark.range(5).coalesce(1), connect, "t", ["id"], rows_per_call=2)
    import json

    batches = [json.load(open(p)) for p in tmp_path.iterdir()]
    assert sorted(len(b) for b in batches) == [1, 2, 2] and sorted(r[0] for b in batches for r in b) == [0, 1, 2, 3, 4]


def test_scan_options():
    options = src_tables.scan_options("jdbc:x", "user", "id", 16, 1, 500_000_000, 1000)
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("id", "16", "500000000")
    with pytest.raises(ValueError):
        src_tables.scan_options("jdbc:x", "user", "id", 0, 1, 2, 3)


def test_detail_log(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.write_detail(spark.createDataFrame([("NEW", 1)], "class string, id int"), path)
    sinks.write_detail(spark.createDataFrame([("LOST", 2)], "class string, id int"), path)
    assert rows(spark.read.option("sep", "\t").csv(path)) == [("LOST", "2"), ("NEW", "1")]


def test_conform_reports_every_rule(spark):
    bad = spark.createDataFrame([("x" * 37, -1, "b", "odd", 5), (None, 1, "c", "mobile", 6)], "id string, app_id int, mapping_id string, type string, event_time bigint")
    found = {(r["column"], r["rule"]): r.cnt for r in conform.violations(conform.conform(bad, "id_mapping"), "id_mapping").collect()}
    assert found == {("id", "not_null"): 1, ("id", "max_chars_36"): 1, ("app_id", "unsigned"): 1, ("type", "allowed"): 1}


@pytest.mark.parametrize("output", ["user", "user_info", "user_product", "id_mapping"])
def test_outputs_fit_their_targets(spark, tables, output):
    made = {
        "user": lambda s: outputs.user_output(s, "all", HASH),
        "user_info": lambda s: outputs.user_info_output(s, "all", HASH),
        "user_product": outputs.product_output,
        "id_mapping": outputs.id_mapping_output,
    }[output](tables[1])
    fitted = conform.conform(made, output)
    assert fitted.columns == [f.name for f in TARGETS[output]]
    assert conform.violations(fitted, output).count() == 0
    assert upsert.key_violations(fitted, TARGET_KEYS[output]).count() == 0


def test_due_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3),)], "t timestamp_ntz")
    assert conform.with_due_dates(df, "t").first()[1:] == (dt.date(2024, 1, 2), dt.date(2024, 1, 2))


def test_every_edge_has_its_mirror(spark, tables):
    edges = outputs.id_mapping_output(tables[1])
    swapped = edges.select(F.col("mapping_id").alias("id"), "app_id", F.col("id").alias("mapping_id"), "event_time")
    forward = edges.select("id", "app_id", "mapping_id", "event_time")
    assert forward.exceptAll(swapped).count() == 0 and forward.count() > 0


def test_count_rules(spark):
    def counts(name, **n):
        return spark.createDataFrame(list(n.items()), f"tbl string, {name} bigint")

    expected, actual = counts("expected_cnt", a=100, b=100, c=100, d=0), counts("actual_cnt", a=90, b=89, c=201, d=0)
    got = {r.tbl: r.result for r in verify.count_check(expected, actual).collect()}
    assert got == {"a": "PASS", "b": "FAIL", "c": "FAIL", "d": "FAIL"}
    lenient = verify.count_check(expected, actual, min_percent=89.0)
    assert {r.tbl for r in lenient.filter("result = 'PASS'").collect()} == {"a", "b", "c"}
    based = verify.count_check(counts("expected_cnt", a=10), counts("actual_cnt", a=110), "baseline_delta", counts("baseline_cnt", a=100))
    assert based.first().result == "PASS"


class OwnTokenizer(HashTokenizer):
    """A tokenizer of the user's own, named on the command line."""


def test_jobs_from_seed_to_change_stream(spark, tables, tmp_path):
    folder, src = tables
    target = str(tmp_path / "target")
    part = src["vt_token_cache"].filter("id % 3 = 0")
    summary = {r.vt_type: r for r in jobs.tokenize(spark, src.using(vt_token_cache=part), f"{target}/vt_token_cache", HASH).collect()}
    assert all(r.remaining == 0 for r in summary.values())
    known = jobs.job_sources(spark, folder, target)  # the dictionary just written, not the source's
    written = known["vt_token_cache"]
    assert written.filter("id IS NULL OR retry_count IS NULL").count() == 0
    assert written.select("id").distinct().count() == written.count() > part.count()
    assert {r["class"] for r in jobs.reconcile(known, HASH, f"{target}/log").collect()} == {"MATCH"}

    start_ms = jobs.bulk(spark, src, target, HASH, ("user", "user_product"))
    users = KeyedTable(spark, f"{target}/user", TARGET_KEYS["user"])
    loaded = rows(users.read())
    assert loaded == rows(outputs.user_output(src, "all", HASH))

    from tests.test_streams import log
    from tokenloom.sources.changes import start_time

    now = start_time(start_ms + 1000, "Africa/Lagos")
    log(spark, ("user", "u", 0, {"id": 11}, {"id": 11})).withColumn("ts", now).write.parquet(f"{target}/changes")
    jobs.follow(spark, lambda: src, f"{target}/changes", target, "user", HASH, None).awaitTermination()
    assert rows(users.read()) == loaded
    assert spark.read.parquet(f"{target}/user/version=1/batch_id=2").count() > 0
    jobs.bulk(spark, src, target, jobs.make_tokenizer("tests.test_writes:OwnTokenizer"), ("user",))
    assert rows(KeyedTable(spark, f"{target}/user", TARGET_KEYS["user"]).read()) == loaded
    assert {r.tbl for r in jobs.check(src).collect()} == {"user", "user_info", "user_bankcard", "application"}
    progress = {r.tbl: r for r in jobs.load_progress(spark, target).collect()}
    assert set(progress) == {"user", "user_product"} and progress["user"].written == len(loaded)
    verdicts = jobs.compare_targets(spark, src, target, HASH)
    assert rows(verdicts) == [("user", 0, 0, "PASS"), ("user_product", 0, 0, "PASS")]
    assert rows(jobs.count_targets(spark, src, target).select("tbl", "result"))[0][0] == "user"
