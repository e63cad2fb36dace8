"""Command line: ``python -m tokenloom.jobs bulk|tokenize|reconcile|incr|verify|layout``."""

from __future__ import annotations

import argparse
import importlib
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.codes import VT_TYPES
from tokenloom.operators.dictionary import seed_dictionary, with_next_ids
from tokenloom.operators.tokenize import (
    HashTokenizer,
    Tokenizer,
    difference_rows,
    ended_counts,
    found_counts,
    preload,
    progress_stats,
    reconcile_dictionary,
    reconcile_summary,
    summary_of,
)
from tokenloom.plans import outputs, verify
from tokenloom.plans.assemble import assemble_application, assemble_bankcard, assemble_user, assemble_user_info
from tokenloom.plans.digests import difference_summary, digest_differences
from tokenloom.plans.edges import LINK_KEY
from tokenloom.settings import Workspace, checkpointed, exists, tune
from tokenloom.sources.changes import scan_changes
from tokenloom.sources.keyed import is_keyed, keyed_sources, write_keyed
from tokenloom.sources.observed import CountsWritten, RowsWritten
from tokenloom.sources.observed import CountsWritten, RowsWritten
from tokenloom.sources.schemas import SOURCE_SCHEMAS, TARGET_KEYS
from tokenloom.sources.sinks import KeyedTable, materialize, standing, write_detail
from tokenloom.sources.tables import Sources, parquet_sources, typed_view
from tokenloom.streaming.handoff import record_start, start_position
from tokenloom.streaming.enqueue import WAIT_SECONDS
from tokenloom.streaming.links import LINK_TABLES, LinkJob, load_links
from tokenloom.streaming.rebuild import ProfileJob, RebuildJob, start
from tokenloom.streaming.triggers import TRIGGER_TABLES

BULK_BATCHES = 2
# The order in which a full run writes the outputs.
OUTPUTS = ("user", "user_info", "user_bankcard", "user_product", "application", "loan", "id_mapping")


def bulk(spark: SparkSession, sources: Sources, target: str, tokenizer: Tokenizer, names=OUTPUTS) -> int:
    """Writes a new version of every output, first the rows with tokens, then those that need some."""
    start_ms = int(time.time() * 1000)
    for name in names:
        table = KeyedTable(spark, f"{target}/{name}", TARGET_KEYS[name])
        before, table = table, table.new_version()
        if name in ("user_product", "loan"):
            make = outputs.product_output if name == "user_product" else outputs.loan_output
            _counted_upsert(target, name, table, 0, lambda: make(sources))
        elif name == "id_mapping":
            load_links(sources, link_table(spark, target, table), table)
        else:
            for batch_id, phase in enumerate(("hit", "miss")):
                ids = _id_start(before, table, batch_id) if name == "user_bankcard" else start_ms
                _counted_upsert(target, name, table, batch_id, lambda: _phase_rows(name, sources, phase, tokenizer, ids))
        record_start(spark, f"{target}/_start/{name}", start_ms)
        table.publish()
    return start_ms


PROGRESS = "tbl string, version bigint, batch bigint, written bigint, seconds double"


def _counted_upsert(target: str, name: str, table: KeyedTable, batch_id: int, make) -> None:
    """One phase of a load, and a line on what it wrote and how long that took. The count comes from the write."""
    began, rows = time.time(), RowsWritten()
    table.upsert(rows.watch(make()), batch_id)
    line = [(name, table.version, batch_id, rows.count, time.time() - began)]
    table.spark.createDataFrame(line, PROGRESS).coalesce(1).write.mode("append").json(f"{target}/_progress/{name}")


def load_progress(spark: SparkSession, target: str, names=OUTPUTS):
    """Rows written and rows per minute of each output's last load; outputs that no counted load wrote are left out."""
    folders = [folder for folder in (f"{target}/_progress/{name}" for name in names) if exists(spark, folder)]
    if not folders:
        return None
    lines = spark.read.schema(PROGRESS).json(folders)
    last = lines.groupBy("tbl").agg(F.max("version").alias("version"))
    totals = lines.join(last, ["tbl", "version"], "left_semi").groupBy("tbl").agg(F.sum("written").alias("written"), F.sum("seconds").alias("seconds"))
    return totals.select("tbl", "written", F.round(F.col("written") * 60 / F.greatest("seconds", F.lit(0.001)), 1).alias("rate_per_min"))


def link_table(spark: SparkSession, target: str, table: KeyedTable) -> KeyedTable:
    """What the edges of a version of ``table`` rest on."""
    return KeyedTable(spark, f"{target}/_links", LINK_KEY, first_batch=table.first_batch, version=table.version)


def _id_start(before: KeyedTable, table: KeyedTable, batch_id: int) -> int:
    """Ids of a new version come after those of the one before, and those of the second phase after the first's."""
    return max(before.id_start_ms(1 << 30), table.id_start_ms(batch_id))


def _phase_rows(name: str, sources: Sources, phase: str, tokenizer: Tokenizer, start_ms: int):
    if name == "user":
        return outputs.user_output(sources, phase, tokenizer)
    if name == "user_info":
        return outputs.user_info_output(sources, phase, tokenizer)
    if name == "application":
        return outputs.application_output(sources, phase, tokenizer)
    return outputs.bankcard_output(sources, start_ms, phase, tokenizer)


def tokenize(spark: SparkSession, sources: Sources, path: str, tokenizer: Tokenizer, retry_failed: bool = False):
    """Seeds the dictionary, tokenises its open rows, and writes it as a new version at ``path``."""
    stored = sources["vt_token_cache"]
    with Workspace(spark) as work:
        new = with_next_ids(work.keep(seed_dictionary(sources, stored)), stored, work.keep)
        return _tokenize(work, stored, new, path, tokenizer, retry_failed)


def _tokenize(work: Workspace, stored, new, path: str, tokenizer: Tokenizer, retry_failed: bool):
    """The counts come from the writes themselves."""
    found, ended = [CountsWritten("vt_type", VT_TYPES.values(), counts) for counts in (found_counts(), ended_counts())]
    seeded = work.keep(found.watch(stored.unionByName(new, allowMissingColumns=True)))
    began = time.time()
    materialize(ended.watch(preload(seeded, tokenizer, retry_failed)), path, ["vt_type", "raw_value"])
    return progress_stats(summary_of(found.rows(work.spark), ended.rows(work.spark)), time.time() - began)


def reconcile(sources: Sources, tokenizer: Tokenizer, log: str):
    compared = checkpointed(reconcile_dictionary(sources["vt_token_cache"], tokenizer))
    write_detail(difference_rows(compared), log)
    return reconcile_summary(compared)


def follow(spark: SparkSession, sources_now, changes: str, target: str, name: str, tokenizer: Tokenizer, interval: str | None):
    """Follows changes from where the bulk load began. Profiles go through the debounced queue.

    Batch numbers of the stream come after those of the bulk load, which are 0 and 1.
    """
    mode, start_ms = start_position(spark, f"{target}/_start/{name}")
    tables = {"user_info": list(WAIT_SECONDS), "id_mapping": LINK_TABLES}.get(name) or TRIGGER_TABLES[name]
    stream = scan_changes(spark, changes, tables, mode, start_ms)
    table = KeyedTable(spark, f"{target}/{name}", TARGET_KEYS[name], first_batch=BULK_BATCHES)
    if name == "user_info":
        queue = KeyedTable(spark, f"{target}/_queue", ["user_id"], version=table.version)
        job = ProfileJob(sources_now, table, queue, tokenizer)
    elif name == "id_mapping":
        job = LinkJob(sources_now, table, link_table(spark, target, table))
    else:
        job = RebuildJob(name, sources_now, table, tokenizer)
    # the checkpoint belongs to the table it feeds: another target or a new bulk load begins anew
    return start(job, stream, f"{target}/_checkpoints/{name}/version={table.version}", interval)


def rebuilt(name: str, sources: Sources, tokenizer: Tokenizer):
    """All rows of an output as the tables give them now; cards without an id."""
    made = {
        "user": lambda: outputs.user_output(sources, "all", tokenizer),
        "user_info": lambda: outputs.user_info_output(sources, "all", tokenizer),
        "user_bankcard": lambda: outputs.bankcard_rows(sources, "all", tokenizer),
        "user_product": lambda: outputs.product_output(sources),
        "application": lambda: outputs.application_output(sources, "all", tokenizer),
        "loan": lambda: outputs.loan_output(sources),
        "id_mapping": lambda: outputs.id_mapping_output(sources),
    }
    return made[name]()


def compare_targets(spark: SparkSession, sources: Sources, target: str, tokenizer: Tokenizer, names=OUTPUTS):
    """One line for each output that was written: how many of its rows differ from what the tables give now, every column compared.
    The differing rows themselves are under ``_differences``."""
    lines = []
    for name in names:
        stored = KeyedTable(spark, f"{target}/{name}", TARGET_KEYS[name]).read()
        if stored is None:
            continue
        with Workspace(spark) as work:
            expected = work.keep(rebuilt(name, sources, tokenizer))
            found = work.keep(digest_differences(work, work.keep(stored.select(*expected.columns)), expected, TARGET_KEYS[name]))
            found.write.mode("overwrite").parquet(f"{target}/_differences/{name}")
            lines += difference_summary(found, name).collect()  # one row
    return spark.createDataFrame([tuple(line) for line in lines], "tbl string, only_stored bigint, only_expected bigint, result string")


def count_targets(spark: SparkSession, sources: Sources, target: str, names=("user", "user_bankcard", "loan")):
    """Rows expected of the first phase against rows stored."""
    expected = {"user": outputs.user_output, "user_bankcard": outputs.bankcard_rows, "loan": outputs.loan_output}
    stored = {name: KeyedTable(spark, f"{target}/{name}", TARGET_KEYS[name]).read() for name in names}
    stored = {name: df for name, df in stored.items() if df is not None}
    if not stored:
        return None
    wanted = verify.table_counts({name: expected[name](sources) for name in stored}, "expected_cnt")
    return verify.count_check(wanted, verify.table_counts(stored, "actual_cnt"))


def reports(spark: SparkSession, sources: Sources, target: str, tokenizer: Tokenizer) -> dict:
    """What the verify job shows. Profiles are compared with a rebuild's expectation, all outputs with the tables as they are now."""
    bundle, wide = verify.incremental_bundle(sources), assemble_user_info(sources)
    found = {
        "phases": check(sources),
        "staging against bundle": verify.staging_vs_bundle(wide, bundle),
        "filtered by the sink": verify.sink_filtered_count(bundle),
        "without a token": verify.missing_token_report(assemble_user(sources), assemble_bankcard(sources), wide, assemble_application(sources)),
        "counts": count_targets(spark, sources, target),
        "progress of the last load": load_progress(spark, target),
        "targets against a rebuild": compare_targets(spark, sources, target, tokenizer),
    }
    profiles = KeyedTable(spark, f"{target}/user_info", TARGET_KEYS["user_info"]).read()
    if profiles is not None:
        found["profiles"] = verify.compare_summary(verify.compare_with_target(bundle, profiles))
    return {name: df for name, df in found.items() if df is not None}


def check(sources: Sources):
    wide = {
        "user": assemble_user(sources),
        "user_info": assemble_user_info(sources),
        "user_bankcard": assemble_bankcard(sources),
        "application": assemble_application(sources),
    }
    return verify.phase_counts(wide)


def job_sources(spark: SparkSession, source: str, target: str) -> Sources:
    """The tables under ``source`` with the dictionary that the tokenize job wrote, else the source's own, else an empty one."""
    sources = (keyed_sources if is_keyed(spark, source) else parquet_sources)(spark, source)
    written = standing(spark, f"{target}/vt_token_cache")
    if written is not None:
        return sources.using(vt_token_cache=typed_view(spark.read.parquet(written), SOURCE_SCHEMAS["vt_token_cache"]))
    given = f"{source}/vt_token_cache"
    if exists(spark, given):
        if is_keyed(spark, source):
            return sources
        return sources.using(vt_token_cache=typed_view(spark.read.parquet(given), SOURCE_SCHEMAS["vt_token_cache"]))
    return sources.using(vt_token_cache=spark.createDataFrame([], SOURCE_SCHEMAS["vt_token_cache"]))


def make_tokenizer(name: str) -> Tokenizer:
    """The tokenizer class named ``module:Class``; the hash takes its key from TOKENLOOM_HASH_KEY."""
    module, _, kind = name.partition(":")
    found = getattr(importlib.import_module(module), kind)
    return found(os.environ["TOKENLOOM_HASH_KEY"]) if found is HashTokenizer else found()


def main() -> None:
    parser = argparse.ArgumentParser(prog="tokenloom")
    parser.add_argument("job", choices=["bulk", "tokenize", "reconcile", "incr", "verify", "layout"])
    parser.add_argument("--source", required=True, help="folder with one parquet table per source table")
    parser.add_argument("--target", required=True)
    parser.add_argument("--changes", help="folder of change files (incr)")
    parser.add_argument("--output", choices=OUTPUTS, help="output to follow (incr)")
    parser.add_argument("--interval", default="5 seconds")
    parser.add_argument("--tokenizer", default="tokenloom.operators.tokenize:HashTokenizer", help="module:Class, made without arguments")
    args = parser.parse_args()

    spark = tune(SparkSession.builder.appName(f"tokenloom-{args.job}").getOrCreate())
    tokenizer = make_tokenizer(args.tokenizer)

    def sources_now() -> Sources:
        return job_sources(spark, args.source, args.target)

    if args.job == "bulk":
        bulk(spark, sources_now(), args.target, tokenizer)
    elif args.job == "tokenize":
        tokenize(spark, sources_now(), f"{args.target}/vt_token_cache", tokenizer).show()
    elif args.job == "reconcile":
        reconcile(sources_now(), tokenizer, f"{args.target}/reconcile_log").show()
    elif args.job == "layout":
        write_keyed(parquet_sources(spark, args.source), args.target)  # the other jobs may take it as their source
    elif args.job == "verify":
        for title, report in reports(spark, sources_now(), args.target, tokenizer).items():
            print(title)
            report.show(truncate=False)
    else:
        follow(spark, sources_now, args.changes, args.target, args.output, tokenizer, args.interval).awaitTermination()


if __name__ == "__main__":
    main()
