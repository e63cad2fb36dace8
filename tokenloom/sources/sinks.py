"""Writing: whole tables, keyed batches as they come, logs, and MySQL."""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tokenloom.functions.ids import IdLayout, free_start_ms
from tokenloom.operators.latest import latest_by
from tokenloom.operators.upsert import assert_unique
from tokenloom.settings import delete_folder, exists, shuffles_dropped
from tokenloom.sources.starts import load_start, record_start

#: How many folders become one.
FOLD = 16


def materialize(df: DataFrame, path: str, pk: list[str]) -> DataFrame:
    """Replaces a table by a query result whose key must be unique and not NULL. The result is written
    beside the table and checked there; only a good one takes the table's place."""
    spark, path = df.sparkSession, path.rstrip("/")
    settle(spark, path)
    made = f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(made)
    try:
        assert_unique(spark.read.parquet(made), pk)
    except Exception:
        delete_folder(spark, made)
        raise
    rename(spark, made, f"{path}.next")  # from here on it is the table
    settle(spark, path)
    return spark.read.parquet(path)


def settle(spark: SparkSession, path: str) -> None:
    """Finishes a replacement of ``path`` that was begun, wherever it stopped. Only the writer of a table does this.

    The next table waits under a name of its own until the one before is set aside, so at every moment a complete table is under
    one of the two names.
    """
    following, previous = f"{path}.next", f"{path}.previous"
    if exists(spark, following):
        if exists(spark, path):
            delete_folder(spark, previous)
            rename(spark, path, previous)
        rename(spark, following, path)
    if exists(spark, path):
        delete_folder(spark, previous)


def standing(spark: SparkSession, path: str) -> str | None:
    """The folder a reader finds the table of ``materialize`` in, also between the two moves; None if there never was one."""
    path = path.rstrip("/")
    return next((folder for folder in (path, f"{path}.next") if exists(spark, folder)), None)


def rename(spark: SparkSession, source: str, target: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    files = jvm_path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.rename(jvm_path(source), jvm_path(target)):
        raise OSError(f"{source} could not be moved to {target}")


class KeyedTable:
    """A target table kept as one folder per batch; the newest row of a key counts.

    A batch costs what it holds, not what the table holds. Writing a batch again replaces its own
    folder, so a replay after a failure changes nothing. Deleted keys are rows marked as such.

    Batches are folded as they come: before a batch whose number is a multiple of FOLD**k is written, the FOLD**k batches before it,
    which are closed then, become one folder with the newest row of each key. Reads take the fewest folders that hold
    the batches they want, by number, so they cost about the same however many batches there were. What a fold
    replaces stays until the next fold of its size, for readers that have begun.

    A bulk load opens a new version and publishes it when it is complete; readers and streams stay with the
    published one.
    """

    def __init__(self, spark: SparkSession, path: str, pk: list[str], first_batch: int = 0, version: int | None = None):
        """``first_batch`` is added to batch ids, for a writer that comes after another."""
        self.spark, self.path, self.pk, self.first_batch = spark, path, pk, first_batch
        self.version = _current_version(spark, path) if version is None else version
        self.root = f"{path}/version={self.version}"

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/batch_id={batch_id + self.first_batch}"

    def new_version(self) -> KeyedTable:
        return KeyedTable(self.spark, self.path, self.pk, self.first_batch, self.version + 1)

    def publish(self) -> None:
        """From now on this version is the table. The pointer is a row in a log, so a crash leaves the old one."""
        row = self.spark.range(1).select(F.lit(self.version).cast("bigint").alias("version"))
        row.coalesce(1).write.mode("append").json(f"{self.path}/_current")

    def id_start_ms(self, batch_id: int, layout: IdLayout | None = None) -> int:
        """Where the ids of a batch start: after all ids the table holds. Kept, so a replay starts there again."""
        kept = f"{self.root}/_ids/{batch_id + self.first_batch}"
        found = load_start(self.spark, kept)
        if found is None:
            wanted, earlier = int(time.time() * 1000), self.history()
            found = record_start(self.spark, kept, wanted if earlier is None else free_start_ms(earlier, wanted, layout))
        return found

    def folders(self, start: int, end: int) -> list[str]:
        """The folders that hold the batches from number ``start`` to before ``end``, the largest folds there are."""
        found, at = [], start
        while at < end:
            size = 1
            while at % (size * FOLD) == 0 and at + size * FOLD <= end:
                size *= FOLD
            while size > 1 and not exists(self.spark, self._fold_folder(at, size)):
                size //= FOLD
            folder = self._fold_folder(at, size) if size > 1 else f"{self.root}/batch_id={at}"
            if size > 1 or exists(self.spark, folder):
                found.append(folder)
            at += size
        return found

    def _fold_folder(self, first: int, size: int) -> str:
        return f"{self.root}/_folds/{size}/{first}"

    def _rows_of(self, folders: list[str]) -> DataFrame | None:
        read = self.spark.read.option("mergeSchema", "true")
        single, folds = [f for f in folders if "/_folds/" not in f], [f for f in folders if "/_folds/" in f]
        parts = [read.option("basePath", self.root).parquet(*single)] if single else []
        parts += [self.spark.read.option("mergeSchema", "true").parquet(*folds)] if folds else []
        parts = [part.withColumn("batch_id", F.col("batch_id").cast("bigint")) for part in parts]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def history(self, before: int | None = None) -> DataFrame | None:
        """The rows of all batches, of folded ones the newest of each key, marks of deleted keys among them; None before the first write."""
        end = _next_batch(self.spark, self.root) if before is None else before + self.first_batch
        return self._rows_of(self.folders(0, end))

    def fold(self, number: int) -> None:
        """Folds the closed batches before the batch of that number, as far as it is time to. Done again after a failure, it changes nothing;
        a fold whose turn fell on a batch without a write is made up for."""
        size = FOLD
        while size <= number:
            end = number - number % size
            first, folder = end - size, self._fold_folder(end - size, size)
            inputs = [] if exists(self.spark, folder) else self.folders(first, end)
            if inputs:
                every, made = self._rows_of(inputs), f"{folder}.new-{uuid.uuid4().hex}"
                latest_by(every, self.pk, ["batch_id"], every.columns).write.parquet(made)
                rename(self.spark, made, folder)
            if inputs or end == number:
                self._drop_inputs(first - size, size)
            size *= FOLD

    def _drop_inputs(self, first: int, size: int) -> None:
        """What the fold of ``size`` batches from ``first`` on was made of."""
        if first >= 0 and exists(self.spark, self._fold_folder(first, size)):
            part = size // FOLD
            for at in range(first, first + size, part):
                delete_folder(self.spark, self._fold_folder(at, part) if part > 1 else f"{self.root}/batch_id={at}")

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """``batch`` holds one row per key."""
        self._write(batch.withColumn("row_deleted", F.lit(False)), batch_id)

    def apply(self, batch: DataFrame, deleted_keys: DataFrame, batch_id: int) -> None:
        gone = deleted_keys.select(*self.pk).distinct().join(batch.select(*self.pk), self.pk, "left_anti")
        marked = gone.withColumn("row_deleted", F.lit(True))
        live = batch.withColumn("row_deleted", F.lit(False))
        self._write(live.unionByName(marked, allowMissingColumns=True), batch_id)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        self.fold(batch_id + self.first_batch)
        with shuffles_dropped(self.spark):
            rows.write.mode("overwrite").parquet(self._folder(batch_id))

    def read(self, before: int | None = None, keys: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame | None:
        """Current rows, or None before the first write; ``before`` leaves out that batch and all
        later ones, which is how things stood when it began. With ``keys`` (all or some columns of the key) only their rows are
        looked at: the history is cut to them before anything is grouped. ``columns`` are those wanted besides the key; others do not move."""
        every = self.history(before)
        if every is None:
            return None
        if columns is not None:
            every = every.select(*dict.fromkeys([*self.pk, *columns, "batch_id", "row_deleted"]))
        if keys is not None:
            named = [c for c in self.pk if c in keys.columns]
            every = every.join(keys.select(*named).distinct(), named, "left_semi")
        newest = latest_by(every, self.pk, ["batch_id"], every.columns)
        return newest.filter(~F.col("row_deleted")).select(*[c for c in every.columns if c not in ("batch_id", "row_deleted")])


def _next_batch(spark: SparkSession, root: str) -> int:
    """The number after the last batch written. Folded batches go, so few names are listed."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(jvm_path)] if files.exists(jvm_path) else []
    return max((int(name.split("=")[1]) + 1 for name in names if name.startswith("batch_id=")), default=0)


def _current_version(spark: SparkSession, path: str) -> int:
    try:
        rows = spark.read.schema("version bigint").json(f"{path}/_current")
    except AnalysisException:
        return 0
    return rows.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def write_detail(differences: DataFrame, path: str) -> None:
    differences.write.mode("append").option("sep", "\t").option("header", "false").csv(path)


def mysql_upsert_sql(table: str, columns: list[str], pk: list[str]) -> str:
    """The statement of a batched keyed write; all columns but the key are overwritten."""
    names = ", ".join(f"`{c}`" for c in columns)
    marks = ", ".join("%s" for _ in columns)
    changes = ", ".join(f"`{c}` = VALUES(`{c}`)" for c in columns if c not in pk)
    return f"INSERT INTO `{table}` ({names}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {changes}"


def jdbc_upsert(df: DataFrame, connect, table: str, pk: list[str], rows_per_call: int = 10_000, retries: int = 3) -> None:
    """Keyed writes over a DB-API connection per partition. ``connect`` opens one on an executor.
    A repeated task writes the same rows again, which changes nothing."""
    sql = mysql_upsert_sql(table, df.columns, pk)

    def flush(connection, rows: list[tuple]) -> None:
        for attempt in range(1, retries + 1):
            try:
                cursor = connection.cursor()
                cursor.executemany(sql, rows)
                connection.commit()
                return
            except Exception:
                connection.rollback()
                if attempt == retries:
                    raise

    def write(rows) -> None:
        connection = connect()
        try:
            waiting: list[tuple] = []
            for row in rows:
                waiting.append(tuple(row))
                if len(waiting) >= rows_per_call:
                    flush(connection, waiting)
                    waiting = []
            if waiting:
                flush(connection, waiting)
        finally:
            connection.close()

    df.foreachPartition(write)
