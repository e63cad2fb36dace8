"""Secrets in every version of every file, with a ledger of the contents that were scanned before.

A content is addressed by the SHA-256 of its text (a blob). The ledger is a table with a row for each pair of a blob and a rule version that
was scanned, and the spans found. A run hashes the versions at hand, takes the pairs that the ledger lacks, scans one text of each such
blob with the rules it lacks, appends the pairs, and joins the spans of all asked pairs back to every path and version with the blob.
So a text that comes again, under whatever path, is not scanned again, and a new version of one rule scans with that rule alone.

Texts move once, one for each new blob and task, and not at all where a run brings few new blobs. Everything else
that moves is hashes and spans. Built-in functions only.

Defined cases: a null text is an empty one; rows with equal path, version or text are rows of their own and each gets the spans of its text; an
empty table gives no rows and leaves the ledger as it is; other columns are kept, and none of their names can clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import Scratch, bind, join_split, partitions

LEDGER_SCHEMA = "blob binary, rule string, version int, spans array<struct<start: int, end: int>>"
#: Up to so many new blobs (32 bytes each) the versions are cut to them by a broadcast before texts move.
FEW_BLOBS = 100_000


def either_case(word: str) -> str:
    """ASCII letters in either case, spelt out: the flags of regular expression engines differ on other letters."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and apart, whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
#: The kinds that are always reported. A run with a least length needs no check of its own: a shorter run holds no match.
BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Further kinds. Their repeats are bounded or end the match, so no text makes them scan a stretch again and again.
MORE_RULES = (
    Rule("forge", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("login", r"://[^\x20\x09-\x0D/:@]{1,64}:[^\x20\x09-\x0D/@]{1,128}@"),
)
RULES = BASE_RULES + MORE_RULES


class Ledger:
    """The scanned pairs, at a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """A pair may be there twice if a run was repeated; its spans are the same."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def append(self, pairs: DataFrame) -> None:
        pairs.select("blob", "rule", "version", "spans").write.mode("append").parquet(self.path)


def blob_of(text: Column | str) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _asked(rules: Sequence[Rule]) -> Column:
    return F.array(*(F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules))


def unseen(blobs: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, todo): the pairs of rule and version that the ledger lacks for a blob, where there are any."""
    done = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("done"))
    none = F.array().cast("array<struct<rule: string, version: int>>")
    todo = F.array_except(_asked(rules), F.coalesce("done", none))
    return blobs.join(done, "blob", "left").select("blob", todo.alias("todo")).where(F.size("todo") > 0)


def _hits(text: Column, rule: Rule) -> Column:
    """For each match the characters between it and the one before, its own, and whether it counts.

    Cutting a text at a pattern and listing the matches walk over the same matches, so both lists go together.
    """
    pattern, length = F.lit(rule.pattern), lambda a: F.transform(a, F.char_length)
    counted = length(F.regexp_extract_all(text, pattern, F.lit(rule.group)))
    sizes = counted if rule.group == 0 else length(F.regexp_extract_all(text, pattern, F.lit(0)))

    def found(gaps: Column) -> Column:
        def joined(own: Column) -> Column:
            ok = F.transform(counted, lambda n: n >= rule.least) if rule.group else F.transform(own, lambda n: n >= rule.least)
            return F.zip_with(F.zip_with(own, ok, lambda n, good: F.struct(n.alias("size"), good.alias("good"))), F.slice(gaps, F.lit(1), F.size(own)),
                              lambda m, gap: F.struct(F.char_length(gap).alias("gap"), m["size"].alias("size"), m["good"].alias("good")))

        return F.when(F.size(gaps) > 1, bind(sizes, joined)).otherwise(F.array().cast("array<struct<gap: int, size: int, good: boolean>>"))

    return bind(F.split(text, rule.pattern), found)


def scan(texts: DataFrame, rules: Sequence[Rule], scratch: Scratch) -> DataFrame:
    """Ledger rows of ``texts`` (blob, text, todo), one text for each blob.

    Places are running sums over the matches of a text, worked out as rows, so a text with very many matches costs no more per match.
    """
    wanted = lambda r: F.array_contains(F.transform("todo", lambda t: t["rule"]), r.kind)
    each = [F.when(wanted(r), F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), _hits(F.col("text"), r).alias("hits"))) for r in rules]
    scanned = texts.select("blob", F.explode(F.filter(F.array(*each), lambda s: s.isNotNull())).alias("s")).select("blob", "s.*")
    scanned = scratch.keep(scanned, "scanned")
    order = Window.partitionBy("blob", "rule", "version").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = scanned.where(F.size("hits") > 0).select("blob", "rule", "version", F.posexplode("hits").alias("pos", "hit"))
    rows = rows.withColumn("until", F.sum(F.col("hit.gap") + F.col("hit.size")).over(order).cast("int"))
    span = F.when(F.col("hit.good"), F.struct((F.col("until") - F.col("hit.size")).alias("start"), F.col("until").alias("end")))
    found = rows.groupBy("blob", "rule", "version").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = scanned.where(F.size("hits") == 0).select("blob", "rule", "version", F.array().cast("array<struct<start: int, end: int>>").alias("spans"))
    return none.union(found)


def _one_text_each(versions: DataFrame, todo: DataFrame, few: bool) -> DataFrame:
    """(blob, text, todo) with one text for each blob of ``todo``. Copies within a task go before anything moves."""
    texts = versions.select(blob_of("text").alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    if few:
        return texts.join(F.broadcast(todo), "blob").dropDuplicates(["blob"])
    return texts.dropDuplicates(["blob"]).join(todo, "blob")


def scan_history(versions: DataFrame, ledger: Ledger, scratch: Scratch, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Each row of ``versions`` (text and any other columns) as ``doc`` (a struct of the others), with its blob and ``findings``.

    ``findings`` has a (start, rank, kind, end) for each span, by start, then by the order of ``rules``; code points, end exclusive.
    The ledger holds the new pairs afterwards.
    """
    others = [c for c in versions.columns if c != "text"]
    doc = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.struct(F.lit(None).alias("none"))
    rows = scratch.keep(versions.select(doc.alias("doc"), blob_of("text").alias("blob")), "addressed")
    blobs = scratch.keep(rows.groupBy("blob").agg(F.count("*").alias("copies")), "blobs")
    todo = scratch.keep(unseen(blobs.select("blob"), ledger.read(), rules), "todo")
    new = todo.count()
    if new:
        ledger.append(scan(_one_text_each(versions, todo, new <= FEW_BLOBS), rules, scratch))
    return _to_paths(rows, blobs, ledger.read(), rules, partitions(versions.sparkSession))


def _to_paths(rows: DataFrame, blobs: DataFrame, ledger: DataFrame, rules: Sequence[Rule], n: int) -> DataFrame:
    """Findings joined to all rows with the blob."""
    kinds = F.create_map(*(x for k, r in enumerate(rules) for x in (F.concat_ws(":", F.lit(r.kind), F.lit(r.version)), F.lit(k))))
    asked = ledger.where(F.size("spans") > 0).select("blob", kinds[F.concat_ws(":", "rule", "version")].alias("rank"), "rule", F.explode("spans").alias("span"))
    finding = F.struct(F.col("span.start").alias("start"), "rank", F.col("rule").alias("kind"), F.col("span.end").alias("end"))
    found = asked.where("rank IS NOT NULL").groupBy("blob").agg(F.sort_array(F.collect_set(finding)).alias("findings"))
    none = F.array().cast("array<struct<start: int, rank: int, kind: string, end: int>>")
    return join_split(rows, found, ["blob"], blobs, n).select("doc", "blob", F.coalesce("findings", none).alias("findings"))


def listed(findings: Column | str, kinds: Sequence[str] | None = None) -> Column:
    """Findings as text: kind:start:end, joined by commas; of some kinds only if these are given."""
    findings = F.col(findings) if isinstance(findings, str) else findings
    if kinds is not None:
        findings = F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def count_of(findings: str, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")
