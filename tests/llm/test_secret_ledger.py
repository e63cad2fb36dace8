"""Secrets against regular expressions of Python, and what the ledger saves."""

import hashlib
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import HARD, frame
from tokenloom.llm import secret_ledger as secrets
from tokenloom.llm.common import Scratch

KEY, HEX = "AKIA" + "A1B2" * 4, "0123456789abcdef" * 2
TEXTS = [
    "password=abc password=abcdef PassWord : 'x1y2z3' tok", f"é漢\U0001f600 {KEY} {KEY}Z AKIAshort {HEX} {HEX[:23]} {HEX.upper()}", f"secret_key=1 secret={HEX}\nsecret ={KEY}",
    'api_key: "abcdef" APIKEY=\'=====\' api__key=abcdefg "token" :  token:abcdef', "passwd\t=abcdef passwd=\tabcdef ſecret=abcdef toKen=abcdef password",
    "x" * 500_000 + f" token={HEX} " + "password=abcdef1 " * 30_000 + "deadbeef" * 60_000, f"ghp_{'a1' * 18} xoxb-{'1' * 12} -----BEGIN RSA PRIVATE KEY----- https://me:pw@host",
    "AKIA" * 50_000, "password" + " " * 200_000 + "=abcdef", "://" + "a" * 200_000 + ":x@ eyJ.eyJ",
]
ROWS = [*HARD, *((100 + k, t, "en", "s", 1) for k, t in enumerate(TEXTS)), (200, TEXTS[0], "fr", "t", 1), (100, TEXTS[0], "en", "s", 1), (None, TEXTS[1], None, None, None)]


def plain(text, rules=secrets.RULES):
    found = []
    for rank, r in enumerate(rules):
        found += [(m.start(), rank, r.kind, m.end()) for m in re.finditer(r.pattern, text or "") if len(m.group(r.group)) >= r.least]
    return sorted(found)


def scanned(spark, monkeypatch):
    """Notes which blobs and rules are scanned."""
    seen, real = [], secrets.scan

    def scan(texts, rules, scratch):
        texts = scratch.keep(texts, "noted")
        seen.extend((r["text"], {t["rule"] for t in r["todo"]}) for r in texts.select("text", "todo").collect())
        return real(texts, rules, scratch)

    monkeypatch.setattr(secrets, "scan", scan)
    return seen


@pytest.mark.parametrize("few", [0, 100_000])
def test_findings_equal_python_expressions(spark, monkeypatch, few):
    monkeypatch.setattr(secrets, "FEW_BLOBS", few)
    scratch = Scratch(spark, "t")
    found = secrets.scan_history(frame(spark, ROWS), secrets.Ledger(spark, scratch.path("ledger")), scratch)
    rows = found.withColumn("listed", secrets.listed("findings")).withColumn("base", secrets.listed("findings", ["assign", "access", "hex"])).collect()
    got = sorted(repr((r["doc"]["doc_id"], [tuple(f) for f in r["findings"]])) for r in rows)
    assert got == sorted(repr((d, plain(t))) for d, t, *_ in ROWS)
    assert sum(len(r["findings"]) > 0 for r in rows) >= 10 and {f["kind"] for r in rows for f in r["findings"]} == {r.kind for r in secrets.RULES}
    by_blob = {hashlib.sha256((t or "").encode()).digest(): plain(t) for _, t, *_ in ROWS}
    for r in rows:
        want = by_blob[bytes(r["blob"])]
        assert r["listed"] == ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert r["base"] == ",".join(f"{k}:{s}:{e}" for s, n, k, e in want if n < 3)
    assert all(r["doc"]["bits"] == "x" for r in rows)


def test_patterns_that_carry_their_least_length_equal_the_checked_ones():
    for short, checked in (("AKIA[A-Z0-9]{16,}", ("AKIA[A-Z0-9]+", 20)), ("[0-9a-f]{24,}", ("[0-9a-f]+", 24))):
        for text in [*TEXTS[:5], "AKIAAKIA" + "B" * 15 + " AKIA" + "B" * 16, "f" * 23 + "g" + "f" * 24]:
            assert [m.span() for m in re.finditer(short, text)] == [m.span() for m in re.finditer(checked[0], text) if len(m[0]) >= checked[1]]


def test_only_unseen_pairs_are_scanned(spark, monkeypatch):
    seen = scanned(spark, monkeypatch)
    ledger = secrets.Ledger(spark, Scratch(spark, "t").path("ledger"))

    def run(rows, rules=secrets.RULES):
        seen.clear()
        found = secrets.scan_history(frame(spark, rows), ledger, Scratch(spark, "t"), rules).collect()
        return sorted(repr((r["doc"]["doc_id"], [tuple(f) for f in r["findings"]])) for r in found)

    want = lambda rows, rules=secrets.RULES: sorted(repr((d, plain(t, rules))) for d, t, *_ in rows)
    first, every = ROWS[:20], {r.kind for r in secrets.RULES}
    assert run(first) == want(first)
    assert sorted(t for t, _ in seen) == sorted({t or "" for _, t, *_ in first}) and all(k == every for _, k in seen)
    assert run(first) == want(first) and not seen
    assert run(ROWS) == want(ROWS)  # copies of known texts under other paths are not read again
    assert {t for t, _ in seen} == {t or "" for _, t, *_ in ROWS} - {t or "" for _, t, *_ in first}
    newer = (*secrets.RULES[:2], replace(secrets.RULES[2], pattern="[0-9a-f]{8,}", version=2), *secrets.RULES[3:])
    assert run(ROWS, newer) == want(ROWS, newer)
    assert {frozenset(k) for _, k in seen} == {frozenset({"hex"})} and len(seen) == len({t or "" for _, t, *_ in ROWS})
    assert run(ROWS) == want(ROWS) and not seen  # the old version of the rule is still known
    assert run(ROWS[:3], secrets.RULES[1:3]) == want(ROWS[:3], secrets.RULES[1:3]) and not seen


def test_a_repeated_append_changes_nothing(spark):
    scratch = Scratch(spark, "t")
    ledger = secrets.Ledger(spark, scratch.path("ledger"))
    first = secrets.scan_history(frame(spark, ROWS[-6:]), ledger, scratch).select("findings").collect()
    ledger.append(scratch.keep(ledger.read(), "again"))
    again = secrets.scan_history(frame(spark, ROWS[-6:]), ledger, Scratch(spark, "t")).select("findings").collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))


def test_a_hot_text_and_no_rows(spark):
    scratch = Scratch(spark, "t")
    ledger = secrets.Ledger(spark, scratch.path("ledger"))
    assert secrets.scan_history(frame(spark, []), ledger, scratch).count() == 0 and ledger.read().count() == 0
    many = spark.range(0, 3000, 1, 6).select("id", F.when(F.col("id") % 3 == 0, "token=abcdef").otherwise(F.concat(F.lit("hex "), F.sha2(F.col("id").cast("string"), 256))).alias("text"))
    found = secrets.scan_history(many, ledger, Scratch(spark, "t"))
    assert found.select(secrets.listed("findings").alias("f")).groupBy("f").count().orderBy("f").collect() == [("assign:0:12", 1000), ("hex:4:68", 2000)]
    assert secrets.scan_history(many.select("text"), ledger, Scratch(spark, "t")).count() == 3000
