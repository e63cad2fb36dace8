"""Quality rules as a ledger of bits: every rule is evaluated once, policies are applied to the bits.

``ledger`` gives each document its measurements and ``bits``: bit k is set where rule k fails. A policy is a
version with the rules that reject; ``apply_policy`` tests a mask, and ``ablation`` counts by bitwise aggregation what each rule
rejects alone, without touching a text again. Built-in functions only.

Defined cases: a null or empty text has no words and fails the rules on too little text; rows with equal doc_id are
judged one by one; an empty table gives no rows; other columns are kept by ``ledger``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import SPACES, bind, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: The rules in the order of their bits: (name, condition of failure over the measurements).
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("few_letters", "10 * n_letters < 6 * word_chars"),
    ("shouting", "10 * n_capitals > 5 * n_letters and n_letters > 0"),
)
BASE_RULES = ("too_few_words", "repeated_windows")

#: Policies by version: the names of the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE_RULES,
    "v2": ("too_few_words", "repeated_windows", "short_words", "long_words", "symbols", "repeated_lines", "few_letters", "shouting"),
}


def repeated_words(tokens: Column) -> Column:
    """How many words lie in windows of five words that occur twice or more in the text."""
    none = F.lit(0).cast("long")

    def hashes(t: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(t) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(t, i + k) for k in range(WINDOW))))

    def marked(pairs: Column) -> Column:  # places of windows that equal a neighbour in the sorted array
        equal = lambda p, other: F.coalesce(other["h"] == p["h"], F.lit(False))
        same = F.filter(pairs, lambda p, k: equal(p, F.get(pairs, k - 1)) | equal(p, F.get(pairs, k + 1)))
        return F.transform(same, lambda p: p["i"])

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), p - F.coalesce(F.get(places, k - 1), F.lit(-WINDOW))))
        return F.aggregate(gaps, none, lambda a, b: a + b)

    def count(h: Column) -> Column:  # most texts repeat no window, which a set tells without sorting
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(
            bind(pairs, lambda p: bind(F.sort_array(marked(p)), covered))
        )

    return bind(tokens, lambda t: F.when(F.size(t) < WINDOW + 1, none).otherwise(bind(hashes(t), count)))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements that the rules read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    count = lambda c: F.char_length(c).cast("long")
    return (
        docs.withColumn("_words", words(F.col("text")))
        .withColumn("_lines", lines)
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": count(F.array_join("_words", "")),
                "n_symbols": count(text) - count(F.translate(text, SYMBOLS, "")),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": repeated_words(F.col("_words")),
                "n_letters": count(F.regexp_replace(text, r"\P{L}+", "")),
                "n_capitals": count(F.regexp_replace(text, r"\P{Lu}+", "")),
            }
        )
        .drop("_words", "_lines")
    )


def mask_of(names: tuple[str, ...]) -> int:
    known = [name for name, _ in RULES]
    return sum(1 << known.index(name) for name in names)


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements and ``bits``, a long with a bit for each rule that fails."""
    bits = sum((F.when(F.expr(fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, fails) in enumerate(RULES)), F.lit(0).cast("long"))
    return measure(docs).withColumn("bits", bits)


def apply_policy(marked: DataFrame, version: str = "v2") -> DataFrame:
    """``marked`` with ``kept``: no rule of the policy fails."""
    return marked.withColumn("kept", F.col("bits").bitwiseAND(F.lit(mask_of(POLICIES[version]))) == 0)


def ablation(marked: DataFrame, version: str = "v2") -> DataFrame:
    """For each rule of a policy: texts that fail it, and texts that only it rejects. One pass over the bits."""
    mask = mask_of(POLICIES[version])
    hit = F.col("bits").bitwiseAND(F.lit(mask))
    combined = marked.groupBy(hit.alias("hit")).agg(F.count("*").alias("n"))  # at most one row for each set of rules
    named = [F.struct(F.lit(name).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for k, (name, _) in enumerate(RULES) if mask >> k & 1]
    return (
        combined.select("hit", "n", F.explode(F.array(*named)).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("hit").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("hit") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("rejected_alone"),
        )
    )
