"""Quality rules with a bitmask ledger, in DataFrame functions alone.

Every rule is evaluated once for each document; the ledger keeps what was measured and one bit for each rule that failed.
A policy is a versioned bit mask, applied to the ledger without looking at the texts again. Ablations come from the few
distinct bit patterns and their counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import kept_table, narrow, words_of

WINDOW = 5
#: The rules by the number of their bit; each is true where a document fails it. New rules take the next bits.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 14 * n_words)"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
]


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << bit for bit, (name, _) in enumerate(RULES) if name in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy("1", tuple(name for name, _ in RULES))
#: Every version of the policy that has been in use.
POLICIES = [BASE, STRICT, Policy("2", tuple(name for name, _ in RULES if name != "word_length"))]


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, what was measured, and fail_bits of each document.

    Null and empty texts have no words, so they fail ``few_words`` alone; null keys and repeated rows are rows like any
    other; an empty table gives an empty ledger; other columns are not carried. Nothing is shuffled: one document is one
    row, however long.
    """
    rows = narrow(docs, key=key, text=text).select("key", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of("text"))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        F.col("key").alias("doc_id"),
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    rows = rows.withColumn("windows", _window_hashes("hashes"))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    sorted_windows = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("by_hash", F.when(repeats, sorted_windows)).withColumn("found", _repeated_starts("by_hash"))
    rows = rows.withColumn("n_repeat_words", F.coalesce(_covered("found"), F.lit(0)).cast("bigint"))
    bits = [F.expr(f"if({failed}, {1 << bit}L, 0L)") for bit, (_, failed) in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    measured = "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"
    return rows.select(*measured, total.alias("fail_bits"))


def _window_hashes(hashes: str) -> Column:
    """A hash of each window of five words, by its start."""
    last = F.size(hashes) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))


def _repeated_starts(by_hash: str) -> Column:
    """Starts of the windows found twice or more, in order; the windows come sorted by hash."""

    def repeated(x: Column, i: Column) -> Column:
        before, after = F.get(by_hash, i - 1)["h"], F.get(by_hash, i + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    return F.array_sort(F.transform(F.filter(by_hash, repeated), lambda x: x["i"]))


def _covered(starts: str) -> Column:
    """How many words the windows cover together: each adds what the one before it left open."""
    none = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(starts, none, lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n"), s.alias("last")))["n"]


def kept_ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The ledger written as a table: policies and ablations read it, never the texts again."""
    return kept_table(ledger(docs, text, key), "ledger")


def verdicts(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """The ledger with a column ``kept_<version>`` for each policy."""
    return rows.withColumns({f"kept_{p.version}": ~fails(p) for p in policies})


def all_ablations(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    return reduce(DataFrame.unionByName, [ablations(rows, p) for p in policies])


def fails(policy: Policy) -> Column:
    """True where a ledger row fails a rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) != 0


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents failing it, failing it alone, and kept if it is left out."""
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << bit).cast("bigint").alias("bit")) for bit, (name, _) in enumerate(RULES) if name in policy.rules]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    held = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).alias
    return each.groupBy("rule").agg(
        held(F.col("bits").bitwiseAND(F.col("bit")) != 0)("failed"),
        held(F.col("bits") == F.col("bit"))("failed_alone"),
        held(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0)("kept_without"),
        F.lit(policy.version).alias("policy"),
    )
