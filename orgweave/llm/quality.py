"""Quality rules kept as a bitmask ledger. DataFrame functions only.

Every rule is evaluated once per text. The ledger keeps the measurements and one long
whose bit k says that rule k failed. A policy is a versioned mask over those bits: to
apply another policy, or to learn what each rule of a policy costs, the ledger is read
and the texts are not.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, table, unused

SYMBOLS = "#*$%&|<>"

#: Rules by bit: name, and the expression over the measurements that holds when it fails.
#: The expressions are plain SQL, so that an oracle can run the same text.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("shouting", "5 * n_marks > n_words"),
    ("capitals", "2 * n_capitals > word_chars"),
    ("digits", "3 * n_digits > word_chars"),
]
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return reduce(lambda m, r: m | BIT[r], self.rules, 0)


BASE = Policy("base", ("few_words", "repeated_words"))
POLICIES = {p.version: p for p in (BASE, Policy("v1", tuple(BIT)), Policy("v2", tuple(r for r in BIT if r != "digits")))}
DEFAULT = POLICIES["v1"]


def _count(text: Column, chars: str) -> Column:
    """Number of characters of text that are in chars."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements that RULES name, as longs; null and empty texts measure 0.

    n_repeat_words counts the words inside five-word windows that occur twice or more in
    the text. Windows are compared by 64-bit hash. Only texts that repeat a window have
    them sorted; sorting is n log n, so a very long text costs no more a word than others.
    Repeated rows measure alike; an empty table stays one. Columns of the input with the
    names of measurements are replaced, others stay, whatever their names.
    """
    import string

    t = F.coalesce(F.col(text), F.lit(""))
    q = {k: unused(docs, f"text_{k}") for k in ("text", "words", "lines", "grams", "sorted", "at")}
    d = docs.withColumn(q["text"], t)
    d = d.withColumn(q["words"], F.filter(F.split(F.translate(q["text"], SPACES, " " * len(SPACES)), " "), lambda w: w != ""))
    d = d.withColumn(q["lines"], F.filter(F.split(q["text"], "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size(q["words"])
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - 4, F.lit(1))), lambda i: F.xxhash64(F.slice(q["words"], i, 5)))
    d = d.withColumn(q["grams"], F.when(n >= 5, grams).otherwise(F.array().cast("array<bigint>")))
    again = F.size(F.array_distinct(q["grams"])) < F.size(q["grams"])
    pairs = F.sort_array(F.transform(q["grams"], lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn(q["sorted"], F.when(again, pairs))
    same = lambda x, i, by: F.coalesce(F.get(q["sorted"], i + by)["h"] == x["h"], F.lit(False))
    dup = F.filter(q["sorted"], lambda x, i: ((i > 0) & same(x, i, -1)) | same(x, i, 1))
    d = d.withColumn(q["at"], F.sort_array(F.transform(dup, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(q["at"], start, lambda a, p: F.struct((p + 5).alias("end"), (a["n"] + p + 5 - F.greatest(a["end"], p)).alias("n")), lambda a: a["n"])
    text_chars = F.char_length(q["text"])
    made = {
        "n_words": n,
        "word_chars": text_chars - _count(F.col(q["text"]), SPACES),
        "n_symbols": _count(F.col(q["text"]), SYMBOLS),
        "n_lines": F.size(q["lines"]),
        "n_dup_lines": F.size(q["lines"]) - F.size(F.array_distinct(q["lines"])),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_marks": _count(F.col(q["text"]), "!?"),
        "n_capitals": _count(F.col(q["text"]), string.ascii_uppercase),
        "n_digits": _count(F.col(q["text"]), string.digits),
    }
    return d.withColumns({k: v.cast("long") for k, v in made.items()}).drop(*q.values())


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with measurements and fail_bits (long): bit k is set where rule k failed.

    Null and empty texts have the bits of a text without words. A measurement that ties with
    a rule's bound doesn't fail. Otherwise see measure()."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(0) for k, (_, rule) in enumerate(RULES)]
    return measure(docs, text).withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))


def apply_policy(entries: DataFrame, policy: Policy = DEFAULT, kept: str = "kept") -> DataFrame:
    """A ledger with a boolean that holds where no rule of the policy failed. A column of the
    ledger called as kept is replaced; rows stay, repeated and empty ones too."""
    return entries.withColumn(kept, F.col("fail_bits").bitwiseAND(policy.mask) == 0)


def ablations(entries: DataFrame, policies: list[Policy] | None = None) -> DataFrame:
    """What each rule costs: version, rule, n_rows, n_failed, n_only, n_kept, n_kept_without.

    n_only: rows that only this rule of the policy rejects. The ledger is first summed by
    fail_bits, at most 2**rules rows whatever the input, and the rest is bit arithmetic.
    An empty ledger gives zeros.
    """
    spark = entries.sparkSession
    rows = [(p.version, r, BIT[r], p.mask) for p in policies or POLICIES.values() for r in p.rules]
    rules = spark.createDataFrame(rows, "version string, rule string, bit long, mask long")
    sums = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    met = F.broadcast(rules).join(sums, F.lit(True), "left")
    got = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return met.groupBy("version", "rule").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        total(got.bitwiseAND(F.col("bit")) != 0)("n_failed"),
        total(got == F.col("bit"))("n_only"),
        total(got == 0)("n_kept"),
        total((got == 0) | (got == F.col("bit")))("n_kept_without"),
    )


def op1(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_policy(apply_policy(ledger(docs)), BASE, "base_kept")
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(*first, (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits")


_BITS = " | ".join(f"(CASE WHEN {rule} THEN {1 << k} ELSE 0 END)" for k, (_, rule) in enumerate(RULES))
OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT r, i, w[i:i + 4] AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), c AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g
), k AS (
  SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 5, 0) AS past FROM c WHERE n > 1
), s AS (
  SELECT r, sum(i + 5 - greatest(past, i)) AS n_repeat_words FROM k GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (length(t) - length(regexp_replace(t, '[!?]', '', 'g')))::BIGINT AS n_marks,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         (length(t) - length(regexp_replace(t, '[0-9]', '', 'g')))::BIGINT AS n_digits
  FROM d LEFT JOIN s USING (r)
), b AS (SELECT *, ({_BITS})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & {BASE.mask} <> 0 AS base_failed, fail_bits & {DEFAULT.mask} = 0 AS kept, fail_bits
FROM b
"""
