"""Pairs of strings whose matching-blocks ratio may reach a bound, met on rare runs of characters."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sequence_ratio
from ..scratch import forget, unused, written
from .hot import by_shuffle


def with_grams(df: DataFrame, s: str, out: str, q: Column) -> DataFrame:
    """df with hashes of a string's runs of q characters, the k-th of equal ones apart."""
    n = F.greatest(F.char_length(s) - q + 1, F.lit(0))
    runs = F.transform(F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1))), F.lit(2), n), lambda i: F.substring(s, i, q))
    # sorted in a column of its own, as what a lambda names is worked out for each element
    d = df.withColumn(out, F.sort_array(runs))
    return d.withColumn(out, F.transform(out, lambda x, i: F.xxhash64(x, i - F.array_position(out, x))))


def needed(chars: Column, least: float, q: Column) -> Column:
    """Runs of q characters that two strings of so many characters together share if their ratio
    is least.

    M matched characters in k blocks share M - (q - 1) k of them; each of the U = chars - 2 M
    others stands between two blocks at most, so k <= U + 1, and M >= least * chars / 2.
    """
    return F.greatest(F.lit(1), F.ceil((least / 2 - (q - 1) * (1 - least)) * chars - (q - 1) - 1e-9))


def candidates(left: DataFrame, right: DataFrame, least: float, block: tuple[str, ...] = ()) -> DataFrame:
    """(k, n, *block): pairs of a string k of left and a string n of right, in the same block,
    among which are all with a ratio of least or more. Both sides hold distinct strings.

    Equal strings meet by an equi-join. Others, which above 0.8 have four characters together
    or more, share a run among the rarest of either, as many as may be missing and one more,
    where lengths and positions still fit, and then must share as many as needed. Runs have
    three characters where both strings are so long that they must share one, else two.

    Strings go by numbers until the few that are alike enough are known. Each rare run brings
    its string's length and which of 256 hashes its pairs of neighbours have in odd number: the
    bits that two strings differ in are pairs of which one has more, and too many of them end
    a meeting before it is written.
    """
    if least <= 0.8:
        raise ValueError("up to a ratio of 0.8 different strings need not share a bigram")
    # strings from this length on share a run of three with all of that length that are like them
    long = math.ceil(3 / (2.5 * least - 2) * (2 - least) / 2)
    longest = math.floor((long - 1) * (2 - least) / least + 1e-9)  # of those like a shorter one
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q = F.col("q")

    def numbered(df: DataFrame, c: str) -> DataFrame:
        return written(df.select(c, *block).repartition(width, c).withColumn(f"{c}_id", F.monotonically_increasing_id()))

    def tokens(df: DataFrame, c: str) -> DataFrame:
        grams, size = unused(df, "grams"), F.char_length(c)
        kinds = F.filter(F.array(F.when(size >= long, 3), F.when(size <= longest, 2)), lambda x: x.isNotNull())
        d = df.withColumn("q", F.explode(kinds))
        return written(with_grams(d, c, grams, q).select(f"{c}_id", *block, "q", F.explode(grams).alias("t")))

    def bits(df: DataFrame, c: str) -> DataFrame:
        pairs = unused(df, "pairs")
        part = lambda x, k: F.when(F.pmod(x, F.lit(4)) == k, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(x, 2), F.lit(64)).cast("int"))).otherwise(0)
        odd = lambda k: F.aggregate(pairs, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(part(x, k))).alias(f"{c}_{k}")
        return with_grams(df, c, pairs, F.lit(2)).select(f"{c}_id", F.char_length(c).alias(f"{c}_len"), *map(odd, range(4)))

    left_names, right_names = numbered(left, "k"), numbered(right, "n")
    l, r = tokens(left_names, "k"), tokens(right_names, "n")
    often = r.groupBy("t").agg(F.count("*").alias("df"))

    def ranked(t: DataFrame, p: str, names: DataFrame) -> DataFrame:
        t = t.join(by_shuffle(often), "t", "left").groupBy(f"{p}_id", *block, "q").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "t"))).alias("o"))
        t = t.select(f"{p}_id", *block, "q", F.size("o").alias(f"{p}_size"), F.transform("o", lambda x: x["t"]).alias(f"{p}_all"))
        return written(t.join(by_shuffle(bits(names, p)), f"{p}_id"))

    def prefixes(t: DataFrame, p: str) -> DataFrame:
        size = F.col(f"{p}_size")
        first = size - needed(F.col(f"{p}_len") * (2 / (2 - least)), least, q).cast("int") + 1
        told = [c for c in t.columns if c != f"{p}_all"]
        return t.select(*told, F.posexplode(F.slice(f"{p}_all", F.lit(1), F.greatest(first, F.lit(0)))).alias(f"{p}_at", "t"))

    tables = [l, r]
    l, r = ranked(l, "k", left_names), ranked(r, "n", right_names)
    forget(*tables)
    met = prefixes(l, "k").join(by_shuffle(prefixes(r, "n")), ["t", "q", *block])
    x, y = F.col("k_len"), F.col("n_len")
    left_over = 1 + F.least(F.col("k_size") - F.col("k_at") - 1, F.col("n_size") - F.col("n_at") - 1)
    fit = ((q == 3) | (F.least(x, y) < long)) & (2 * F.least(x, y) / (x + y) >= least) & (left_over >= needed(x + y, least, q))
    apart = sum((F.bit_count(F.col(f"k_{k}").bitwiseXOR(F.col(f"n_{k}"))) for k in range(1, 4)), F.bit_count(F.col("k_0").bitwiseXOR(F.col("n_0"))))
    pairs = F.greatest(x - 1, F.lit(0)) + F.greatest(y - 1, F.lit(0))
    met = met.where(fit & (apart <= pairs - 2 * needed(x + y, least, F.lit(2)))).select("k_id", "n_id", "q").distinct()
    met = met.join(by_shuffle(l.select("k_id", "q", "k_all")), ["k_id", "q"]).join(by_shuffle(r.select("n_id", "q", "n_all")), ["n_id", "q"])
    met = met.join(by_shuffle(left_names), "k_id").join(by_shuffle(right_names.drop(*block)), "n_id").withColumn("both", F.char_length("k") + F.char_length("n"))
    both = F.col("both")
    met = met.where(F.size(F.array_intersect("k_all", "n_all")) >= needed(both, least, q)).select("k", "n", *block)
    same = left.select("k", *block).join(by_shuffle(right.select(F.col("n").alias("k"), "n", *block)), ["k", *block])
    return met.unionByName(same.select("k", "n", *block)).distinct()


def scored(pairs: DataFrame, least: float, a: str = "k", b: str = "n") -> DataFrame:
    """pairs whose ratio of a against b, which isn't symmetric, is at least `least`. They are
    written first, as the ratio would else be worked out before the joins that thin them out."""
    return written(pairs).withColumn("ratio", F.when(F.col(a) == F.col(b), 1.0).otherwise(sequence_ratio(F.col(a), F.col(b)))).where(F.col("ratio") >= least)
