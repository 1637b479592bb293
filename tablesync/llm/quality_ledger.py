"""Quality rules as a ledger: every rule once, its measurement and one failure bit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: The rules, in the order of their bits. Each fails on a share or count that clean prose does not reach.
RULES = (
    "few_words",  # fewer than 10 words
    "repeated_words",  # more than 20 % of the words in 5-word windows that the text repeats
    "symbols",  # more than 20 symbols for 100 word characters
    "repeated_lines",  # more than 60 % of the lines equal an earlier one
    "long_words",  # a mean word of more than 30 characters
)
#: A policy is the set of rules whose failure rejects a document.
POLICIES = {"base": ("few_words", "repeated_words"), "v1": RULES}


def mask(policy: str) -> int:
    return sum(1 << RULES.index(rule) for rule in POLICIES[policy])


def _n_repeat_words() -> Column:
    """Words inside 5-word windows that occur more than once, over the column ``grams``.

    With the starts of such windows in order, each adds the words up to the next
    start, five at most.
    """
    placed = F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def repeated(sorted_grams: Column) -> Column:
        last = F.size(sorted_grams) - 1
        same = lambda x, j: F.get(sorted_grams, j)["g"] == x["g"]
        return F.array_sort(
            F.transform(
                F.filter(
                    sorted_grams,
                    lambda x, j: ((j > 0) & F.coalesce(same(x, j - 1), F.lit(False)))
                    | ((j < last) & F.coalesce(same(x, j + 1), F.lit(False))),
                ),
                lambda x: x["i"],
            )
        )

    def covered(starts: Column) -> Column:
        # the running pair: the words so far and the end of the last window
        step = lambda a, s: F.struct(
            (a["n"] + s + 5 - F.greatest(s, a["end"])).alias("n"), (s + 5).alias("end")
        )
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(starts, zero, step, lambda a: a["n"])

    # a one-element array binds a value that the lambdas inside read many times
    counted = F.get(F.transform(F.array(placed), lambda p: covered(repeated(p))), F.lit(0))
    return F.when(F.size(F.array_distinct("grams")) < F.size("grams"), counted).otherwise(0).cast("long")


def measure(docs: DataFrame, *carried: str | Column) -> DataFrame:
    """doc_id and the ``carried`` columns, the measurements of its whole text, and ``failed``: one bit per rule.

    All is one projection over each row: no shuffle, nothing gathered. A null text
    has no words and so fails ``few_words`` alone. Rows that repeat, and null ids,
    are each measured and returned. An empty table gives no rows; columns other
    than doc_id and text are not looked at.
    """
    given = docs.select(*carried).columns
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", *carried, text.alias("text")).select(
        "doc_id",
        *given,
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    grams = F.when(
        F.size("words") >= 5,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 5),
            lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(5)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        "doc_id",
        *given,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        grams.alias("grams"),
    ).withColumn("n_repeat_words", _n_repeat_words()).drop("grams")
    n = F.col
    fails = {
        "few_words": n("n_words") < 10,
        "repeated_words": 100 * n("n_repeat_words") > 20 * n("n_words"),
        "symbols": 100 * n("n_symbols") > 20 * n("word_chars"),
        "repeated_lines": 100 * n("n_dup_lines") > 60 * n("n_lines"),
        "long_words": n("word_chars") > 30 * n("n_words"),
    }
    bits = [F.when(fails[rule], F.lit(1 << i)).otherwise(0) for i, rule in enumerate(RULES)]
    ledger = counted.withColumn("failed", reduce(Column.bitwiseOR, bits))
    # Filters on the ledger stay above this: pushed below, they would repeat every measurement.
    return ledger.select(F.inline(F.array(F.struct(*ledger.columns))))


def apply_policy(ledger: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``kept``: no failure among the policy's rules. Nothing is measured anew."""
    return ledger.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does: documents failing it, and those that only it rejects.

    One aggregation over the distinct bit sets, 2 to the number of rules at most.
    """
    within = F.col("failed").bitwiseAND(F.lit(mask(policy)))
    sets = ledger.groupBy(within.alias("bits")).agg(F.count("*").alias("docs"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).alias("bit")) for r in POLICIES[policy]]))
    of_rule = sets.select("bits", "docs", rules.alias("r")).select("bits", "docs", "r.*")
    has, alone = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit")
    return of_rule.groupBy("rule").agg(
        F.sum(F.when(has, F.col("docs")).otherwise(0)).alias("failing"),
        F.sum(F.when(alone, F.col("docs")).otherwise(0)).alias("rejected_by_it_alone"),
    )


def op9_quality_ledger(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The digest of the ledger under a policy."""
    return apply_policy(measure(docs), policy).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(mask("base"))) != 0).alias("base_failed"),
        "kept",
        "failed",
    )


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM w, unnest(range(1, len(words) - 3)) AS r(i)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(5) AS x(j) GROUP BY doc_id),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  len(lines) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1, 100 * n_symbols > 20 * word_chars AS f2,
  100 * n_dup_lines > 60 * n_lines AS f3, word_chars > 30 * n_words AS f4 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 OR f1 AS base_failed,
  NOT (f0 OR f1 OR f2 OR f3 OR f4) AS kept, f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT AS failed FROM f
"""
