"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is an expression that is true where a text fails.  On a sample the cascade
measures what each rule costs and how many texts it rejects, and orders the rules
by rejections per cost; a text meets the rules in that order and leaves at its
first failure (a CASE evaluates no later branch).  The order changes the work,
never the verdict, so the result does not depend on the sample.

NULL and empty texts have no words and fail; so do texts of under 10 words.
Repeated rows get equal verdicts.  Other columns pass unchanged.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import SPACE, let, stored, whole_text, word_hashes, words_of

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"


def count_of(text: Column, pattern: str) -> Column:
    """Characters of the text that one character class matches."""
    return F.when(text.rlike(pattern), F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).otherwise(0)


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE + "+", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return count_of(text, SYMBOLS).cast("long")


def full_lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text: Column) -> Column:
    return F.size(full_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(full_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _windows(hashes: Column) -> Column:
    """A hash of each run of five words, in order."""
    return F.when(
        F.size(hashes) >= WINDOW,
        F.transform(
            F.slice(hashes, F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda first, i: F.xxhash64(first, *(F.get(hashes, i + k) for k in range(1, WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: the union of their extents."""
    ranked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(order: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(order, i - 1)["h"])
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(F.get(order, i + 1)["h"] == x["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(order, twice), lambda x: x["i"]))

    def extent(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, i: F.least(F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    return let(ranked, lambda order: let(repeated(order), extent))


def n_repeat_words(text: Column) -> Column:
    return let(
        let(word_hashes(text), _windows),
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w)),
    )


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def base_rules(text: Column) -> list[Rule]:
    return [
        Rule("few_words", n_words(text) < 10),
        Rule("repeated_words", 100 * n_repeat_words(text) > 20 * n_words(text)),
    ]


def more_rules(text: Column) -> list[Rule]:
    """Rules beside the base: symbols, shouting, repeated lines, odd word lengths."""
    return [
        Rule("symbols", 100 * n_symbols(text) > 30 * n_words(text)),
        Rule("exclamations", 100 * count_of(text, "!") > 50 * n_words(text)),
        Rule("repeated_lines", 100 * n_dup_lines(text) > 30 * n_lines(text)),
        Rule("word_length", (word_chars(text) > 25 * n_words(text)) | (2 * word_chars(text) < 3 * n_words(text))),
    ]


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000, runs: int = 3) -> list[Rule]:
    """Rules by rejections per second, both measured on a sample of the rows, which is stored once.

    A rule's cost is the least time of several runs over that of counting the rows.
    """
    total = docs.count()
    sample = stored(docs.sample(min(1.0, sample_rows / max(total, 1)), seed=7), "rule-sample")

    def timed(*columns: Column) -> tuple[float, tuple]:
        spent = []
        for _ in range(runs):
            began = time.perf_counter()
            row = sample.agg(*columns).first()
            spent.append(time.perf_counter() - began)
        return min(spent), tuple(row)

    least, (n,) = timed(F.count(F.lit(1)))
    if not n:
        return rules
    worth = {}
    for rule in rules:
        seconds, (failed,) = timed(F.sum(F.coalesce(rule.fails, F.lit(True)).cast("long")))
        worth[rule.name] = failed / max(seconds - least, 1e-4)
    return sorted(rules, key=lambda rule: -worth[rule.name])


def first_failure(rules: list[Rule]) -> Column:
    """Name of the first rule that a text fails, NULL where it passes all."""
    branches = F.lit(None).cast("string")
    for rule in reversed(rules):
        branches = F.when(rule.fails, F.lit(rule.name)).otherwise(branches)
    return branches


def cascade(docs: DataFrame, text: str = "text", **sampling) -> Column:
    """First failure of each text, base rules and others in the measured order."""
    whole = whole_text(text)
    return first_failure(ordered(docs.select(text), [*base_rules(whole), *more_rules(whole)], **sampling))


def keep_good(docs: DataFrame, text: str = "text", **sampling) -> DataFrame:
    """Rows whose text passes every rule."""
    return docs.filter(cascade(docs, text, **sampling).isNull())


def measured(docs: DataFrame, text: str = "text", **sampling) -> DataFrame:
    """docs with the base counts, base_failed and kept, which replace columns of these names."""
    whole = whole_text(text)
    order = ordered(docs.select(text), more_rules(whole), **sampling)
    counted = docs.withColumns(
        {
            "n_words": n_words(whole),
            "word_chars": word_chars(whole),
            "n_symbols": n_symbols(whole),
            "n_dup_lines": n_dup_lines(whole),
            "n_repeat_words": n_repeat_words(whole),
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(first_failure(order).isNull())
    )


KEPT_SQL = """
  words AS (
    SELECT rid, doc_id, text, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM whole),
  windows AS (
    SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS five
    FROM words, unnest(generate_series(1, len(w) - 4)) AS u(i)),
  twice AS (
    SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS after
    FROM (SELECT *, count(*) OVER (PARTITION BY rid, five) AS n FROM windows) WHERE n > 1),
  covered AS (SELECT rid, CAST(sum(least(5, coalesce(after - i, 5))) AS BIGINT) AS n FROM twice GROUP BY rid),
  counts AS (
    SELECT rid, doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
      CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
      coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
      length(text) - length(replace(text, '!', '')) AS n_marks
    FROM words LEFT JOIN covered USING (rid)),
  judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
      NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 30 * n_words
        OR 100 * n_marks > 50 * n_words OR 100 * n_dup_lines > 30 * n_lines
        OR word_chars > 25 * n_words OR 2 * word_chars < 3 * n_words) AS kept
    FROM counts)"""

SQL = f"""WITH whole AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents), {KEPT_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""
