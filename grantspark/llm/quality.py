"""Quality rules as a short-circuit cascade (operator 4); DataFrame functions only.

A rule is a condition that rejects a document. On a bounded sample each rule's share of rejections is counted in one pass
and its cost is measured, by running it alone and subtracting a run that does nothing else. Rules are ordered by rejections
per cost and joined in one CASE, which stops at the first rule that rejects; so a costly rule sees only what cheaper or more
selective ones let through. The order changes the cost and which rule is named, never the verdict.

Null texts have no words and fail the base rule. Ratios of an empty document reject nothing by themselves. Repeated rows
and further columns do no harm; on an empty table the rules keep their given order.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import compute
from .common import SPACE, query, table

#: Bound of the sample that orders the rules.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``reject`` is an SQL condition on the columns of the documents; null means no."""

    name: str
    reject: str


#: Production rules beyond the base; the columns are those of ``word_statistics`` and ``words``.
RULES = (
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines AND n_dup_lines >= 3"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("few_letters", "size(filter(words, w -> w rlike '\\\\p{L}')) * 10 < 7 * n_words"),
    # a word of more than half stands in the middle of the sorted words; a one-element transform binds it once
    Rule("one_word", "2 * get(transform(array(get(sort_array(words), int(n_words div 2))), m -> size(filter(words, w -> w = m))), 0) > n_words"),
)

_BLANK = f"[{SPACE}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _BLANK), lambda w: w != "")


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words inside a window of ``window`` words that starts twice or more in the array.

    Windows are sorted with their places, so equal ones are neighbours and no pair is compared twice; the places of those with an equal
    neighbour, sorted again, are cut to what the place before does not cover. The window itself is the key, with a
    separator that no word can hold.
    """
    last = F.size(words) - window

    def key(i):
        return F.concat_ws(" ", *[F.get(words, i + k) for k in range(window)])

    ordered = F.array_sort(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(key(i).alias("k"), i.alias("i"))))

    def twice(o):
        marked = F.transform(o, lambda x, j: F.when((x["k"] == F.get(o, j - 1)["k"]) | (x["k"] == F.get(o, j + 1)["k"]), x["i"]))
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def width(p):
        return F.aggregate(F.transform(p, lambda i, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - i, F.lit(window)))), F.lit(0), lambda a, b: a + b)

    # a one-element transform binds a value once
    places = F.get(F.transform(F.array(ordered), twice), F.lit(0))
    return F.when(last < 1, F.lit(0)).otherwise(F.get(F.transform(F.array(places), width), F.lit(0)))


def word_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add words (array) and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{SPACE}]"))
    first = compute(docs.drop("words", "_lines"), words=words_of(text), _lines=lines)
    return compute(
        first,
        n_words=F.size("words").cast("long"),
        word_chars=F.length(F.array_join("words", "")).cast("long"),
        n_symbols=F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        n_repeat_words=repeated_words(F.col("words")).cast("long"),
    ).drop("_lines")


def measured(sample: DataFrame, rules: tuple[Rule, ...]) -> dict[str, tuple[float, float]]:
    """{rule: (share of rows it rejects, seconds on the sample)}."""
    rows, *hits = sample.agg(F.count("*"), *[F.count_if(F.expr(r.reject)) for r in rules]).first()

    def seconds(what: Column) -> float:
        took = []
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.count_if(what)).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    idle = seconds(F.lit(True))
    return {r.name: (n / max(rows, 1), max(seconds(F.expr(r.reject)) - idle, 1e-4)) for r, n in zip(rules, hits)}


def ordered(rules: tuple[Rule, ...], cost: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first."""
    return sorted(rules, key=lambda r: -cost[r.name][0] / cost[r.name][1])


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, else null; later rules are not evaluated."""
    chain = None
    for r in rules:
        chain = F.when(F.expr(r.reject), F.lit(r.name)) if chain is None else chain.when(F.expr(r.reject), F.lit(r.name))
    return chain if chain is not None else F.lit(None).cast("string")


def apply_cascade(docs: DataFrame, rules: tuple[Rule, ...], prepare=lambda df: df, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``prepare`` adds the columns the rules read; rejected_by is added to the result.

    The sample is the first rows the reader meets (``limit`` stops after a few splits), handed back as a small table.
    """
    sample = prepare(docs.sparkSession.createDataFrame(docs.limit(sample_rows).collect(), docs.schema)).cache()
    try:
        order = ordered(rules, measured(sample, rules))
    finally:
        sample.unpersist()
    return prepare(docs).withColumn("rejected_by", cascade(order))


BASE = Rule("base", "n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the statistics, base_failed, rejected_by and kept; rules past the base run only where it passes."""
    stated = apply_cascade(docs, rules, word_statistics)
    failed = F.coalesce(F.expr(BASE.reject), F.lit(False))
    verdict = F.when(failed, F.lit(BASE.name)).otherwise(F.col("rejected_by"))
    return stated.withColumn("base_failed", failed).withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull()).drop("words")


_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    row_number() OVER () AS r FROM d),
g AS (SELECT r, i, concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS k
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
s AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM s) GROUP BY r),
m AS (SELECT doc_id, words, list_sort(words)[len(words) // 2 + 1] AS middle, len(words) AS n_words, CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT) AS chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, coalesce(chars, 0) AS word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words OR (2 * n_dup_lines > n_lines AND n_dup_lines >= 3)
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words
        OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 7 * n_words
        OR coalesce(2 * len(list_filter(words, lambda x: x = middle)) > n_words, false)) AS kept
FROM b
"""


@query("op4_quality", _SQL)
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
