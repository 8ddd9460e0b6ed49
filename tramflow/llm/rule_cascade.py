"""Quality rules as a short-circuit cascade (native).

The counts that most rules read are array and string expressions of the text. The
verdict's rules form one CASE chain, which Spark evaluates in order and leaves at the first
rule that rejects. Their order comes from a bounded sample: each rule is timed on it
and its share of rejected documents is measured; rules with the most rejections per
second come first. The order changes what is computed, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramflow.llm.common import BLANK, WORD

BLANKS = " \t\n\x0b\x0c\r"
#: Rows on which rules are timed; at most this many texts are read for it.
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean column over ``text``, ``words``, ``lines`` and the counts of ``base_counts``."""

    name: str
    rejects: Column


def rules() -> list[Rule]:
    """The default rules, each with a wide margin to ordinary prose."""
    n, c = F.col("n_words"), F.col
    return [
        Rule("symbols", 10 * c("n_symbols") > n),
        Rule("duplicate_lines", 10 * c("n_dup_lines") > 4 * F.size("lines")),
        Rule("word_length", (c("word_chars") < 2 * n) | (c("word_chars") > 20 * n)),
        Rule("ellipsis_lines", 10 * F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))) > 3 * F.size("lines")),
        Rule("bullet_lines", 10 * F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-•]"))) > 9 * F.size("lines")),
        Rule("few_letters", 10 * F.size(F.filter("words", lambda x: x.rlike(r"\p{L}"))) < 8 * n),
        Rule("few_distinct", 10 * F.size(F.array_distinct("words")) < n),
    ]


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words in three-word windows that the array of words holds twice or more.

    Windows are compared by a 64-bit hash, sorted with their places only when one repeats, so a
    text costs n log n in its words. Each step is bound once by ``let``: as columns of
    nested projections they would be copied into each other when a filter is pushed down.
    """

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(hashes, places))

    def places(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, repeated))

    def repeated(o: Column) -> Column:
        twice = F.filter(o, lambda x, i: (F.get(o, i - 1)["h"] == x["h"]) | (F.get(o, i + 1)["h"] == x["h"]))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(words, windows)


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, text, words, lines`` and the five counts; a null text counts as empty."""
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(BLANKS))
    split = text.select(
        "doc_id",
        "text",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    return split.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        (F.char_length("text") - F.size(F.split("text", r"[\x20\x09-\x0D]")) + 1).cast("long").alias("word_chars"),
        (F.size(F.split("text", r"[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Fixed by the result contract: under 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measure(docs: DataFrame, candidates: list[Rule], sample_rows: int = SAMPLE_ROWS, repeats: int = 2) -> list[tuple[str, float, float]]:
    """``(name, seconds, selectivity)`` of each rule on a sample of ``sample_rows`` documents.

    The sample is ranked by a hash of the id, so it does not follow the order of the files; its
    counts are written to the checkpoint folder once. A rule's time is that of counting what it
    rejects, over that of counting alone, the best of some runs; a time below the clock's noise counts as that.
    """
    rank = F.xxhash64("doc_id")
    last = docs.select(rank.alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    chosen = docs.select("doc_id", "text").where(rank <= F.lit(last)).limit(sample_rows)
    sample = base_counts(chosen).checkpoint().where(~base_failed())

    def timed(found: Column) -> tuple[float, int, int]:
        best, row = float("inf"), None
        for _ in range(repeats):
            began = time.perf_counter()
            row = sample.agg(F.count(F.lit(1)), F.count_if(found)).first()
            best = min(best, time.perf_counter() - began)
        return best, row[0], row[1]

    idle, _, _ = timed(F.col("n_words") < 0)
    noise = 1e-4
    out = []
    for rule in candidates:
        spent, rows, rejected = timed(rule.rejects)
        out.append((rule.name, max(spent - idle, noise), rejected / max(rows, 1)))
    return out


def ordered_rules(candidates: list[Rule], measured: list[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejections per second, most first; at equal rates the cheaper, then by name."""
    figures = {name: (-rejected / seconds, seconds, name) for name, seconds, rejected in measured}
    return sorted(candidates, key=lambda rule: figures[rule.name])


def cascade(docs: DataFrame, candidates: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    A null or empty text has no words and fails the base. Repeated rows get equal results, row by
    row; columns other than ``doc_id`` and ``text`` are not read. An empty table gives no rows.
    """
    candidates = rules() if candidates is None else candidates
    order = ordered_rules(candidates, measure(docs, candidates, sample_rows))
    verdict = F.when(base_failed(), False)
    for rule in order:
        verdict = verdict.when(rule.rejects, False)
    return base_counts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), verdict.otherwise(True).alias("kept")
    )


ORACLE = r"""
WITH base AS (SELECT doc_id, row_number() OVER () AS id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT id, unnest(w) AS w, generate_subscripts(w, 1) AS pos
  FROM (SELECT id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM base)),
grams AS (
  SELECT a.id, a.pos, count(*) OVER (PARTITION BY a.id, a.w, b.w, c.w) AS n
  FROM words a JOIN words b ON a.id = b.id AND b.pos = a.pos + 1 JOIN words c ON a.id = c.id AND c.pos = a.pos + 2),
repeated AS (
  SELECT id, count(DISTINCT pos + k) AS n_repeat_words FROM grams, (VALUES (0), (1), (2)) t(k) WHERE n > 1 GROUP BY id),
lines AS (
  SELECT id, unnest(string_split(text, chr(10))) AS line FROM base),
line_counts AS (
  SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$')) AS n_ellipsis,
         count(*) FILTER (regexp_matches(line, '^[\x20\x09-\x0D]*[-•]')) AS n_bullets
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY id),
word_counts AS (
  SELECT id, count(*) AS n_words, sum(length(w)) AS word_chars, count(DISTINCT w) AS n_distinct,
         count(*) FILTER (regexp_matches(w, '\p{L}')) AS n_letters FROM words GROUP BY id),
counts AS (
  SELECT b.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(b.text) - length(regexp_replace(b.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_lines, n_ellipsis, n_bullets, n_distinct, n_letters
  FROM base b LEFT JOIN word_counts USING (id) LEFT JOIN line_counts USING (id) LEFT JOIN repeated USING (id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines OR word_chars < 2 * n_words
            OR word_chars > 20 * n_words OR 10 * n_ellipsis > 3 * n_lines OR 10 * n_bullets > 9 * n_lines
            OR 10 * n_letters < 8 * n_words OR 10 * n_distinct < n_words) AS kept
FROM judged
"""
