"""Quality rules as a short-circuit cascade.

Rules look at a text and at its counts, which every document gets. What a rule
costs beyond the counts and how many documents it rejects are measured on a
sample, and the rules run in the order of rejection per cost; a document that
one rejects is not shown to the next.

Windows of three words are compared by 64-bit hashes: two different windows of
one text would have to share one (odds of 1e-11 for 20,000 words) to be taken as
equal.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.common import BLANK_RUN, BLANKS, Query, stored, table, whole_text

# Windows are sorted as one long each: hash bits above, position below. Longer texts sort pairs instead.
POSITION_BITS = 20
SAMPLE_ROWS = 2_000
# Rows of the sample are worked on so often, and jobs run so often, to measure a rule; less than LEAST_COST isn't told apart.
REPEATS = 3
RUNS = 2
LEAST_COST = 2e-5


@dataclass(frozen=True)
class Rule:
    """A condition on columns under which a document is rejected."""

    name: str
    rejects: str


# Loose bounds: a document must be clearly odd to fail.
RULES = (
    Rule("short", "n_words < 50"),
    Rule("repeated words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "n_symbols > 0.5 * n_words"),
    Rule("repeated lines", "2 * n_dup_lines > n_lines"),
    Rule("word length", "word_chars < 2 * n_words or word_chars > 25 * n_words"),
    Rule("letters", "length(regexp_replace(text, '[^\\\\p{L}]+', '')) < 0.5 * word_chars"),
    Rule("bullets", r"""10 * size(filter(split(text, '\\n'), x -> x rlike '^[\\x20\\x09-\\x0D]*[-*\u2022]')) > 9 * n_lines"""),
    Rule("ellipses", r"""10 * size(filter(split(text, '\\n'), x -> x rlike '([.][.][.]|\u2026)[\\x20\\x09-\\x0D]*\\z')) > 3 * n_lines"""),
)


def repeated_words(frame: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from the array column ``words``: words in windows of three that occur again.

    Each step refers to the one before more than once, which keeps the optimizer
    from folding a step into the function that runs per element.
    """
    n = "size(words)"
    kept = [c for c in frame.columns if c != "words"]
    low = (1 << POSITION_BITS) - 1
    short = f"size(h) < {1 << POSITION_BITS}"
    hashes = frame.select(
        *kept,
        F.expr(f"""if({n} < 3, cast(array() as array<bigint>),
            transform(sequence(1, {n} - 2), i -> xxhash64(words[i - 1], words[i], words[i + 1])))""").alias("h"),
    )
    once = hashes.select(*kept, "h", F.expr("size(h) = size(array_distinct(h))").alias("fresh"))
    packed = once.select(
        *kept,
        "h",
        "fresh",
        F.expr(f"""case when fresh or not {short} then null
            else sort_array(transform(h, (x, i) -> (x & {~low}L) | i)) end""").alias("p"),
    )
    # Neighbours that share the upper bits but not the hash: rare, and left to the sort by pairs.
    mixed = f"""exists(sequence(1, size(p) - 1), k -> shiftright(p[k], {POSITION_BITS}) = shiftright(p[k - 1], {POSITION_BITS})
        and h[int(p[k] & {low})] != h[int(p[k - 1] & {low})])"""
    exact = packed.select(
        *kept,
        "h",
        "fresh",
        "p",
        F.expr(f"""case when fresh then null when p is null or {mixed}
            then sort_array(transform(h, (x, i) -> struct(x as x, i as i))) end""").alias("s"),
    )
    again = exact.select(
        *kept,
        "p",
        "s",
        "fresh",
        F.expr(f"""case when fresh then null
            when s is not null then filter(sequence(1, size(s) - 1), k -> s[k].x = s[k - 1].x)
            else filter(sequence(1, size(p) - 1),
                k -> shiftright(p[k], {POSITION_BITS}) = shiftright(p[k - 1], {POSITION_BITS})) end""").alias("k"),
    )
    both = again.select(
        *kept, "p", "s", "fresh", F.expr("case when not fresh then array_distinct(concat(k, transform(k, x -> x - 1))) end").alias("k")
    )
    places = both.select(
        *kept,
        "fresh",
        F.expr(f"""case when fresh then null when s is not null then sort_array(transform(k, x -> s[x].i))
            else sort_array(transform(k, x -> int(p[x] & {low}))) end""").alias("at"),
    )
    return places.select(
        *kept,
        F.expr("""case when fresh or size(at) = 0 then 0L
            else aggregate(sequence(1, size(at) - 1, 1), 3L, (sum, j) -> sum + if(j < 1, 0, least(3, at[j] - at[j - 1]))) end""").alias(
            "n_repeat_words"
        ),
    )


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts that the rules use; null and empty texts count nothing."""
    trimmed = docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id", "text", F.btrim("text", F.lit(BLANKS)).alias("core")
    )
    split = trimmed.select(
        "doc_id",
        "text",
        F.when(F.col("core") == "", F.array().cast("array<string>")).otherwise(F.split("core", BLANK_RUN)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("lines"),
    )
    counted = split.select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    return repeated_words(counted)


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost on a sample of about ``rows`` documents; the order changes no verdict.

    A cost is the time per document that a job over the counted sample, every
    row of it many times, takes longer with the rule than without one: the least
    of some runs, so that starting and compiling it don't count. Rules cheaper
    than LEAST_COST seconds count as equally cheap; among equals the given order
    stays, as for an empty table.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = stored(measures(docs.select("doc_id", "text").sample(min(1.0, rows / total), seed=5)), "quality-sample")
    again = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))
    seen = max(1, sample.count() * REPEATS)

    def measured(rejects: str) -> tuple[float, float]:
        """Seconds and share of rejected rows."""
        counted = again.agg(F.count_if(F.expr(rejects)))
        took = []
        for _ in range(RUNS):
            started = time.perf_counter()
            rejected = counted.first()[0]
            took.append(time.perf_counter() - started)
        return min(took), rejected / seen

    # Reads the text as well, and tells nothing about it.
    without, _ = measured("text is null")

    def worth(rule: Rule) -> float:
        took, share = measured(rule.rejects)
        return share / max(LEAST_COST, (took - without) / seen)

    return sorted(rules, key=worth, reverse=True)


def rejected_by(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null for a kept document; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.expr(rule.rejects), F.lit(rule.name)).otherwise(verdict)
    return verdict


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures of every document and ``rejected_by``; repeated rows and null ids stay rows of their own."""
    return measures(docs).withColumn("rejected_by", rejected_by(order_rules(docs, rules)))


def verdicts(docs: DataFrame) -> DataFrame:
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return assess(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
),
s AS (
  SELECT r, doc_id, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
places AS (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM s WHERE len(words) >= 3),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS times FROM places
),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY r
),
m AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM s LEFT JOIN covered USING (r)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.5 * n_words OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 25 * n_words
    OR length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 0.5 * word_chars
    OR 10 * len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) > 9 * n_lines
    OR 10 * len(list_filter(string_split(text, chr(10)),
      lambda x: regexp_matches(x, '([.][.][.]|…)[\x20\x09-\x0D]*\z'))) > 3 * n_lines) AS kept
FROM b
"""

QUERIES = {"op3_quality": Query(lambda spark, sf_dir: verdicts(table(spark, sf_dir, "documents")), SQL)}
