"""Rules on documents, and verdicts on the hosts they come from.

Rules are counted per document, their failures per host. A host's failure rate is shrunk
towards the rate of all hosts with a beta prior whose mean and weight are fitted to the
hosts by moments; a host with few documents is judged mostly by the prior. Documents of
hosts whose shrunk rate is over a limit go, whatever they look like themselves.

Only column functions run. Counts by host are combined on the map side, and the verdicts
are one row per host, so a host with a third of all documents gathers nowhere.

Defined results: a null text has no words and no lines; so has an empty or blank one. Such
documents fail the base rule. Documents without a host are judged by the base rule alone and
do not count for the prior. Repeated rows are judged row by row. An empty table gives an
empty result. Other columns pass unchanged; those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES, join_few, stored, words_of

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MAX_HOST_RATE = 0.5
# A document counts against its host if it fails any of these.
MAX_SYMBOLS_PER_WORD = 0.3
MAX_DUP_LINES_PER_WORD = 0.1
WORD_CHARS = (2.5, 15.0)
MIN_WEIGHT, MAX_WEIGHT = 2.0, 1e6


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words from ``_words``: the words inside 3-word windows found twice or more.

    Windows are compared by a 64-bit hash of the words' hashes. They are sorted with their
    places only in documents where some window repeats.
    """
    hashed = df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w))).withColumn(
        "_win",
        F.expr("IF(size(_h) < 3, CAST(array() AS array<bigint>), "
               "transform(sequence(0, size(_h) - 3), i -> xxhash64(_h[i], _h[i + 1], _h[i + 2])))"),
    )
    sorted_windows = hashed.withColumn(
        "_s",
        F.expr("IF(size(array_distinct(_win)) = size(_win), NULL, "
               "array_sort(transform(_win, (h, i) -> struct(h AS h, i AS i))))"),
    )
    placed = sorted_windows.withColumn(
        "_p",
        F.expr("array_sort(transform(filter(_s, (x, j) -> (j > 0 AND get(_s, j - 1).h = x.h) "
               "OR (j < size(_s) - 1 AND get(_s, j + 1).h = x.h)), x -> x.i))"),
    )
    covered = F.expr("aggregate(transform(_p, (p, j) -> IF(j < size(_p) - 1, least(3, get(_p, j + 1) - p), 3)), 0L, (a, x) -> a + x)")
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_h", "_win", "_s", "_p")


def document_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The table with the rules' counts and ``base_failed``."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    counted = (
        docs.drop(*COUNTS, "base_failed", "kept", "rule_failed")
        .withColumn("_words", words_of(text))
        .withColumn("_lines", lines)
        .withColumn("n_words", F.size("_words").cast("bigint"))
        .withColumn("word_chars", _without(value, SPACES).cast("bigint"))
        .withColumn("n_symbols", (F.length(value) - _without(value, SYMBOLS)).cast("bigint"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return _repeat_words(counted).drop("_words", "_lines").withColumn("base_failed", failed)


def rule_failed() -> Column:
    """Whether a document fails the base rule or one of the rules that count for its host."""
    n = F.col("n_words")
    return (
        F.col("base_failed")
        | (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n)
        | (F.col("n_dup_lines") > MAX_DUP_LINES_PER_WORD * n)
        | (F.col("word_chars") < WORD_CHARS[0] * n)
        | (F.col("word_chars") > WORD_CHARS[1] * n)
    )


def host_verdicts(counts: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, host_docs, host_failures, host_rate, host_rejected), one row per non-null host.

    With n_h documents and rate r_h per host, m is the mean and v the variance of the rates
    over hosts, less the variance m(1-m)/n_h that equal hosts would show on average. The
    prior weighs m(1-m)/v - 1 documents, kept between 2 and a million.
    """
    hosts = stored(
        counts.where(F.col(host).isNotNull()).groupBy(host).agg(
            F.count("*").alias("host_docs"), F.sum(rule_failed().cast("bigint")).alias("host_failures")
        ),
        "hosts",
    )
    rate = F.col("host_failures") / F.col("host_docs")
    row = hosts.agg(
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("variance"), F.avg(1 / F.col("host_docs")).alias("noise")
    ).first()
    mean, spread = row["mean"] or 0.0, mean_spread(row["mean"] or 0.0)
    own = max((row["variance"] or 0.0) - spread * (row["noise"] or 0.0), 0.0)
    weight = MAX_WEIGHT if own == 0 else min(max(spread / own - 1, MIN_WEIGHT), MAX_WEIGHT)
    shrunk = (F.col("host_failures") + mean * weight) / (F.col("host_docs") + weight)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", F.col("host_rate") > max_rate)


def mean_spread(mean: float) -> float:
    return mean * (1 - mean)


def judge(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The table with counts, ``base_failed`` and ``kept``.

    The texts are read once for the verdicts and once for the result; nothing wide is shuffled.
    """
    return _judged(document_counts(docs, text), host, max_rate)


def passing(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The kept rows, in the same columns.

    The texts are counted once: the counts are stored with the rows that pass the base rules,
    the others leave only their counts for their host's rate.
    """
    rows = docs.select(F.col(text).alias("_text"), F.col(host).alias("_host"), F.struct(*docs.columns).alias("_original"))
    counted = document_counts(rows, "_text").drop("_text")
    counts = stored(counted.withColumn("_original", F.when(~F.col("base_failed"), F.col("_original"))), "counted-rows")
    return _judged(counts, "_host", max_rate).where("kept").select("_original.*")


def _judged(counts: DataFrame, host: str, max_rate: float) -> DataFrame:
    bad = stored(
        host_verdicts(counts, host, max_rate).where("host_rejected").select(host, F.lit(True).alias("_bad")),
        "bad-hosts",
    )
    kept = ~F.col("base_failed") & F.col("_bad").isNull()
    return join_few(counts, bad, [host]).withColumn("kept", kept).drop("_bad")


def report(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """doc_id, counts, base_failed, kept. The narrow counts are stored, so texts are read once."""
    narrow = docs.select("doc_id", F.col(host).alias("_host"), F.col(text).alias("_text"))
    counts = stored(document_counts(narrow, "_text").drop("_text"), "document-counts")
    return _judged(counts, "_host", max_rate).select("doc_id", *COUNTS, "base_failed", "kept")


# The same in DuckDB's SQL, over ``documents``.
SQL = f"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\x09-\\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
twice AS (SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM windows JOIN twice USING (doc_id, win)) GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
failed AS (
  SELECT *, base_failed OR n_symbols > {MAX_SYMBOLS_PER_WORD} * n_words OR n_dup_lines > {MAX_DUP_LINES_PER_WORD} * n_words
            OR word_chars < {WORD_CHARS[0]} * n_words OR word_chars > {WORD_CHARS[1]} * n_words AS f FROM judged),
hosts AS (SELECT source, count(*) AS n, sum(f::INT) AS k FROM failed WHERE source IS NOT NULL GROUP BY source),
moments AS (SELECT avg(k / n) AS m, greatest(var_pop(k / n) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n), 0) AS v FROM hosts),
prior AS (SELECT m, CASE WHEN v = 0 THEN {MAX_WEIGHT} ELSE least(greatest(m * (1 - m) / v - 1, {MIN_WEIGHT}), {MAX_WEIGHT}) END AS weight
          FROM moments),
bad AS (SELECT source FROM hosts, prior WHERE (k + m * weight) / (n + weight) > {MAX_HOST_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM failed"""
