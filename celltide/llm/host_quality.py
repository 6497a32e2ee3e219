"""Quality rules for documents and hosts, in DataFrame functions only.

Base rules judge a text alone.  Host rules count for each host (``source``) how many of its documents break each rule,
and shrink the rates with a beta prior fitted to all hosts (method of moments), so that a host of few documents is not
judged by chance.  A host's verdict on a rule is its lift, the shrunk rate over the prior's mean: 1 for an ordinary host,
more for one that breaks the rule more often than hosts do.  Joined back, it weighs how far a document itself breaks the
rule: the document goes if excess times lift is over ``VERDICT``.  So a document just over a rule's limit goes on a host of
twice the usual rate, and one that is twice over it goes on an ordinary host, but stays on a host that hardly ever breaks
the rule.  A document that breaks no rule is never rejected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.llm.common import staged

LEAST_WORDS, REPEAT_PERCENT = 50, 50
#: A document goes if, on some host rule, its excess times its host's lift is more than this.
VERDICT = 2
BLANK = r"[ \t\n\x0B\f\r]+"
SYMBOLS = r"[^#*$%&|<>]+"
#: (measure, limit) of each rule: a document breaks it if the measure is over the limit, and their ratio is its excess.  One line that
#: comes twice is no pattern.
BASE_RULES = {"short": (f"{LEAST_WORDS}", "n_words"), "repetitive": ("100 * n_repeat_words", f"{REPEAT_PERCENT} * n_words")}
HOST_RULES = {"symbols": ("2 * n_symbols", "n_words"), "repeated_lines": ("100 * (n_dup_lines - 1)", "30 * n_lines"), "long_words": ("word_chars", "15 * n_words")}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _words(text: Column) -> Column:
    stripped = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, BLANK))


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` (``text`` and ``row``, a struct to carry) with the measures of each text instead of the text.

    Three-word windows are compared by a 64-bit hash, of which a document of n words leaves 64 - log2(n) bits: a key is
    hash and position, sorted, so that equal windows are neighbours.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    cut = rows.select("row", _words(text).alias("words"), lines.alias("lines"), F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"))
    counted = cut.select(
        "row", "words", "n_symbols", F.size("words").alias("n"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.bin(F.size("words"))).alias("bits"))
    keys = F.expr("""sort_array(if(n < 3, cast(array() as array<bigint>), transform(sequence(0, n - 3),
        i -> shiftleft(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)), bits) | cast(i as bigint))))""")
    keyed = counted.withColumn("keys", keys)
    repeated = F.expr("""filter(transform(keys, (k, j) -> if(shiftright(k, bits) <=> shiftright(get(keys, j - 1), bits)
        or shiftright(k, bits) <=> shiftright(get(keys, j + 1), bits), cast(k & (shiftleft(1L, bits) - 1) as int), -1)), i -> i >= 0)""")
    covered = F.expr("""aggregate(sort_array(at), named_struct('n', 0L, 'until', 0), (a, i) -> named_struct(
        'n', a.n + cast(i + 3 - greatest(a.until, i) as bigint), 'until', i + 3), a -> a.n)""")
    found = keyed.withColumn("at", repeated).withColumn("n_repeat_words", covered)
    # by way of a generator: a filter on a measure stays above it, and the planner does not put the measure's whole
    # expression, which sorts a text's windows, into the filter once for every use
    values = F.struct(F.col("n").cast("long").alias("n_words"), *MEASURES[1:])
    return found.select("row", F.inline(F.array(values)))


def _breaks(rule: tuple[str, str]) -> Column:
    return F.expr(f"{rule[0]} > {rule[1]}")


def host_verdicts(documents: DataFrame, host: str = "source") -> DataFrame:
    """(host, n, <rule>_rate, <rule>_lift) for each host of ``documents`` with measures; a null host is no host.

    A rule that no document breaks has lift 1 everywhere.  Lifts are rounded to nine decimals, as sums of rates are.
    """
    broken = {r: F.count_if(_breaks(rule)).cast("double").alias(r) for r, rule in HOST_RULES.items()}
    hosts = documents.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").cast("double").alias("n"), *broken.values())
    hosts = staged(hosts, "hosts")
    moments = hosts.agg(F.sum("n").alias("total"), *(f(F.col(r) / F.col("n")).alias(f"{r}_{k}") for r in broken for k, f in (("mean", F.avg), ("var", F.var_pop)))).first()  # one row

    def posterior(r: str) -> list[Column]:
        mean, var = moments[f"{r}_mean"] or 0.0, moments[f"{r}_var"] or 0.0
        strength = max(0.0, mean * (1 - mean) / var - 1) if var > 0 else (moments["total"] or 0.0)
        rate = (F.col(r) + mean * strength) / (F.col("n") + strength)
        return [rate.alias(f"{r}_rate"), (F.round(rate / mean, 9) if mean > 0 else F.lit(1.0)).alias(f"{r}_lift")]

    return hosts.select("host", "n", *(c for r in broken for c in posterior(r)))


def judged(documents: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """``documents`` with measures, and ``base_failed`` and ``kept`` by their own measures and their host's verdicts."""
    bad = F.lit(False)
    for r, (measure, limit) in HOST_RULES.items():
        far = F.expr(measure) * F.col(f"{r}_lift") > VERDICT * F.expr(limit)
        bad = bad | (_breaks((measure, limit)) & F.coalesce(far, F.lit(False)))
    failed = reduce(Column.__or__, map(_breaks, BASE_RULES.values()))
    joined = documents.join(verdicts.drop("n"), documents[host] == verdicts["host"], "left")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~bad)


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``source``, ``text``): ``doc_id``, measures, ``base_failed``, ``kept``.

    Null text is a text without words.  A row without a source is judged by the base rules alone.  Repeated rows are
    separate documents.  An empty table gives an empty result.  Other columns are ignored.
    """
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    texts = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    table = staged(measured(texts).select("row.*", *MEASURES), "measures")
    return judged(table, host_verdicts(table)).select("doc_id", *MEASURES[:-1], "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    Measures are taken once, and staged without the texts.  Rows of one source and text have one verdict, so the rejected
    (source, digest of the text) are taken out of ``docs`` by an anti join.
    """
    text = F.col("text").cast("string")
    key = [F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_host"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("_digest")]
    row = F.struct(F.col("source").cast("string").alias("source"), *key)
    table = staged(measured(docs.select(row.alias("row"), text.alias("text"))).select("row.*", *MEASURES), "measures")
    rejected = judged(table, host_verdicts(table)).filter("not kept").select("_host", "_digest").distinct()
    return docs.select("*", *key).join(staged(rejected, "rejected"), ["_host", "_digest"], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
tri AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM tri) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines FROM w LEFT JOIN cov ON w.r = cov.r),
rules AS (SELECT *, """ + " OR ".join(f"{a} > {b}" for a, b in BASE_RULES.values()) + """ AS base_failed,
                 [""" + ", ".join(f"({a})::DOUBLE" for a, _ in HOST_RULES.values()) + """] AS measure, [""" + ", ".join(f"({b})::DOUBLE" for _, b in HOST_RULES.values()) + """] AS lim FROM m),
h AS (SELECT source, k, count(*)::DOUBLE AS n, count(*) FILTER (measure[k] > lim[k])::DOUBLE AS f
      FROM rules, (SELECT unnest(range(1, """ + str(len(HOST_RULES) + 1) + """)) AS k) WHERE source IS NOT NULL GROUP BY ALL),
p AS (SELECT k, avg(f / n) AS mean, var_pop(f / n) AS var, sum(n) AS total FROM h GROUP BY k),
s AS (SELECT k, mean, CASE WHEN var > 0 THEN greatest(0, mean * (1 - mean) / var - 1) ELSE total END AS strength FROM p),
v AS (SELECT source, list(CASE WHEN mean > 0 THEN round((f + mean * strength) / (n + strength) / mean, 9) ELSE 1 END ORDER BY h.k) AS lift
      FROM h JOIN s ON h.k = s.k GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(list_filter(range(1, """ + str(len(HOST_RULES) + 1) + """), lambda k: measure[k] > lim[k] AND coalesce(measure[k] * lift[k] > """ + str(VERDICT) + """ * lim[k], false))) = 0 AS kept
FROM rules LEFT JOIN v ON rules.source = v.source
"""
