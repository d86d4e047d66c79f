"""Host-level quality rules: documents are measured by rules, failures are counted by host, the rates are shrunk with a
beta prior fitted to all hosts, and the host's verdict sets how strict the rules are for its documents.

DataFrame functions only. A document's measures never leave its row; the one shuffle is the count by host, combined in
each map task first, so a host with a third of all rows sends a few counts per task.

Defined results: null text counts as empty (no words, fails the base rule); a null host is a host of its own; repeated
rows are judged alike, each on its own; an empty table gives an empty result; columns of the input are kept whatever
their names, because the measures live in one struct whose name is chosen free of clashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafile.functions.presence import compute_once
from stratafile.llm.tables import stored, text_or_empty

SPACE = r"[ \t\n\x0B\f\r]"
SYMBOLS = r"[#*$%&|<>]"
SOFT = ["symbols", "dup_lines", "word_length", "shouting"]


@dataclass(frozen=True)
class Rules:
    """Thresholds. A soft rule fails on a share of the document's own words, lines or characters."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_percent: int = 20
    #: Text that is mostly symbols counts as two soft failures.
    extreme_symbol_percent: int = 40
    max_dup_line_percent: int = 30
    min_word_chars: int = 3
    max_word_chars: int = 15
    max_upper_percent: int = 50
    #: A host whose shrunk failure rate is above this loses the benefit of the doubt.
    max_host_rate: float = 0.5
    #: Soft failures that reject a document of a host in good and in bad standing.
    soft_failures: int = 2
    soft_failures_bad_host: int = 1


def free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def repeat_words(words: Column) -> Column:
    """Words of the text that lie in a 5-word window found twice or more in it.

    Windows become 64-bit hashes. Only a text that has equal ones sorts them, by (hash, position).
    """
    n = F.size(words)
    hashes = F.transform(
        F.slice(words, F.lit(1), F.greatest(n - 4, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2), F.get(words, i + 3), F.get(words, i + 4)),
    )
    return hashes


def _covered(positions: Column) -> Column:
    """Words under 5-word windows at these ascending positions: each adds what reaches past the one before."""
    last = F.size(positions) - 1
    added = F.transform(
        positions, lambda p, j: F.when(j == last, F.lit(5)).otherwise(F.least(F.lit(5), F.get(positions, j + 1) - p))
    )
    return F.aggregate(added, F.lit(0), lambda total, x: total + x)


def measured(docs: DataFrame, text: str = "text", rules: Rules = Rules(), out: str = "_quality") -> DataFrame:
    """Adds a struct of measures and rule failures. The steps are separate projections, so each array is made once."""
    body, words, win, dup = (free_name(docs, x) for x in ("_body", "_words", "_win", "_dup"))
    df = docs.withColumn(body, text_or_empty(text))
    trimmed = F.regexp_replace(F.col(body), rf"^{SPACE}+|{SPACE}+\z", "")
    df = df.withColumn(
        words, F.when(F.length(trimmed) > 0, F.split(trimmed, f"{SPACE}+")).otherwise(F.array().cast("array<string>"))
    )
    df = df.withColumn(win, repeat_words(F.col(words)))
    ordered = F.sort_array(F.transform(F.col(win), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(
        dup, F.when(F.size(F.array_distinct(F.col(win))) < F.size(F.col(win)), ordered)
    ).drop(win)
    row = F.col(dup)
    repeated = F.filter(
        row,
        lambda s, j: (s["h"] == F.get(row, j + 1)["h"]) | ((j > 0) & (s["h"] == F.get(row, j - 1)["h"])),
    )
    positions = F.sort_array(F.transform(repeated, lambda s: s["i"]))
    df = df.withColumn(dup, positions)
    joined, lines = F.array_join(F.col(words), ""), F.filter(F.split(F.col(body), "\n", -1), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    raw = F.struct(
        F.size(words).cast("bigint").alias("n_words"),
        F.length(joined).cast("bigint").alias("word_chars"),
        F.regexp_count(F.col(body), F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col(dup).isNotNull(), _covered(F.col(dup))).otherwise(F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.length(F.regexp_replace(joined, "[^A-Z]+", "")).cast("bigint").alias("n_upper"),
    )
    df = df.withColumn(body, raw).drop(words, dup)
    m = {k: F.col(body)[k] for k in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")}
    base = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.max_repeat_percent * m["n_words"])
    extreme = 100 * m["n_symbols"] > rules.extreme_symbol_percent * m["n_words"]
    soft = {
        "symbols": 100 * m["n_symbols"] > rules.max_symbol_percent * m["n_words"],
        "dup_lines": 100 * m["n_dup_lines"] > rules.max_dup_line_percent * m["n_lines"],
        "word_length": (m["word_chars"] < rules.min_word_chars * m["n_words"]) | (m["word_chars"] > rules.max_word_chars * m["n_words"]),
        "shouting": 100 * m["n_upper"] > rules.max_upper_percent * m["word_chars"],
    }
    fields = [v.alias(k) for k, v in m.items()] + [base.alias("base_failed")] + [soft[k].alias(f"fails_{k}") for k in SOFT]
    points = sum((soft[k].cast("int") for k in SOFT), extreme.cast("int"))
    fields.append(points.alias("soft_failures"))
    # a filter on the measures must not be pushed below, where it would repeat them once per use
    return compute_once(df, **{out: F.struct(*fields)}).drop(body)


def host_rates(df: DataFrame, host: str = "source", measures: str = "_quality", rules: Rules = Rules()) -> DataFrame:
    """One row per host: documents, failures by rule, and the shrunk rate of documents that fail any rule.

    The beta prior has the mean of all documents and the spread between hosts (method of moments). Its two numbers are
    all that reaches the driver.
    """
    q = F.col(measures)
    failures = {"base": q["base_failed"]} | {k: q[f"fails_{k}"] for k in SOFT}
    any_failed = q["base_failed"]
    for k in SOFT:
        any_failed = any_failed | q[f"fails_{k}"]
    counts = df.groupBy(F.col(host).cast("string").alias("_host")).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(any_failed.cast("bigint")).alias("failed"),
        *[F.sum(c.cast("bigint")).alias(f"failed_{k}") for k, c in failures.items()],
    )
    counts = stored(counts, "hosts")
    n, f = F.col("documents").cast("double"), F.col("failed").cast("double")
    mean = F.sum("failed").cast("double") / F.sum("documents").cast("double")
    spread = F.sum(f * f / n)
    first = counts.agg(mean.alias("mean"), spread.alias("squares"), F.sum("documents").alias("n")).first()
    strength, m = 2.0, 0.5
    if first["n"]:
        m = first["mean"]
        variance = max(first["squares"] / first["n"] - m * m, 0.0)
        strength = min(max(m * (1 - m) / variance - 1, 2.0), 1e4) if variance > 0 else 1e4
    shrunk = (f + F.lit(m * strength)) / (n + F.lit(strength))
    return counts.withColumn("rate", shrunk).withColumn("distrusted", shrunk > F.lit(rules.max_host_rate))


def judged(df: DataFrame, hosts: DataFrame, host: str = "source", measures: str = "_quality", rules: Rules = Rules(), out: str = "_kept") -> DataFrame:
    """Joins the host verdicts back: ``out`` is false for a document that the rules reject at its host's strictness."""
    key, bad = free_name(df, "_host"), free_name(df, "_distrusted")
    verdicts = hosts.select(F.col("_host").alias(key + "_v"), F.col("distrusted").alias(bad))
    joined = df.withColumn(key, F.col(host).cast("string")).join(
        verdicts, F.col(key).eqNullSafe(F.col(key + "_v")), "left"
    )
    q = F.col(measures)
    most = F.when(F.col(bad), rules.soft_failures_bad_host).otherwise(rules.soft_failures)
    return joined.withColumn(out, ~q["base_failed"] & (q["soft_failures"] < most)).drop(key, key + "_v", bad)


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", rules: Rules = Rules()) -> tuple[DataFrame, str, str]:
    """The judged documents with all their columns, and the names of the struct of measures and of the verdict.

    Documents are measured twice, once for the hosts and once for their own verdict, so that no text is stored.
    """
    q, kept = free_name(docs, "_quality"), free_name(docs, "_kept")
    hosts = host_rates(measured(docs.select(F.col(text), F.col(host)), text, rules, q), host, q, rules)
    return judged(measured(docs, text, rules, q), hosts, host, q, rules, kept), q, kept


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """Documents that the rules keep, with their own columns."""
    df, q, kept = quality_rules(docs, text, host, rules)
    return df.where(F.col(kept)).drop(q, kept)


def quality_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The query's columns, one row per document."""
    df, q, kept = quality_rules(docs.select("doc_id", "text", "source"), rules=rules)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return df.select("doc_id", *[F.col(q)[c].alias(c) for c in names], F.col(kept).alias("kept"))
