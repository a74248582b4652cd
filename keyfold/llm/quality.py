"""Quality rules per document, and verdicts on the hosts that documents come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.store import small_side, staged

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Limits:
    """What a document may show, and what share of failures a host may have.

    ``symbols`` is symbols per word, ``dup_lines`` the share of lines seen before,
    ``repeats`` the percentage of words in repeated windows. A host is rejected when its
    shrunk failure rate is over ``host_rate``.
    """

    min_words: int = 20
    repeats: int = 30
    symbols: float = 0.1
    dup_lines: float = 0.3
    host_rate: float = 0.5


def measured(docs: DataFrame, text_col: str = "text", prefix: str = "_q_") -> DataFrame:
    """Add the measures of every whole text, and ``lines``, as ``prefix`` columns.

    Null and empty texts measure 0 throughout. Repeated windows are found by sorting a
    text's window hashes with their places, so a long text costs n log n.
    """
    words, hashes, places = f"{prefix}words", f"{prefix}hashes", f"{prefix}places"
    starts, lines, text = f"{prefix}starts", f"{prefix}all_lines", f"{prefix}text"
    have = list(docs.columns)
    step = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    step = step.select(
        *have,
        text,
        F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " "), "").alias(words),
        F.filter(F.split(text, "\n"), lambda line: F.trim(F.translate(line, _SPACES, " " * 6)) != "")
        .alias(lines),
    )
    step = step.select(
        *have, text, lines, F.transform(words, lambda w: F.xxhash64(w)).alias(words)
    )
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(_WINDOW)])
    step = step.select(
        *have,
        text,
        lines,
        F.size(words).cast("long").alias(f"{prefix}n_words"),
        F.when(
            F.size(words) >= _WINDOW,
            F.transform(F.sequence(F.lit(0), F.size(words) - _WINDOW), window),
        ).alias(hashes),
    )
    step = step.withColumn(
        places,
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    again = lambda x, k: (F.get(places, k - 1)["h"] == x["h"]) | (
        F.get(places, k + 1)["h"] == x["h"]
    )
    step = step.withColumn(
        starts,
        F.when(
            F.col(places).isNotNull(),
            F.sort_array(F.transform(F.filter(places, again), lambda x: x["i"])),
        ),
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-_WINDOW).alias("last"), F.lit(0).alias("sum")),
        lambda acc, at: F.struct(
            at.alias("last"), (acc["sum"] + F.least(F.lit(_WINDOW), at - acc["last"])).alias("sum")
        ),
        lambda acc: acc["sum"],
    )
    return step.select(
        *have,
        f"{prefix}n_words",
        F.length(F.translate(text, _SPACES, "")).cast("long").alias(f"{prefix}word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, "")))
        .cast("long")
        .alias(f"{prefix}n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(f"{prefix}n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias(f"{prefix}n_repeat_words"),
        F.size(lines).cast("long").alias(f"{prefix}lines"),
    )


def base_failed(limits: Limits, prefix: str = "_q_") -> Column:
    words = F.col(f"{prefix}n_words")
    return (words < limits.min_words) | (
        F.col(f"{prefix}n_repeat_words") * 100 > words * limits.repeats
    )


def failed(limits: Limits, prefix: str = "_q_") -> Column:
    """Whether a document fails any rule: the base rules, symbols, or repeated lines."""
    return (
        base_failed(limits, prefix)
        | (F.col(f"{prefix}n_symbols") > F.col(f"{prefix}n_words") * limits.symbols)
        | (F.col(f"{prefix}n_dup_lines") > F.col(f"{prefix}lines") * limits.dup_lines)
    )


def host_verdicts(docs: DataFrame, host_col: str, limits: Limits, prefix: str = "_q_") -> DataFrame:
    """``host, n_docs, n_failed, rate, rejected``: one row per host, null being a host too.

    The failure rates of hosts are taken for draws from a beta distribution. Its mean and
    spread come from the moments over all hosts, less the spread that counting alone gives.
    A host's rate is its posterior mean, so that a host with few documents stays near the
    mean of all, and one with many near its own rate. With one host, or hosts no more
    different than chance, every host gets the common mean.

    Hosts are summed before the shuffle; the prior is two numbers.
    """
    hosts = staged(
        docs.groupBy(F.col(host_col).alias("host")).agg(
            F.count("*").alias("n_docs"),
            F.sum(failed(limits, prefix).cast("long")).alias("n_failed"),
        ),
        "quality-hosts",
    )
    rate = F.col("n_failed") / F.col("n_docs")
    sums = hosts.agg(
        F.sum("n_docs"), F.sum("n_failed"), F.avg(rate), F.var_pop(rate), F.avg(1 / F.col("n_docs"))
    ).first()
    docs_all, failed_all, mean, spread, per_doc = (float(v or 0.0) for v in sums)
    between = spread - mean * (1 - mean) * per_doc
    if between > 0 and 0 < mean < 1:
        weight = max(mean * (1 - mean) / between - 1, 1e-6)
    else:
        weight = 1e9
        mean = failed_all / docs_all if docs_all else 0.0
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("rate", shrunk).withColumn("rejected", shrunk > limits.host_rate)


def with_verdicts(
    docs: DataFrame, host_col: str, limits: Limits = Limits(), prefix: str = "_q_"
) -> DataFrame:
    """Join host verdicts to measured rows; adds ``{prefix}base_failed`` and ``{prefix}kept``.

    A document is kept if it fails no rule and its host is not rejected. ``docs`` is used
    twice, so pass rows that are staged.
    """
    hosts = host_verdicts(docs, host_col, limits, prefix)
    side = small_side(
        hosts.select(F.col("host").alias(f"{prefix}host"), F.col("rejected").alias(f"{prefix}bad")),
        row_bytes=256,
    )
    joined = docs.join(side, F.col(host_col).eqNullSafe(F.col(f"{prefix}host")), "left")
    return joined.withColumn(f"{prefix}base_failed", base_failed(limits, prefix)).withColumn(
        f"{prefix}kept",
        ~failed(limits, prefix) & ~F.coalesce(F.col(f"{prefix}bad"), F.lit(False)),
    )


def report(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every document.

    Texts are read once: their measures are staged, a few numbers per document.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(host_col).cast("string").alias("host"),
    )
    rows = staged(measured(rows).drop("text"), "quality-measures")
    found = with_verdicts(rows, "host", limits)
    columns = [*MEASURES, "base_failed", "kept"]
    return found.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in columns])


def keep(
    docs: DataFrame, limits: Limits = Limits(), text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """The rows of kept documents, with all their columns."""
    columns = list(docs.columns)
    rows = staged(measured(docs, text_col), "quality-documents")
    return with_verdicts(rows, host_col, limits).filter("_q_kept").select(*columns)
