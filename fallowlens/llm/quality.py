"""Quality rules with cutoffs whose false rejections are bounded in every stratum.

Each rule rejects a document whose signal reaches a cutoff. The cutoffs are chosen on
labelled documents: within a stratum and for a rule, candidate cutoffs are tested from
the laxest to the strictest, and the last one passes whose exact binomial bound on the
share of good documents rejected stays below the rule's part of the risk. Testing in
that fixed order needs no correction for the number of candidates; strata and rules
are corrected for by Bonferroni. A stratum with too little evidence gets no cutoff,
so nothing is rejected there by a rule.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import maybe_broadcast, rows, stored, texts_of

SYMBOLS = "#*$%&|<>"
NGRAM = 5
RULES = ("symbol_share", "upper_share", "line_share", "repeat_share", "mark_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]")


@dataclass(frozen=True)
class Params:
    """``risk``: share of good documents of a stratum that all rules together may reject.
    ``error``: chance that the bound fails anywhere. ``bins``: candidate cutoffs a rule."""

    risk: float = 0.02
    error: float = 0.05
    bins: int = 64
    min_words: int = 10
    max_repeat_percent: int = 20


def repeated_positions(words: list[bytes], n: int = NGRAM) -> int:
    """Words that stand in an n-word window found twice or more, the first one included."""
    if len(words) <= n:
        return 0
    windows = list(zip(*(words[k:] for k in range(n))))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total = end = 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            total += i + n - max(i, end)
            end = i + n
    return total


def measure(text: str) -> tuple:
    """``COUNTS``, then the signals of ``RULES``, of one whole text."""
    words = text.encode("utf-8", "replace").split()
    blanks = sum(map(text.count, " \t\n\r\x0b\x0c"))
    chars = len(text) - blanks
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")] if "\n" in text else []
    duplicates = len(lines) - len(set(lines))
    repeated = repeated_positions(words)
    marks = text.count("!") + text.count("?")
    share = lambda part, whole: part / whole if whole else 0.0
    return (
        len(words), chars, symbols, duplicates, repeated,
        share(symbols, chars), share(len(_UPPER.findall(text)), chars), share(duplicates, len(lines)),
        share(repeated, len(words)), share(marks, chars),
    )


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str | None = "lang") -> DataFrame:
    """Counts and signals per row, with ``id`` and ``stratum`` (null as ``-``)."""
    schema = pa.schema([(n, pa.int64()) for n in COUNTS] + [(n, pa.float64()) for n in RULES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t) for t in texts_of(batch)]
            columns = rows(schema, **dict(zip(schema.names, map(list, zip(*found)) if found else [[]] * len(schema))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("stratum"), *columns.columns], names=["id", "stratum", *schema.names]
            )

    group = F.lit("-") if stratum is None else F.coalesce(F.col(stratum).cast("string"), F.lit("-"))
    taken = docs.select(F.col(doc_id).alias("id"), group.alias("stratum"), F.col(text).alias("text"))
    kind = taken.schema["id"].dataType.simpleString()
    ddl = ", ".join([f"id {kind}", "stratum string", *(f"{n} long" for n in COUNTS), *(f"{n} double" for n in RULES)])
    return taken.mapInArrow(run, ddl)


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for a binomial X of n trials with chance p."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    terms = log_fact[n] - log_fact[i] - log_fact[n - i] + i * math.log(p) + (n - i) * math.log1p(-p)
    top = terms.max()
    return float(min(1.0, math.exp(top) * np.exp(terms - top).sum()))


def choose_cutoff(rejected: list[int], n: int, risk: float, error: float) -> int | None:
    """Strictest bin that passes. ``rejected[b]``: good documents whose signal is in bin b or above.

    The exact upper bound on the share rejected is below ``risk`` just when a binomial
    with chance ``risk`` is that small with a chance of at most ``error``.
    """
    chosen = None
    for b in range(len(rejected) - 1, 0, -1):
        if n == 0 or at_most(rejected[b], n, risk) > error:
            break
        chosen = b
    return chosen


def cutoffs(measured: DataFrame, labels: DataFrame, label_id: str, good: str, params: Params) -> DataFrame:
    """(stratum, rule, cutoff), a row for each rule that a stratum can support.

    The good labelled documents are counted by stratum, rule and bin in Spark; a
    stratum's counts are at most ``rules x bins`` rows, in which its cutoffs are chosen.
    """
    labelled = labels.where(F.col(good) == 1).select(F.col(label_id).alias("id")).distinct()
    signal = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES)))
    counts = stored(
        measured.join(labelled, "id", "left_semi")
        .select("stratum", signal.alias("s"))
        .select("stratum", "s.rule", F.least(F.floor(F.col("s.value") * params.bins), F.lit(params.bins - 1)).cast("int").alias("bin"))
        .groupBy("stratum", "rule", "bin")
        .count(),
        "quality-counts",
    )
    tests = max(1, counts.select("stratum").distinct().count() * len(RULES))
    risk, error, bins = params.risk / len(RULES), params.error / tests, params.bins

    def choose(key, table):
        per_bin = np.bincount(table["bin"], weights=table["count"], minlength=bins).astype(int)
        above = per_bin[::-1].cumsum()[::-1]
        chosen = choose_cutoff(above.tolist(), int(above[0]), risk, error)
        table = table.iloc[:1][["stratum", "rule"]].assign(cutoff=-1.0 if chosen is None else chosen / bins)
        return table[table["cutoff"] >= 0]

    return stored(
        counts.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff double"),
        "quality-cutoffs",
    )


def limits(measured: DataFrame, labels: DataFrame, label_id: str, good: str, params: Params) -> DataFrame:
    """(stratum, limits): each stratum's cutoffs as a map by rule."""
    chosen = cutoffs(measured, labels, label_id, good, params)
    entries = F.map_from_entries(F.collect_list(F.struct("rule", "cutoff")))
    return maybe_broadcast(stored(chosen.groupBy("stratum").agg(entries.alias("limits")), "quality-limits"))


def base_failed(params: Params) -> Column:
    return (F.col("n_words") < params.min_words) | (
        100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words")
    )


def failed_rules(params: Params) -> Column:
    """Names of the rules whose cutoff in ``limits`` the row's signals reach."""
    reached = [F.floor(F.col(r) * params.bins) / params.bins >= F.element_at("limits", r) for r in RULES]
    names = F.array(*(F.when(x, F.lit(r)) for r, x in zip(RULES, reached)))
    return F.coalesce(F.array_compact(names), F.array().cast("array<string>"))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str | None = "lang",
    label_id: str = "doc_id",
    good: str = "quality",
    params: Params | None = None,
) -> DataFrame:
    """One row per document: id, the five counts, ``base_failed``, ``kept`` and ``failed_rules``.

    A null or empty text has no words and fails the base rule. A null stratum is the
    stratum ``-``; a null id matches no label. Repeated rows are judged each, and a
    document labelled twice counts once in its stratum's evidence. Without labels no
    rule gets a cutoff, so the base rule alone decides. Whole texts are measured, of any
    length. A signal that equals its cutoff rejects, and of cutoffs that pass the strictest
    is taken. Extra columns are left out; an empty table gives an empty result.
    """
    params = params or Params()
    measured = stored(features(docs, doc_id, text, stratum), "quality-features")
    return (
        measured.join(limits(measured, labels, label_id, good, params), "stratum", "left")
        .select("id", *COUNTS, base_failed(params).alias("base_failed"), failed_rules(params).alias("failed_rules"))
        .select(F.col("id").alias(doc_id), *COUNTS, "base_failed",
                (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules")
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", params: Params | None = None
) -> DataFrame:
    """The documents that pass, with their own columns; every row is judged by itself.

    Null and empty texts fail the base rule and go; repeated rows go or stay alike. Extra
    columns, whatever their names, stay; an empty table gives an empty one.

    Only measures are gathered for the cutoffs. The texts are measured again where they
    are filtered, which is cheaper than moving them to their verdicts.
    """
    params = params or Params()
    measured = stored(features(docs, doc_id, text, stratum), "quality-features")
    per_stratum = limits(measured, labels, "doc_id", "quality", params)
    ddl = ", ".join([*(f"{n} long" for n in COUNTS), *(f"{n} double" for n in RULES)])

    @F.pandas_udf(f"struct<{ddl.replace(' ', ':').replace(',:', ', ')}>")
    def measures(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t or "") for t in texts], columns=[*COUNTS, *RULES])

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    packed = docs.select(
        row, F.coalesce(F.col(stratum).cast("string"), F.lit("-")).alias("own_stratum"), measures(F.col(text)).alias("m")
    ).select("row", "own_stratum", "m.*")
    judged = packed.join(per_stratum, packed["own_stratum"] == per_stratum["stratum"], "left")
    return judged.where(~base_failed(params) & (F.size(failed_rules(params)) == 0)).select("row.*")
