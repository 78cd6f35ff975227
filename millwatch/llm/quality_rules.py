"""Quality rules with risk-controlled cutoffs.

Each rule is a ratio of two counts of a text, larger for worse texts, put on a fixed grid of GRID steps. In
each stratum the labelled documents are split by a hash of their id. The smaller part proposes: a rule's cutoff
is the step with the best balance (junk rejected, less WEIGHT times clean documents rejected), the most lenient of
equals; a rule without a positive balance rejects nothing there. The other part is the holdout, which only certifies:
all proposed cutoffs, raised together by t steps, are one candidate, and a document's margin is the largest
t that still rejects it. With n clean documents in the holdout, c of them with a margin of t or more, the exact
binomial bound P(Bin(n, risk) <= c) is the p-value of "the rules raised by t reject more than `risk` of the clean
documents of this stratum". Candidates are tested from the most lenient one down and testing stops at the first
that fails (fixed sequence, so no correction along it); the last that passed is used. The error `delta` is divided by the
number of strata (Bonferroni). So with probability 1 - delta, in no stratum do all rules together reject more
than `risk` of the clean documents that pass the base rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.shared import ship, stored
from millwatch.llm.words import texts_of

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

GRID = 256  # steps of every rule; the last one holds all larger values
RISK = 0.03  # largest share of clean documents that all rules together may reject in one stratum
DELTA = 0.05  # chance that the limit is broken in any stratum
PROPOSING = "4"  # labelled documents whose id has an MD5 below this hex digit propose cutoffs: a quarter
WEIGHT = 10  # rejected clean documents count so many times as much as rejected junk
MAX_BROADCAST_STRATA = 10_000

# rule: counts (numerator, denominator) and steps per unit of the ratio
RULES = {
    "symbols": ("n_symbols", "n_words", 100),
    "capitals": ("n_upper", "word_chars", 250),
    "repeated_lines": ("n_dup_lines", "n_lines", 250),
    "long_words": ("word_chars", "n_words", 10),
    "short_words": ("n_words", "word_chars", 250),
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_UPPER: list[np.ndarray] = []


def _upper_table() -> np.ndarray:
    """Which code points are letters in capitals (general category Lu)."""
    if not _UPPER:
        import unicodedata

        table = np.zeros(0x110000, bool)
        for c in range(0x20000):  # there is none above
            table[c] = unicodedata.category(chr(c)) == "Lu"
        _UPPER.append(table)
    return _UPPER[0]


def count_text(data: bytes) -> tuple[int, ...]:
    """COUNTS of one text."""
    words = data.split()
    n = len(words)
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    spaces = sum(data.count(bytes([b])) for b in _SPACE)
    symbols = sum(data.count(bytes([b])) for b in SYMBOLS)
    lines = [line for line in data.split(b"\n") if line.split()]
    repeated = 0
    if n > 3:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
        pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
        _, group, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[group] > 1)
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[starts + k] = True
        repeated = int(covered.sum())
    upper = int(_upper_table()[points].sum())
    return n, len(points) - spaces, symbols, len(lines) - len(set(lines)), repeated, len(lines), upper


def with_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` and COUNTS of each whole text. A null text counts as empty."""
    ship(docs.sparkSession)
    columns = docs.select(*keep, F.col(text).alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [count_text(t) for t in texts_of(batch)]
            counts = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(c) for c in counts], names=[*keep, *COUNTS])

    return columns.mapInArrow(run, ", ".join([*fields, *(f"{c} bigint" for c in COUNTS)]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def step(rule: str) -> Column:
    """The grid step of a rule; null if its denominator is 0."""
    top, bottom, scale = RULES[rule]
    return F.least(F.lit(GRID - 1), F.expr(f"try_divide({top} * {scale}, {bottom})").cast("bigint")).cast("int")


def binomial_tail(n: int, risk: float) -> np.ndarray:
    """P(Bin(n, risk) <= c) for c = 0 .. n, up to the first that is close to 1."""
    last = min(n, int(n * risk + 40 * math.sqrt(n * risk + 1) + 40))
    c = np.arange(1, last + 1, dtype=np.float64)
    ratios = np.log((n - c + 1) / c) + math.log(risk / (1 - risk))
    logs = n * math.log1p(-risk) + np.concatenate([[0.0], np.cumsum(ratios)])
    return np.minimum(1.0, np.cumsum(np.exp(logs)))


def proposed(clean: np.ndarray, junk: np.ndarray) -> int | None:
    """The cutoff of best balance from the counts of clean and junk documents at each grid step; None if none is positive."""
    balance = np.cumsum(junk[::-1])[::-1] - WEIGHT * np.cumsum(clean[::-1])[::-1]
    last = GRID - 1 - int(np.argmax(balance[:0:-1]))  # the most lenient of equals
    return last if balance[last] > 0 else None


def certified(margins: np.ndarray, n: int, risk: float, error: float) -> int | None:
    """The smallest raise t for which `risk` holds, from the counts of clean documents at each margin, among `n`; None if none."""
    if not n:
        return None
    tail = binomial_tail(n, risk)
    above, found = np.cumsum(margins[::-1])[::-1], None
    for t in range(len(margins) - 1, -1, -1):
        if above[t] >= len(tail) or tail[above[t]] > error:
            break
        found = t
    return found


def cutoffs(counted: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row (stratum, one cutoff per rule or null) per stratum with labelled documents of both parts.

    Labels: doc_id and quality, 1 for clean. A document labelled twice counts with its smallest label; null
    ids and labels are ignored. Rows of one id in one stratum are one trial, with the largest step of each rule.
    A null stratum is a stratum of its own.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 1).alias("clean"))
    held = counted.where(~base_failed()).groupBy("doc_id", F.col(stratum).alias("stratum")).agg(*(F.max(step(r)).alias(r) for r in RULES))
    held = stored(held.join(marks, "doc_id").withColumn("proposes", F.substr(F.md5(F.col("doc_id").cast("string")), F.lit(1), F.lit(1)) < PROPOSING))
    kind = counted.schema[stratum].dataType.simpleString()
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES))
    grid = (
        held.where("proposes")
        .select("stratum", "clean", F.inline(rules))
        .where("step IS NOT NULL")
        .groupBy("stratum", "rule", "step")
        .agg(F.count_if("clean").alias("n_clean"), F.count_if(~F.col("clean")).alias("n_junk"))
    )

    def propose(pdf: pd.DataFrame) -> pd.DataFrame:
        clean, junk = np.zeros(GRID, np.int64), np.zeros(GRID, np.int64)
        clean[pdf["step"]], junk[pdf["step"]] = pdf["n_clean"], pdf["n_junk"]
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "rule": [pdf["rule"].iloc[0]], "cutoff": pd.array([proposed(clean, junk)], dtype="Int32")})

    chosen = grid.groupBy("stratum", "rule").applyInPandas(propose, f"stratum {kind}, rule string, cutoff int")
    chosen = stored(chosen.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cutoff_{r}") for r in RULES)))
    holdout = _with_strata(held.where("clean AND NOT proposes"), chosen, "stratum")
    margin = F.greatest(*(F.col(r) - F.col(f"cutoff_{r}") for r in RULES))
    margins = holdout.groupBy("of", F.when(margin >= 0, margin).alias("margin")).agg(F.count("*").alias("n"))
    error = delta / max(1, chosen.count())

    def certify(pdf: pd.DataFrame) -> pd.DataFrame:
        counts, rejected = np.zeros(GRID, np.int64), pdf[pdf["margin"].notna()]
        counts[rejected["margin"].astype(int)] = rejected["n"]
        raised = certified(counts, int(pdf["n"].sum()), risk, error)
        return pd.DataFrame({"of": [pdf["of"].iloc[0]], "raised": pd.array([raised], dtype="Int32")})

    raises = margins.groupBy("of").applyInPandas(certify, f"of {kind}, raised int")
    both = chosen.join(raises, F.col("stratum").eqNullSafe(F.col("of")))
    return both.select("stratum", *((F.col(f"cutoff_{r}") + F.col("raised")).alias(f"cutoff_{r}") for r in RULES))


def _with_strata(rows: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    """Rows with the limits of their stratum, null where it has none; `of` is their stratum."""
    if limits.count() <= MAX_BROADCAST_STRATA:
        limits = F.broadcast(limits)
    rows, limits = rows.withColumnRenamed(stratum, "of"), limits.withColumnRenamed("stratum", "limits_of")
    return rows.join(limits, F.col("of").eqNullSafe(F.col("limits_of")), "left").drop("limits_of")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept; then n_lines,
    n_upper and rejected_by, the first rule that rejects it (else null).

    Null and empty texts have no words and fail the base rules. Repeated rows are judged each. Documents of a
    stratum without labels are judged by the base rules alone. An empty table gives an empty result.
    """
    counted = stored(with_counts(docs, ["doc_id"] if stratum == "doc_id" else ["doc_id", stratum]))
    judged = _judged(counted, cutoffs(counted, labels, stratum, risk, delta), stratum)
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept", *COUNTS[5:], "rejected_by")


def kept_rows(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of `docs` that judge() keeps, with their columns whatever their names. Texts are counted again, not shuffled."""
    counted = stored(with_counts(docs, ["doc_id"] if stratum == "doc_id" else ["doc_id", stratum]))
    limits = cutoffs(counted, labels, stratum, risk, delta)
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(stratum).alias("stratum_of"), "text")
    return _judged(with_counts(packed, ["row", "stratum_of"]), limits, "stratum_of").where("kept").select("row.*")


def _judged(counted: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    judged = _with_strata(counted, stored(limits), stratum)
    broken = F.coalesce(*(F.when(step(r) >= F.col(f"cutoff_{r}"), F.lit(r)) for r in RULES))
    judged = judged.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.when(~F.col("base_failed"), broken))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
