"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per rule that failed; policies are masks over these bits, so a new policy, or the
effect of leaving out one of its rules, needs no second look at the texts.

Null texts count as texts without words. Repeated rows are measured row by row, an
empty table gives an empty ledger, and columns other than the two named are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worksledger.llm.common import map_texts

SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_upper long"
MEASURED = [m.split()[0] for m in MEASURES.split(", ")]

#: Rule by bit; each is SQL over the measurements, and true where a document fails.
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 14 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("capitals", "100 * n_upper > 50 * word_chars"),
]
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A version of the rules in force: those in mask, of which a document may fail `allowed`."""

    version: str
    mask: int
    allowed: int = 0


POLICIES = {
    "v1": Policy("v1", BASE | BIT["symbols"]),
    "v2": Policy("v2", (1 << len(RULES)) - 1),
}


def _measure(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(MEASURED)
    words = text.encode().split()  # bytes split at exactly the six ASCII blanks
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, end = Counter(windows), 0
        for k, window in enumerate(windows):
            if seen[window] > 1:
                repeated += k + 3 - max(end, k)
                end = k + 3
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    )


def _bits() -> Column:
    return F.expr(" + ".join(f"if({test}, {1 << k}L, 0L)" for k, (_, test) in enumerate(RULES)))


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the measurements and `fail_bits`, one bit for each rule that failed."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_measure(text) for text in batch.column(1).to_pylist()]
        values = zip(*rows) if rows else [()] * len(MEASURED)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(v, pa.int64()) for v in values)], [id_col, *MEASURED]
        )

    kind = df.schema[id_col].dataType.simpleString()
    measured = map_texts(df.select(id_col, text_col), f"`{id_col}` {kind}, {MEASURES}", work)
    return measured.withColumn("fail_bits", _bits())


def verdict(policy: Policy, bits: str = "fail_bits") -> Column:
    """True where a document passes the policy."""
    return F.bit_count(F.col(bits).bitwiseAND(F.lit(policy.mask))) <= policy.allowed


def ablations(kept: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: documents that fail it, and those kept without it."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    parts = []
    for k, (name, _) in enumerate(RULES):
        if policy.mask >> k & 1:
            without = F.bit_count(hit.bitwiseAND(F.lit(~(1 << k)))) <= policy.allowed
            parts.append((name, F.sum(hit.bitwiseAND(F.lit(1 << k)) / (1 << k)), F.sum((without & ~verdict(policy)).cast("long"))))
    totals = kept.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(verdict(policy).cast("long")).alias("kept"),
        F.array(
            *(
                F.struct(
                    F.lit(name).alias("rule"),
                    F.coalesce(failed.cast("long"), F.lit(0)).alias("failed"),
                    F.coalesce(gain, F.lit(0)).alias("kept_without"),
                )
                for name, failed, gain in parts
            )
        ).alias("rules"),
    )
    return totals.select(
        F.lit(policy.version).alias("policy"), "documents", F.coalesce("kept", F.lit(0)).alias("kept"), F.inline("rules")
    )
