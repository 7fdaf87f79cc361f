"""Quality rules as a ledger: every rule is evaluated once, its failures are kept as bits.

Policies are masks over the bits, so that changing one, or asking what each rule does, reads
the ledger and never the texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# Bit numbers are part of the stored format: new rules are appended, none is renumbered.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("short_mean_word", "10 * word_chars < 25 * n_words"),
    ("long_mean_word", "word_chars > 15 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
)
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(name for name, _ in RULES),
}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    _, pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    window = pair[:-1] * len(numbers) + ids[2:]
    order = np.argsort(window, kind="stable")
    same = np.flatnonzero(window[order[1:]] == window[order[:-1]])
    if not len(same):
        return 0
    covered = np.zeros(n, bool)
    for start in (order[same], order[same + 1]):
        for k in range(3):
            covered[start + k] = True
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of MEASURES; null and empty texts have zeros."""
    data = (text or "").encode()
    words = data.split()
    inside = sum(map(len, words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words), len(text or "") - (len(data) - inside), sum((text or "").count(c) for c in SYMBOLS),
        len(lines), len(lines) - len(set(lines)), repeated_words(words),
    )


def measure(docs: DataFrame, text: str = "text", keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Keys and the measures of every text. No shuffle; texts don't leave their task."""
    keys = list(keys)

    def run(batches):
        for batch in batches:
            columns = list(zip(*(measure_text(t.as_py()) for t in batch.column(text)))) or [()] * len(MEASURES)
            out = {k: batch.column(k) for k in keys} | {n: pa.array(c, pa.int64()) for n, c in zip(MEASURES, columns)}
            yield pa.RecordBatch.from_pydict(out)

    kinds = dict(docs.select(*keys).dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"{m} long" for m in MEASURES)])
    return docs.select(*keys, text).mapInArrow(run, schema)


def mask_of(names: Iterable[str], rules=RULES) -> int:
    """The bits of the rules of a policy."""
    bit = {name: 1 << i for i, (name, _) in enumerate(rules)}
    return sum(bit[n] for n in set(names))


def ledger(measures: DataFrame, rules=RULES) -> DataFrame:
    """Measures and `failed`, whose bit i says that rule i fails."""
    bits = [F.when(F.expr(sql), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, sql) in enumerate(rules)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measures.withColumn("failed", failed)


def fails(policy: Iterable[str], rules=RULES) -> Column:
    """Whether a row of the ledger fails any rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(policy, rules))) != 0


def apply_policies(rows: DataFrame, policies: Mapping[str, Iterable[str]] = POLICIES, rules=RULES) -> DataFrame:
    """One column kept_<version> for each policy."""
    return rows.withColumns({f"kept_{name}": ~fails(p, rules) for name, p in policies.items()})


def ablations(rows: DataFrame, policy: Iterable[str], rules=RULES) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone (kept without it), and that fail it with others.

    Documents are counted by their failure bits first, so the shuffle has a row for each
    combination that occurs; rules are then read off the combinations. An empty ledger gives no rows.
    """
    mask, names = mask_of(policy, rules), [n for n, _ in rules]
    combinations = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    entries = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(1 << names.index(n)).cast("long").alias("bit")) for n in sorted(set(policy), key=names.index))))
    rule = combinations.select("bits", "n", entries.alias("r")).select("bits", "n", "r.*")
    has, alone = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit")
    return rule.groupBy("rule").agg(
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("failing_alone"),
        F.sum(F.when(has & ~alone, F.col("n")).otherwise(0)).alias("failing_with_others"),
    )
