"""A sparse ensemble of rules for text quality.

Trees are grown on statistics of labelled texts; every path from a root to a node is a rule, a
conjunction of comparisons. A logistic model with an L1 penalty weighs the rules and the
statistics themselves, most of them with zero. What is left becomes one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.llm.rules import measure_text
from chromasea.llm.shared import materialise, remainder

# Labelled rows that trees and weights are fitted on: at most so many, those with the smallest hashes of their id.
FIT_ROWS = 20_000
TREES = 24
DEPTH = 3
PENALTY = 0.001
ACCEPT = 0.7
STATISTICS = (
    "log_words", "mean_word", "longest_word", "distinct_words", "single_letters", "long_words", "digits", "capitals", "marks", "symbols",
    "brackets", "non_ascii", "words_per_line", "repeated_lines", "repeated_words", "words_per_sentence", "most_common_word", "odd_words",
)

_DIGITS, _CAPITALS, _MARKS = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?'\"()-"
_SYMBOLS, _BRACKETS, _ENDS = b"#*$%&|<>@^~=+", b"{}[]\\/_`", b".!?"
_LETTERS = bytes(range(97, 123)) + _CAPITALS + bytes(range(128, 256))


def statistics_of(text: str | None) -> tuple[float, ...]:
    """The statistics of one text, in the order of STATISTICS; shares are of characters, words or lines. Empty texts have zeros."""
    import math
    from collections import Counter

    n_words, word_chars, _, n_lines, n_dup_lines, n_repeat = measure_text(text)
    if not n_words:
        return (0.0,) * len(STATISTICS)
    data = (text or "").encode()
    words, size = data.split(), len(data)
    counts = Counter(words)

    def share(chars: bytes) -> float:
        return (size - len(data.translate(None, chars))) / size

    lengths = [len(w) for w in words]
    ends = size - len(data.translate(None, _ENDS))
    odd = sum(n for w, n in counts.items() if len(w.translate(None, _LETTERS)) * 2 > len(w))
    return (
        math.log1p(n_words), word_chars / n_words, float(max(lengths)), len(counts) / n_words, lengths.count(1) / n_words,
        sum(x > 20 for x in lengths) / n_words, share(_DIGITS), share(_CAPITALS), share(_MARKS), share(_SYMBOLS), share(_BRACKETS),
        (size - len(text)) / size, n_words / n_lines, n_dup_lines / n_lines, n_repeat / n_words, n_words / (ends + 1),
        max(counts.values()) / n_words, odd / n_words,
    )


def with_statistics(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and the statistics of every text; no shuffle."""

    def run(batches):
        for batch in batches:
            columns = list(zip(*(statistics_of(t.as_py()) for t in batch.column("text")))) or [()] * len(STATISTICS)
            yield pa.RecordBatch.from_pydict({k: batch.column(k) for k in keys} | {n: pa.array(c, pa.float64()) for n, c in zip(STATISTICS, columns)})

    kinds = dict(docs.select(*keys).dtypes)
    return docs.select(*keys, "text").mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"{s} double" for s in STATISTICS)]))


@dataclass(frozen=True)
class Rule:
    """Comparisons that all hold: (statistic, whether it is above, limit)."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = None
        for name, above, limit in self.terms:
            term = F.col(name) > F.lit(limit) if above else F.col(name) <= F.lit(limit)
            out = term if out is None else out & term
        return out.cast("double")


def tree_rules(forest, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """Every path from a root to a node of the trees, each once; a statistic compared twice keeps the narrower limit."""
    found: dict[Rule, None] = {}

    def walk(node, held: dict[tuple[str, bool], float]) -> None:
        if held:
            found.setdefault(Rule(tuple(sorted((n, above, limit) for (n, above), limit in held.items()))))
        if node.numDescendants() == 0:
            return
        name, limit = names[node.split().featureIndex()], float(node.split().threshold())
        low, high = held.get((name, False), limit), held.get((name, True), limit)
        walk(node.leftChild(), {**held, (name, False): min(low, limit)})
        walk(node.rightChild(), {**held, (name, True): max(high, limit)})

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


@dataclass
class RuleEnsemble:
    """Weighted rules and statistics; `linear` are (statistic, low, high, weight), cut to the range they were fitted in."""

    intercept: float
    rules: list[tuple[Rule, float]]
    linear: list[tuple[str, float, float, float]]

    def score(self) -> Column:
        """The probability of label 1 as one column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + rule.column() * F.lit(weight)
        for name, low, high, weight in self.linear:
            total = total + F.greatest(F.lit(low), F.least(F.lit(high), F.col(name))) * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), total))))


def fit(rows: DataFrame, label: str = "quality") -> RuleEnsemble:
    """Fit on rows of statistics and a 0/1 label. With no rows the score is 0.5; with one label only, nearly that label."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    n, ones = rows.agg(F.count("*"), F.sum(F.col(label).cast("long"))).first()
    if not n or ones in (0, n):
        return RuleEnsemble({None: 0.0, 0: -4.0}.get(ones, 4.0), [], [])
    vector = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows.withColumn("label", F.col(label).cast("double")))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", subsamplingRate=0.7, minInstancesPerNode=10, seed=7).fit(vector)
    rules = tree_rules(forest)
    ranges = rows.agg(*(F.percentile_approx(s, [0.01, 0.99], 1000).alias(s) for s in STATISTICS)).first()
    cut = [F.greatest(F.lit(ranges[s][0]), F.least(F.lit(ranges[s][1]), F.col(s))) for s in STATISTICS]
    from pyspark.ml.functions import array_to_vector

    wide = materialise(rows.select(F.col(label).cast("double").alias("label"), F.array(*(r.column() for r in rules), *cut).alias("x")), "rule-rows")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=80, featuresCol="features", labelCol="label")
    model = lasso.fit(wide.select("label", array_to_vector("x").alias("features")))
    weights = model.coefficients.toArray().tolist()
    kept = [(r, w) for r, w in zip(rules, weights) if w]
    linear = [(s, ranges[s][0], ranges[s][1], w) for s, w in zip(STATISTICS, weights[len(rules) :]) if w]
    return RuleEnsemble(model.intercept, kept, linear)


def held_out():
    """The fold that isn't learned from."""
    return remainder("doc_id", 4) == 2


def fit_labelled(docs: DataFrame, labels: DataFrame) -> RuleEnsemble:
    """Fit on labelled documents outside the held-out fold, at most FIT_ROWS of them."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out()).select("doc_id", "quality").distinct()
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(FIT_ROWS)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return fit(materialise(with_statistics(texts, ["doc_id", "quality"]), "fit-rows"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Null and empty texts are scored like any other, by their zeros."""
    model = fit_labelled(docs, labels)
    scored = with_statistics(docs, ["doc_id"]).select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
