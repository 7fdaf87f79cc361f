"""Language of texts as a mixture: expectation maximisation over character trigrams.

Every language is a distribution over hashed trigrams, counted over all training texts. A
document's trigrams are a mixture of languages whose shares expectation maximisation estimates. The
set of languages is chosen by likelihood with a penalty for each language: languages are taken
away as long as that costs less likelihood than the penalty.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.llm.shared import remainder

BUCKETS = 1 << 15
SMOOTHING = 0.5
STEPS = 25
LEAST_SHARE = 0.01
# Trigrams overlap, so a likelihood counts each character about three times.
OVERLAP = 3.0
MOST_LANGUAGES = 2_000
UNKNOWN = "und"
_M1, _M2, _M3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the trigrams of a text in lower case; what isn't a letter is one space. Empty without a letter."""
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate([[np.uint32(32)], codes[keep], [np.uint32(32)]]).astype(np.uint32)
    mixed = codes[:-2] * _M1 + codes[1:-1] * _M2 + codes[2:] * _M3
    return ((mixed ^ (mixed >> np.uint32(15))) * _M2 >> np.uint32(17)).astype(np.int64)


@dataclass
class Languages:
    """Names, and log-free probabilities of the buckets (buckets x languages)."""

    names: list[str]
    odds: np.ndarray

    def shares(self, text: str | None) -> tuple[list[str], list[float]]:
        """The chosen languages of a text and their shares, largest first; nothing for a text without letters."""
        grams = trigrams(text)
        if not len(grams) or not self.names:
            return [], []
        found, counts = np.unique(grams, return_counts=True)
        odds, weight = self.odds[found], counts / len(grams)
        chosen = np.arange(len(self.names))
        share, fit = _estimate(odds, weight)
        while True:
            keep = share >= min(LEAST_SHARE, share.max())
            if not keep.all():
                odds, chosen = odds[:, keep], chosen[keep]
                share, fit = _estimate(odds, weight)
            if len(chosen) == 1:
                break
            least = int(share.argmin())
            fewer = np.delete(odds, least, 1)
            share_1, fit_1 = _estimate(fewer, weight)
            # The penalty of one language: half the logarithm of the number of observations.
            if (fit - fit_1) * len(grams) / OVERLAP > 0.5 * np.log(len(grams)):
                break
            odds, chosen, share, fit = fewer, np.delete(chosen, least), share_1, fit_1
        order = np.argsort(-share, kind="stable")
        return [self.names[i] for i in chosen[order]], share[order].tolist()

    def confidence(self, text: str | None, language: str) -> float:
        """The probability of one language if the whole text were in a single one, tempered for short texts."""
        grams = trigrams(text)
        fit = np.log(self.odds[grams]).sum(0) / OVERLAP
        chance = np.exp(fit - fit.max())
        return float(chance[self.names.index(language)] / chance.sum())


def _estimate(odds: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages by expectation maximisation, and the mean log likelihood."""
    share = np.full(odds.shape[1], 1 / odds.shape[1])
    if odds.shape[1] > 1:
        for _ in range(STEPS):
            part = odds * share
            new = (weight / part.sum(1)) @ part
            done = np.abs(new - share).max() < 1e-4
            share = new
            if done:
                break
    return share, float(weight @ np.log(odds @ share))


def train(docs: DataFrame, buckets: int = BUCKETS) -> Languages:
    """Count trigrams of all rows with a text and a `lang`, per language.

    A task adds up its rows before the shuffle; what reaches the driver is at most one number per
    language and bucket. More than MOST_LANGUAGES names are refused. Without rows there are no languages.
    """

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if name not in sums:
                    sums[name] = np.zeros(buckets, np.int64)
                sums[name] += np.bincount(trigrams(text.as_py()), minlength=buckets)
        for name, n in sums.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(used)), "bucket": pa.array(used), "n": pa.array(n[used])})

    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    sums = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"{len(names)} languages; at most {MOST_LANGUAGES} are learned")
    counts = np.full((buckets, len(names)), SMOOTHING)
    place = {n: i for i, n in enumerate(names)}
    np.add.at(counts, (table.column("bucket").to_numpy(), [place[n] for n in table.column("lang").to_pylist()]), table.column("n").to_numpy())
    return Languages(names, counts / counts.sum(0))


def languages_of(docs: DataFrame, model: Languages) -> DataFrame:
    """docs with `languages` (names) and `shares`, largest first, and `confidence` in the first.

    A null text, or one without a letter, has no languages and confidence 0. All rows and columns stay;
    columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("languages", "shares", "confidence")]

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found, shares = shared.value.shares(text.as_py())
                rows.append((found, shares, shared.value.confidence(text.as_py(), found[0]) if found else 0.0))
            langs, shares, sure = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in names} | {
                "languages": pa.array(langs, pa.list_(pa.string())), "shares": pa.array(shares, pa.list_(pa.float64())), "confidence": pa.array(sure, pa.float64()),
            })

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields)
    return docs.select(*names).mapInArrow(run, f"{kinds}, languages array<string>, shares array<double>, confidence double")


def held_out():
    """The fold that isn't learned from."""
    return remainder("doc_id", 5) == 0


def predict(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (share of the language, times the confidence in it).

    Learns from text and non-null lang of the documents that are not held out.
    """
    model = train(docs.where(~held_out()))
    found = languages_of(docs.select("doc_id", "text"), model)
    first = F.try_element_at("languages", F.lit(1))
    return found.select(
        "doc_id", held_out().alias("held_out"), F.coalesce(first, F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(first.isNull(), 0.0).otherwise(F.try_element_at("shares", F.lit(1)) * F.col("confidence")).alias("score"),
    )


def with_language(docs: DataFrame) -> DataFrame:
    """Documents that have a language, with all their columns: those without text or letters go."""
    model = train(docs.where(~held_out()))
    names = docs.columns
    marked = languages_of(docs.withColumn("_row", F.struct(*names)).select("_row", "text"), model)
    return marked.where(F.size("languages") > 0).select("_row.*")
