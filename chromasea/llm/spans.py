"""Removal of passages that repeat across documents, found as runs of consecutive sentences.

Every run of at least RUN_SENTENCES sentences and RUN_WORDS words is hashed, one run from each
sentence on. Hashes are joined over all documents; the sentences under a run that an earlier
document, or the same one further up, has too are removed. A run lies inside any repeated passage
of whole sentences that is a little longer than RUN_WORDS, while a single common line or a
few common words aren't a run. Long sentences are cut where their words say so, not by number: any
passage of RUN_WORDS + 3 * PART_WORDS words has a run of its own, wherever it stands in its sentences,
and what stays of it is less than two parts at either end.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.llm.shared import materialise, unused

RUN_SENTENCES = 3
RUN_WORDS = 20
# A longer sentence is cut into parts of at most so many words, as if each part were a sentence.
PART_WORDS = 10

_END = re.compile(r"[.!?。！？]+[\"')\]»”]*\s+|\s*\n\s*")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def part_starts(longer: list[list[bytes]]) -> list[list[int]]:
    """For each of the sentences, all of more than PART_WORDS words: the numbers of the words at which its parts begin.

    The word of smallest hash in each stretch of PART_WORDS words begins a part, of equal ones the last. So no
    part is longer than that, and all cuts from the first to the last that a passage's own stretches
    make are the same whatever words stand around it.
    """
    from xxhash import xxh64_intdigest

    if not longer:
        return []
    sizes = np.array([len(words) for words in longer])
    firsts = np.cumsum(sizes) - sizes
    values = np.fromiter((xxh64_intdigest(w) for words in longer for w in words), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    lowest = np.arange(PART_WORDS - 1, len(values)) - sliding_window_view(values, PART_WORDS)[:, ::-1].argmin(1)
    chosen = np.zeros(len(values), bool)
    chosen[lowest[owner[: 1 - PART_WORDS] == owner[PART_WORDS - 1 :]]] = True
    chosen[firsts] = True
    cuts = np.flatnonzero(chosen)
    bounds = [*np.searchsorted(cuts, firsts).tolist(), len(cuts)]
    numbers = (cuts - firsts[owner[cuts]]).tolist()
    return [numbers[a:b] for a, b in zip(bounds, bounds[1:])]


def sentences(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts (characters), word counts and hashes of the sentences; a sentence reaches to the next start.

    Words are compared without white space and case of A-Z. Text without words belongs to the
    sentence before it, or to the first.
    """
    from xxhash import xxh64_intdigest

    units = []
    begin, ends = 0, [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    for end in ends:
        unit = text[begin:end]
        words = unit.encode().lower().split()
        if words:
            units.append((begin, unit, words))
        begin = end
    parts = iter(part_starts([words for _, _, words in units if len(words) > PART_WORDS]))
    starts, counts, hashes = [], [], []
    for begin, unit, words in units:
        if len(words) > PART_WORDS:
            places, firsts = [m.start() for m in _WORD.finditer(unit)], next(parts)
            for i, j in zip(firsts, [*firsts[1:], len(words)]):
                starts.append(begin + (places[i] if i else 0))
                counts.append(j - i)
                hashes.append(xxh64_intdigest(b" ".join(words[i:j])))
        else:
            starts.append(begin)
            counts.append(len(words))
            hashes.append(xxh64_intdigest(b" ".join(words)))
    if starts:
        starts[0] = 0
    return np.array(starts, np.int64), np.array(counts, np.int64), np.array(hashes, np.uint64)


def runs(counts: np.ndarray, hashes: np.ndarray, least: int = RUN_SENTENCES, least_words: int = RUN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """For each sentence from which a run begins: the sentence after the run, and the run's hash.

    A run is the shortest that has enough sentences and words, so it depends on its words alone.
    """
    n = len(counts)
    words = np.concatenate([[0], np.cumsum(counts)])
    after = np.maximum(np.searchsorted(words, words[:n] + least_words, "left"), np.arange(n) + least)
    m = int((after <= n).sum())  # `after` never falls, so runs that fit come first
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    after = after[:m]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(n, _FACTOR, np.uint64))
        back = np.cumprod(np.full(n, _INVERSE, np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power)])
        value = (total[after] - total[:m]) * back[:m]
        value ^= value >> np.uint64(29)
        value = value * np.uint64(0xBF58476D1CE4E5B9) + (after - np.arange(m)).astype(np.uint64)
        value ^= value >> np.uint64(32)
    return after, value.view(np.int64)


def _mapped(kinds: str, function):
    """A mapInArrow function over (doc_id, text) rows that gives lists of rows."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                keys = batch.column("doc_id").slice(i, 500).to_pylist()
                yield function(keys, batch.column("text").slice(i, 500).to_pylist())

    return run


def run_hashes(docs: DataFrame) -> DataFrame:
    """(hash, doc_id) of every distinct run of each document that has an id and a text; one with a null hash for a document that repeats itself."""

    def emit(keys, texts):
        hashes, ids, own = [np.zeros(0, np.int64)], [], []
        for key, text in zip(keys, texts):
            found = runs(*sentences(text)[1:])[1]
            distinct = np.unique(found)
            hashes.append(distinct)
            ids.append(np.full(len(distinct), key, np.int64))
            if len(distinct) < len(found):
                own.append(key)
        hashes = pa.concat_arrays([pa.array(np.concatenate(hashes)), pa.nulls(len(own), pa.int64())])
        return pa.RecordBatch.from_pydict({"hash": hashes, "doc_id": pa.array(np.concatenate([*ids, np.array(own, np.int64)]).astype(np.int64))})

    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return usable.mapInArrow(_mapped("", emit), "hash long, doc_id long")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id and the hashes of its runs that a document with a smaller id has too; documents that repeat themselves have a row as well.

    The smallest document of each hash comes from an aggregate with partial sums before the shuffle;
    hashes of one document end there. The join's side of all runs can be split where a hash
    is in very many documents. A list holds one document's own runs.
    """
    found = materialise(run_hashes(docs), "runs")
    known = found.where("hash IS NOT NULL")
    first = known.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").select("hash", "first")
    later = known.join(first, "hash").where("doc_id <> first").select("doc_id", "hash")
    return later.unionByName(found.where("hash IS NULL").select("doc_id", "hash")).groupBy("doc_id").agg(F.collect_list("hash").alias("_hashes"))


def remove_repeated(docs: DataFrame, report: bool = False) -> DataFrame:
    """Documents without the sentences under a repeated run; n_chars, where there is one, follows.

    All rows and columns stay; a document that is a copy as a whole is left with an empty text.
    Null and empty texts stay as they are. Documents without an id are only compared with themselves.
    Rows that share an id count as one document given twice: both keep the same sentences. With
    `report`, a column n_removed (sentences) is added, or takes the place of one of that name. Only documents with a
    repeated run are cut into sentences again.
    """
    names, key, found = [c for c in docs.columns if not report or c.lower() != "n_removed"], unused(docs, "_key"), unused(docs, "_hashes")
    keyed = docs.where(F.col("doc_id").isNotNull())
    hits = repeated_runs(docs).select(F.col("doc_id").alias(key), F.col("_hashes").alias(found))
    joined = keyed.join(hits, F.col("doc_id") == F.col(key), "left").select(*names, found)
    rest = docs.where(F.col("doc_id").isNull()).select(*names, F.array().cast("array<bigint>").alias(found))
    rows = joined.unionByName(rest)

    def rewrite(batches):
        for batch in batches:
            texts, gone = [], []
            for text, hashes in zip(batch.column("text"), batch.column(found)):
                text, k = (text.as_py(), 0) if not hashes.is_valid else cut_text(text.as_py(), hashes.values.to_numpy(zero_copy_only=False))
                texts.append(text)
                gone.append(k)
            out = {n: batch.column(n) for n in names} | {"text": pa.array(texts, pa.string())}
            if report:
                out["n_removed"] = pa.array(gone, pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + (", n_removed long" if report else "")
    cleaned = rows.mapInArrow(rewrite, schema)
    if "n_chars" in names:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return cleaned


def cut_text(text: str | None, repeated: np.ndarray) -> tuple[str | None, int]:
    """The text without its repeated sentences, and how many went."""
    if not text:
        return text, 0
    starts, counts, hashes = sentences(text)
    after, value = runs(counts, hashes)
    again = np.ones(len(value), bool)
    again[np.unique(value, return_index=True)[1]] = False
    if len(repeated):
        again |= np.isin(value, repeated)
    if not again.any():
        return text, 0
    step = np.zeros(len(starts) + 1, np.int64)
    np.add.at(step, np.flatnonzero(again), 1)
    np.add.at(step, after[again], -1)
    covered = np.cumsum(step)[:-1] > 0
    ends = [*starts[1:].tolist(), len(text)]
    kept = "".join(text[a:b] for a, b, gone in zip(starts.tolist(), ends, covered.tolist()) if not gone)
    return kept, int(covered.sum())
