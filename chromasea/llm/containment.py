"""Benchmark items inside documents, by MinHash containment search on size partitions.

Items are partitioned by the number of their word shingles. Each partition has a sketch size:
the shingles with the smallest hashes, one more than an item of the partition may miss at the asked
containment. A document that contains the item has at least one of them, so the search finds every such
pair, however long the document is; documents too short for an item are left out. Candidates are
then verified on all shingles.

DataFrame functions only. Sketch shingles are looked up by their longest word, so a document's
shingles are only formed where that word stands, and texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.llm.shared import broadcast_rows, materialise, unused

WIDTH = 5
CONTAINMENT = 0.8
# Rows of a side that may be broadcast, as counted; larger sides are joined by shuffle.
BROADCAST_ROWS = 200_000

# The ASCII white space that separates words, and the letters that are made small.
_SPACES = " \t\n\v\f\r"
_LARGE, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> Column:
    """Words of a text, A-Z in lower case; null and blank texts have none."""
    trimmed = F.btrim(F.translate(F.coalesce(F.col(text), F.lit("")), _LARGE, _SMALL), F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _shingles(words: str, width: Column) -> Column:
    """Distinct runs of `width` words, as arrays; none where there are fewer words."""
    last = F.size(words) - width + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.slice(words, i, width)))


def _identity(text: str) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, width, run, n): the distinct shingles of every item, as arrays of words, and their number.

    An item is all rows of one id, repeated rows or several texts; rows without an id are left out. A text
    of fewer than five words is one shingle of all of them; one without words has none.
    """
    split = items.where("item_id IS NOT NULL").select("item_id", words_of("text").alias("words")).withColumn("width", F.least(F.size("words"), F.lit(WIDTH))).where("width > 0")
    runs = split.select("item_id", "width", F.explode(_shingles("words", F.col("width"))).alias("run")).distinct()
    sizes = runs.groupBy("item_id").agg(F.count("*").alias("n"))
    return runs.join(sizes, "item_id").select("item_id", "width", "run", "n")


def sketches(shingled: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(item_id, width, shingle, key, place, least): the bottom shingles of every item by hash.

    `key` is the longest word of the shingle and `place` its position; `least` is the least
    number of shingles of a document that holds the item, where they have one width. A partition is a power of two of sizes; its
    sketch size suits its largest item, so it suits the others.
    """
    size_class = F.floor(F.log2(F.col("n").cast("double")))
    largest = F.pow(F.lit(2.0), size_class + 1) - 1
    missing = F.floor(largest * F.lit(1 - containment) + F.lit(1e-9)).cast("int")
    text = F.array_join("run", " ")
    bottom = F.slice(F.sort_array(F.collect_list(F.struct(F.xxhash64(text).alias("hash"), text.alias("shingle"), F.col("run").alias("run"), "width"))), F.lit(1), F.first("k"))
    one_width = (F.min("width") == F.max("width")).alias("one_width")
    low = shingled.withColumn("k", missing + 1).groupBy("item_id", "n").agg(bottom.alias("low"), one_width).select("item_id", "n", "one_width", F.explode("low").alias("s"))
    longest = F.array_max(F.transform("s.run", lambda w, i: F.struct(F.length(w).alias("size"), i.alias("place"), w.alias("word"))))
    return low.withColumn("longest", longest).select(
        "item_id", "s.width", "s.shingle", F.col("longest.word").alias("key"), F.col("longest.place").alias("place"),
        F.when(F.col("one_width"), F.ceil(F.col("n") * F.lit(containment) - F.lit(1e-9))).otherwise(0).alias("least"),
    )


def _found(texts: DataFrame, sketch: DataFrame) -> DataFrame:
    """(_text, item_id) of the texts (_text, words) and sketch shingles that stand in them.

    A sketch that may be broadcast meets the words in place; for a larger one a word takes the few words around it along, never its text.
    """
    small = sketch.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    each = texts.select("_text", "words", F.size("words").alias("_n"), F.posexplode("words").alias("_at", "key")).withColumn("_from", F.lit(1))
    if not small:
        begin = F.greatest(F.col("_at") - WIDTH + 2, F.lit(1))
        each = each.select("_text", "_n", "_at", "key", begin.alias("_from"), F.slice("words", begin, F.lit(2 * WIDTH - 1)).alias("words"))
    start = F.col("_at") - F.col("place") + 1
    inside = (F.col("_n") - F.col("width") + 1 >= F.col("least")) & (start >= 1) & (start + F.col("width") - 1 <= F.col("_n"))
    here = F.array_join(F.slice("words", F.greatest(start - F.col("_from") + 1, F.lit(1)), F.col("width")), " ")
    return each.join(F.broadcast(sketch) if small else sketch, "key").where(inside & (here == F.col("shingle"))).select("_text", "item_id")


def contained(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(_text, item_id, n_item, n_shared) for each text and each item contained in it.

    `_text` is a digest of the text: copies are searched once each but joined as one. n_item is the number of the item's
    distinct shingles, n_shared of those that the text has; n_shared >= containment * n_item. Null
    texts hold nothing. Empty tables give no rows.
    """
    shingled = materialise(item_shingles(items), "item-shingles")
    sketch = materialise(sketches(shingled, containment), "sketches")
    texts = docs.where(F.col("text").isNotNull()).select("text", _identity("text").alias("_text"))
    candidates = materialise(_found(texts.select("_text", words_of("text").alias("words")), sketch).distinct(), "candidates")

    some_texts = texts.join(broadcast_rows(candidates.select("_text").distinct(), 5 * BROADCAST_ROWS), "_text", "left_semi").dropDuplicates(["_text"])
    widths = [r.width for r in shingled.select("width").distinct().collect()]  # 1 to 5
    split = some_texts.select("_text", words_of("text").alias("words"), F.explode(F.array(*map(F.lit, widths or [WIDTH]))).alias("width"))
    ours = split.select("_text", "width", F.explode(_shingles("words", F.col("width"))).alias("run")).select("_text", "width", F.array_join("run", " ").alias("shingle"))
    theirs = shingled.select("item_id", "width", F.array_join("run", " ").alias("shingle"))
    shared = (
        ours.join(broadcast_rows(theirs, 5 * BROADCAST_ROWS), ["width", "shingle"])
        .groupBy("_text", "item_id").agg(F.count("*").alias("n_shared"))
    )
    sizes = shingled.select("item_id", F.col("n").alias("n_item")).distinct()
    return (
        shared.join(candidates, ["_text", "item_id"], "left_semi").join(sizes, "item_id")
        .where(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(containment) - F.lit(1e-9)))
        .select("_text", "item_id", "n_item", "n_shared")
    )


def contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) for every document that holds a benchmark item.

    Repeated rows give repeated results. Other columns are ignored.
    """
    found = materialise(contained(docs, items, containment), "contained")
    own = docs.where(F.col("text").isNotNull()).select("doc_id", _identity("text").alias("_text"))
    return own.join(broadcast_rows(found, 5 * BROADCAST_ROWS), "_text").select(
        "doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )


def without_contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """Documents that hold no benchmark item, with all their columns; null and empty texts stay."""
    key = unused(docs, "_text")
    found = materialise(contained(docs, items, containment).select(F.col("_text").alias(key)).distinct(), "contained")
    keyed = docs.withColumn(key, _identity("text"))
    return keyed.join(broadcast_rows(found, 5 * BROADCAST_ROWS), key, "left_anti").drop(key)
