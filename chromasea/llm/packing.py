"""Best-fit packing of token documents into sequences, planned on the histogram of lengths.

The plan sees counts of lengths only, at most one number per length up to the capacity, so
its cost doesn't depend on the number of documents. Documents then take the planned slots by
joining on their rank within their length.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chromasea.llm.shared import materialise
from chromasea.llm.tokens import crc, encoder

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Ids of every document and an end id, cut into pieces of `capacity` only where longer.

    Null texts are empty: one piece with the end id. Null doc_ids are kept. Other columns are
    ignored.
    """
    end = np.array([end_id], np.uint32)

    def cut(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                rows = []
                for key, ids in zip(batch.column("doc_id").slice(i, 200).to_pylist(), encoder(tokenizer)(batch.column("text").slice(i, 200).to_pylist())):
                    ids = np.concatenate([ids, end])
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append((key, n, start, len(part), crc(part), part.astype(np.int64) if with_ids else None))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
                yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in list(zip(names, columns, kinds))[: 5 + with_ids]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES + (", ids array<long>" if with_ids else ""))


@dataclass
class Plan:
    """Runs of slots: pieces of one length, ranks from `rank` on, lie `each` to a sequence from `sequence` and `offset` on."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces: the last run of their length that begins at or before their rank."""
        first = np.searchsorted(self.length, length, "left")
        last = np.searchsorted(self.length, length, "right")
        while (open_ := last - first > 1).any():
            middle = (first + last) // 2
            right = open_ & (self.rank[np.minimum(middle, len(self.rank) - 1)] <= rank)
            first, last = np.where(right, middle, first), np.where(open_ & ~right, middle, last)
        nth = rank - self.rank[first]
        return self.sequence[first] + nth // self.each[first], self.offset[first] + nth % self.each[first] * length


def plan_best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best fit, longest first, over counts of lengths.

    Sequences with the same room left are held as runs of numbers. An item of length L goes to the
    smallest room r that takes it; that sequence is then the tightest for the next item too, so
    r // L items go to each sequence of the run at once.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    runs, opened = [], 0

    def give(room: int, run: tuple[int, int]) -> None:
        if room and run[1]:
            if room not in free:
                free[room] = []
                bisect.insort(rooms, room)
            free[room].append(run)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1 to {capacity}")
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                start, count = free[room].pop()
                if not free[room]:
                    del free[room], rooms[at]
            else:
                room, start = capacity, opened
                count = -(-left // (capacity // length))
                opened += count
            each = room // length
            full, rest = min(count, left // each), 0
            if full:
                runs.append((length, rank, start, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                give(room - each * length, (start, full))
            if full < count and left:
                rest = 1
                runs.append((length, rank, start + full, left, capacity - room))
                give(room - left * length, (start + full, 1))
                rank, left = rank + left, 0
            give(room, (start + full + rest, count - full - rest))
    table = np.array(sorted(runs) or np.zeros((0, 5)), np.int64)
    return Plan(*table.T, sequences=opened)


def rank_within_length(pieces: DataFrame) -> DataFrame:
    """Add `rank`, 0 to n - 1 within each length.

    Pieces are dealt into buckets by a hash; a piece's rank is the number of pieces of its length in
    earlier buckets and its place in its own, so a length that holds a third of all pieces is
    ranked by many tasks.
    """
    spark = pieces.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("own", F.row_number().over(own) - 1).join(bases, ["length", "bucket"])
        .select(*pieces.columns, (F.col("base") + F.col("own")).alias("rank"))
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence_id and an offset; sequences are filled without gaps from 0.

    `pieces` (as of token_pieces) is read twice, so pass a written table. Repeated rows are
    packed once each. An empty table gives no rows.
    """
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_best_fit(histogram, capacity)

    def take(batches):
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            length = batch.column("length").to_numpy()
            sequence, offset = plan.place(length, rank)
            kept = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            yield pa.RecordBatch.from_pydict(kept | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return rank_within_length(pieces).mapInArrow(take, f"{_ddl(pieces)}, sequence_id long, offset long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Encode, cut and pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(materialise(token_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """Rows of packed pieces with `ids` to one row per sequence: sequence_id, ids, doc_ids and offsets of its pieces.

    A group holds at most `capacity` pieces, since no piece is empty.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("parts")
    return packed.groupBy("sequence_id").agg(parts).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets")
    )
