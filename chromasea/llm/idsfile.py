"""Token-id shards: documents compressed one by one against a shared zstandard dictionary.

A shard holds a header (format mark, bytes per id, SHA-256 of the dictionary), the
compressed frames in ascending document order, an index, and a trailer that says where
the index begins. The index has each document's id, the place of its frame, the number of
its ids and of all ids before it in the shard. A single document is read by its frame
alone; its frame refers to the dictionary, so short documents stay small and cheap.

The shards' table (Parquet) names the files that count: a task that ran twice, or was lost,
leaves a file that no row names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chromasea.llm.shared import file_system, materialise, shared_folder, task_file
from chromasea.llm.tokens import crc, encoder

MARK = b"IDSHARD1"
END_ID = 2
LEVEL = 3
# Bounds of the dictionary and of what it is trained on. They affect size on disk, not content.
DICTIONARY_BYTES = 110_000
DICTIONARY_DOCUMENTS = 1_000
DICTIONARY_CHARS = 20_000
INDEX = np.dtype([("doc_id", "<i8"), ("known", "?"), ("offset", "<i8"), ("size", "<i8"), ("start", "<i8"), ("n_tokens", "<i8")])
INDEX_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _encoded(texts: list, path: str, end_id: int) -> list[np.ndarray]:
    end = np.array([end_id], np.uint32)
    return [np.concatenate([ids, end]) for ids in encoder(path)(texts)]


def train_dictionary(docs: DataFrame, tokenizer: str, width: int = 2, end_id: int = END_ID) -> bytes:
    """A zstandard dictionary over serialized id arrays.

    It is trained in one task on at most DICTIONARY_DOCUMENTS documents of at most
    DICTIONARY_CHARS characters, those with the smallest hashes of id and length. Tables with
    too little to train on give the sample itself as dictionary, empty ones give b"".
    """
    order = F.xxhash64("doc_id", F.length("text"))
    chosen = (
        docs.where(F.length("text").between(1, DICTIONARY_CHARS)).select("doc_id", order.alias("_order"))
        .orderBy("_order", "doc_id").limit(DICTIONARY_DOCUMENTS).distinct()
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.length("text").between(1, DICTIONARY_CHARS))

    def train(batches):
        import zstandard

        texts = sorted(t for b in batches for t in b.column("text").to_pylist())[:DICTIONARY_DOCUMENTS]
        parts = [ids.astype(f"<u{width}").tobytes() for i in range(0, len(texts), 100) for ids in _encoded(texts[i : i + 100], tokenizer, end_id)]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes() if parts else b""
        except zstandard.ZstdError:
            made = b"".join(parts)[-DICTIONARY_BYTES:]
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([made], pa.binary())})

    rows = sample.select("text").repartition(1).mapInArrow(train, "dictionary binary").collect()
    return bytes(rows[0][0]) if rows else b""


def _zstd(dictionary: bytes):
    import zstandard

    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data), zstandard.ZstdDecompressor(dict_data=data)


def write_ids(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, width: int = 2) -> tuple[DataFrame, bytes]:
    """Encode `text` and write shards in ascending order of doc_id; returns the shards' table and the dictionary.

    A null text has the end id only; null ids come first. Rows with one id are ordered by
    their text's hash. Other columns are ignored. `width` is the bytes per id, 2 for
    vocabularies under 65 536. An empty table has no shards.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    dictionary = train_dictionary(docs, tokenizer, width, end_id)
    digest = hashlib.sha256(dictionary).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, out, index, tokens = TaskContext.get(), None, [], 0
        compressor = _zstd(dictionary)[0]
        for batch in batches:
            if out is None and batch.num_rows:
                name = task_file(folder, ".ids")
                system, path = file_system(name)
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(path)
                out.write(MARK + bytes([width]) + digest)
            keys = batch.column("doc_id")
            for i in range(0, batch.num_rows, 200):
                some = keys.slice(i, 200).to_pylist()
                for key, ids in zip(some, _encoded(batch.column("text").slice(i, 200).to_pylist(), tokenizer, end_id)):
                    if len(ids) and int(ids.max()) >> (8 * width):
                        raise ValueError(f"an id does not fit in {width} bytes")
                    frame = compressor.compress(ids.astype(f"<u{width}").tobytes())
                    index.append((key or 0, key is not None, out.tell(), len(frame), tokens, len(ids)))
                    out.write(frame)
                    tokens += len(ids)
        if out is not None:
            at = out.tell()
            out.write(np.array(index, INDEX).tobytes())
            out.write(at.to_bytes(8, "little") + len(index).to_bytes(8, "little") + MARK)
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([context.partitionId()], pa.int64()), "path": pa.array([name]), "n_docs": pa.array([len(index)], pa.int64()),
                "n_tokens": pa.array([tokens], pa.int64()), "dictionary_sha256": pa.array([digest.hex()]),
            })

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    shards = ordered.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long, dictionary_sha256 string")
    return materialise(shards, "id-shards"), dictionary


class Shard:
    """One shard file: its index, and the ids of single documents or of all in order."""

    def __init__(self, name: str, dictionary: bytes):
        system, path = file_system(name)
        self.file = system.open_input_file(path)
        size, head = self.file.size(), len(MARK) + 33
        start = self.file.read_at(head, 0)
        if start[: len(MARK)] != MARK or start[len(MARK) + 1 :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name}: not a shard of this dictionary")
        self.width = start[len(MARK)]
        tail = self.file.read_at(24, size - 24)
        if tail[16:] != MARK:
            raise ValueError(f"{name}: the shard is cut off")
        at = int.from_bytes(tail[:8], "little")
        self.index = np.frombuffer(self.file.read_at(size - 24 - at, at), INDEX)
        self.expand = _zstd(dictionary)[1].decompress

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.expand(frame), f"<u{self.width}").astype(np.uint32)

    def document(self, row: int) -> np.ndarray:
        """The ids of the document in this row of the index: one read, one frame."""
        entry = self.index[row]
        return self._ids(self.file.read_at(int(entry["size"]), int(entry["offset"])))

    def __iter__(self) -> Iterator[np.ndarray]:
        self.file.seek(len(MARK) + 33)
        for size in self.index["size"].tolist():
            yield self._ids(self.file.read(size))


def read_ids(shards: DataFrame, dictionary: bytes, with_ids: bool = False) -> DataFrame:
    """Read the shards back: per document doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    n = max(1, shards.count())
    placed = shards.withColumn("before", F.coalesce(before, F.lit(0))).repartition(n, "shard")

    def read(batches):
        for batch in batches:
            for name, base, n_tokens in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), batch.column("n_tokens").to_pylist()):
                shard, seen, rows = Shard(name, dictionary), 0, []
                for i, ids in enumerate(shard):
                    entry = shard.index[i]
                    if len(ids) != entry["n_tokens"]:
                        raise ValueError(f"{name}: row {i} of the index and its frame differ")
                    rows.append((int(entry["doc_id"]) if entry["known"] else None, base + int(entry["start"]), len(ids), crc(ids), ids if with_ids else None))
                    seen += len(ids)
                    if len(rows) == 500:
                        yield _batch(rows, with_ids)
                        rows = []
                if seen != n_tokens:
                    raise ValueError(f"{name}: {seen} ids, {n_tokens} expected")
                yield _batch(rows, with_ids)

    return placed.select("path", "before", "n_tokens").mapInArrow(read, INDEX_SCHEMA + (", ids array<long>" if with_ids else ""))


def _batch(rows: list, with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    out = {n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "start", "n_tokens", "ids_crc32"), columns)}
    if with_ids:
        out["ids"] = pa.array([c.astype(np.int64) for c in columns[4]], pa.list_(pa.int64()))
    return pa.RecordBatch.from_pydict(out)


def read_document(spark: SparkSession, shards: DataFrame, dictionary: bytes, doc_id: int) -> list[list[int]]:
    """The ids of every document with this id: looks in the shards' indexes, then reads its frames alone."""

    def find(batches):
        for batch in batches:
            found = []
            for name in batch.column("path").to_pylist():
                shard = Shard(name, dictionary)
                hits = np.flatnonzero(shard.index["known"] & (shard.index["doc_id"] == doc_id))
                found += [shard.document(int(i)).tolist() for i in hits]
            yield pa.RecordBatch.from_pydict({"ids": pa.array(found, pa.list_(pa.int64()))})

    return [r.ids for r in shards.select("path").mapInArrow(find, "ids array<long>").collect()]
