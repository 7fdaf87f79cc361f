"""Exact join of texts whose word shingles are similar, on PartEnum signatures.

Two sets of sizes a <= b with intersection / union >= 0.8 differ in at most k = (a + b) / 9
elements. The domain of shingle hashes is dealt into N parts of three subparts each. If N exceeds
k / 2, some part has at most one difference, so at least two of its subparts are the same in
both sets: the contents of those two are a signature that both sets have. Every set thus
gives, for each part, the three pairs of subparts as signatures.

A pair of empty subparts says nothing and gives no signature. Parts where that could happen
(fewer than two subparts have elements) are counted as lost: a set is covered if
N - floor(k / 2) exceeds its lost parts. Then some shared signature isn't empty. Sets that aren't
covered are dealt anew with another seed, and at last give each element as a signature; a
pair is found as soon as one of its sets is covered, or both have arrived at the same last step.

N depends on a band of sizes, an octave of the smaller set's size. A set gives signatures for
its own octave, and for the next lower one if a partner can be there.

Candidates are the sets of one signature. Each set is first compared with the set that is smallest in
most of its signatures, and links are contracted to components. Only signatures that still hold
several components go on: their sets are dealt into blocks, and pairs of blocks are compared inside a
task, so that a group of any size is spread over many tasks and no list of pairs is made.

Sets are compared by sketches first, a byte for the content of each subpart. Every difference between
two sets changes one subpart, so sets with more than k different bytes can't be similar. What is
left, mostly links, is compared shingle by shingle.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.llm.graph import components
from chromasea.llm.shared import broadcast_rows, materialise, unused

WIDTH = 5
SEEDS = 2
BLOCK = 256  # sets of one block of a group that is compared
OCTAVE_BITS = 6  # the lowest bits of a signature say its octave
LEAST_SIZE = 4  # smaller sets are similar only if equal
BROADCAST_IDS = 2_000_000

_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)

# The three pairs of subparts of a part, and their tags.
_LEFT, _RIGHT, _TAGS = np.array([0, 0, 1]), np.array([1, 2, 2]), np.array([1, 2, 6], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` words; a shorter text is one run, one without words none."""
    from xxhash import xxh3_64_digest

    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.frombuffer(b"".join(map(xxh3_64_digest, words)), np.uint64)
    size, m = min(n, width), max(n - width, 0) + 1
    out = np.full(m, size, np.uint64)
    for k in range(size):
        out *= _C
        out += w[k : k + m]
    out = np.sort(_mix(out))
    fresh = np.ones(m, bool)
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out if fresh.all() else out[fresh]


@cache
def parts_of(octave: int) -> int:
    """N for pairs whose smaller set has 2**octave to 2**(octave+1) - 1 elements: as many as cover nearly all sets."""
    a = 2 ** (octave + 1) - 1
    half = (a + 5 * a // 4) // 9 // 2
    n = half + 1
    while True:
        p = math.exp(-a / (3 * n))
        lost = n * (3 * p * p * (1 - p) + p**3)
        if n - half > lost + 3 * math.sqrt(lost):
            return n
        n += 1


def instances(n: int) -> list[tuple[int, int]]:
    """Octaves a set of n elements takes part in, and the most differences to a partner there."""
    if n < LEAST_SIZE:
        return []
    own = n.bit_length() - 1
    out = [(own, (n + 5 * n // 4) // 9)]
    below = 2**own - 1
    if below >= LEAST_SIZE and 4 * n <= 5 * below:
        out.append((own - 1, (n + below) // 9))
    return out


def _deal(elements: np.ndarray, mixed: np.ndarray, octave: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the contents of the subparts (N x 3), and which of them have elements; `mixed` are the elements mixed."""
    n, tag = parts_of(octave), np.array([octave * 64 + seed + 1], np.uint64)
    place = (_mix(elements + _C * tag) % np.uint64(3 * n)).astype(np.int64)
    total = np.zeros(3 * n, np.uint64)
    np.add.at(total, place, mixed)
    return total.reshape(n, 3), np.bincount(place, minlength=3 * n).reshape(n, 3) > 0


@cache
def _numbers(octave: int, seed: int) -> np.ndarray:
    return _mix(np.arange(parts_of(octave), dtype=np.uint64) * _A + np.array([octave * 64 + seed + 1], np.uint64))[:, None]


def sketch(elements: np.ndarray, octave: int) -> bytes:
    """A byte for each subpart of an octave's first deal: 0 if it is empty, else 1 to 255 by its content."""
    content, filled = _deal(elements, _mix(elements), octave, 0)
    return np.where(filled, _mix(content) % np.uint64(255) + np.uint64(1), np.uint64(0)).astype(np.uint8).tobytes()


def signatures(elements: np.ndarray) -> np.ndarray:
    """All signatures of a set of hashes."""
    out, mixed = [], _mix(elements)
    low = np.uint64(2**OCTAVE_BITS - 1)
    for octave, most in instances(len(elements)):
        n = parts_of(octave)
        for seed in range(SEEDS):
            content, filled = _deal(elements, mixed, octave, seed)
            value = _mix(_mix(content[:, _LEFT] * _C + _numbers(octave, seed)) + content[:, _RIGHT] * _B + _TAGS)
            out.append(value[filled[:, _LEFT] | filled[:, _RIGHT]] & ~low | np.uint64(octave))
            if n - most // 2 > int((filled.sum(1) < 2).sum()):
                break
        else:
            out.append(_mix(elements * _A + np.uint64(octave * 64 + SEEDS)) & ~low | np.uint64(octave))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _usable(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    return int(_mix(elements).sum(dtype=np.uint64)), int(_mix(elements ^ _C).sum(dtype=np.uint64))


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def set_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, k1, k2): the size of each document's set, and a key that equal sets share."""

    def run(batches):
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column("text"):
                s = shingles(text.as_py())
                sizes.append(len(s))
                keys.append(_key(s))
            k1, k2 = zip(*keys) if keys else ((), ())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()), "k1": _signed(k1), "k2": _signed(k2)})

    return _usable(docs).mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long")


def emit_signatures(docs: DataFrame) -> DataFrame:
    """(sig, doc_id) of every document; of equal sets met in one task, the first stands for all."""

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                ids, found = [], []
                for key, text in zip(batch.column("doc_id").slice(i, 500).to_pylist(), batch.column("text").slice(i, 500)):
                    elements = shingles(text.as_py())
                    mark = _key(elements)
                    if len(elements) < LEAST_SIZE or mark in seen:
                        continue
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen.add(mark)
                    ids.append(key)
                    found.append(signatures(elements))
                if found:
                    yield pa.RecordBatch.from_pydict({"sig": _signed(np.concatenate(found)), "doc_id": pa.array(np.repeat(np.array(ids, np.int64), [len(f) for f in found]))})

    return _usable(docs).mapInArrow(run, "sig long, doc_id long")


def shared_signatures(sigs: DataFrame) -> DataFrame:
    """(sig, doc_id) where at least two documents have the signature.

    Rows are sorted and streamed: nothing of a group is held but its first row, however large it is.
    """

    def run(batches):
        last_sig = last_doc = None
        alone = False  # the last row is the first of its group and wasn't given yet
        for batch in batches:
            if not batch.num_rows:
                continue
            s, d = batch.column("sig").to_numpy(), batch.column("doc_id").to_numpy()
            if last_sig is not None:
                s, d = np.concatenate([[last_sig], s]), np.concatenate([[last_doc], d])
            fresh = np.ones(len(s), bool)
            fresh[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
            s, d = s[fresh], d[fresh]
            same = s[1:] == s[:-1]
            keep = np.zeros(len(s), bool)
            keep[1:] |= same
            keep[:-1] |= same
            given = last_sig is not None and not alone
            if given:
                keep[0] = False
            last_sig, last_doc = int(s[-1]), int(d[-1])
            alone = not keep[-1] and not (given and len(s) == 1)
            yield pa.RecordBatch.from_pydict({"sig": pa.array(s[keep]), "doc_id": pa.array(d[keep])})

    return sigs.repartition("sig").sortWithinPartitions("sig", "doc_id").mapInArrow(run, "sig long, doc_id long")


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents that are nodes; an id has all its different texts."""
    chosen = broadcast_rows(nodes.select(F.col("node").alias("doc_id")).distinct(), BROADCAST_IDS)
    texts = _usable(docs).join(chosen, "doc_id", "left_semi").withColumn("_hash", F.xxhash64("text"))
    return texts.dropDuplicates(["doc_id", "_hash"]).drop("_hash")


def sketches_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, octave, n, sketch) for each octave that a node takes part in."""

    def run(batches):
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                s = shingles(text.as_py())
                rows += [(key, octave, len(s), sketch(s, octave)) for octave, _ in instances(len(s))]
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(("node", "octave", "n", "sketch"), columns, kinds)})

    return _texts_of(docs, nodes).mapInArrow(run, "node long, octave int, n long, sketch binary")


def possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow for enough shared shingles."""
    a = sketches.select(F.col("node").alias("a"), "octave", F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = sketches.select(F.col("node").alias("b"), "octave", F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    sizes = (4 * F.greatest("n_a", "n_b") <= 5 * F.least("n_a", "n_b")) & (F.col("octave") == F.floor(F.log2(F.least("n_a", "n_b").cast("double"))))
    both = pairs.join(a, "a").join(b, ["b", "octave"]).where(sizes).select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")

    def run(batches):
        for batch in batches:
            most = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()) // 9
            apart = [
                int((np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8)).sum())
                for x, y in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())
            ]
            kept = batch.filter(pa.array(np.array(apart, np.int64) <= most))
            yield pa.RecordBatch.from_pydict({"a": kept.column("a"), "b": kept.column("b")})

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= 80 * union. `pairs` is read twice, so pass a written table."""

    def collect(batches):
        for batch in batches:
            sets = [shingles(t.as_py()).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"node": batch.column("doc_id"), "shingles": pa.array(sets, pa.list_(pa.int64()))})

    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    sets = materialise(_texts_of(docs, nodes).mapInArrow(collect, "node long, shingles array<long>"), "sets")
    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = with_a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            good = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb")):
                x, y = sa.values.to_numpy(), sb.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= 80 * (len(x) + len(y) - both))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_pydict({"a": kept.column("a"), "b": kept.column("b")})

    return both.mapInArrow(run, "a long, b long")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members (sig, node) with their component so far, where the signature holds several; `size` is their number."""
    named = members.join(components(links), "node", "left").select("sig", "node", F.coalesce("component", "node").alias("component"))
    spread = named.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low <> high").drop("high")
    return named.join(spread, "sig")


def _by_width(sketch: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Sketches as a matrix for each length: the lengths, the row of each in its matrix, and the matrices."""
    width = pa.compute.binary_length(sketch).to_numpy(zero_copy_only=False).astype(np.int64)
    place, matrices = np.zeros(len(width), np.int64), {}
    for size in np.unique(width).tolist():
        rows = np.flatnonzero(width == size)
        place[rows] = np.arange(len(rows))
        matrices[size] = np.frombuffer(b"".join(sketch.take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), size)
    return width, place, matrices


def _near(x: np.ndarray, y: np.ndarray, n: np.ndarray, sketches: tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]) -> np.ndarray:
    """Which pairs of rows of one octave have no more different bytes in their sketches than similar sets can."""
    width, place, matrices = sketches
    near = np.zeros(len(x), bool)
    for size, matrix in matrices.items():
        some = np.flatnonzero(width[x] == size)
        step = max(1, 1_000_000 // max(size, 1))
        for i in range(0, len(some), step):
            part = some[i : i + step]
            a, b = x[part], y[part]
            near[part] = np.count_nonzero(matrix[place[a]] != matrix[place[b]], axis=1) <= (n[a] + n[b]) // 9
    return near


def block_pairs(rows: DataFrame, sketches: DataFrame, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b) of one signature, of different components, whose sizes and sketches allow for a link.

    rows: sig, node, component, size (of the signature's group). A group of n sets has n / block blocks
    by a hash of the node; a set goes to each pair of blocks that its own is in, so that a task
    compares two blocks at a time and holds no more than their sketches.
    """
    octave = F.col("sig").bitwiseAND(F.lit(2**OCTAVE_BITS - 1)).cast("int")
    blocks = F.ceil(F.col("size") / block).cast("int")
    known = rows.withColumn("octave", octave).join(sketches, ["node", "octave"])
    dealt = known.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    keyed = dealt.select("sig", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "node", "component", "n", "sketch")

    def compared(table, end):
        """Pairs of the first `end` rows, which are whole groups: rows at each distance from one another in turn, so that memory stays in proportion to rows."""
        if not end:
            return np.zeros((0, 2), np.int64)
        sig, i, j, own, node, component, n = (table.column(c).to_numpy()[:end] for c in ("sig", "i", "j", "_own", "node", "component", "n"))
        sketches = _by_width(pa.concat_arrays(table.column("sketch").slice(0, end).chunks))
        # the smaller set's own octave is the one whose sketches are fine enough
        finer = np.int64(2) ** ((sig & (2**OCTAVE_BITS - 1)) + 1)
        group = np.cumsum(np.concatenate([[False], (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        left, found, gap = np.arange(end), [], 0
        while True:
            gap += 1
            left = left[left + gap < end]
            left = left[group[left] == group[left + gap]]
            if not len(left):
                break
            right = left + gap
            fit = ((i[left] == j[left]) | (own[left] != own[right])) & (component[left] != component[right])
            small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
            fit &= (small < finer[left]) & (4 * large <= 5 * small)
            x, y = left[fit], right[fit]
            near = _near(x, y, n, sketches)
            x, y = x[near], y[near]
            if len(x):
                found.append(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def run(batches):
        held = None
        for batch in _and_end(batches):
            parts = [b for b in (held, batch) if b is not None and b.num_rows]
            if not parts:
                continue
            table = pa.Table.from_batches(parts).combine_chunks()
            key = [table.column(c).to_numpy() for c in ("sig", "i", "j")]
            # the last group may go on
            end = len(table) if batch is None else int(np.flatnonzero((key[0] == key[0][-1]) & (key[1] == key[1][-1]) & (key[2] == key[2][-1]))[0])
            found = compared(table, end)
            held = table.slice(end).combine_chunks().to_batches()[0] if batch is not None else None
            if len(found):
                yield pa.RecordBatch.from_pydict({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    ordered = keyed.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _and_end(batches):
    yield from batches
    yield None


def similar_components(docs: DataFrame) -> DataFrame:
    """Per document of docs (doc_id, text, ...): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id reachable by links between sets of which
    100 * intersection >= 80 * union. A text without words has no shingles and no links. Rows
    without an id are not compared: component_id is null. Rows that share an id are one
    node; each keeps its own n_shingles.
    """
    sizes = materialise(set_sizes(docs), "set-sizes")
    equal = sizes.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least <> most").drop("most")
    nodes = materialise(sizes.join(equal, ["k1", "k2", "n_shingles"], "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("node")), "nodes")

    held = materialise(shared_signatures(emit_signatures(docs)), "shared-signatures")
    members = materialise(
        held.join(nodes.select("doc_id", "node").distinct(), "doc_id").select("sig", "node").distinct(), "members"
    )
    sketches = materialise(sketches_of(docs, members), "sketches")
    # Rows that share an id but not a set join the nodes of both.
    twice = nodes.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b")
    links = materialise(twice, "links")
    open_members = materialise(_labelled(members, links), "open-members")
    star = open_members.where("node <> low").groupBy("node", F.col("low").alias("centre")).agg(F.count("*").alias("n"))
    best = star.groupBy("node").agg(F.max_by("centre", F.struct("n", "centre")).alias("centre"))
    near = materialise(possible(best.select(F.col("node").alias("a"), F.col("centre").alias("b")), sketches), "star-pairs")
    links = materialise(links.unionByName(verified(near, docs)), "links")
    near = materialise(block_pairs(_labelled(members, links), sketches), "pairs")
    links = links.unionByName(verified(near, docs))
    found = materialise(components(links), "components")
    named = nodes.join(found, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    unnamed = docs.where(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def sizes_only(batches):
        for batch in batches:
            n = [len(shingles(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": pa.array(n, pa.int64()), "component_id": pa.nulls(len(n), pa.int64())})

    return named.unionByName(unnamed.mapInArrow(sizes_only, "doc_id long, n_shingles long, component_id long"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component, with all its columns; rows without an id stay.

    Of rows that share an id, the one whose text has the smallest hash stays.
    """
    from pyspark.sql import Window

    key, row = unused(docs, "_kept"), unused(docs, "_row")
    kept = similar_components(docs.select("doc_id", "text")).where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    own = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    named = docs.where(F.col("doc_id").isNotNull())
    chosen = named.join(kept, F.col("doc_id") == F.col(key), "left_semi").withColumn(row, F.row_number().over(own)).where(F.col(row) == 1).drop(row)
    return chosen.unionByName(docs.where(F.col("doc_id").isNull()))
