"""The trie of conversation prefixes, with subtree totals by time-forward processing.

Turns become digests at once, and a prefix is the pair of polynomials of its digests (modulo two
primes), so that prefixes of one conversation can be computed in pieces: a conversation may span
many tasks. Nodes are counted by a hash aggregation. Nodes with one member are chains with known
totals. The others are dealt to shards by the subtree they lie in; within a shard they are sorted by
reverse level order, and each passes its totals to its parent through a priority queue that spills.
What reaches the top of a shard is added up by parent and passed on across the shards' roots, of
which there is a bounded number.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.llm.shared import file_system, materialise, shared_folder

# Fixed values of the rebuilding rule.
BLOCK, HEADS = 5, 9
# Two primes below 2^63 and a base for each.
PRIMES = ((1 << 61) - 1, (1 << 62) - 57)
BASES = (0x1F3D5B79A2C4E681, 0x2545F4914F6CDD1D)
# Nodes with more members than this lie above the shards, at most one of ABOVE_SHARE members of the trie.
SHARD_MEMBERS, ABOVE_SHARE = 256, 50_000
IN_MEMORY = 200_000
SALT_ROWS = 1 << 16
IDS_IN_PIECE = 4096
BATCH = 4096

Pair = tuple[int, int]


@lru_cache(maxsize=4096)
def _powers(n: int) -> Pair:
    """The bases to a power, which may be negative."""
    return tuple(pow(b, n, p) for b, p in zip(BASES, PRIMES))


def _plus(a: Pair, b: Pair, power: int) -> Pair:
    """a + b times the bases to a power."""
    return tuple((x + y * g) % p for x, y, g, p in zip(a, b, _powers(power), PRIMES))


def _minus(a: Pair, b: Pair) -> Pair:
    return tuple((x - y) % p for x, y, p in zip(a, b, PRIMES))


def _rows(batches: Iterator[pa.RecordBatch], columns: Iterable[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _map(df: DataFrame, columns: Iterable[str], schema: str, run: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """`run` over the rows of each task in Arrow batches: from tuples of the columns to tuples of the schema."""
    columns = tuple(columns)
    fields = [c.strip().split(" ") for c in schema.split(",")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}

    def batches_of(batches):
        rows = run(_rows(batches, columns))
        while some := list(islice(rows, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(zip(*some), fields)], [n for n, _ in fields])

    return df.select(*columns).mapInArrow(batches_of, schema)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest (16 bytes) and n_bytes of conversations (conv_id, turn, role, text).

    Null roles and texts are empty. Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text).cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, at (from 1), n_bytes, and the prefix up to each turn (g1, g2) and before it (p1, p2).

    Turns are ordered by turn, null first, then by digest. The sort is global, so a long conversation is
    spread over tasks; each task starts at nothing, and what stands before it (one row a task) is added later.
    """
    spark = turns.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "copy"]
    placed = (
        turns.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .select("conv_id", "digest", "n_bytes", F.spark_partition_id().alias("part"))
    )
    columns = ("conv_id", "part", "at", "n_bytes", "g1", "g2", "p1", "p2")
    schema = "conv_id long, part int, at long, n_bytes long, g1 long, g2 long, p1 long, p2 long"

    def number(rows):
        current, at, prefix = None, 0, (0, 0)
        for conv, digest, size, part in rows:
            if conv != current:
                current, at, prefix = conv, 0, (0, 0)
            at += 1
            before = prefix
            prefix = _plus(prefix, (int.from_bytes(digest[:8]), int.from_bytes(digest[8:])), at)
            yield conv, part, at, size, *prefix, *before

    local = materialise(_map(placed, ("conv_id", "digest", "n_bytes", "part"), schema, number), "turns")
    last = F.max_by(F.struct("conv_id", "at", "g1", "g2"), F.struct("conv_id", "at")).alias("last")
    ends = sorted(local.groupBy("part").agg(F.min("conv_id").alias("first"), last).collect(), key=lambda r: r.part)
    carried: dict[int, tuple[int, int, Pair]] = {}
    conv, at, prefix = None, 0, (0, 0)
    for r in ends:
        if r.first == conv:
            carried[r.part] = (conv, at, prefix)
        if r.last.conv_id != conv:
            conv, at, prefix = r.last.conv_id, 0, (0, 0)
        prefix, at = _plus(prefix, (r.last.g1, r.last.g2), at), at + r.last.at
    if not carried:
        return local.drop("part")

    def carry(rows):
        for conv, part, at, size, g1, g2, p1, p2 in rows:
            before = carried.get(part)
            if before and before[0] == conv:
                g1, g2 = _plus(before[2], (g1, g2), before[1])
                p1, p2 = _plus(before[2], (p1, p2), before[1])
                at += before[1]
            yield conv, part, at, size, g1, g2, p1, p2

    return _map(local, columns, schema, carry).drop("part")


def members_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (conv_id, depth, g1, g2, p1, p2, n_bytes, ends) of all nodes below the root; and conversations (conv_id, turnless).

    A conversation takes the first h turns of the first one in its block of BLOCK ids, then its own after h.
    """
    own = numbered_turns(turns)
    head = F.when(F.col("at") < HEADS, F.struct("at", "g1", "g2", "p1", "p2", "n_bytes"))
    conversations = materialise(own.groupBy("conv_id").agg(F.max("at").alias("n"), F.sort_array(F.collect_list(head)).alias("heads")), "conversations")
    # A sum below the smallest long has no block.
    first = F.expr(f"try_subtract(conv_id, pmod(conv_id, {BLOCK}))")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    firsts = conversations.select(F.col("conv_id").alias("first"), F.col("heads").alias("others"))
    rebuilt = (
        conversations.withColumns({"first": first, "h": taken}).join(firsts, "first", "left")
        .withColumn("others", F.slice(F.coalesce("others", F.array().cast(conversations.schema["heads"].dataType)), F.lit(1), F.col("h").cast("int")))
        .withColumn("k", F.size("others"))
    )
    rebuilt = materialise(rebuilt.drop("first"), "rebuilt")
    copied = rebuilt.select("conv_id", "n", "h", "k", F.explode("others").alias("o")).select(
        "conv_id", F.col("o.at").alias("depth"), "o.g1", "o.g2", "o.p1", "o.p2", "o.n_bytes",
        ((F.col("o.at") == F.col("k")) & (F.col("n") <= F.col("h"))).alias("ends"),
    )
    # Long conversations meet their row in as many salts as they have blocks of rows.
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {SALT_ROWS}"))).alias("salt")
    at_h, at_k = F.try_element_at("heads", F.col("h").cast("int")), F.try_element_at("others", F.col("k"))
    some = F.col("h") > 0
    starts = rebuilt.where("n > h").select(
        "conv_id", "n", "h", "k", blocks,
        *(F.coalesce(F.when(some, at_h[g]), F.lit(0)).cast("long").alias(f"s{i}") for i, g in ((1, "g1"), (2, "g2"))),
        *(F.coalesce(F.when(F.col("k") > 0, at_k[g]), F.lit(0)).cast("long").alias(f"a{i}") for i, g in ((1, "g1"), (2, "g2"))),
    )
    tails = own.where(F.col("at") > taken).withColumn("salt", F.expr(f"at div {SALT_ROWS}")).join(starts, ["conv_id", "salt"])
    schema = "conv_id long, depth long, g1 long, g2 long, p1 long, p2 long, n_bytes long, ends boolean"
    names = ("conv_id", "at", "n", "h", "k", "n_bytes", "g1", "g2", "p1", "p2", "s1", "s2", "a1", "a2")

    def moved(rows):
        for conv, at, n, h, k, size, g1, g2, p1, p2, s1, s2, a1, a2 in rows:
            g = _plus((a1, a2), _minus((g1, g2), (s1, s2)), k - h)
            p = _plus((a1, a2), _minus((p1, p2), (s1, s2)), k - h)
            yield conv, k + at - h, *g, *p, size, at == n

    members = materialise(copied.unionByName(_map(tails, names, schema, moved)), "members")
    return members, rebuilt.select("conv_id", ((F.col("n") <= F.col("h")) & (F.col("k") == 0)).alias("turnless"))


class SpillingQueue:
    """A priority queue of (key, values) that keeps at most `limit` of them in memory.

    Beyond it they are sorted and written as a run to the folder, which is read back in order. Keys
    must be pushed above the last one popped; the runs are removed when they have been read.
    """

    def __init__(self, folder: str | None, limit: int = IN_MEMORY):
        self.folder, self.limit, self.heap, self.heads, self.runs = folder, limit, [], [], []

    def push(self, key: tuple, values: tuple) -> None:
        heapq.heappush(self.heap, (key, values))
        if len(self.heap) > self.limit and self.folder:
            self._spill()

    def _spill(self) -> None:
        system, path = file_system(f"{self.folder}/run-{uuid.uuid4().hex}")
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.heap.sort()
        with system.open_output_stream(path, compression=None) as out:
            for i in range(0, len(self.heap), 1000):
                out.write(pickle.dumps(self.heap[i:i + 1000]))
        self.heap = []
        self.runs.append(_read_run(system, path))
        self._refill(len(self.runs) - 1)

    def _refill(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heads, (*entry, run))

    def pop_all(self, key: tuple) -> Iterator[tuple]:
        """Take the values of all entries with this key."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)[1]
        while self.heads and self.heads[0][0] == key:
            _, values, run = heapq.heappop(self.heads)
            self._refill(run)
            yield values


def _read_run(system, path: str) -> Iterator[tuple]:
    with system.open_input_stream(path, compression=None) as raw, io.BufferedReader(raw) as stream:
        while True:
            try:
                yield from pickle.load(stream)
            except EOFError:
                break
    system.delete_file(path)


KEY = ("depth", "g1", "g2")
PASSED = ("conv_id", "parent_conv_id", "n_convs")


def pass_upwards(nodes: DataFrame, folder: str | None = None, limit: int = IN_MEMORY) -> DataFrame:
    """Time-forward processing within shards.

    nodes: shard, depth, g1, g2, p1, p2, inside (whether the parent is in the shard too), own (tokens of
    the node itself), and children, leaves, saved as they come from outside; PASSED goes with them. Returns each node
    with its n_children, n_leaves and saved_tokens. Spark sorts the rows of a task by shard, deepest level first,
    so all messages to a node stand at the queue's front when it is its turn.
    """
    columns = ("shard", *KEY, "p1", "p2", "inside", "own", "children", "leaves", "saved", *PASSED)
    schema = (
        "depth long, g1 long, g2 long, p1 long, p2 long, inside boolean, n_children long, n_leaves long, saved_tokens long, "
        "conv_id long, parent_conv_id long, n_convs long"
    )

    def run(rows):
        queue = SpillingQueue(folder, limit)
        for shard, depth, g1, g2, p1, p2, inside, own, children, leaves, saved, *passed in rows:
            for n, s in queue.pop_all((shard, -depth, g1, g2)):
                children, leaves, saved = children + 1, leaves + n, saved + s
            leaves, saved = leaves or 1, saved + own
            if inside:
                queue.push((shard, 1 - depth, p1, p2), (leaves, saved))
            yield depth, g1, g2, p1, p2, inside, children, leaves, saved, *passed

    dealt = nodes.select(*columns).repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "g1", "g2")
    return _map(dealt, columns, schema, run)


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, g1, g2 and the SHA-256 of the conv_ids of ends (depth, g1, g2, conv_id), ascending, joined by commas.

    Ids are sorted over all tasks and joined to pieces first. A digest is sequential by its nature, so the pieces of
    one node are read by one task, which keeps a piece at a time.
    """
    n = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    order = [*KEY, "conv_id"]

    def join(rows):
        for node, run in groupby(rows, lambda r: r[:3]):
            while ids := [str(r[3]) for r in islice(run, IDS_IN_PIECE)]:
                yield *node, int(ids[0]), ",".join(ids)

    def digest(rows):
        for node, run in groupby(rows, lambda r: r[:3]):
            state = hashlib.sha256(next(run)[3].encode())
            for r in run:
                state.update(b"," + r[3].encode())
            yield *node, state.hexdigest()

    placed = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
    pieces = _map(placed, order, "depth long, g1 long, g2 long, least long, ids string", join)
    gathered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "least")
    return _map(gathered, [*KEY, "ids"], "depth long, g1 long, g2 long, ends_sha256 string", digest)


def prefix_trie(conversations: DataFrame, shard_members: int = SHARD_MEMBERS, above_share: int = ABOVE_SHARE, limit: int = IN_MEMORY) -> DataFrame:
    """All nodes of the trie of rebuilt conversations (conv_id, turn, role, text).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Turns are ordered by
    turn (null first), equal ones by a digest of role and text, so repeated rows are turns of their own. Null roles and
    texts are empty; rows without conv_id belong to no conversation and are left out; no conversation, no rows. Other
    columns are left out.
    """
    spark = conversations.sparkSession
    members, everyone = members_of(turns_of(conversations))
    root = everyone.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    nodes = materialise(members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("ends").alias("has_end"),
    ), "nodes")
    total = members.count()
    bound = max(shard_members, total // above_share)

    # At most total / bound nodes have more members than the bound, so they may be broadcast.
    above = nodes.where(F.col("n_convs") > bound)
    high = above.select((F.col("depth") + 1).alias("depth"), F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("conv_id").alias("high_conv"))
    first = F.when(F.col("depth") == 1, F.lit(root.conv_id))
    below_high = nodes.join(F.broadcast(high), ["depth", "p1", "p2"], "left").withColumn("high_conv", F.coalesce("high_conv", first))
    # Nodes below a high one are done; they keep out of the second join by a key of their own.
    done = F.col("high_conv").isNotNull()
    keyed = below_high.withColumns({
        "j0": F.when(done, -F.col("depth")).otherwise(F.col("depth")), "j1": F.when(done, F.col("g1")).otherwise(F.col("p1")),
        "j2": F.when(done, F.col("g2")).otherwise(F.col("p2")),
    })
    low = nodes.where((F.col("n_convs") > 1) & (F.col("n_convs") <= bound)).select(
        (F.col("depth") + 1).alias("j0"), F.col("g1").alias("j1"), F.col("g2").alias("j2"), F.col("conv_id").alias("low_conv"))
    linked = materialise(keyed.join(low, ["j0", "j1", "j2"], "left").drop("j0", "j1", "j2"), "linked")
    parent = F.coalesce("high_conv", "low_conv")

    # A node with one member begins a chain with one leaf; only its parent has to know.
    alone, shared = F.col("n_convs") == 1, F.col("n_convs") > 1
    above_key = ((F.col("depth") - 1).alias("depth"), F.col("p1").alias("g1"), F.col("p2").alias("g2"))
    tops = linked.where(alone & parent.isNotNull()).groupBy(*above_key).agg(F.count("*").alias("tops"))
    paths = members.join(F.broadcast(above.select(*KEY)), list(KEY), "left_anti").groupBy("conv_id").agg(F.min_by("g1", "depth").alias("shard"))
    zero, folder = F.lit(0).cast("long"), shared_folder(spark, "queue")
    own = ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("own")
    from_tops = F.coalesce("tops", zero)
    low_nodes = linked.where(shared & (F.col("n_convs") <= bound)).join(tops, list(KEY), "left").join(paths, "conv_id").select(
        "shard", *KEY, "p1", "p2", F.col("low_conv").isNotNull().alias("inside"), own, from_tops.alias("children"), from_tops.alias("leaves"), zero.alias("saved"),
        "conv_id", parent.alias("parent_conv_id"), "n_convs",
    )
    low_totals = materialise(pass_upwards(low_nodes, folder, limit), "totals")

    arrived = low_totals.where("NOT inside").groupBy(*above_key).agg(
        F.count("*").alias("roots"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    top = spark.range(1).where(F.lit(root.n_convs > 0)).select(
        zero.alias("depth"), zero.alias("g1"), zero.alias("g2"), zero.alias("p1"), zero.alias("p2"), zero.alias("n_bytes"), F.lit(root.n_convs).cast("long").alias("n_convs"),
        F.lit(root.conv_id).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"))
    high_nodes = (
        linked.where(F.col("n_convs") > bound).withColumn("parent_conv_id", parent).select(*top.columns).unionByName(top)
        .join(tops, list(KEY), "left").join(arrived, list(KEY), "left")
    )
    high_totals = pass_upwards(high_nodes.select(
        zero.alias("shard"), *KEY, "p1", "p2", (F.col("depth") > 0).alias("inside"), own, (from_tops + F.coalesce("roots", zero)).alias("children"),
        (from_tops + F.coalesce("more_leaves", zero)).alias("leaves"), F.coalesce("more_saved", zero).alias("saved"), *PASSED,
    ), folder, limit)

    chains = linked.where(alone).select(
        *KEY, F.when(F.col("has_end"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"),
        "conv_id", F.coalesce("high_conv", "low_conv", "conv_id").alias("parent_conv_id"), "n_convs",
    )
    digests = end_digests(
        members.where("ends").select(*KEY, "conv_id").unionByName(everyone.where("turnless").select(zero.alias("depth"), zero.alias("g1"), zero.alias("g2"), "conv_id")))
    totals = chains.unionByName(low_totals.select(*chains.columns)).unionByName(high_totals.select(*chains.columns))
    return totals.join(digests, list(KEY), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
