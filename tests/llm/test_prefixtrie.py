import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import SF
from pyspark.sql import functions as F

from chromasea.llm import prefixtrie as pt
from chromasea.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).digest()


def plain(rows):
    """The trie as tuples of turns."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    turns = defaultdict(list, {c: [t[-1] for t in sorted(v)] for c, v in turns.items()})
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(list)
    for conv in list(turns):
        h = zlib.crc32(str(conv).encode()) % 9
        whole = tuple(turns.get(conv - conv % 5, [])[:h] + turns[conv][h:])
        for depth in range(len(whole) + 1):
            members[whole[:depth]].append(conv)
        ends[whole].append(conv)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = [totals[c] for c in children[node]]
        totals[node] = (sum(x for x, _ in below) or 1, own + sum(x for _, x in below))
    return sorted(((
        min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), *totals[node],
        hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
    ) for node, m in members.items()), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in pt.prefix_trie(df, **options).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = []
    for conv in [*range(40), -7, -3, 10**12, -(2**63)]:
        for turn in range(r.randrange(14)):
            out.append((conv, r.choice([turn, turn, turn, None]), r.choice(["u", "a", None]), r.choice(["x", "yé", None, ""])))
    out += [(None, 1, "u", "x"), *out[:20]]
    # Long conversations, two of them alike, and many with one text.
    out += [(c, t, "u", "same") for c in (100, 101) for t in range(300)] + [(105, t, "u", "q") for t in range(500)]
    return out + [(c, t, "u", f"copy {t}") for c in range(200, 300) for t in range(3)]


@pytest.mark.parametrize("options", [{}, {"shard_members": 3}, {"shard_members": 5, "limit": 2}, {"shard_members": 1}])
def test_trie(spark, rows, options):
    df = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("clash")).withColumn("shard", F.lit(1)).withColumn("at", F.lit(2)).repartition(5)
    assert found(df, **options) == plain(rows)


def test_empty(spark):
    assert found(spark.createDataFrame([], TURNS)) == []
    assert found(spark.createDataFrame([(None, 1, "u", "x")], TURNS)) == []


def test_queue_spills_and_keeps_the_order(tmp_path):
    r = random.Random(1)
    queue = pt.SpillingQueue(str(tmp_path), limit=10)
    entries = [((r.randrange(50),), (i,)) for i in range(500)]
    for key, values in entries:
        queue.push(key, values)
    assert len(queue.runs) > 10 and len(queue.heap) <= 10
    for key in range(50):
        assert sorted(queue.pop_all((key,))) == sorted(v for k, v in entries if k == (key,))
    assert not list(tmp_path.iterdir())


def test_prefixes_of_parts():
    turns = [(random.Random(i).getrandbits(64), i) for i in range(20)]
    whole = (0, 0)
    for at, turn in enumerate(turns, 1):
        whole = pt._plus(whole, turn, at)
    head = tail = (0, 0)
    for at, turn in enumerate(turns[:7], 1):
        head = pt._plus(head, turn, at)
    for at, turn in enumerate(turns[7:], 1):
        tail = pt._plus(tail, turn, at)
    assert pt._plus(head, tail, 7) == whole
    assert pt._plus((0, 0), pt._minus(whole, head), -7) == tail


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_prefix_trie"](spark, SF).collect()), key=str) == plain(rows)
