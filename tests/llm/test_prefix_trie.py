"""The trie of rebuilt conversations against a brute-force version."""

import hashlib
import math
import zlib
from collections import defaultdict

import pytest

from refinery.llm import prefix_trie as trie
from refinery.llm import spread
from support import rows

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(data):
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(math.fmod(c, 100))
        built = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def subtree(node):
        todo, out = [node], []
        while todo:
            out.append(at := todo.pop())
            todo += kids[at]
        return out

    found = []
    for node, ids in members.items():
        below = subtree(node)
        found.append((
            ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), len(kids[node]),
            sum(not kids[n] for n in below), sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        ))
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def data():
    out = []
    for c in [*range(0, 40), *range(100, 130), 205, 206, 207, 300, -3, -200, 10**12]:
        for t in range(c % 7):
            same = c % 3 == 0
            out.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if same else f"own {c} of {t}"))
    out += [(100, None, None, None), (100, None, "user", ""), (3, 1, "user", "tie b"), (3, 1, "user", "tie a"), (3, 1, "user", "tie a")]
    out += [(None, 0, "user", "nobody"), (30, 2, "user", "é𝄞" * 4_000), (31, 9, "", ""), (31, 9, "", "")]
    out += [(500 + i, t, "user", f"chain {t}" if t < i else f"leaves at {i}") for i in range(1, 9) for t in range(i + 1)]
    return out


def test_brute_force(spark):
    made = data()
    df = spark.createDataFrame(made, SCHEMA).repartition(5)
    assert rows(trie.prefix_trie(df)) == brute(made)


def test_hot_conversation_and_hot_parent_are_split(spark, monkeypatch):
    made = [(7, t, "user", f"t{t % 5}") for t in range(900)] + [(c, 0, "user", "hello") for c in range(1_000, 1_300)]
    made += [(c, t, "user", f"reply {c}") for c in range(1_000, 1_300) for t in range(1, 8)]
    df = spark.createDataFrame(made, SCHEMA)
    monkeypatch.setattr(spread, "HOT_ROWS", 20)
    turns = trie._digests(trie._turns(df, "conv_id", "turn", "role", "text"))
    places = trie._positions(turns)
    assert places.where("conv_id = 7").select("part").distinct().count() > 1
    assert sorted(r.pos for r in places.where("conv_id = 7").collect()) == list(range(1, 901))
    assert rows(trie.prefix_trie(df)) == brute(made)


def test_colliding_fingerprints_are_noticed(spark):
    made = data()
    df = spark.createDataFrame(made, SCHEMA)
    tiny = ((3, 2), (3, 2), (3, 2))
    assert rows(trie.prefix_trie(df, lanes=(tiny, trie.LANES[0]))) == brute(made)
    with pytest.raises(RuntimeError):
        trie.prefix_trie(df, lanes=(tiny,))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(empty).count() == 0
    made = data()
    more = spark.createDataFrame([(*r, 1, "x", 2) for r in made], SCHEMA + ", part int, f0 string, depth int")
    assert rows(trie.prefix_trie(more)) == brute(made)


def test_running_sums_and_spread_lookup(spark):
    df = spark.range(5_000).selectExpr("CASE WHEN id % 3 = 0 THEN 1L ELSE id END AS k", "id AS o")
    from pyspark.sql import functions as F

    arranged = spread.arranged(df, "k", [F.col("o")], "test")
    got = {(r.k, r.o): r.s for r in spread.running_sums(arranged, "k", [F.col("o")], {"s": F.col("o")}).collect()}
    total = defaultdict(int)
    for k, o in sorted(got):
        total[k] += o
        assert got[k, o] == total[k]
    right = df.select("k").distinct().withColumn("v", F.col("k") * 2)
    hot = spread.repeated_keys(df, ["k"], 50)
    assert hot.count() == 1
    joined = spread.spread_lookup(df, right, ["k"], hot)
    assert joined.count() == 5_000 and joined.where("v <> k * 2 or v is null").count() == 0
