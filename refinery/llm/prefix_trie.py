"""The prefix trie of conversations that share another one's head, by composable fingerprints.

A sequence of turns t1, t2, ... has the fingerprint sum(t[i] * x**i) modulo a prime. Sequences
form a monoid under joining, and so do (fingerprint, x**length): the fingerprint of a head of
``k`` turns followed by a suffix is head + x**k * suffix. A rebuilt conversation is therefore
known from two products, that of its base's head and that of its own suffix, and no rebuilt
text is ever put together.

Fingerprints only propose groups. Turns are stored once under their digest, which is checked
against the texts; every group of equal prefixes must agree in the digest of its last turn and
in the group of its parent, which by induction over the depth is equality of the whole. If a
check fails, everything is done again with other primes and points.

A node is named by its smallest member and its depth. The nodes of one smallest member form a
path to the end of that conversation, so the trie is a tree of paths, one per conversation at
most. Sums over subtrees are sums over whole paths, found by doubling the pointers between
paths, and then running sums from the end of each path; nothing walks the trie level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import column_named, discard, partitions, possibly_in, stored
from refinery.llm.spread import arranged, marked, repeated_keys, running_sums, spread_lookup

#: Primes below 2**31 (so that products stay in 64 bits) with the points of the polynomials.
LANES = (
    ((2147483647, 1220703125), (2147483629, 1664525), (2147483587, 69069)),
    ((2147483579, 48271), (2147483563, 40014), (2147483549, 1103515245)),
)
_POWERS = 40
_PLACE = ["depth", "f0", "f1", "f2"]


def _power(x: int, prime: int, exponent: Column) -> Column:
    """``x ** exponent`` modulo the prime, by the bits of the exponent."""
    squares = [x % prime]
    for _ in range(_POWERS - 1):
        squares.append(squares[-1] ** 2 % prime)
    table = F.lit(squares)
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(_POWERS - 1)),
        F.lit(1).cast("long"),
        lambda done, i: F.when(
            F.call_function("shiftright", exponent.cast("long"), i).bitwiseAND(F.lit(1)) == 1,
            F.pmod(done * F.element_at(table, i + 1), F.lit(prime)),
        ).otherwise(done),
    )


def _digit(lane: int, prime: int) -> Column:
    """What a turn counts in a lane: 1 to prime - 1, made of both halves of its digest."""
    return F.pmod(F.xxhash64(F.lit(lane), "h1", "h2"), F.lit(prime - 1)) + 1


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base: crc32 of its decimal id, modulo 6."""
    return (F.crc32(conv_id.cast("string")) % 6).cast("int")


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 100


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    named = lambda c: column_named(conversations, c)
    said = [F.coalesce(named(c).cast("string"), F.lit("")) for c in (role, text)]
    return conversations.select(
        named(conv).cast("long").alias("conv_id"),
        named(turn).alias("turn"),
        said[0].alias("role"),
        said[1].alias("text"),
    ).where("conv_id is not null")


def _digests(turns: DataFrame) -> DataFrame:
    return turns.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit("turn"), "text", "role")})


def _check_digests(turns: DataFrame) -> None:
    """That turns of equal digest are equal; only texts that occur again are looked at."""
    again = repeated_keys(turns, ["h1", "h2"], rows=1)
    texts = possibly_in(turns, again, ["h1", "h2"])
    differing = texts.groupBy("h1", "h2").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("role", "text") for f in (F.min, F.max)]
    )
    if not differing.where("min_role <> max_role or min_text <> max_text").isEmpty():
        raise RuntimeError("two different turns have one digest of 128 bits")


def _positions(turns: DataFrame) -> DataFrame:
    """Every turn with its place ``pos`` in its conversation; texts stay where they are.

    A text is carried along only where two turns of a conversation have one number.
    """
    order = ["turn", "role", "tie", "row"]
    tied = repeated_keys(turns, ["conv_id", "turn"], rows=1)
    light = marked(turns, tied, ["conv_id", "turn"], "tied").select(
        "conv_id", "turn", "role", F.when(F.col("tied"), F.col("text")).alias("tie"),
        F.monotonically_increasing_id().alias("row"), "h1", "h2", F.length("text").cast("long").alias("chars"),
    )
    by = [F.col(c).asc_nulls_first() for c in order]
    rows = arranged(light, "conv_id", by, "trie-turns")
    counted = running_sums(rows, "conv_id", by, {"pos": F.lit(1).cast("long")})
    kept = stored(counted.select("conv_id", "part", "pos", "h1", "h2", "chars"), "trie-places")
    discard(rows)
    return kept


def _heads(places: DataFrame, lanes: Sequence[tuple[int, int]]) -> DataFrame:
    """Per base its first turns, five at most, each with the fingerprint of the head up to it."""
    first = places.where((F.col("conv_id") % 100 == 0) & (F.col("pos") <= 5))
    digits = [_digit(lane, p).alias(f"t{lane}") for lane, (p, _) in enumerate(lanes)]
    listed = first.select("conv_id", F.struct("pos", "h1", "h2", "chars", *digits).alias("s")).groupBy(
        F.col("conv_id").alias("base")
    ).agg(F.sort_array(F.collect_list("s")).alias("head"))

    def product(lane: int, prime: int, x: int, upto: Column) -> Column:
        powers = F.lit([pow(x, i, prime) for i in range(6)])
        return F.aggregate(
            F.slice("head", F.lit(1), upto), F.lit(0).cast("long"),
            lambda done, s: F.pmod(done + F.pmod(s[f"t{lane}"] * F.element_at(powers, (s["pos"] + 1).cast("int")), F.lit(prime)), F.lit(prime)),
        )

    return listed.select(
        "base",
        F.transform(
            "head",
            lambda s: F.struct(
                s["h1"].alias("h1"), s["h2"].alias("h2"), s["chars"].alias("chars"),
                *[product(lane, p, x, s["pos"].cast("int")).alias(f"q{lane}") for lane, (p, x) in enumerate(lanes)],
            ),
        ).alias("head"),
    )


def _members(places: DataFrame, lanes: Sequence[tuple[int, int]]) -> DataFrame:
    """A row per conversation and depth: its prefix's fingerprint, that of the parent, the last turn."""
    n_lanes = range(len(lanes))
    with_base = places.withColumns({"base": base_of(F.col("conv_id")), "h": head_length(F.col("conv_id"))})
    # Heads go to the ranges in which they are wanted, so a hot conversation is joined in parts.
    wanted = with_base.select("base", "part").distinct()
    heads = wanted.join(_heads(places, lanes), "base", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)))
    taken = F.greatest(taken, F.lit(0))  # the size of null is -1

    starts = with_base.where("pos = 1").join(heads, ["base", "part"]).withColumn("hb", taken)
    at = F.col("depth")
    here, before = F.get("head", at - 1), F.get("head", at - 2)
    shared = starts.select("conv_id", "head", F.explode(F.sequence(F.lit(0), F.col("hb"))).alias("depth")).select(
        "conv_id", "depth",
        *[F.coalesce(here[f"q{i}"], F.lit(0)).alias(f"f{i}") for i in n_lanes],
        *[F.coalesce(before[f"q{i}"], F.lit(0)).alias(f"g{i}") for i in n_lanes],
        *[F.coalesce(here[c], F.lit(0)).alias(c) for c in ("h1", "h2", "chars")],
    )

    # The own suffix is numbered from 1; its product is a running sum over the conversation.
    step = F.col("pos") - F.col("h")
    term = {f"d{i}": F.when(step > 0, F.pmod(_digit(i, p) * _power(x, p, F.greatest(step, F.lit(0))), F.lit(p))).otherwise(F.lit(0)) for i, (p, x) in enumerate(lanes)}
    terms = stored(with_base.withColumns(term), "trie-terms")
    summed = running_sums(terms, "conv_id", [F.col("pos")], {f"s{i}": F.col(f"d{i}") for i in n_lanes})
    own = summed.where("pos > h").join(heads, ["base", "part"]).withColumn("hb", taken)

    def joined(i: int, suffix: Column) -> Column:
        p, x = lanes[i]
        powers = F.lit([pow(x, k, p) for k in range(6)])
        head = F.coalesce(F.get("head", F.col("hb") - 1)[f"q{i}"], F.lit(0))
        return F.pmod(head + F.pmod(F.element_at(powers, F.col("hb") + 1) * F.pmod(suffix, F.lit(p)), F.lit(p)), F.lit(p))

    suffixes = own.select(
        "conv_id", (F.col("hb") + F.col("pos") - F.col("h")).cast("int").alias("depth"),
        *[joined(i, F.col(f"s{i}")).alias(f"f{i}") for i in n_lanes],
        *[joined(i, F.col(f"s{i}") - F.col(f"d{i}")).alias(f"g{i}") for i in n_lanes],
        "h1", "h2", "chars",
    )
    members = stored(shared.unionByName(suffixes), "trie-members")
    discard(terms)
    return members


def _grouped(members: DataFrame) -> DataFrame | None:
    """The nodes; None if a group of equal fingerprints does not hold equal prefixes."""
    compared = ["h1", "h2", "g0", "g1", "g2"]
    nodes = stored(
        members.groupBy(*_PLACE).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"),
            *[F.min(c).alias(c) for c in compared], *[F.max(c).alias(f"{c}_max") for c in compared],
        ),
        "trie-nodes",
    )
    if nodes.where(" or ".join(f"{c} <> {c}_max" for c in compared)).isEmpty():
        return nodes.drop("h1", "h2", *[f"{c}_max" for c in compared])
    return None


def _linked(nodes: DataFrame) -> DataFrame:
    """Nodes with the smallest member of their parent and the number of their children."""
    above = [(F.col("depth") - 1).alias("depth"), *[F.col(f"g{i}").alias(f"f{i}") for i in range(3)]]
    kids = nodes.where("depth > 0").groupBy(*above).agg(F.count(F.lit(1)).alias("n_children"))
    kids = stored(kids, "trie-children")
    counted = nodes.join(kids, _PLACE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    counted = stored(counted, "trie-counted")
    # The parent of many children is met in several groups.
    below = counted.select(
        F.col("depth").alias("own_depth"), *[F.col(f"f{i}").alias(f"e{i}") for i in range(3)], *above,
        "conv_id", "n_convs", "n_children", "chars",
    )
    parents = counted.select(*_PLACE, F.col("conv_id").alias("parent_conv_id"))
    hot = kids.where(F.col("n_children") > 10_000).select(*_PLACE)
    met = spread_lookup(below, parents, _PLACE, hot).drop(*_PLACE)
    linked = stored(met.withColumnsRenamed({"own_depth": "depth", **{f"e{i}": f"f{i}" for i in range(3)}}), "trie-linked")
    discard(kids, counted)
    return linked


def _path_totals(paths: DataFrame) -> DataFrame:
    """``(path, leaves, saved)`` over each path and all that hang on it.

    ``paths`` has ``path``, ``up`` (null for none), ``leaves`` and ``saved``. In every round a
    path takes what the paths that point to it have gathered, and pointers jump twice as far.
    """
    state = stored(paths, "trie-paths")
    while not (open_ := state.where("up is not null")).isEmpty():
        gained = open_.groupBy(F.col("up").alias("path")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = state.select(F.col("path").alias("up"), F.col("up").alias("next_up"))
        jumped = spread_lookup(open_, further, ["up"], repeated_keys(open_, ["up"])).select("path", F.col("next_up").alias("up"), "leaves", "saved")
        moved = jumped.unionByName(state.where("up is null")).join(gained, "path", "left")
        after = stored(
            moved.select(
                "path", "up",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "trie-paths",
        )
        discard(state)
        state = after
    return state


def _with_subtrees(linked: DataFrame) -> DataFrame:
    """Nodes with ``n_leaves`` and ``saved_tokens`` of their subtrees."""
    own = linked.withColumns(
        {"leaf": (F.col("n_children") == 0).cast("long"), "spare": (F.col("n_convs") - 1) * F.col("chars")}
    )
    # All nodes of a smallest member are one path; it hangs on the parent of its first node.
    begins = F.when(F.col("depth") == 0, F.lit(True)).otherwise(F.col("parent_conv_id") != F.col("conv_id"))
    paths = stored(
        own.groupBy(F.col("conv_id").alias("path")).agg(
            F.sum("leaf").alias("leaves"), F.sum("spare").alias("saved"),
            F.max(F.when(begins, F.col("parent_conv_id"))).alias("up"), F.min("depth").alias("first"),
        ),
        "trie-path-list",
    )
    # Nothing asks for the total of the path of the root, which most paths may hang on.
    top = own.where("depth = 0").select(F.col("conv_id").alias("top"))
    cut = paths.join(F.broadcast(top), F.col("up") == F.col("top"), "left")
    totals = _path_totals(cut.select("path", F.when(F.col("top").isNull(), F.col("up")).alias("up"), "leaves", "saved"))
    hung = (
        paths.where("up is not null").select("path", F.col("up").alias("conv_id"), (F.col("first") - 1).alias("depth"))
        .join(totals.select("path", "leaves", "saved"), "path")
        .groupBy("conv_id", "depth").agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
    )
    valued = own.join(hung, ["conv_id", "depth"], "left").withColumns(
        {
            "leaf": F.col("leaf") + F.coalesce("hung_leaves", F.lit(0)),
            "spare": F.col("spare") + F.coalesce("hung_saved", F.lit(0)),
        }
    )
    from_end = [F.col("depth").desc()]
    rows = arranged(valued.drop("hung_leaves", "hung_saved"), "conv_id", from_end, "trie-valued")
    summed = running_sums(rows, "conv_id", from_end, {"n_leaves": F.col("leaf"), "saved_tokens": F.col("spare")})
    return summed.drop("leaf", "spare", "part", "chars")


def _ends(members: DataFrame) -> DataFrame:
    """Per node at which conversations end, the digest of their ids in ascending order.

    The ids are joined to blocks in ranges of (node, id); what one task has to read of a node
    with very many ends is a few blocks, one after the other.
    """
    last = members.groupBy("conv_id").agg(F.max(F.struct(*_PLACE)).alias("end")).select("end.*", "conv_id")
    ranged = last.repartitionByRange(partitions(last.sparkSession), *_PLACE, "conv_id").sortWithinPartitions(*_PLACE, "conv_id")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_pylist() for c in batch.columns]
            places = list(zip(*columns[:4]))
            starts = [0, *(i for i in range(1, len(places)) if places[i] != places[i - 1])]
            ids = columns[4]
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(starts, [*starts[1:], len(ids)])]
            kept = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(kept) for c in batch.columns), pa.array(texts, pa.string())], [*_PLACE, "first_id", "ids"]
            )

    kind = "depth int, f0 long, f1 long, f2 long"
    joined = ranged.mapInArrow(blocks, f"{kind}, first_id long, ids string")
    dealt = joined.repartition(partitions(last.sparkSession), *_PLACE).sortWithinPartitions(*_PLACE, "first_id")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, digest = None, None

        def row(rows: list) -> pa.RecordBatch:
            values = [pa.array([r[0][i] for r in rows], t) for i, t in enumerate([pa.int32()] + [pa.int64()] * 3)]
            return pa.RecordBatch.from_arrays([*values, pa.array([r[1] for r in rows], pa.string())], [*_PLACE, "ends_sha256"])

        for batch in batches:
            done = []
            for *here, ids in zip(*[batch.column(n).to_pylist() for n in (*_PLACE, "ids")]):
                if here != place:
                    if place is not None:
                        done.append((place, digest.hexdigest()))
                    place, digest = here, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield row(done)
        if place is not None:
            yield row([(place, digest.hexdigest())])

    return dealt.mapInArrow(digests, f"{kind}, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    lanes: Sequence[Sequence[tuple[int, int]]] = LANES,
) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    A conversation c is rebuilt as the first h turns of conversation c - c % 100 (with the sign
    of c, as everywhere in SQL), followed by its own turns after its first h; h is
    ``head_length``. Per node:

    | column | content |
    | --- | --- |
    | conv_id, depth | smallest member, and number of turns |
    | parent_conv_id | smallest member of the parent; null for the root |
    | n_convs | members: rebuilt conversations that begin with the node's turns |
    | n_children, n_leaves | children; childless nodes in the subtree, the node itself included |
    | saved_tokens | over the subtree, (members - 1) times the characters of the last text |
    | ends_sha256 | digest of the ids that end here, ascending and joined by commas |

    Turns are ordered by number (null first), equal numbers by role and then text; repeated rows
    are turns of their own. A null role or text is empty. Ids are whole numbers; rows with a null
    id belong to no conversation and are left out. A table without conversations has no nodes,
    not even a root. Other columns are ignored.
    """
    turns = _digests(_turns(conversations, conv, turn, role, text))
    _check_digests(turns)
    places = _positions(turns)
    for points in lanes:
        members = _members(places, points)
        nodes = _grouped(members)
        if nodes is not None:
            break
        discard(members)
    else:
        raise RuntimeError("prefixes of one fingerprint differ in all lanes")
    linked = _linked(nodes)
    whole = _with_subtrees(linked)
    found = whole.join(_ends(members), _PLACE, "left")
    empty = hashlib.sha256(b"").hexdigest()
    done = stored(
        found.select(
            "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        ),
        "trie",
    )
    discard(places, members, linked)
    return done
