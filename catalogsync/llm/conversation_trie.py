"""The trie of all conversations' beginnings, with totals of every subtree by parallel tree contraction.

A node stands for a distinct sequence of first turns. It is known by sums of
hashes of its turns with their places, so beginnings of one conversation are
running sums, taken in blocks of turns: no conversation is read by one task.

Subtree totals are found in rounds of joins over the nodes that are left. A round
rakes the leaves, whose totals are complete and go to their parents, and
compresses chains: of the nodes with one child left, those with the smallest draw
among their neighbours are spliced out, what they hold goes to their parent and
their child hangs on that parent from then on. So bushes and long chains alike
shrink by a share per round. Going back through the rounds, a spliced node's total
is what it held plus its child's total.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogsync.llm.common import WORD, crc_mod, map_batches, pick, stage

# Turns of a conversation that are summed by one task at once.
BLOCK = 4096
# Ids that are joined to one piece of text before a node's digest reads them.
PIECE = 10_000

_KEY = ["k1", "k2"]


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``i`` (from 1), ``a`` and ``b`` (hashes of role and text) and ``words`` of every turn.

    Turns are sorted over all tasks and numbered by their place in their task
    plus the conversation's turns in the tasks before.
    """
    rows = pick(conversations, conv=conv_id, turn=turn, role=role, text=text).where("conv is not null")
    rows = rows.select("conv", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    order = ["conv", "turn", "role", "text"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"),
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit(1), "text", "role").alias("b"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    placed = stage(placed, "turns")
    runs = placed.groupBy("conv", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = F.coalesce(F.sum("n").over(W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("conv", "part", (F.col("low") - earlier - 1).alias("zero"))
    return placed.join(runs, ["conv", "part"]).select("conv", (F.col("at") - F.col("zero")).alias("i"), "a", "b", "words")


def rebuild(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin like the first of their block of ``every`` ids: ``conv``, ``pos`` (from 1), ``a``, ``b``, ``words``.

    A conversation c takes the first crc32(c) % ``most`` turns from conversation
    c - c % every, and its own turns after as many; nothing where that one is absent.
    """
    taken = crc_mod("conv", most)
    block = F.col("conv") - F.col("conv") % every
    heads = stage(turns.where((F.col("conv") % every == 0) & (F.col("i") < most)), "heads")
    length = heads.groupBy(F.col("conv").alias("block")).agg(F.max("i").alias("given"))
    own = turns.withColumn("h", taken).where("i > h").withColumn("block", block).join(length, "block", "left")
    own = own.select("conv", F.expr("i - h + least(h, coalesce(given, 0))").alias("pos"), "a", "b", "words")
    members = turns.select("conv").distinct().withColumn("h", taken).where("h > 0").withColumn("block", block)
    copied = members.join(heads.withColumnRenamed("conv", "block"), "block").where("i <= h")
    return own.unionByName(copied.select("conv", F.col("i").alias("pos"), "a", "b", "words"))


def _key(sums: list[Column]) -> list[Column]:
    return [F.xxhash64(*sums), F.xxhash64(F.lit(1), *sums[::-1])]


def _root_key() -> list[Column]:
    return _key([F.lit(0).cast("long")] * 4)


def beginnings(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every conversation's beginnings: ``conv``, ``depth``, ``k1``, ``k2`` (the node), ``p1``, ``p2`` (its parent), ``words`` of its last turn."""
    x, y = F.xxhash64("pos", "a", "b"), F.xxhash64(F.lit(1), "b", "pos", "a")
    halves = [x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32), y.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(y, 32)]
    names = [f"s{k}" for k in range(4)]
    coded = turns.select("conv", "pos", F.expr(f"pos div {block}").alias("block"), "words", *[h.alias(s) for h, s in zip(halves, names)])
    coded = stage(coded, "codes")
    blocks = coded.groupBy("conv", "block").agg(*[F.sum(s).alias(s) for s in names])
    before = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    # Only conversations longer than a block have an offset.
    offsets = blocks.select("conv", "block", *[F.sum(s).over(before).alias(f"o{s}") for s in names]).where("os0 is not null")
    inside = W.partitionBy("conv", "block").orderBy("pos")
    run = coded.select("conv", "block", "pos", "words", *names, *[F.sum(s).over(inside).alias(f"r{s}") for s in names])
    run = run.join(offsets, ["conv", "block"], "left")
    sums = [F.col(f"r{s}") + F.coalesce(f"o{s}", F.lit(0)) for s in names]
    above = [total - F.col(s) for total, s in zip(sums, names)]
    keys = [*_key(sums), *_key(above)]
    return run.select("conv", F.col("pos").alias("depth"), "words", *[k.alias(n) for k, n in zip(keys, ["k1", "k2", "p1", "p2"])])


def _joined(size: int):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of node and id to pieces of text of up to ``size`` ids."""
        key, ids, out = None, [], []

        def made() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["k1", "k2", "low", "ids"])

        for batch in batches:
            for k1, k2, conv in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "conv"))):
                if ids and ((k1, k2) != key or len(ids) >= size):
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = (k1, k2)
                ids.append(conv)
            if out:
                yield made()
                out = []
        if ids:
            out.append((*key, ids[0], ",".join(map(str, ids))))
            yield made()

    return join


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to a digest per node; only the state of one digest is held."""
    key, state, out = None, None, []

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.string()])], names=["k1", "k2", "ends_sha256"])

    for batch in batches:
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) != key:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(out) >= 5000:
            yield done()
            out = []
    if key:
        out.append((*key, state.hexdigest()))
        yield done()


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """SHA-256 of the ids ``conv`` of each node, ascending, joined by commas.

    Ids are sorted and joined to pieces over all tasks; what is left for one task
    is to run a node's digest over its pieces, which a digest has to do in order.
    """
    pieces = map_batches(ends.repartitionByRange(*_KEY, "conv").sortWithinPartitions(*_KEY, "conv"), _joined(piece), "k1 long, k2 long, low long, ids string")
    return map_batches(pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "low"), _digests, "k1 long, k2 long, ends_sha256 string")


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over every node's subtree, itself included: ``id`` and the values.

    ``nodes`` has ``id``, ``parent`` (null for roots), ``kids`` (how many have it as
    their parent) and the values, longs. Any forest will do: a path of n nodes
    takes rounds as the logarithm of n, and so does a star.
    """
    columns = ["id", "parent", "kid", "kids", "spliced", *values]
    types = {"spliced": "boolean"}

    def message(**given: Column | str) -> Column:
        made = [F.expr(given[c]) if isinstance(given.get(c), str) else given.get(c, F.lit(None)) for c in columns]
        return F.struct(*[m.cast(types.get(c, "long")).alias(c) for m, c in zip(made, columns)])

    def delivered(rows: DataFrame, *messages: tuple[str, Column]) -> DataFrame:
        """Send messages to nodes and let each add up what it got."""
        sent = F.filter(F.array(*[F.when(F.expr(cond), m) for cond, m in messages]), lambda m: m.isNotNull())
        out = rows.select(F.inline(sent)).groupBy("id")
        return out.agg(F.max("parent").alias("parent"), F.max("kid").alias("kid"), F.sum("kids").alias("kids"), F.max("spliced").alias("spliced"), *[F.sum(v).alias(v) for v in values])

    own = {v: v for v in values}
    alive, rounds = stage(nodes.select("id", "parent", F.lit(None).cast("long").alias("kid"), "kids", F.lit(False).alias("spliced"), *values), "alive"), []
    while alive.where("not spliced and kids > 0").take(1):
        salt = len(rounds)
        draw = lambda c: f"xxhash64({c}, {salt})"
        rounds.append(alive)
        raked = delivered(
            alive.where("not spliced"),
            ("kids > 0", message(id="id", parent="parent", kids="kids", spliced="false", **own)),
            ("kids > 0 and parent is not null", message(id="parent", kid="id")),
            ("kids = 0 and parent is not null", message(id="parent", kids="-1", **own)),
        )
        out = raked.withColumn("out", F.expr(f"kids = 1 and parent is not null and {draw('id')} < {draw('parent')} and {draw('id')} < {draw('kid')}"))
        moved = delivered(
            out,
            ("not out", message(id="id", parent="parent", kids="kids", spliced="false", **own)),
            ("out", message(id="id", kid="kid", spliced="true", **own)),
            ("out", message(id="kid", kid="parent")),
            ("out", message(id="parent", **own)),
        )
        # Of a node that stays, ``kid`` holds the parent it was hung on; of a spliced one, its child.
        alive = stage(moved.withColumn("parent", F.expr("if(spliced, null, coalesce(kid, parent))")), "alive")
    totals = alive.where("not spliced").select("id", *values)
    last = alive
    for before in reversed(rounds):
        spliced = last.where("spliced").select("id", "kid", *values)
        below = totals.select(F.col("id").alias("kid"), *[F.col(v).alias(f"below_{v}") for v in values])
        grown = spliced.join(below, "kid").select("id", *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values])
        leaves = before.where("not spliced and kids = 0").select("id", *values)
        totals = stage(totals.unionByName(leaves).unionByName(grown), "totals")
        last = before
    return totals


def prefix_trie(turns: DataFrame, members: DataFrame, block: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """The nodes of the trie of the conversations ``turns`` (``conv``, ``pos``, ``a``, ``b``, ``words``).

    ``members`` lists all conversations in ``conv``, also those without turns,
    which end at the root. Turns are the same if their hashes ``a`` and ``b`` are.
    Returns per node ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` of its subtree (words of the last turn for
    all members but one) and ``ends_sha256`` of the members that end there. No
    conversation gives no node, not even a root.
    """
    convs = members.select("conv").distinct()
    paths = stage(beginnings(turns, block), "beginnings")
    nodes = paths.groupBy(*_KEY).agg(
        F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0")
    no_key = F.lit(None).cast("long")
    root_key = [k.alias(n) for k, n in zip(_root_key(), _KEY)]
    root = root.select(*root_key, "conv", F.lit(0).cast("long").alias("depth"), "n", F.lit(0).cast("long").alias("words"), no_key.alias("p1"), no_key.alias("p2"))
    nodes = stage(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    kids = nodes.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("kids")).select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "kids")
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("conv").alias("parent_conv"))
    linked = nodes.join(kids, _KEY, "left").join(above, ["p1", "p2"], "left").select(
        "id", "parent", "parent_conv", *_KEY, "conv", "depth", "n", F.coalesce("kids", F.lit(0)).alias("kids"), ((F.col("n") - 1) * F.col("words")).alias("saved")
    )
    linked = stage(linked, "linked")
    totals = subtree_totals(linked.select("id", "parent", "kids", (F.col("kids") == 0).cast("long").alias("leaves"), "saved"), ["leaves", "saved"])
    last = paths.groupBy("conv").agg(F.max_by(F.struct(*_KEY), "depth").alias("last"))
    ends = convs.join(last, "conv", "left").select("conv", *[F.coalesce(F.col(f"last.{n}"), k).alias(n) for k, n in zip(_root_key(), _KEY)])
    found = linked.drop("saved").join(totals, "id").join(end_digests(ends, piece), _KEY, "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def shared_beginnings(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """The trie of all conversations after ``rebuild``; columns as ``prefix_trie`` returns them.

    Turns are ordered by ``turn``, null first; turns that tie, also repeated rows,
    go by role and text and all count. Null roles and texts are empty ones; an
    empty turn is a turn. Rows without a conversation id belong to none and are
    left out. An empty table gives no node. Other columns are ignored, whatever
    their names. A conversation may hold any share of all turns, and a node any
    share of all conversations: both are summed in blocks. Long texts are read
    once, for their hash and their words.
    """
    turns = stage(numbered_turns(conversations, conv_id, turn, role, text), "numbered")
    return prefix_trie(rebuild(turns), turns, block, piece)
