"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles, sketched by minwise tokens. The
join grows trees: a node holds documents that share the tokens chosen on the
path to it; it chooses two further coordinates, and its documents branch by their
tokens there. Nodes of a bounded size are compared exhaustively by their
sketches, and so are nodes of a few times that size, in blocks. Several
independent trees are grown; every pair has a chance in each, so together they
find it but for a probability that falls with their number. A pair at the
threshold shares 1.5 of a node's two children on average, so its chance to be met
does not fade with depth.

Documents of equal sets are one vertex from the start. Each document is first
compared on full sets with the one whose sketch is most like its own, which joins
nearly all there is to join. Then all pairs that look alike and still cross
components are compared on full sets, node by node; pairs already joined by other
links need no comparison, as components, not all pairs, are asked for. In a node too large to compare, all are first compared with one of its
documents, which joins large groups of near copies, and what is one component by
then is left alone. Where only a few documents are not in a node's largest
component, just these are compared with all others; the rest branches further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.llm.common import map_batches, pick, stage
from catalogsync.llm.components import hung

SHINGLE = 5
THRESHOLD = (75, 100)  # as a fraction of whole numbers
COORDINATES = 128
TREES = 6
BRANCHES = 2
# Documents of a node that are compared exhaustively.
NODE = 2048
# Nodes of up to so many times NODE are compared in blocks: about the comparisons of three more levels.
BLOCKED = 4
# Nodes as deep as this are compared in blocks, however large: members double with every level.
DEEPEST = 10
# Standard errors that a sketch may fall short of the threshold.
SLACK = 4.5
PAIRS_AT_ONCE = 32_768
# Of so many hashes of a node's full sets numbers are made at once.
HASHES_AT_ONCE = 2_000_000

_RANDOM = np.random.Generator(np.random.PCG64(7))
_ODD = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_STEPS = _RANDOM.integers(1, 1 << 63, BRANCHES, dtype=np.uint64)
_PLACES = _RANDOM.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; with fewer words, of the whole sequence; none without words."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    of = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(of) < SHINGLE:
        total = _PLACES[SHINGLE] * np.uint64(len(of))
        for k in range(len(of)):
            total = total + _mix(of[k : k + 1]) * _PLACES[k]
        return _mix(total)
    of, n = _mix(of), len(of) - SHINGLE + 1
    total = of[:n] * _PLACES[0]
    for k in range(1, SHINGLE):
        total += of[k : k + n] * _PLACES[k]
    return np.unique(_mix(total))


def sketch(found: np.ndarray) -> bytes:
    """The smallest of every coordinate's hashes over a set, 32 bits each."""
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(found), 4096):
        some = found[start : start + 4096]
        np.minimum(low, ((some[:, None] * _ODD) >> np.uint64(32)).min(axis=0), out=low)
    return low.astype("<u4").tobytes()


def marks(signs: bytes, trees: int) -> bytes:
    """What documents are compared by: a byte of each token, and the whole tokens of the trees' first branches."""
    tokens = np.frombuffer(signs, "<u4")
    return (tokens & 0xFF).astype(np.uint8).tobytes() + tokens[: trees * BRANCHES].tobytes()


def sketches(docs: DataFrame, doc_id: str, text: str, trees: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, the 128-bit digest of the set in two longs, its sketch and its marks."""
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, high, low, signs = [], [], [], []
            for value in batch.column("text").to_pylist():
                found = shingles(value)
                digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                n.append(len(found))
                high.append(digest[0])
                low.append(digest[1])
                signs.append(sketch(found) if len(found) else None)
            short = [marks(x, trees) if x else None for x in signs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, high, low)), *(pa.array(x, pa.binary()) for x in (signs, short))],
                names=["doc_id", "n_shingles", "high", "low", "sketch", "marks"],
            )

    return map_batches(rows, run, "doc_id long, n_shingles long, high long, low long, sketch binary, marks binary")


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(len(column), COORDINATES)


def _child(node: np.ndarray, coordinate: np.ndarray, token: np.ndarray) -> np.ndarray:
    return _mix(_mix(node.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + coordinate.astype(np.uint64)) + token.astype(np.uint64))


def _members(node: np.ndarray, rep: pa.Array, coordinate: int = 0) -> pa.RecordBatch:
    place = pa.array(np.full(len(node), coordinate, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), rep, place], names=["node", "rep", "c"])


def roots(reps: DataFrame, trees: int) -> DataFrame:
    """First branches of all trees: each tree has its own coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = _signs(batch.column("sketch"))
            for c in range(trees * BRANCHES):
                root = np.full(len(signs), c // BRANCHES, np.uint64)
                yield _members(_child(root, np.full(len(signs), c), signs[:, c]), batch.column("rep"), c)

    return map_batches(reps.select("rep", "sketch"), run, "node long, rep long, c int")


def children(node: np.ndarray, signs: np.ndarray) -> Iterator[np.ndarray]:
    """The children that members of nodes branch to by their tokens, one for each of a node's two coordinates.

    The second is drawn from the other 127: of one coordinate twice, a pair
    would have one chance only.
    """
    rows = np.arange(len(node))
    first = _mix(node + _STEPS[0]) % np.uint64(COORDINATES)
    step = _mix(node + _STEPS[1]) % np.uint64(COORDINATES - 1) + np.uint64(1)
    for coordinate in (first, (first + step) % np.uint64(COORDINATES)):
        yield _child(node, coordinate, signs[rows, coordinate])


def branch(members: DataFrame) -> DataFrame:
    """Children of nodes, two for every member at every level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = _signs(batch.column("sketch"))
            node = batch.column("node").to_numpy().view(np.uint64)
            for child in children(node, signs):
                yield _members(child, batch.column("rep"))

    return map_batches(members.select("node", "rep", "sketch"), run, "node long, rep long, c int")


def few_against_all(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes whose largest component lacks few documents: blocks of it, each with all these few.

    ``members``: ``node``, ``rep``, ``component``; ``nodes``: ``node``, ``most``
    (the largest component) and ``d`` (its documents).
    """
    rows = members.join(nodes.select("node", "most", F.ceil(F.col("d") * 2 / NODE).alias("blocks")), "node")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.array(F.pmod(F.xxhash64("rep"), F.col("blocks")))
    block = F.explode(F.when(F.col("component") == F.col("most"), own).otherwise(every)).alias("block")
    return rows.select("node", "rep", block).select(F.xxhash64("node", "block").alias("node"), "rep")


def in_blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Large nodes as pairs of blocks that fit: each document goes with its block to every other block."""
    rows = members.join(sizes.select("node", F.ceil(F.col("n") * 4 / NODE).alias("blocks")), "node")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node"), "rep")


def _equal_bytes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each row the number of its COORDINATES bytes that are equal: eight are added at once, as no sum exceeds a byte."""
    words = (x == y).view(np.uint64).sum(axis=1, dtype=np.uint64)
    return ((words * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def _tokens_needed() -> int:
    """Tokens that sketches have in common, if their sets may reach the threshold."""
    share = THRESHOLD[0] / THRESHOLD[1]
    return int(np.ceil(COORDINATES * (share - SLACK * np.sqrt(share * (1 - share) / COORDINATES))))


def _pairs(node: np.ndarray, rep: np.ndarray, part: np.ndarray, size: np.ndarray, c: np.ndarray, small_nodes: np.ndarray, short: np.ndarray) -> Iterator[tuple]:
    """Compare the documents of each node by their sketches: places of pairs of different components, tokens in common.

    Only pairs that may reach the threshold, by their sketches and by the sizes
    of their sets. A pair that meets in several first branches is left to the
    first of these that is small enough to be compared, so it comes once.
    """
    signs, tokens = np.ascontiguousarray(short[:, :COORDINATES]), np.ascontiguousarray(short[:, COORDINATES:]).view("<u4")
    places = np.arange(tokens.shape[1])
    earlier = ((small_nodes[:, None] >> places) & 1).astype(bool) & (places < c[:, None])
    least = _tokens_needed()
    starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    counts = np.diff(np.append(starts, len(node)))
    for n in np.unique(counts[counts > 1]):
        i, j = np.triu_indices(int(n), 1)
        own = starts[counts == n]
        for s in np.array_split(own, max(1, len(i) * len(own) // PAIRS_AT_ONCE)):
            x, y = (s[:, None] + i).ravel(), (s[:, None] + j).ravel()
            small, big = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            open_ = (part[x] != part[y]) & (rep[x] != rep[y]) & (small * THRESHOLD[1] >= big * THRESHOLD[0])
            x, y = x[open_], y[open_]
            for k in range(0, len(x), PAIRS_AT_ONCE):
                p, q = x[k : k + PAIRS_AT_ONCE], y[k : k + PAIRS_AT_ONCE]
                same = _equal_bytes(signs[p], signs[q])
                ok = np.flatnonzero(same >= least)
                ok = ok[~((tokens[p[ok]] == tokens[q[ok]]) & earlier[p[ok]]).any(axis=1)]
                if len(ok):
                    yield p[ok], q[ok], same[ok]


def _by_node(leaves: DataFrame, columns: list[str], work: Callable[..., pa.RecordBatch | None], schema: str) -> DataFrame:
    """Run ``work`` on the rows of whole nodes; packed columns are taken apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = []
            for c in columns:
                column = batch.column(c)
                now.append(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1) if c == "marks" else np.array(column.to_pylist(), dtype=object) if c == "hashes" else column.to_numpy())
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            # The last node may go on in the next batch.
            end = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if end and (made := work(*(x[:end] for x in now))):
                yield made
            rest = [x[end:] for x in now]
        if rest is not None and len(rest[0]) and (made := work(*rest)):
            yield made

    if "c" not in leaves.columns:
        leaves = leaves.select("*", F.lit(0).alias("c"), F.lit(0).alias("small_nodes"))
    return map_batches(leaves.select(*columns).repartition("node").sortWithinPartitions("node"), run, schema)


COMPARED = ["node", "rep", "component", "n_shingles", "c", "small_nodes", "marks"]


def most_alike(leaves: DataFrame) -> DataFrame:
    """For each document of a node its most alike partner of another component: ``a``, ``b``, ``alike``, and the node's columns.

    A pair that is open after later links is open now, so these rows have both its documents.
    """

    def best(*columns: np.ndarray) -> pa.RecordBatch | None:
        found = list(_pairs(*columns))
        if not found:
            return None
        rep = columns[1]
        x, y, same = (np.concatenate(c) for c in zip(*found))
        mine, theirs, same = np.concatenate((x, y)), np.concatenate((y, x)), np.concatenate((same, same))
        order = np.lexsort((rep[theirs], -same, mine))
        mine, theirs, same = mine[order], theirs[order], same[order]
        first = np.concatenate(([True], mine[1:] != mine[:-1]))
        mine, theirs, same = mine[first], theirs[first], same[first].astype(np.int32)
        arrays = [rep[mine], rep[theirs], same, *(columns[k][mine] for k in (0, 4, 5))]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["a", "b", "alike", "node", "c", "small_nodes"])

    return _by_node(leaves, COMPARED, best, "a long, b long, alike int, node long, c int, small_nodes int")


def alike(pairs: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of different components that may reach the threshold by their sketches.

    ``pairs`` has ``component``, ``n_shingles`` and ``marks`` of ``a``, and those of ``b`` as ``their_*``.
    """
    small, big = F.least("n_shingles", "their_n_shingles"), F.greatest("n_shingles", "their_n_shingles")
    open_ = pairs.where((F.col("component") != F.col("their_component")) & (small * THRESHOLD[1] >= big * THRESHOLD[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1) for c in ("marks", "their_marks"))
            same = _equal_bytes(one[:, :COORDINATES], other[:, :COORDINATES])
            yield batch.select(["a", "b"]).filter(pa.array(same >= _tokens_needed()))

    return map_batches(open_.select("a", "b", "marks", "their_marks"), run, "a long, b long")


def linked(members: DataFrame) -> DataFrame:
    """Compare all alike pairs of different components of each node on their full sets; links of components enough to join what is linked.

    A pair whose documents the node's links have joined by then is left out, so
    a node of n documents gives fewer than n links.
    """

    def confirm(*columns: np.ndarray) -> pa.RecordBatch | None:
        rep, part, hashes = columns[1], columns[2], columns[-1]
        found = list(_pairs(*columns[:-1]))
        if not found:
            return None
        x, y, same = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(-same, kind="stable")
        x, y = x[order], y[order]
        labels = np.unique(part, return_inverse=True)[1]
        sets = [np.frombuffer(h, np.uint64) for h in hashes]
        a, b, at, many = [], [], 0, len(rep)
        while at < len(x):
            p, q = x[at : at + many], y[at : at + many]
            at, many = at + many, min(2 * many, 4 * PAIRS_AT_ONCE)
            apart = labels[p] != labels[q]
            p, q = p[apart], q[apart]
            good = reached(sets, p, q)
            for i, j in zip(p[good].tolist(), q[good].tolist()):
                if labels[i] != labels[j]:
                    labels[labels == labels[j]] = labels[i]
                    a.append(part[i])
                    b.append(part[j])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]) if a else None

    return _by_node(members, [*COMPARED, "hashes"], confirm, "a long, b long")


def reach(one: bytes, other: bytes) -> bool:
    """Do two full sets, packed and sorted, reach the threshold?"""
    p, q = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    if len(p) > len(q):
        p, q = q, p
    at = np.searchsorted(q, p)
    both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
    return both * THRESHOLD[1] >= (len(p) + len(q) - both) * THRESHOLD[0]


def reached(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of sets, given by their places, reach the threshold.

    What the sets hold is numbered, a range of hashes at a time, so that each set is
    marked once and looked up by all that it is paired with.
    """
    if not len(x):
        return np.zeros(0, bool)
    used = np.unique(np.concatenate((x, y)))
    size, both = np.array([len(s) for s in sets]), np.zeros(len(x), np.int64)
    order = np.argsort(x, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], np.diff(x[order]) != 0)))
    ranges = -(-int(size[used].sum()) // HASHES_AT_ONCE)
    bounds = [(k << 64) // ranges for k in range(1, ranges)]
    cuts = {k: [0, *np.searchsorted(sets[k], np.array(bounds, np.uint64)).tolist(), len(sets[k])] for k in used.tolist()}
    for r in range(ranges):
        parts = [sets[k][cuts[k][r] : cuts[k][r + 1]] for k in used.tolist()]
        known, numbers = np.unique(np.concatenate(parts), return_inverse=True)
        ends = np.cumsum([len(part) for part in parts])
        of = dict(zip(used.tolist(), np.split(numbers.astype(np.int32), ends[:-1])))
        marked = np.zeros(len(known), bool)
        for own in np.split(order, starts[1:]):
            mine = of[int(x[own[0]])]
            marked[mine] = True
            for k in range(0, len(own), some := max(1, HASHES_AT_ONCE // max(1, int(size[y[own]].max())))):
                theirs = [of[j] for j in y[own[k : k + some]].tolist()]
                hits = np.concatenate(([0], np.cumsum(marked[np.concatenate(theirs)])))
                ends = np.cumsum([len(t) for t in theirs])
                both[own[k : k + some]] += hits[ends] - hits[ends - [len(t) for t in theirs]]
            marked[mine] = False
    return both * THRESHOLD[1] >= (size[x] + size[y] - both) * THRESHOLD[0]


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that reach the threshold on their full sets; a pair comes again where an id has several sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [reach(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y"))
    return map_batches(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y"), run, "a long, b long")


def full_sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """The full sets of the documents in ``wanted`` (``rep``)."""
    rows = pick(docs, rep=doc_id, text=text).select(F.col("rep").cast("long").alias("rep"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [shingles(v).tobytes() for v in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(packed, pa.binary())], names=["rep", "hashes"])

    return map_batches(rows.join(wanted, "rep", "left_semi"), run, "rep long, hashes binary").where(F.length("hashes") > 0)


class _Join:
    """The state of one join: which documents are connected by now."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, reps: DataFrame, trees: int):
        self.docs, self.doc_id, self.text, self.reps, self.trees = docs, doc_id, text, reps, trees
        self.connected: DataFrame | None = None
        self.sets: DataFrame | None = None

    def labelled(self, members: DataFrame) -> DataFrame:
        """Members with the component that each is known to be in."""
        if self.connected is None:
            return members.withColumn("component", F.col("rep"))
        known = self.connected.withColumnRenamed("vertex", "rep")
        return members.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def sketched(self, members: DataFrame) -> DataFrame:
        return members.join(self.reps.select("rep", "sketch"), "rep")

    def marked(self, members: DataFrame) -> DataFrame:
        return members.join(self.reps.select("rep", "n_shingles", "marks"), "rep")

    def sized(self, members: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        """Members of nodes with two components or more, and the nodes that are too large, and whether there are any."""
        rows = stage(self.labelled(members), "members")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("p"), F.max("component").alias("q"), F.min_by("rep", F.xxhash64("node", "rep")).alias("leader"))
        sizes = stage(sizes.where("p <> q").select("node", "n", "leader"), "nodes")
        large = sizes.where(F.col("n") > NODE)
        return rows.join(sizes.select("node", "n"), "node").select("node", "rep", "c", "n"), large, bool(large.take(1))

    def mixed(self, leaves: DataFrame) -> DataFrame:
        """What ``COMPARED`` names, of nodes with two components or more."""
        rows = self.labelled(leaves)
        if self.connected is not None:
            mixed = rows.groupBy("node").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q")
            rows = rows.join(mixed.select("node"), "node")
        return self.marked(rows)

    def join(self, links: DataFrame) -> None:
        """Join what new links connect. Known components stand for the links in them."""
        if self.connected is not None:
            links = links.unionByName(self.connected.select(F.col("vertex").alias("a"), F.col("component").alias("b")))
        self.connected = hung(links)

    def connect(self, pairs: DataFrame) -> None:
        """Compare pairs on full sets and join what is linked."""
        links = verify(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), self.sets)
        # Links of components make shorter paths, so fewer rounds, than links of documents in them.
        for end in ("a", "b") if self.connected is not None else ():
            known = self.connected.select(F.col("vertex").alias(end), "component")
            links = links.join(known, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
        self.join(links)

    def led(self, inside: DataFrame, large: DataFrame) -> DataFrame:
        """Members of large nodes with their leaders, where these may be linked: ``a``, ``b``."""
        lead = inside.join(large.select("node", "leader"), "node").where("rep <> leader").select("rep", "leader")
        leaders = self.marked(self.labelled(large.select(F.col("leader").alias("rep")).distinct()))
        # Few rows, each for very many members: staged, so that the join is a broadcast or is split.
        leaders = stage(leaders.toDF("leader", *(f"their_{c}" for c in leaders.columns[1:])), "leaders")
        pairs = self.marked(self.labelled(lead)).join(leaders, "leader")
        return alike(pairs.withColumnsRenamed({"rep": "a", "leader": "b"}))

    def run(self) -> None:
        members, large, any_large = self.sized(roots(self.reps, self.trees))
        members = stage(members, "branches")
        leaves = members.where(F.col("n") <= NODE).select("node", "rep", "c")
        # By document, which of its first branches are compared.
        small = leaves.groupBy("rep").agg(F.expr("bit_or(shiftleft(1, c))").alias("small_nodes"))
        leaves = stage(leaves.join(small, "rep"), "leaves")
        first = stage(most_alike(self.mixed(leaves)), "alike")
        active = first.select(F.col("a").alias("rep")).distinct()
        wanted = active
        if any_large:
            wanted = active.unionByName(members.where(F.col("n") > NODE).select("rep")).distinct()
        wanted = stage(wanted, "active")
        self.sets = stage(full_sets(self.docs, self.doc_id, self.text, wanted), "sets")
        grown = [stage(leaves.join(wanted, "rep", "left_semi"), "leaves")]
        depth = 0
        while any_large:
            depth += 1
            inside = members.where(F.col("n") > NODE).select("node", "rep")
            # All against one: joins the bulk of a large group before it is branched.
            self.connect(self.led(inside, large))
            inside = stage(self.labelled(inside), "inside")
            parts = inside.groupBy("node", "component").agg(F.count(F.lit(1)).alias("d"))
            parts = parts.groupBy("node").agg(F.sum("d").alias("n"), F.max("d").alias("d"), F.max_by("component", "d").alias("most"))
            mixed = stage(parts.where("n > d"), "mixed")
            few = F.col("n") - F.col("d") <= NODE // 2
            grown.append(stage(few_against_all(inside, mixed.where(few)), "leaves"))
            hard = mixed.where(~few)
            if not hard.take(1):
                break
            blocked = F.lit(depth >= DEEPEST) | (F.col("n") <= BLOCKED * NODE)
            grown.append(stage(in_blocks(inside.select("node", "rep"), hard.where(blocked)), "leaves"))
            hard = hard.where(~blocked)
            if not hard.take(1):
                break
            inside = inside.join(hard.select("node"), "node", "left_semi").select("node", "rep")
            members, large, any_large = self.sized(branch(self.sketched(inside)))
            members = stage(members, "branches")
            grown.append(members.where(F.col("n") <= NODE).select("node", "rep"))
        leaves = grown[0]
        for more in grown[1:]:
            leaves = leaves.unionByName(more.select("node", "rep", F.lit(0).alias("c"), F.lit(0).alias("small_nodes")))
        # The most alike pair of each document first: that joins nearly all there is to join.
        pairs, left = first, first
        if len(grown) > 1:
            left = stage(most_alike(self.mixed(leaves)), "alike")
            pairs = first.select("a", "b", "alike").unionByName(left.select("a", "b", "alike"))
        best = pairs.groupBy("a").agg(F.max_by("b", F.struct("alike", -F.col("b"))).alias("b"))
        self.connect(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        # Then everything alike that still crosses components, on full sets, node by node.
        open_ = self.mixed(left.select("node", F.col("a").alias("rep"), "c", "small_nodes"))
        self.join(linked(open_.join(self.sets, "rep")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trees: int = TREES) -> DataFrame:
    """Components of documents whose shingle sets are similar to 0.75 or more.

    Returns a row per row of ``docs``: ``doc_id``, ``n_shingles`` (size of its
    set), ``component_id`` (the smallest id reachable over links, its own
    included) and ``kept`` (is it that document). Words are runs without ASCII
    white space after A-Z are lower-cased; a set holds the distinct shingles of
    five words, the whole sequence where there are fewer.

    Texts that are null or have no word have an empty set and are linked with
    nothing. Ids are whole numbers. A row with a null id belongs to the component
    of its set, null if no row with an id has that set. Rows that repeat an id
    with its text all get the same values; rows of one id with different texts
    are linked as each text is. An empty table gives an empty one. Other columns
    are ignored. Long texts are hashed whole; sketches have a fixed size.

    ``trees``: a pair of similarity 0.75 is missed by the first branches of six
    trees with a probability of about 1e-7, one that has to pass large nodes with
    one below 1e-4 after any number of levels (2.5e-5 at most by the recursion
    over all sketches that such a pair may have).
    """
    every = stage(sketches(docs, doc_id, text, trees), "sketches")
    # All but the ids is the same in a class.
    same = [F.first(c).alias(c) for c in ("n_shingles", "sketch", "marks")]
    reps = every.where("n_shingles > 0").groupBy("high", "low").agg(F.min("doc_id").alias("rep"), *same).where("rep is not null")
    reps = stage(reps, "reps")
    classes = reps.select("high", "low", "rep")
    join = _Join(docs, doc_id, text, reps, trees)
    join.run()
    placed = every.select("doc_id", "n_shingles", "high", "low").join(classes, ["high", "low"], "left")
    if join.connected is not None:
        placed = placed.join(join.connected.withColumnRenamed("vertex", "rep"), "rep", "left")
    else:
        placed = placed.withColumn("component", F.lit(None).cast("long"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "rep"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component, with all their columns; rows with a null id stay."""
    decided = near_duplicates(docs, doc_id, text).where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = decided.where("not kept").select(F.col("doc_id").alias("_gone"))
    names = docs.columns
    rows = docs.toDF(*[f"_c{k}" for k in range(len(names))])
    return rows.join(gone, F.col(f"_c{names.index(doc_id)}") == F.col("_gone"), "left_anti").toDF(*names)
