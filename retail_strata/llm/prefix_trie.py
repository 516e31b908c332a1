"""Conversation prefix trie by truncation peeling.

A node is a distinct sequence of first turns (role, text); its members are the conversations that
begin with it. The trie is peeled from its deepest level up: at depth d the conversations of d turns
join the nodes that survived from depth d + 1, what has the same turns is one node, its figures are
summed as it is found, and its last turn is stripped, which gives the node that it joins at d - 1.

A sequence is held as the XOR of its turns' hashes, each with its place (two times 64 bits), so that
stripping a turn is one XOR and no list of turns is carried.

The peeling is cut where groups get large. Distinct sequences that share a node with at most
``LIGHT`` of them are peeled in one task, at any depth, sorted from the deepest turn up: the task
holds the nodes of two levels, which are no more than the sequences. Nodes with more (``heavy``) are
peeled level by level by Spark, from one row for each light part below them and one for each heavy
end, by sums that are combined before they are shuffled. Copies of a whole conversation count as one
sequence from the start. So no group of rows has to fit a task, however many share their first
turns; the rounds are as many as the deepest heavy node has turns.

Turns are ordered by their number, null first (ties: by role, then by the text's hash); their places
come from one range shuffle, which can cut through a conversation. Null roles and texts count as
empty; rows without a conversation id are left out. Without conversations there are no rows, not
even a root. Only the columns named are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_strata.llm.common import stage
from retail_strata.operators.keys import assign_surrogate_keys

#: Most distinct sequences that one task peels together.
LIGHT = 512
#: Turns over which a running XOR goes at a time, so that no window holds a whole conversation.
BLOCK = 1024
#: Member ids in a piece of the text that is hashed.
PIECE = 16_384

WORDS = r"[^\x20\x09-\x0D]+"


def number_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, depth, t1, t2, words)``: each turn's place from 1, its hashes and its words."""
    said = F.coalesce(F.col(role), F.lit("")).alias("role")
    words = F.coalesce(F.col(text), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        said,
        F.xxhash64(F.lit(1), said, words).alias("t1"),
        F.xxhash64(F.lit(2), words, said).alias("t2"),
        F.regexp_count(words, F.lit(WORDS)).cast("bigint").alias("words"),
    )
    placed = assign_surrogate_keys(rows, ["conv", "turn", "role", "t1", "t2"], 0, "place")
    first = placed.groupBy("conv").agg(F.min("place").alias("first"))
    return placed.join(first, "conv").select(
        "conv", (F.col("place") - F.col("first") + 1).alias("depth"), "t1", "t2", "words"
    )


def graft(turns: DataFrame, every: int, most: int, heads: Column) -> tuple[DataFrame, DataFrame]:
    """Turns of every conversation with its head replaced, and all conversations (``conv``).

    Conversation c gets the first ``heads`` turns of conversation c - c % every, then its own turns
    after its first ``heads``. ``heads`` is a column over ``conv`` and at most ``most``.
    """
    turns = stage(turns, "numbered")
    convs = turns.select("conv").distinct()
    base = turns.where((F.col("conv") % every == 0) & (F.col("depth") <= most)).select(
        F.col("conv").alias("base"), *[c for c in turns.columns if c != "conv"]
    )
    head = (
        convs.withColumn("base", F.col("conv") - F.col("conv") % every)
        .join(base, "base")
        .where(F.col("depth") <= heads)
        .select(*turns.columns)
    )
    head = stage(head, "heads")
    got = head.groupBy("conv").agg(F.count(F.lit(1)).alias("got"))
    own = (
        turns.where(F.col("depth") > heads)
        .join(got, "conv", "left")
        .select(
            "conv",
            (F.col("depth") - heads + F.coalesce("got", F.lit(0))).alias("depth"),
            *turns.columns[2:],
        )
    )
    return head.unionByName(own), convs


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, depth, p1, p2, u1, u2, words)``: the node after each turn and the one above it."""
    block = F.floor((F.col("depth") - 1) / BLOCK)
    rows = turns.select(
        "conv",
        "depth",
        block.alias("block"),
        F.xxhash64("t1", "t2", "depth").alias("h1"),
        F.xxhash64("depth", "t2", "t1").alias("h2"),
        "words",
    )
    within = Window.partitionBy("conv", "block").orderBy("depth")
    rows = rows.withColumns(
        {"p1": F.bit_xor("h1").over(within), "p2": F.bit_xor("h2").over(within)}
    )
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        turns.where(F.col("depth") > 0)
        .select(
            "conv",
            block.alias("block"),
            F.xxhash64("t1", "t2", "depth").alias("h1"),
            F.xxhash64("depth", "t2", "t1").alias("h2"),
        )
        .groupBy("conv", "block")
        .agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    )
    starts = totals.select(
        "conv",
        "block",
        F.coalesce(F.bit_xor("h1").over(earlier), F.lit(0)).alias("s1"),
        F.coalesce(F.bit_xor("h2").over(earlier), F.lit(0)).alias("s2"),
    )
    node = {f"p{k}": F.col(f"p{k}").bitwiseXOR(F.col(f"s{k}")) for k in (1, 2)}
    return rows.join(starts, ["conv", "block"]).select(
        "conv",
        "depth",
        *[node[f"p{k}"].alias(f"p{k}") for k in (1, 2)],
        *[node[f"p{k}"].bitwiseXOR(F.col(f"h{k}")).alias(f"u{k}") for k in (1, 2)],
        "words",
    )


def member_digests(ends: DataFrame) -> DataFrame:
    """``(p1, p2, ends_sha256)`` of each node at which conversations end, ids ascending.

    ``ends`` is ``(p1, p2, conv)``. Ids are sorted by a range shuffle that can cut through a node and
    become pieces of text; a node's pieces, one for ``PIECE`` ids and task, are hashed in order as
    they come, so a node of any number of members takes bounded memory.
    """

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def made() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_pylist(
                [{"p1": node[0], "p2": node[1], "first": ids[0], "text": text}], _PIECES
            )

        for batch in batches:
            for p1, p2, conv in zip(*(batch[c].to_pylist() for c in ("p1", "p2", "conv")), strict=True):
                if ids and (node != (p1, p2) or len(ids) >= PIECE):
                    yield made()
                    ids = []
                node = (p1, p2)
                ids.append(conv)
        if ids:
            yield made()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            found = []
            for p1, p2, text in zip(*(batch[c].to_pylist() for c in ("p1", "p2", "text")), strict=True):
                if node == (p1, p2):
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    found.append((*node, state.hexdigest()))
                node, state = (p1, p2), hashlib.sha256(text.encode())
            yield _digests(found)
        if state is not None:
            yield _digests([(*node, state.hexdigest())])

    return (
        ends.orderBy("p1", "p2", "conv")
        .mapInArrow(pieces, "p1 bigint, p2 bigint, first bigint, text string")
        .repartition("p1", "p2")
        .sortWithinPartitions("p1", "p2", "first")
        .mapInArrow(hashed, "p1 bigint, p2 bigint, ends_sha256 string")
    )


_PIECES = pa.schema(
    [("p1", pa.int64()), ("p2", pa.int64()), ("first", pa.int64()), ("text", pa.string())]
)


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    p1, p2, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(p1, pa.int64()), pa.array(p2, pa.int64()), pa.array(digest, pa.string())],
        ["p1", "p2", "ends_sha256"],
    )


#: A node as it is found: what it is, what it is stripped to, and its figures.
_NODE = (
    "depth bigint, p1 bigint, p2 bigint, u1 bigint, u2 bigint, conv_id bigint, parent_conv_id bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
)
_NODE_NAMES = [x.split()[0] for x in _NODE.split(", ")]


class _Level:
    """The nodes of one depth in a task: by node ``[u, words, conv, convs, children, leaves, saved]``."""

    def __init__(self, depth: int) -> None:
        self.depth, self.nodes = depth, {}

    def join(self, p: tuple, u: tuple, words: int, conv: int, ended: int) -> None:
        """A sequence passes here; ``ended`` are its conversations if it ends here."""
        node = self.nodes.get(p)
        if node is None:
            self.nodes[p] = [u, words, conv, ended, 0, 0, 0]
        else:
            node[2] = min(node[2], conv)
            node[3] += ended

    def finish(self, below: _Level | None) -> Iterator[tuple]:
        """Take over the surviving nodes from one level down and give them out, parents known."""
        for p, (u, _, conv, convs, children, leaves, saved) in (below.nodes if below else {}).items():
            node = self.nodes[u]
            node[3] += convs
            node[4] += 1
            node[5] += leaves
            node[6] += saved
            yield (below.depth, *p, *u, conv, node[2], convs, children, leaves, saved)
        for node in self.nodes.values():
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * node[1]

    def tops(self) -> Iterator[tuple]:
        for p, (u, _, conv, convs, children, leaves, saved) in self.nodes.items():
            yield (self.depth, *p, *u, conv, None, convs, children, leaves, saved)


def _peel(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peel light parts: rows by part, deepest first. A part's top nodes have no parent yet."""
    names = ["g1", "g2", "depth", "p1", "p2", "u1", "u2", "words", "conv", "ended"]
    part, below, level, found = None, None, None, []
    for batch in batches:
        for g1, g2, depth, p1, p2, u1, u2, words, conv, ended in zip(
            *(batch[c].to_pylist() for c in names), strict=True
        ):
            if level is not None and (part != (g1, g2) or level.depth != depth):
                found += level.finish(below)
                below, level = level, None
                if part != (g1, g2):
                    found += below.tops()
                    below = None
            if level is None:
                part, level = (g1, g2), _Level(depth)
            level.join((p1, p2), (u1, u2), words, conv, ended)
            if len(found) >= 10_000:
                yield _nodes(found)
                found = []
    if level is not None:
        found += level.finish(below)
        found += level.tops()
    yield _nodes(found)


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_NODE_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _NODE_NAMES)


def build_trie(turns: DataFrame, convs: DataFrame, light: int = LIGHT) -> DataFrame:
    """One row a node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns`` is ``(conv, depth, t1, t2, words)`` as of ``number_turns``, ``convs`` all
    conversations, those without turns included. ``light`` is the most sequences a task peels.
    """
    path = stage(prefixes(turns), "prefixes")
    last = path.groupBy("conv").agg(F.max_by(F.struct("p1", "p2", "depth"), "depth").alias("end"))
    ends = convs.join(last, "conv", "left").select(
        "conv",
        *[F.coalesce(f"end.{c}", F.lit(0)).cast("bigint").alias(c) for c in ("p1", "p2", "depth")],
    )
    ends = stage(ends, "ends")
    digests = stage(member_digests(ends.select("p1", "p2", "conv")), "digests")

    # Each distinct sequence once, by its least conversation, with the number of its copies.
    sequences = ends.groupBy("p1", "p2").agg(
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("copies"),
        F.max("depth").alias("length"),
    )
    sequences = stage(sequences, "sequences").select("conv", "copies", "length")
    root = F.lit(0).cast("bigint")
    steps = path.join(sequences, "conv").select(
        "conv",
        "depth",
        "p1",
        "p2",
        "u1",
        "u2",
        "words",
        F.when(F.col("depth") == F.col("length"), F.col("copies")).otherwise(0).alias("ended"),
    )
    tops = sequences.select(
        "conv",
        root.alias("depth"),
        *[root.alias(c) for c in ("p1", "p2", "u1", "u2", "words")],
        F.when(F.col("length") == 0, F.col("copies")).otherwise(0).alias("ended"),
    )
    steps = stage(steps.unionByName(tops), "steps")

    heavy = steps.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth"))
    heavy = stage(heavy.where(F.col("n") > light).select("p1", "p2", "depth"), "heavy")
    marked = steps.join(heavy.select("p1", "p2", F.lit(True).alias("heavy")), ["p1", "p2"], "left")
    marked = stage(marked.withColumn("heavy", F.col("heavy").isNotNull()), "marked")

    # A sequence's light part begins below its deepest heavy node.
    begins = (
        marked.where("not heavy")
        .groupBy("conv")
        .agg(F.min_by(F.struct("p1", "p2"), "depth").alias("part"))
        .select("conv", F.col("part.p1").alias("g1"), F.col("part.p2").alias("g2"))
    )
    nodes = (
        marked.where("not heavy")
        .drop("heavy")
        .join(begins, "conv")
        .repartition("g1", "g2")
        .sortWithinPartitions("g1", "g2", F.desc("depth"))
        .select("g1", "g2", "depth", "p1", "p2", "u1", "u2", "words", "conv", "ended")
        .mapInArrow(_peel, _NODE)
    )
    nodes = stage(nodes, "light-nodes")
    ended = marked.where("heavy").groupBy("depth", "p1", "p2").agg(
        *[F.first(c).alias(c) for c in ("u1", "u2", "words")],
        F.min("conv").alias("conv_id"),
        F.sum("ended").alias("n_convs"),
    )
    nodes = _peel_heavy(nodes, stage(ended, "heavy-nodes"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(digests, ["p1", "p2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def _peel_heavy(nodes: DataFrame, heavy: DataFrame) -> DataFrame:
    """All nodes: ``nodes`` below heavy ones, and the heavy ones, a level a round from the deepest.

    ``heavy`` has each heavy node with its turn's words, its least member and the conversations that
    end there.
    """
    levels = sorted((r["depth"] for r in heavy.select("depth").distinct().collect()), reverse=True)
    known = heavy.select(F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.col("conv_id").alias("above"))
    done = []
    for depth in levels:  # as many as a heavy node has turns
        parts = [nodes.where((F.col("depth") == depth + 1) & F.col("parent_conv_id").isNull())]
        if done:
            parts.append(done[-1])
        sums = None
        for part in parts:
            sums = part if sums is None else sums.unionByName(part)
        sums = sums.groupBy(F.col("u1").alias("p1"), F.col("u2").alias("p2")).agg(
            F.sum("n_convs").alias("convs"),
            F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"),
        )
        zero = F.lit(0).cast("bigint")
        found = (
            heavy.where(F.col("depth") == depth)
            .join(sums, ["p1", "p2"], "left")
            .withColumn("n_convs", F.col("n_convs") + F.coalesce("convs", zero))
            .select(
                "depth",
                "p1",
                "p2",
                "u1",
                "u2",
                "conv_id",
                F.lit(None).cast("bigint").alias("parent_conv_id"),
                "n_convs",
                F.coalesce("n_children", zero).alias("n_children"),
                F.coalesce("leaves", F.lit(1).cast("bigint")).alias("n_leaves"),
                (F.coalesce("saved", zero) + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
            )
        )
        done.append(stage(found, "heavy-level"))
    for level in done:
        nodes = nodes.unionByName(level)
    return nodes.join(known, ["u1", "u2"], "left").withColumn(
        "parent_conv_id",
        F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "above")),
    )
