"""Chat formatting: reply trees to ranked root-to-leaf paths to marked-up conversations."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: The template's control strings: they open and close a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Roles whose text is under the loss mask.
LOSS_ROLES = ("assistant",)
_TURN = re.compile(re.escape(OPEN) + r"((?:\\.|[^\\\n])*)\n(.*?)" + re.escape(CLOSE) + "\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column) -> Column:
    r"""Without control strings: \ becomes \\ and <| becomes <\|, so that dropping each escaping \ gives the text back."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted_turn(role: Column, text: Column) -> Column:
    head = F.replace(escaped(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit("\\\n"))
    return F.concat(F.lit(OPEN), head, F.lit("\n"), escaped(F.coalesce(text, F.lit(""))), F.lit(CLOSE + "\n"))


def pointers(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, up, total, depth) of every node after its pointer has gone up as far as it can, and the pointers of each round.

    Self-joins double the reach of every node's pointer each round, summing
    scores on the way, so a path of n turns takes log2(n) rounds.  up is null
    where a root was met; a node that still has one is on or below a circle.
    """
    there = nodes.select("tree", F.col("node").alias("parent")).withColumn("ok", F.lit(True))
    now = nodes.join(there, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("ok"), F.col("parent")).alias("up"), F.col("score").cast("double").alias("total"), F.lit(1).cast("long").alias("depth"))
    now, steps = materialize(now, "pointers"), []
    limit = max(1, nodes.count()).bit_length() + 1
    while len(steps) < limit and not (open_ := now.where("up is not null")).isEmpty():
        steps.append(open_.select("tree", "node", "up"))
        above = now.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"), F.col("depth").alias("depth2"))
        # nodes that have met their root stand still: only the others are joined
        more = open_.join(above, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("depth") + F.col("depth2")).alias("depth"))
        now = materialize(now.where("up is null").unionByName(more), "pointers")
    return now, steps


def circular_nodes(nodes: DataFrame) -> DataFrame:
    """(tree, node) of the nodes without a root, on or below a circle of parents: what ranked_paths leaves out."""
    return pointers(nodes)[0].where("up is not null").select("tree", "node")


def ranked_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, place) of the nodes on the best `keep` root-to-leaf paths of each tree.

    nodes: tree, node, parent, score.  The pointers that find the roots
    enumerate the chosen paths in the same rounds.  Branches rank by mean score,
    then total, then node.  A parent that isn't there makes its node a root;
    nodes on or below a circle have no root and are left out (circular_nodes).
    """
    now, steps = pointers(nodes)
    rooted = now.where("up is null")
    leaves = rooted.join(nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy((F.col("total") / F.col("depth")).desc(), F.col("total").desc(), "node")
    best = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    paths = best.select("tree", F.col("node").alias("leaf"), "rank", "node", F.col("depth").alias("place"))
    for k, step in enumerate(steps):
        paths = paths.unionByName(paths.join(step, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("place") - F.lit(1 << k)).alias("place")))
        if k % 4 == 3:
            paths = materialize(paths, "paths")
    return paths


def tree_key(conv: Column) -> Column:
    """A join key that null has too."""
    return F.coalesce(conv.cast("string"), F.lit("\0null"))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", parent_col: str | None = None, score_col: str | None = None, keep: int = 1) -> DataFrame:
    """(conv_id, rank, place, piece): the formatted turns of each chosen path; a conversation's text is its pieces in order.

    Without parent_col every turn answers the one before it (by turn, then role,
    then text, so that repeated rows stay and have one order).  With it, turn_col
    names a turn and parent_col the turn that it answers; both are unique in a
    conversation.  Null texts and roles are empty, a null conversation is one of
    its own, an empty table gives no rows, other columns are not read.
    """
    base = rows.select(tree_key(F.col(conv_col)).alias("tree"), F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), (F.col(score_col) if score_col else F.lit(0.0)).alias("score"), *([F.col(parent_col).alias("parent")] if parent_col else []))
    if not parent_col:
        base = base.withColumn("node", F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
    else:
        base = base.withColumnRenamed("turn", "node")
    base = materialize(base.select("tree", "conv_id", "node", "parent", "score", formatted_turn(F.col("role"), F.col("text")).alias("piece")), "turns")
    paths = ranked_paths(base.select("tree", "node", "parent", "score"), keep)
    return paths.join(base.select("tree", "node", "conv_id", "piece"), ["tree", "node"]).select("conv_id", "rank", "place", "piece")


class Reader:
    """Parses a formatted conversation that arrives in parts, and digests it."""

    def __init__(self, loss_roles: tuple[str, ...] = LOSS_ROLES):
        self.loss_roles, self.rest = loss_roles, ""
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, part: str) -> None:
        self.chars += len(part)
        self.rest += part
        at = 0
        for m in _TURN.finditer(self.rest):
            if m.start() != at:
                raise ValueError("text between turns")
            at = m.end()
            role, text = unescaped(m[1]), unescaped(m[2])
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role in self.loss_roles:
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.rest = self.rest[at:]

    def row(self) -> tuple[int, str, int, str, int]:
        if self.rest:
            raise ValueError("a turn has no end")
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_conversations(pieces: DataFrame) -> DataFrame:
    """A row for each formatted conversation, read back from its pieces.

    Pieces are sorted on disk where needed and streamed, so a conversation of
    any length takes the memory of a batch.  A digest runs over a conversation
    from first to last turn; one conversation is therefore one task's work.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "rank", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [None, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader, done = None, None, []

        def out(kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t or kind) for c, t in zip(cols, types, strict=True)], names=names)

        seen = pa.int64()
        for b in batches:
            seen = b.column(0).type
            for conv, rank, piece in zip(*(b.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if at != (conv, rank):
                    if reader:
                        done.append((*at, *reader.row()))
                    at, reader = (conv, rank), Reader()
                reader.feed(piece)
            yield out(seen)
            done.clear()
        if reader:
            done.append((*at, *reader.row()))
            yield out(seen)

    ordered = pieces.select("conv_id", "rank", "place", "piece").repartition(tree_key(F.col("conv_id")), "rank").sortWithinPartitions("conv_id", "rank", "place")
    return ordered.mapInArrow(run, f"conv_id {kind}, rank long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
