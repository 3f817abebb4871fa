"""Chat formatting of reply trees.

A message names its parent; leaves end branches. Iterative self-joins double how
far each message points up (1, 2, 4, ... replies), which also adds up scores;
then, from the longest jumps down, every leaf gathers the messages above it. So
a tree of depth d takes about log2(d) rounds and each path is listed once. Per
conversation the branches are ranked by total score and the best ones formatted,
each as one conversation: its formatted turns, in order, are its text.

A turn is written ``### role: text </turn>`` and a line end. Inside roles and
texts a backslash goes before every backslash, ``#`` and ``<`` (in roles also
``:``), so no text can hold a mark and taking the backslashes away gives the
text back. The loss mask holds the spans, in code points, of assistant texts.

Turns stay rows (``format_trees``), which no conversation is too long for; reading
back streams them in order, as digests of a whole conversation need one reader.
``conversations`` puts each into one cell, whose limit is 2 GB.

Defined results: a null text or role is empty; a message whose parent is missing
starts a branch; messages on a cycle are on no branch; rows that tie in order are
ordered by role and text, and repeated rows are turns of their own; a null
conv_id is one more conversation; an empty table gives an empty table; extra
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import save, ship, slices

END = " </turn>\n"
MARK = "### "
_BACK = re.compile(r"\\(.)", re.S)
#: Runs of plain characters at a time: a pattern of single alternatives would keep a state for each.
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*) </turn>\n", re.S)


def unescape(s: str) -> str:
    return _BACK.sub(r"\1", s) if "\\" in s else s


def formatted_turn(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """The formatted turn, and where in it the text begins and ends."""
    head = F.concat(F.lit(MARK), F.regexp_replace(role, r"([\\#<:])", r"\\$1"), F.lit(": "))
    body = F.regexp_replace(text, r"([\\#<])", r"\\$1")
    start = F.char_length(head)
    return F.concat(head, body, F.lit(END)), start, start + F.char_length(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of one or more formatted turns, read back."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def linear_tree(rows: DataFrame) -> DataFrame:
    """Message rows (conv_id, turn, role, text) as trees of one branch: each turn replies to the one before."""
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "role", "text", F.lit(0.0).alias("score"), F.row_number().over(by_turn).cast("long").alias("node")).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def branches(nodes: DataFrame, best: int = 1, max_rounds: int = 40) -> DataFrame:
    """(tree, leaf, rank, node, up): the messages of each tree's ``best`` branches, ``up`` replies above the leaf.

    ``nodes``: tree (not null), node, parent, score; a node id is unique in its tree.
    """
    present = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    answered = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node"), F.lit(False).alias("leaf")).distinct()
    near = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")).join(present, ["tree", "parent"], "left").join(answered, ["tree", "node"], "left")
    jump = save(near.select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("to"), "score", F.coalesce("leaf", F.lit(True)).alias("leaf")), "jump")
    jumps, done, active = [], [jump.where("to IS NULL")], jump.where("to IS NOT NULL")
    while len(jumps) < max_rounds and not active.isEmpty():
        # only messages whose jump has not passed the root go on, so the many short branches end early
        jumps.append(active.select("tree", "node", "to"))
        beyond = reduce(DataFrame.unionByName, done, active).select("tree", F.col("node").alias("to"), F.col("to").alias("further"), F.col("score").alias("more"))
        jump = save(active.join(beyond, ["tree", "to"]).select("tree", "node", F.col("further").alias("to"), (F.col("score") + F.col("more")).alias("score"), "leaf"), "jump")
        done.append(jump.where("to IS NULL"))
        active = jump.where("to IS NOT NULL")
    # where no jump is left, the score is that of the whole branch; on a cycle one always is
    ends = reduce(DataFrame.unionByName, done).where("leaf")
    by_score = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    leaves = ends.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= best)
    paths = leaves.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(jumps))):
        paths = save(paths, "paths")
        paths = paths.unionByName(paths.join(jumps[k], ["tree", "node"]).select("tree", "leaf", "rank", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up")))
    return paths


def format_trees(nodes: DataFrame, best: int = 1, learned: str = "assistant") -> DataFrame:
    """The turns of each chosen branch of (conv_id, node, parent, role, text, score), saved.

    tree, conv_id, leaf, rank, place (from 1), formatted, loss_from, loss_to (in
    code points of ``formatted``; null where nothing is to be learned).
    """
    keyed = save(nodes.select("conv_id", "node", "parent", "score", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]).withColumn("tree", F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))), "nodes")
    chosen = branches(keyed.select("tree", "node", "parent", "score"), best)
    turns = chosen.join(keyed.select("tree", "conv_id", "node", "role", "text"), ["tree", "node"])
    formatted, start, stop = formatted_turn(F.col("role"), F.col("text"))
    learn = lambda c: F.when(F.col("role") == learned, c)
    return save(turns.select("tree", "conv_id", "leaf", F.col("rank").cast("int").alias("rank"), (-F.col("up")).alias("place"), formatted.alias("formatted"), learn(start).alias("loss_from"), learn(stop).alias("loss_to")), "turns")


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, leaf, rank, formatted, loss (spans as from, to): each conversation in one cell."""
    listed = turns.groupBy("tree", "leaf", "rank").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("place", "formatted", "loss_from", "loss_to"))).alias("t"))
    length = F.transform("t", lambda x: F.char_length(x["formatted"]))
    at = F.transform("t", lambda x, i: F.aggregate(F.slice(length, F.lit(1), i), F.lit(0), lambda s, y: s + y))
    spans = F.filter(F.zip_with("t", at, lambda x, n: F.struct((x["loss_from"] + n).alias("from"), (x["loss_to"] + n).alias("to"))), lambda x: x["from"].isNotNull())
    return listed.select("conv_id", "leaf", "rank", F.concat_ws("", "t.formatted").alias("formatted"), spans.alias("loss"))


def read_back(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, digests of the turns and of the text under the loss mask, read from formatted turns."""
    ship(turns.sparkSession)
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, out = None, [], []

        def close() -> None:
            if now is not None:
                conv, n, whole, chars, loss, length = own
                out.append((conv, n, whole.hexdigest(), chars, loss.hexdigest(), length))

        def emit() -> pa.RecordBatch:
            cols = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            for part in slices(batch, 3):
                for tree, leaf, conv, piece, low, high in zip(*(c.to_pylist() for c in part.columns)):
                    if now != (tree, leaf):
                        close()
                        now, own = (tree, leaf), [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for role, text in read_turns(piece):
                        own[1] += 1
                        own[2].update(f"{role}\n{text}\n".encode())
                    if low is not None:
                        loss = unescape(piece[low:high])
                        own[3] += len(loss)
                        own[4].update(loss.encode())
                    own[5] += len(piece)
                if len(out) > 2000:
                    yield emit()
        close()
        if out:
            yield emit()

    n = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = turns.repartition(n, "tree", "leaf").sortWithinPartitions("tree", "leaf", "place")
    return ordered.select("tree", "leaf", "conv_id", "formatted", "loss_from", "loss_to").mapInArrow(run, schema)
