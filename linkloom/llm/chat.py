"""Reply trees as conversations: enumerate root-to-leaf paths, rank branches, format each chosen path.

Iterative self-joins double what every node knows of its ancestors: after round i, the ancestor 2**i steps up
and the score on the way. Nodes that have reached their root drop out, so a round joins only those still
climbing, and a chain of n turns takes log2(n) rounds. The leaves of a tree are ranked by the score of their
path; the paths of the chosen ones are unfolded over the same tables, largest step first, which meets every
ancestor exactly once. Only ids take part, in tables of long integers that go once no round reads them; texts join
once, at the end, and are formatted as a sorted stream. Turns are put in order by their digests, without the texts.

The template marks each turn as ``### role: text </turn>`` and a newline. In texts and roles a backslash, ``#``
and ``<``, and in roles also ``:``, are written as a backslash and a letter (or a second backslash); so no mark can
occur in them, and the reverse restores them. The loss mask is the span of each assistant's text.

Edge cases: null texts and roles are empty; null scores count 0; a parent that isn't there makes a root; nodes on
a cycle have no root and are on no path; equal paths' scores rank by leaf id; turns of a conversation with equal
numbers are ordered by role and the text's MD5, null turns first; equal rows stay, one after another; rows without a
conversation id form one of their own, which like any conversation has to fit one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import drop, scratch, slices, written

#: Fixed values of the template.
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
ASSISTANT = "assistant"
#: What stands, after a backslash, for a character that could begin or end a mark.
CODES = {"\\": "\\", "#": "h", "<": "l", ":": "c"}
PLAIN = {v: k for k, v in CODES.items()}
TURN = re.compile(r"### ((?:[^\\:#<]|\\.)*): ((?:[^\\#<]|\\.)*) </turn>\n", re.DOTALL)


def escape(text: str, more: str = "") -> str:
    return re.sub(rf"[\\#<{more}]", lambda m: "\\" + CODES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: PLAIN[m[1]], text)


# --- paths ------------------------------------------------------------------------------------------


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Steps (tree, node, up: the ancestor 2**i steps up) by round, and every node's (tree, node, depth, score).

    ``nodes``: tree, node, parent, score, with unique (tree, node).
    """
    ids = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    own = nodes.join(ids, nodes["tree"].eqNullSafe(ids["t"]) & (nodes["parent"] == ids["n"]) & (nodes["parent"] != nodes["node"]), "left")
    own = own.select("tree", "node", F.col("n").alias("up"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    # a round's table has the nodes that still climbed; score: of the node and its next 2**i - 1 ancestors; steps: how far ``up`` is
    step = written(own.withColumn("steps", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "step0")
    rounds, through, total = [], step.where("up IS NULL"), nodes.count()
    while 1 << len(rounds) <= 2 * total:
        climbing = step.where("up IS NOT NULL")
        if not climbing.head(1):
            break
        rounds.append(climbing.select("tree", "node", "up"))
        # one step further: from the ancestor on; ancestors that are through give what they have
        ahead = climbing.unionByName(through)
        ahead = ahead.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("score").alias("more"), F.col("steps").alias("steps2"))
        far = climbing.join(ahead, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")))
        far = far.select("tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("more")).alias("score"), (F.col("steps") + F.col("steps2")).alias("steps"))
        step = written(far, f"step{len(rounds)}")
        through = through.unionByName(step.where("up IS NULL"))
    return rounds, through.select("tree", "node", F.col("steps").alias("depth"), "score")


def paths(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """tree, branch (1: the best score), leaf, node, depth: a row per node of every chosen root-to-leaf path, as a written table.

    ``top``: branches of a tree to take; all if None.
    """
    with scratch(nodes.sparkSession) as keep:
        rounds, depths = climb(nodes)
        parents = nodes.where("parent IS NOT NULL AND parent <> node").select(F.col("tree").alias("t"), F.col("parent").alias("n")).distinct()
        leaves = depths.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
        order = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
        leaves = leaves.withColumn("branch", F.row_number().over(order))
        if top is not None:
            leaves = leaves.where(F.col("branch") <= top)
        found = written(leaves.select("tree", "branch", F.col("node").alias("leaf"), "node", "depth"), "leaves")
        for i in range(len(rounds) - 1, -1, -1):
            up = rounds[i].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
            further = found.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
            further = further.select("tree", "branch", "leaf", F.col("up").alias("node"), (F.col("depth") - (1 << i)).alias("depth"))
            past, found = found, written(found.unionByName(further), f"path{i}")
            drop(past)
        return keep(found)


# --- formatting -------------------------------------------------------------------------------------


def formatted(nodes: DataFrame, top: int | None = None, texts: DataFrame | None = None, on: tuple[str, ...] = ("tree", "node")) -> DataFrame:
    """tree, branch, formatted, spans (start and end, in code points, of each text under the loss mask).

    ``nodes``: tree, node, parent, score, and role and text unless ``texts`` has these, by the columns ``on`` of
    both. One row per chosen path; its turns arrive sorted.
    """
    texts = nodes if texts is None else texts
    chosen = paths(nodes.select("tree", "node", "parent", "score"), top)
    if tuple(on) != ("tree", "node"):
        own = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), *[F.col(c).alias(f"on_{c}") for c in on if c != "tree"])
        chosen = chosen.join(own, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).drop("t", "n")
    said = texts.select(*[F.col(c).alias(f"of_{c}") for c in on], *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    match = [F.col(c if c in ("tree", "node") else f"on_{c}").eqNullSafe(F.col(f"of_{c}")) for c in on]
    rows = chosen.join(said, reduce(lambda a, b: a & b, match))
    rows = rows.select("tree", "branch", "depth", "role", "text").repartition("tree", "branch").sortWithinPartitions("tree", "branch", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["tree", "branch", "formatted", "starts", "ends"]
        key, parts, starts, ends, at = None, [], [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, "".join(parts), starts, ends), kinds)], names)

        for batch in slices(batches, "text", 4 << 20):
            for tree, branch, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (tree, branch) != key:
                    if key is not None:
                        yield flush()
                    key, parts, starts, ends, at = (tree, branch), [], [], [], 0
                head, body = f"{OPEN}{escape(role, ':')}{MIDDLE}", escape(text)
                if role == ASSISTANT:
                    starts.append(at + len(head))
                    ends.append(at + len(head) + len(body))
                parts += [head, body, CLOSE]
                at += len(head) + len(body) + len(CLOSE)
        if key is not None:
            yield flush()

    return rows.mapInArrow(run, "tree long, branch long, formatted string, starts array<long>, ends array<long>")


def turns(formatted_text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    out, at = [], 0
    for m in TURN.finditer(formatted_text):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted_text):
        raise ValueError(f"no turn at {at}")
    return out


def read_back(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each formatted conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "branch"]
        for batch in slices(batches, "formatted", 4 << 20):
            out = []
            for tree, branch, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
                said = turns(text)
                every = "".join(f"{role}\n{body}\n" for role, body in said)
                loss = "".join(unescape(text[a:b]) for a, b in zip(starts, ends))
                sha = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (every, loss)]
                out.append((tree, len(said), sha[0], len(loss), sha[1], len(text), branch))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds)], names)

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, branch long")


#: What identifies a turn's text beside its conversation, and orders it.
TURN_KEY = ("turn", "role", "digest")


def as_trees(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, turn, role, text) as reply trees, each turn replying to the one before.

    The nodes (tree, node, parent, score and ``TURN_KEY``), a written table without texts, and the texts by
    ``tree`` and ``TURN_KEY``, once where rows are equal: the arguments ``nodes`` and ``texts`` of ``formatted``.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("digest", F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long"))  # 60 bits, in the order of the whole
    order = Window.partitionBy("tree").orderBy("turn", "role", "digest")
    nodes = rows.drop("text").withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    nodes = nodes.select("tree", "node", parent.alias("parent"), F.lit(1.0).alias("score"), *TURN_KEY)
    return written(nodes, "nodes"), rows.dropDuplicates(["tree", *TURN_KEY])


def conversations_formatted(conversations: DataFrame) -> DataFrame:
    """``formatted`` of conversations as reply trees."""
    nodes, texts = as_trees(conversations)
    return formatted(nodes, None, texts, ("tree", *TURN_KEY))


#: The same in DuckDB, from the turns themselves.
SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + 15 AS chars FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, 1::BIGINT AS branch
FROM e GROUP BY conv_id
"""
