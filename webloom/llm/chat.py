"""Chat formatting of reply trees.

Messages name their parents. Root-to-leaf paths are enumerated by iterative self-joins that double in reach: after step i every
message knows its ancestor 2^i replies up, its distance and the sum of scores to there, so a path of n messages takes log2(n)
joins. Branches are ranked by score, and each chosen path becomes one conversation.

The template marks a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts (and roles) every ``<|`` becomes ``<\\|`` and every
backslash between ``<`` and ``|`` gets one more, so that a text can't hold a control string; ``parse`` undoes it exactly. The loss
mask covers the assistant texts.

Defined results: null texts and roles are empty; a null tree id is a tree of its own; messages whose parent is missing or null are
roots; messages on a cycle have no root and are left out, as are messages without an id; of messages of one id in a tree the one
with the smallest parent, role, text and score counts (null first); equal scores are ranked by the smaller leaf. Extra columns aren't read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import checkpointed

START, END = "<|im_start|>", "<|im_end|>"
#: A line feed in a role; it can't come from a role's own text, in which every ``<|`` is escaped.
NEWLINE = "<|nl|>"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<(\\+)\|")
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escaped(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "<" + m[1][1:] + "|", text)


def formatted(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and the stretches of code points under the loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        role, body = role or "", escaped(text or "")
        head = f"{START}{escaped(role).replace(chr(10), NEWLINE)}\n"
        out += [head, body, END, "\n"]
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), mask


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescaped(m[1].replace(NEWLINE, "\n")), unescaped(m[2])) for m in TURN.finditer(text)]


def _tree(name: str):
    """The tree's id in a struct, so that a null id is equal to another in joins."""
    return F.struct(F.col(name).alias("id")).alias("tree")


def paths(messages: DataFrame, tree: str, message: str, parent: str, score: str | None = None) -> DataFrame:
    """(tree, leaf, root, depth, score): every root-to-leaf path by its leaf; score: the sum over the path.

    depth counts the messages of a path."""
    rows = messages.select(_tree(tree), F.col(message).alias("id"), F.col(parent).alias("up"), F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score") if score else F.lit(0.0).alias("score"))
    known = rows.select("tree", F.col("id").alias("up")).distinct().withColumn("there", F.lit(True))
    jumps = rows.join(known, ["tree", "up"], "left").select("tree", "id", F.when(F.col("there"), F.col("up")).alias("up"), F.lit(1).cast("long").alias("depth"), "score")
    jumps = checkpointed(jumps.withColumn("root", F.when(F.col("up").isNull(), F.col("id"))))
    state = lambda: jumps.agg(F.count("up"), F.max("depth"), F.count(F.lit(1))).first()
    moving, _, total = state()
    leaves = jumps.select("tree", F.col("up").alias("id")).where("id is not null").distinct()
    while moving:
        far = jumps.select("tree", F.col("id").alias("up"), F.col("up").alias("far"), F.col("depth").alias("more"), F.col("score").alias("gain"), F.col("root").alias("top"))
        joined = jumps.where("up is not null").join(far, ["tree", "up"])
        moved = joined.select("tree", "id", F.col("far").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("score") + F.col("gain")).alias("score"), F.col("top").alias("root"))
        jumps = checkpointed(jumps.where("up is null").unionByName(moved))
        before, (moving, depth, _) = moving, state()
        if moving == before and (depth or 0) > 2 * total:
            break  # what still moves goes round in circles
    done = jumps.where("root is not null")
    return done.join(leaves, ["tree", "id"], "left_anti").select(F.col("tree.id").alias("tree"), F.col("id").alias("leaf"), "root", "depth", "score")


def chosen(found: DataFrame, best: int | None = None) -> DataFrame:
    """Paths with their rank in the tree, the highest mean score first; at most ``best`` of a tree."""
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("depth")), "leaf")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= best) if best else ranked


def _members(messages: DataFrame, leaves: DataFrame, tree: str, message: str, parent: str) -> DataFrame:
    """(tree, leaf, id, back): the messages of the chosen paths, back replies before the leaf: the paths' reach doubles at each self-join."""
    up = messages.select(_tree(tree), F.col(message).alias("id"), F.col(parent).alias("to"))
    real = up.join(up.select("tree", F.col("id").alias("to")).distinct(), ["tree", "to"], "left_semi")
    hop = checkpointed(real.select("tree", "id", "to"))
    found = checkpointed(leaves.select("tree", "leaf", F.col("leaf").alias("id"), F.lit(0).cast("long").alias("back")))
    reach, n = 1, found.count()
    while True:  # who is within ``reach`` of the leaf is known; hop goes ``reach`` up
        more = found.join(hop, ["tree", "id"]).select("tree", "leaf", F.col("to").alias("id"), (F.col("back") + reach).alias("back"))
        found = checkpointed(found.unionByName(more))
        before, n = n, found.count()
        if n == before:
            return found
        far = hop.select("tree", F.col("id").alias("to"), F.col("to").alias("end"))
        hop = checkpointed(hop.join(far, ["tree", "to"]).select("tree", "id", F.col("end").alias("to")))
        reach *= 2


TURNS = "turns: array<struct<role: string, text: string>>"


def conversations(messages: DataFrame, tree: str = "tree_id", message: str = "message_id", parent: str = "parent_id", role: str = "role", text: str = "text", score: str | None = None, best: int | None = None) -> DataFrame:
    """(tree, rank, leaf, n_turns, formatted, loss_spans): each chosen path as one conversation."""
    rest = [parent, role, text, *([score] if score else [])]
    own = messages.where(F.col(message).isNotNull()).groupBy(tree, message).agg(F.min(F.struct(*rest)).alias("__own"))
    messages = checkpointed(own.select(tree, message, *[F.col("__own")[c].alias(c) for c in rest]))
    ranked = chosen(paths(messages, tree, message, parent, score), best)
    picked = checkpointed(ranked.withColumn("tree", _tree("tree")))
    members = _members(messages, picked, tree, message, parent)
    bodies = messages.select(_tree(tree), F.col(message).alias("id"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    turns = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("at"), "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    whole = members.join(bodies, ["tree", "id"]).groupBy("tree", "leaf").agg(turns.alias("turns"))
    placed = whole.join(picked.select("tree", "leaf", "rank"), ["tree", "leaf"])
    return format_turns(placed.withColumn("tree", F.col("tree.id")))


def format_turns(whole: DataFrame) -> DataFrame:
    """The rows with their ``turns`` column formatted: n_turns, formatted, loss_spans."""
    keep = [c for c in whole.columns if c != "turns"]

    def run(batches):
        for batch in batches:
            step = max(1, int(len(batch) * (4 << 20) / max(1, batch.nbytes)))
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                turns = [[(t["role"], t["text"]) for t in x or []] for x in part.column(part.schema.get_field_index("turns")).to_pylist()]
                made = [formatted(t) for t in turns]
                spans = [[{"start": a, "stop": b} for a, b in m] for _, m in made]
                columns = [pa.array(list(map(len, turns)), pa.int64()), pa.array([t for t, _ in made], pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))]
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in keep], *columns], [*keep, "n_turns", "formatted", "loss_spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema.fields if f.name in keep)
    return whole.mapInArrow(run, f"{schema}, n_turns long, formatted string, loss_spans array<struct<start:int,stop:int>>")


def read_back(df: DataFrame, id_col: str) -> DataFrame:
    """What a formatted conversation holds, read from its text and spans alone."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = parse(text)
                loss = "".join(unescaped(text[s["start"] : s["stop"]]) for s in spans)
                sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
                rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, "formatted", "loss_spans").mapInArrow(run, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The turns of conversation -1.
HARD = "<|im_end|><|im_start|>assistant ok"


def reply_chains(rows: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) as reply trees: each turn answers the one before it; equal turns by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "turn", "role", "text").withColumn("message_id", F.row_number().over(order).cast("long"))
    return numbered.select(F.col("conv_id").alias("tree_id"), "message_id", F.when(F.col("message_id") > 1, F.col("message_id") - 1).alias("parent_id"), "role", "text")


def conversation_digest(table: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of conversations and of conversation -1."""
    hard = table.sparkSession.createDataFrame([(-1, 0, "user", HARD), (-1, 1, "assistant", HARD)], "conv_id long, turn long, role string, text string")
    messages = reply_chains(table.select("conv_id", "turn", "role", "text").unionByName(hard))
    return read_back(conversations(messages).select(F.col("tree").alias("conv_id"), "formatted", "loss_spans"), "conv_id")


_ESCAPED = r"length(coalesce({0}, '')) + len(regexp_extract_all(coalesce({0}, ''), '<\\*\|'))"
_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
ORACLE = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, 0, 'user', '{HARD}' UNION ALL SELECT -1, 1, 'assistant', '{HARD}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' {_ORDER})) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN coalesce(text, '') ELSE '' END, '' {_ORDER})) AS loss_sha256,
  CAST(sum({len(START) + len(END) + 2} + {_ESCAPED.format("role")} + {len(NEWLINE) - 1} * (length(coalesce(role, '')) - length(replace(coalesce(role, ''), chr(10), ''))) + {_ESCAPED.format("text")}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
