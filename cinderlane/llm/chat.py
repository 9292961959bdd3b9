"""Chat formatting as a prefix tree: conversations that share their first turns share those turns' tokens.

Tokens are the code points of the formatted text. A turn's node is its path: a digest chained over the roles and texts
from the first turn on, so conversations with the same first turns meet in the same nodes. Sorting conversations by
the digests of their turns puts the tree in depth-first order: each conversation (a run) emits only the turns that
none before it in that order has, as a piece of its own without a gap. All runs together are one sequence. Each node carries the
place of its tokens in that sequence, the position id of its first token in the conversation, the part under the loss
mask, and the intervals of its ancestors' tokens, which it attends to beside its own up to itself.

A tree of any size is dealt over tasks: paths are compared by digest, owners by a pre-aggregated minimum, places by
prefix sums over partitions. One conversation is one chain (each digest needs the one before): it is read in order in
one task, a row at a time, and keeps 16 bytes a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderlane.llm import common

START, END = "<|im_start|>", "<|im_end|>"
_OPEN, _SHUT = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)
_TURNS = "conv_id long, k long, node binary, text string, chars long, position long, loss_lo long, loss_hi long, key binary"


def escape(text: str) -> str:
    """The text without a control string: each '<', run of backslashes, '|' gets one backslash more."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn, and where its text begins and ends in it."""
    head = START + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text; raises ValueError where it isn't one."""
    out, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], unescape(m[1]))
        out.append((role, unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at character {at}")
    return out


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    """Each conversation's rows together and in order, without gathering them."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _formatted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of conversations and turns, a row late so that a conversation's last one knows itself."""
    names = [x.split()[0] for x in _TURNS.split(", ")]
    schema = pa.schema([(n, pa.binary() if n in ("node", "key") else pa.string() if n == "text" else pa.int64()) for n in names])
    held, now, chain, key, at = None, (), b"", bytearray(), 0
    for batch in batches:
        out = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if now != (conv,):
                if held:
                    out.append({**held, "key": bytes(key)})
                held, now, chain, key, at = None, (conv,), b"", bytearray(), 0
            if held:
                out.append(held)
            piece, lo, hi = format_turn(role, text)
            chain = hashlib.blake2b(chain + piece.encode(), digest_size=16).digest()
            key += chain
            learns = role == "assistant"
            held = {"conv_id": conv, "k": len(key) // 16, "node": chain, "text": piece, "chars": len(piece), "position": at, "loss_lo": lo if learns else None, "loss_hi": hi if learns else None, "key": None}
            at += len(piece)
        yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist([{**held, "key": bytes(key)}], schema)


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each turn's formatted text with its number, position, loss span and path digest; see tree for odd rows."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = conversations.select("conv_id", "turn", empty("role"), empty("text"))
    with common.small_batches(rows.sparkSession):
        return common.materialise(_in_order(rows, "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(_formatted, _TURNS))


def _places(runs: DataFrame) -> DataFrame:
    """start of each run: the characters that all runs before it emit. Partitions' totals are summed first."""
    runs = runs.withColumn("part", F.shiftright("run", 33))
    parts = runs.groupBy("part").agg(F.sum("emitted").alias("total"))
    before = lambda c, *by: F.coalesce(F.sum(c).over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each partition of the sort, so its size is bounded
    parts = parts.select("part", before("total", "part").alias("base"))
    runs = runs.select("*", before("emitted", "part", "run").alias("own"))
    return runs.join(F.broadcast(parts), "part").select("run", "first_position", "emitted", (F.col("base") + F.col("own")).alias("start"))


def tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, members) of conversations (conv_id, turn, role, text).

    nodes, one row for each distinct path of turns: start (place of its first token, the node's name), chars, text,
    position (id of its first token; the others count on), loss_lo and loss_hi (places under the loss mask; null
    where the role isn't assistant), tree (place of the root), run, ancestors (intervals [lo, hi) of places, in order
    of position). Ordered by start they are the sequence, depth first.
    members: conv_id, k (from 1), start: the node of each conversation's k-th turn.

    Null roles and texts are empty. Turns go by turn, role and text, nulls first; repeated rows are turns of their
    own. Rows of null conv_id are one conversation. Texts may hold control strings; they come back as they were.
    Empty tables give empty results. Other columns play no part.
    """
    turns = format_turns(conversations)
    convs = turns.filter("key IS NOT NULL").select("conv_id", "key")
    ranked = common.materialise(convs.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").select("conv_id", F.monotonically_increasing_id().alias("run")))
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    path = turns.alias("t").join(ranked.alias("r"), same("t", "r")).select("t.conv_id", "run", "k", "node", "chars", "position")
    owners = common.materialise(path.groupBy("node").agg(F.min("run").alias("owner")))  # written, so that hot nodes can be split
    path = common.materialise(path.join(owners.hint("merge"), "node").drop("node"))
    runs = path.filter("owner = run").groupBy("run").agg(F.min("position").alias("first_position"), F.sum("chars").alias("emitted"))
    runs = common.materialise(_places(runs))
    place = F.col("start") + F.col("position") - F.col("first_position")
    owner = runs.withColumnRenamed("run", "owner").hint("merge")
    members = path.join(owner, "owner").select("conv_id", "k", place.alias("start"))

    legs = path.filter("owner <> run").groupBy("run", "owner").agg(F.min("position").alias("position"), F.max(F.col("position") + F.col("chars")).alias("end"))
    legs = legs.join(owner, "owner").select("run", F.struct("position", place.alias("lo"), (place + F.col("end") - F.col("position")).alias("hi")).alias("leg"))
    legs = legs.groupBy("run").agg(F.transform(F.sort_array(F.collect_list("leg")), lambda x: F.struct(x.lo.alias("lo"), x.hi.alias("hi"))).alias("above"))
    emits = ranked.join(runs, "run").join(legs, "run", "left").withColumnRenamed("start", "run_start")
    rows = turns.alias("t").join(emits.alias("r"), same("t", "r") & (F.col("position") >= F.col("first_position")))
    start = F.col("run_start") + F.col("position") - F.col("first_position")
    above = F.coalesce("above", F.array().cast("array<struct<lo:bigint,hi:bigint>>"))
    own = F.when(start > F.col("run_start"), F.array(F.struct(F.col("run_start").alias("lo"), start.alias("hi")))).otherwise(F.array().cast("array<struct<lo:bigint,hi:bigint>>"))
    nodes = rows.select(
        start.alias("start"), "chars", "text", "position", (start + F.col("loss_lo")).alias("loss_lo"), (start + F.col("loss_hi")).alias("loss_hi"),
        F.coalesce(F.get("above", F.lit(0))["lo"], F.col("run_start")).alias("tree"), "run", F.concat(above, own).alias("ancestors"),
    )
    return nodes, members


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _DIGESTS.split(", ")]
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])
    now: tuple = ()
    turns, chars, masked, all_turns, all_masked = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
    done = lambda: {"conv_id": now[0], "n_turns": turns, "turns_sha256": all_turns.hexdigest(), "loss_chars": masked, "loss_sha256": all_masked.hexdigest(), "formatted_chars": chars}
    for batch in batches:
        out = []
        for conv, text, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "lo", "hi")), strict=True):
            if now != (conv,):
                if now:
                    out.append(done())
                now, turns, chars, masked, all_turns, all_masked = (conv,), 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for role, said in parse(text):
                turns += 1
                all_turns.update(f"{role}\n{said}\n".encode())
            if lo is not None:
                learned = unescape(text[lo:hi])
                masked += len(learned)
                all_masked.update(learned.encode())
            chars += len(text)
        yield pa.RecordBatch.from_pylist(out, schema)
    if now:
        yield pa.RecordBatch.from_pylist([done()], schema)


def read_back(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Digests of each conversation as it stands in the tree: its turns, and the text under its loss mask."""
    loss = [(F.col(f"loss_{c}") - F.col("start")).alias(c) for c in ("lo", "hi")]
    rows = members.join(nodes.select("start", "text", *loss).hint("merge"), "start").select("conv_id", "k", "text", "lo", "hi")
    with common.small_batches(rows.sparkSession):
        return common.materialise(_in_order(rows, "k").mapInArrow(_digested, _DIGESTS))
