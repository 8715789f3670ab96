"""Chat formatting as a prefix tree.

Conversations that share their first turns share nodes: a node is a turn after a given chain of turns, named by a hash over
that chain. Every node's tokens are emitted once, in depth-first order. The order comes from a node's path, which has a step for
each place above it where conversations part, and its own depth: within an unbranched run only the depth differs, so that
a long conversation's paths stay short. Running sums over ranges of paths give each node its place in the emitted stream (``emit``). A node
carries its token ids, their position ids (which go on from its parent's), the token range under the loss mask, and the stream
intervals of its ancestors, which it may attend to besides itself. Ancestors that follow one another in the stream share an
interval, so that a node has one more interval than there are later branches above it; ranges are streamed with a stack of the
branchings above, and each starts from the ancestors of its first node. Turns that many conversations share are hot keys, whose
joins are salted (``join_hot``).

The template is ``<|role|>\\n`` text ``<|end|>\\n``. In roles and texts each of ``< [ | \\`` is followed by a backslash, so that
no control string of this or another template survives there, and taking the backslashes away restores them.

Rows are ordered by turn, then role, then text; null texts and roles count as empty; repeated rows are turns of their own. A null conv_id is a
conversation of its own name. Conversations are streamed, one turn held at a time, and none is cut. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_hot, materialize

TOKENIZER = "byte_bpe_50k.tiktoken"
NODE = 16  # bytes of a node's hash
DEPTH = 4  # bytes of a depth in a path
BLOCK = 256  # tokens of the stream that are looked up together
LOSS_ROLE = "assistant"
END = "<|end|>\n"
_SPECIAL = re.compile(r"([<\[|\\])")
_ESCAPED = re.compile(r"([<\[|\\])\\")


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; escaped texts cannot hold a marker, so that plain searches find the ends."""
    out, at = [], 0
    while at < len(formatted):
        mid = formatted.index("|>\n", at)
        end = formatted.index(END, mid)
        if formatted[at : at + 2] != "<|":
            raise ValueError("not a formatted conversation")
        out.append((unescape(formatted[at + 2 : mid]), unescape(formatted[mid + 3 : end])))
        at = end + len(END)
    return out


def encoding(path: str | None = None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(TOKENIZER), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def turns(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """A row for each turn: conv_id, turn_no, parent (empty for a first turn), node, role, ids, n (their number), begin (tokens before), loss_from and loss_to (token range)."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    names = ["conv_id", "turn_no", "parent", "node", "role", "ids", "n", "begin", "loss_from", "loss_to"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        held, chain, begin, no = (), b"", 0, 0
        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if held != (conv_id,):
                    held, chain, begin, no = (conv_id,), b"", 0, 0
                parent, chain = chain, hashlib.sha256(b"%s%d:%s%s" % (chain, len(role), role.encode(), text.encode())).digest()
                head, body, tail = encode(f"<|{escape(role)}|>\n"), encode(escape(text)), encode(END)
                loss = (len(head), len(head) + len(body)) if role == LOSS_ROLE else (0, 0)
                ids = head + body + tail
                out.append((conv_id, no, parent[:NODE], chain[:NODE], role, ids, len(ids), begin, *loss))
                begin, no = begin + len(ids), no + 1
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return dealt.mapInArrow(run, "conv_id long, turn_no int, parent binary, node binary, role string, ids array<int>, n long, begin long, loss_from int, loss_to int")


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and path of turns sorted by conversation and turn; ``forked`` tells whether the parent has other children too."""
    path = b""
    for batch in batches:
        found = []
        for no, node, forked in zip(*(batch.column(c).to_pylist() for c in ("turn_no", "node", "forked"))):
            at = no.to_bytes(DEPTH, "big")
            path = node + at if no == 0 else path + node + at if forked else path[:-DEPTH] + at
            found.append(path)
        yield pa.record_batch([batch.column("node"), pa.array(found, pa.binary())], ["node", "path"])


def forest(conversations: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The nodes, in no order of rows (node, parent, depth, path, role, ids, position_ids, loss_from, loss_to, start, end, ancestors), and the turns of the conversations (conv_id, turn_no, node)."""
    every = materialize(turns(conversations, path), "turns")
    nodes, steps = _grown(every)
    return positioned(nodes), steps


def positioned(nodes: DataFrame) -> DataFrame:
    """Nodes with ``position_ids`` in place of ``begin``, where they begin: they follow one another, so that tables of nodes need not hold them."""
    positions = F.sequence(F.col("begin"), F.col("begin") + F.size("ids") - 1)
    return nodes.withColumn("begin", positions).withColumnRenamed("begin", "position_ids")


def _grown(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``forest`` gives of written turns, with ``begin`` in place of ``position_ids``."""
    steps = every.select("conv_id", "turn_no", "parent", "node")
    forks = materialize(steps.select("parent", "node").distinct().groupBy("parent").count().where("count > 1").select("parent", F.lit(True).alias("forked")), "forks")
    marked = join_hot(steps, forks, ["parent"], "left").select("conv_id", "turn_no", "node", F.coalesce("forked", F.lit(False)).alias("forked"))
    named = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no").mapInArrow(_paths, "node binary, path binary").groupBy("node").agg(F.any_value("path").alias("path"))

    # nodes are placed without their ids, which the first conversation through a node lends it at the end
    once = every.groupBy("node").agg(F.min("conv_id").alias("lender"), F.min("turn_no").alias("depth"), F.min("n").alias("n"))
    once = once.join(named, "node").join(forks.withColumnRenamed("parent", "node"), "node", "left").withColumn("forked", F.coalesce("forked", F.lit(False)))
    ranged = materialize(once.repartitionByRange("path").withColumn("part", F.spark_partition_id()), "nodes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    bases = ranged.groupBy("part").agg(F.sum("n").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "base")
    within = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("at", F.coalesce(F.sum("n").over(within), F.lit(0))).join(bases, "part").withColumn("start", F.col("base") + F.col("at"))
    placed = placed.withColumn("end", F.col("start") + F.col("n")).drop("at", "base", "n")

    # a range's first node has ancestors in earlier ranges: the turns before it in any conversation through it; one row for each range, so that these are small
    first = ranged.groupBy("part").agg(F.min_by(F.struct("node", "depth"), "path").alias("x")).select("part", "x.*")
    through = steps.join(F.broadcast(first), "node").groupBy("part", "depth").agg(F.min(F.struct("conv_id")).alias("c")).select("part", "depth", F.col("c.conv_id").alias("through"))
    above = steps.join(F.broadcast(through), F.col("conv_id").eqNullSafe(F.col("through")) & (F.col("turn_no") < F.col("depth"))).select("part", "node")
    carried = above.join(placed.drop("part"), "node").withColumn("carried", F.lit(True))
    dealt = placed.withColumn("carried", F.lit(False)).unionByName(carried).repartition("part").sortWithinPartitions("part", "path", F.desc("carried"))
    shown = dealt.mapInArrow(_ancestors, "node binary, lender long, depth int, path binary, start long, end long, ancestors array<struct<start:long,end:long>>")
    # (conversation, turn) names one row, so that no key is hot
    lent = every.drop("node").join(shown, F.col("conv_id").eqNullSafe(F.col("lender")) & (F.col("turn_no") == F.col("depth")))
    columns = ["node", "parent", "depth", "path", "role", "ids", "begin", "loss_from", "loss_to", "start", "end", "ancestors"]
    return lent.select(*columns), steps.drop("parent")


def emit(nodes: DataFrame) -> DataFrame:
    """The nodes as the stream itself: ranges of ``start``, each in order."""
    return nodes.repartitionByRange("start").sortWithinPartitions("start")


def _ancestors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with the joined intervals of their ancestors, from rows in depth-first order within each range."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    part, stack = None, []  # branchings above, and the node before: depth, intervals down to its own, whether it branches
    for batch in batches:
        found = []
        for p, depth, start, end, forked in zip(*(batch.column(c).to_pylist() for c in ("part", "depth", "start", "end", "forked"))):
            if p != part:
                part, stack = p, []
            while stack and stack[-1][0] >= depth:
                stack.pop()
            above = stack[-1][1] if stack else []
            found.append([{"start": x, "end": y} for x, y in above])
            if stack and not stack[-1][2]:
                stack.pop()  # nothing but this node hangs below it
            stack.append((depth, [*above[:-1], (above[-1][0], end)] if above and above[-1][1] == start else [*above, (start, end)], forked))
        names = ["node", "lender", "depth", "path", "start", "end"]
        out = pa.record_batch([*(batch.column(c) for c in names), pa.array(found, kind)], [*names, "ancestors"])
        yield out.filter(pc.invert(batch.column("carried")))


def spoken(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, position, ids, loss_from, loss_to: every conversation as cut from the emitted stream, by the ancestor intervals of its last node and that node itself.

    Intervals and nodes meet in blocks of ``BLOCK`` tokens of the stream; an interval holds whole nodes, which start in it. ``nodes`` should be cheap to read twice."""
    last = conversations.groupBy("conv_id").agg(F.max_by("node", "turn_no").alias("node"))
    spans = nodes.select("node", F.concat("ancestors", F.array(F.struct("start", "end"))).alias("spans"))
    asked = join_hot(last, spans, ["node"]).select("conv_id", F.explode("spans").alias("span")).select("conv_id", F.col("span.start").alias("from"), F.col("span.end").alias("to"))
    block = lambda c: F.floor(c / F.lit(BLOCK))
    asked = materialize(asked.withColumn("block", F.explode(F.sequence(block(F.col("from")), block(F.col("to") - 1)))), "asked")
    stream = nodes.select(block(F.col("start")).alias("block"), "start", F.col("position_ids")[0].alias("position"), "ids", "loss_from", "loss_to")
    met = join_hot(asked, stream, ["block"]).where((F.col("start") >= F.col("from")) & (F.col("start") < F.col("to")))
    return met.select("conv_id", "position", "ids", "loss_from", "loss_to")


def read_back(nodes: DataFrame, conversations: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, decoded from the emitted stream. Tokens stand where their position ids say, and a
    conversation whose positions do not follow one another is an error."""
    dealt = spoken(nodes, conversations).repartition("conv_id").sortWithinPartitions("conv_id", "position")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoding(path).decode_bytes
        open_: list | None = None  # conversation, turns, their digest, loss characters, their digest, formatted characters, tokens

        def told(o: list) -> tuple:
            return o[0], o[1], o[2].hexdigest(), o[3], o[4].hexdigest(), o[5]

        for batch in batches:
            out = []
            for conv_id, position, ids, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "position", "ids", "loss_from", "loss_to"))):
                if open_ and conv_id != open_[0]:
                    out.append(told(open_))
                    open_ = None
                open_ = open_ or [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                if position != open_[6]:
                    raise ValueError(f"conversation {conv_id} has position {position} where {open_[6]} is due")
                open_[6] += len(ids)
                formatted = decode(ids).decode()
                for role, text in parse(formatted):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{text}\n".encode())
                loss = unescape(decode(ids[lo:hi]).decode())
                open_[3] += len(loss)
                open_[4].update(loss.encode())
                open_[5] += len(formatted)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
        if open_:
            yield pa.record_batch([pa.array([v], t) for v, t in zip(told(open_), kinds)], names)

    return dealt.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digest(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """The result that the registered query returns: what is read back from the emitted stream. No conversations give no rows."""
    every = materialize(turns(conversations, path), "turns")
    nodes, said = _grown(every)
    last = materialize(said.groupBy("conv_id").agg(F.max("turn_no").alias("turn_no"), F.max_by("node", "turn_no").alias("node")), "last")
    emitted = materialize(nodes, "emitted")
    discard(every)  # nothing reads the turns once their tokens stand in the stream
    return read_back(positioned(emitted), last, path)
