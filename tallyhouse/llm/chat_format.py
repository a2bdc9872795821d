"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only that
reply lies under the loss mask. A conversation that does not end with a reply gets one more example
of all its turns, with nothing to learn, so that no turn is lost.

Turns are sorted by range, so a conversation of any length is spread over tasks, and cut into blocks
of at most 64 turns. The text of an example is a sequence of parts, one for each block it spans:
most have a single part, and no row ever holds more than a block. What a long conversation costs is
the expansion itself, whose size is that of all prefixes.

The template is ``<turn>role\\ntext</turn>\\n``. Within roles and texts a backslash is doubled and
the ``<`` of anything that looks like a marker becomes ``\\l`` (a line break in a role ``\\n``), so
markers occur nowhere else and every text can be read back.

Defined results: turns are ordered by number (null first), then role, then text; a null role or
text is empty; repeated rows are turns of their own; rows without a conversation id form one
conversation; an empty table gives no parts. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import staged

ASSISTANT = "assistant"
OPEN, CLOSE = "<turn>", "</turn>\n"
BLOCK_TURNS, BLOCK_CHARS = 64, 1 << 20


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), "<(/?turn)", r"\\l$1")


def unescape(text: Column) -> Column:
    """Doubled backslashes are split off first, so that what is left has only markers' escapes."""
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(plain, "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def formatted(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(turn["role"]), F.lit("\n"), escape(turn["text"]), F.lit(CLOSE))


def parsed(text: Column) -> Column:
    """The turns (role, text) of formatted text."""

    def turn(piece):
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        end = F.instr(body, "\n")
        return F.struct(
            unescape(F.substr(body, F.lit(1), end - 1)).alias("role"), unescape(F.substr(body, end + 1)).alias("text")
        )

    return F.transform(F.filter(F.split(text, CLOSE, -1), lambda piece: piece != ""), turn)


def _blocks(batches):
    """Rows sorted by conversation → (conv, at, first, last, turns); ``at`` ascends with the sort order.

    ``first`` and ``last`` say that the conversation surely starts and ends with the block: at the
    edges of a task it may go on in another.
    """
    part, seen = TaskContext.get().partitionId() << 33, 0
    out, turns, chars, conv, first, kind = [], [], 0, None, False, None

    def close(last):
        out.append((conv, part + seen - len(turns), first, last, turns))

    def record():
        columns = list(zip(*out, strict=True)) or [[]] * 5
        item = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        types = [kind, pa.int64(), pa.bool_(), pa.bool_(), item]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv", "at", "first", "last", "turns"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
            if turns and (key != conv or len(turns) == BLOCK_TURNS or chars > BLOCK_CHARS):
                close(key != conv)
                first, turns, chars = key != conv, [], 0
            conv = key
            turns.append({"role": role, "text": text})
            seen, chars = seen + 1, chars + len(text)
        if len(out) >= 256:
            yield record()
            out.clear()
    if turns:
        close(False)
        yield record()


def turn_blocks(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, at, first, last, turns): the turns of every conversation in order, in blocks."""
    empty = F.lit("")
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), empty).alias("role"),
        F.coalesce(F.col(text_col), empty).alias("text"),
    )
    # Range bounds are sampled to the driver, so they take the beginning of a text only.
    keys = ["conv", "turn", F.substr("role", F.lit(1), F.lit(40)), F.substr("text", F.lit(1), F.lit(40))]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "role", "text")
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, at long, first boolean, last boolean, turns array<struct<role:string,text:string>>"
    return staged(rows.mapInArrow(_blocks, schema), "turn-blocks")


def _own_parts(blocks: DataFrame) -> DataFrame:
    """The part in its own block of each example whose target lies there."""
    count = F.size("turns")
    wanted = F.filter(
        F.sequence(F.lit(1), count), lambda i: (F.element_at("turns", i)["role"] == ASSISTANT) | (F.col("ends") & (i == count))
    )
    rows = blocks.withColumn("texts", F.transform("turns", formatted)).withColumn("place", F.explode(wanted))
    target = F.element_at("turns", F.col("place"))
    size = F.when(target["role"] == ASSISTANT, F.char_length(escape(target["text"])))
    text = F.array_join(F.slice("texts", F.lit(1), F.col("place")), "")
    rows = rows.select("conv", (F.col("at") + F.col("place") - 1).alias("example"), F.col("at").alias("part"), text.alias("text"), size.alias("loss_chars"), (F.col("ends") & (F.col("place") == count)).alias("whole"))
    start = F.char_length("text") - len(CLOSE) - F.col("loss_chars")
    return rows.select("conv", "example", "part", "text", start.alias("loss_start"), "loss_chars", "whole", F.lit(False).alias("context"))


def prefix_examples(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv, example, part, text, loss_start, loss_chars, whole, context): the parts of all examples.

    ``example`` and ``part`` ascend with the turns. ``loss_start`` (from 0, in code points of
    ``text``) and ``loss_chars`` mark the escaped reply, in the last part of an example only.
    ``whole`` marks the parts of the example that holds all turns of its conversation, ``context``
    those before its last part.
    """
    blocks = turn_blocks(turns, **columns)
    single = blocks.where("first AND last").withColumn("ends", F.lit(True))
    # Conversations of several blocks: their last block, and earlier blocks as context of later targets.
    long = blocks.where("NOT (first AND last)")
    final = long.groupBy(F.col("conv").alias("final_conv")).agg(F.max("at").alias("final_at"))
    same = lambda other: F.col("conv").eqNullSafe(F.col(other))
    long = long.join(final, same("final_conv")).withColumn("ends", F.col("at") == F.col("final_at"))
    long = staged(long.drop("final_conv", "final_at"), "long-conversations")
    own = _own_parts(single.unionByName(long))
    later = _own_parts(long).select(F.col("conv").alias("later_conv"), "example", F.col("part").alias("later_at"), F.col("whole"))
    context = long.join(later, same("later_conv") & (F.col("at") < F.col("later_at")))
    nothing = F.lit(None).cast("int")
    context = context.select(
        "conv",
        "example",
        F.col("at").alias("part"),
        F.array_join(F.transform("turns", formatted), "").alias("text"),
        nothing.alias("loss_start"),
        nothing.alias("loss_chars"),
        "whole",
        F.lit(True).alias("context"),
    )
    return own.unionByName(context)


def _digest(batches):
    """Parts sorted by conversation and example → one row of digests each, a part at a time."""
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    out, conv, state, kind = [], None, None, None

    def close():
        turns, turns_hash, chars, loss_hash, size = state
        out.append((conv, turns, turns_hash.hexdigest(), chars, loss_hash.hexdigest(), size))

    for batch in batches:
        kind = batch.schema.field("conv").type
        columns = (batch.column(c).to_pylist() for c in ("conv", "said", "turns", "loss", "size"))
        for key, said, turns, loss, size in zip(*columns, strict=True):
            if state is None or key != conv:
                if state:
                    close()
                conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            if said is not None:
                state[1].update(said.encode())
                state[0] += turns
            if loss is not None:
                state[3].update(loss.encode())
                state[2] += len(loss)
            state[4] += size
    if state:
        close()
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def read_back(parts: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation.

    Everything is parsed from the formatted text. The digests run over a conversation in order, so
    its turns and replies, each once, pass through one task as a stream.
    """
    turns = F.when(F.col("whole"), parsed(F.col("text")))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = unescape(F.substr("text", F.col("loss_start") + 1, F.col("loss_chars")))
    size = F.char_length("text").cast("long").alias("size")
    read = parts.where("NOT context OR whole")
    rows = read.select("conv", "example", "part", said.alias("said"), F.size(turns).alias("turns"), loss.alias("loss"), size)
    # Context of other examples only counts: it is added up before the shuffle.
    counted = parts.where("context AND NOT whole").select("conv", size).groupBy("conv").agg(F.sum("size").alias("size"))
    nothing, first = F.lit(None).cast("string"), F.lit(-1).cast("long")
    counted = counted.select(
        "conv", first.alias("example"), first.alias("part"), nothing.alias("said"), F.lit(0).alias("turns"), nothing.alias("loss"), "size"
    )
    rows = rows.unionByName(counted)
    rows = rows.repartition("conv").sortWithinPartitions("conv", "example", "part")
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(_digest, schema)
