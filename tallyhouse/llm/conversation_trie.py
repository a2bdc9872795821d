"""The trie of all conversations' prefixes, as double arrays over prefix shards.

Every distinct turn (role, text) gets a dense id, and conversations become sequences of ids. Equal
sequences are folded first, so a conversation that very many share is one row. The sequences are
sorted by range and every shard is a stretch of that order; its task packs BASE and CHECK arrays,
walks the sequences through them and adds up what each node holds. A shard also gets, without
weight, the last sequence before it and the first one after it. With these it knows which of its
nodes an earlier shard has brought in and which go on in a later one, so that every measure is a
sum over shards: nodes on the path of a neighbour (upper nodes that shards share) are summed
globally by Spark, all others are final.

Defined results: turns are ordered by number (null first), then by a digest of the turn; a null role or text is
empty; repeated rows are turns of their own; rows without a conversation id belong to none; an
empty table has no nodes, not even the root. Other columns are not read. A conversation is one row
of ids (12 bytes a turn), whatever its texts.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import drop_staged, staged

WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256().hexdigest()
SHARD_TURNS = 200_000
PREFIX_GROUP = 20


def dense_ids(digests: DataFrame) -> DataFrame:
    """(digest, id): numbers 0, 1, … without gaps, in the order of the digests."""
    rows = digests.repartitionByRange("digest").sortWithinPartitions("digest")
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "dense-turns")
    part = F.shiftright("row", 33)
    # One number for each task of the sort.
    sizes = sorted((r.part, r.n) for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, offsets = 0, []
    for key, n in sizes:
        offsets += [F.lit(key), F.lit(before)]
        before += n
    if not sizes:
        return rows.select("digest", F.col("row").alias("id"), "words")
    offset = F.element_at(F.create_map(*offsets), part)
    return rows.select("digest", (F.col("row") - F.shiftleft(part, 33) + offset).cast("long").alias("id"), "words")


def prefix_turns(conv: Column) -> Column:
    return (F.crc32(conv.cast("string")) % 4).cast("int")


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """(conv, ids, words): each conversation with its first turns from the one its group shares.

    ``turns`` is (conv, turn, role, text). Conversation c starts with the first ``prefix_turns(c)``
    turns of conversation c - c % 20 and goes on with its own turns after as many.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.where("conv IS NOT NULL").select("conv", "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    rows = staged(rows, "turn-digests")
    dense = staged(dense_ids(rows.groupBy("digest").agg(F.max("words").alias("words"))), "turn-ids")
    own = rows.drop("words").join(dense, "digest").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("own"))
    own = staged(own, "conversations")
    drop_staged(rows)
    first = own.where(F.col("conv") % PREFIX_GROUP == 0).select(F.col("conv").alias("group"), F.slice("own", 1, 3).alias("shared"))
    h = prefix_turns(F.col("conv"))
    joined = own.join(first, own["conv"] - own["conv"] % PREFIX_GROUP == first["group"], "left")
    shared = F.coalesce(F.slice("shared", F.lit(1), h), F.slice("own", 1, 0))
    sequence = F.concat(shared, F.slice("own", h + 1, F.size("own")))
    joined = joined.select("conv", sequence.alias("sequence"))
    return joined.select(
        "conv",
        F.transform("sequence", lambda t: t["id"]).alias("ids"),
        F.transform("sequence", lambda t: t["words"].cast("int")).alias("words"),
    )


class DoubleArray:
    """A trie in two arrays: the child of slot s by code c is t = base[s] + c if check[t] == s.

    Codes start from 1. Slots up to the largest code stay unused, so that every free slot can be
    reached from some base.
    """

    def __init__(self, codes: int):
        self.floor = codes + 1
        self.base, self.check = [0] * (self.floor + 1), [-1] * (self.floor + 1)
        self.root = self.floor
        self.check[self.root] = self.root
        self.free = self.root + 1  # no slot below it is free

    def _reserve(self, slot: int) -> None:
        missing = slot + 1 - len(self.check)
        if missing > 0:
            self.base += [0] * missing
            self.check += [-1] * missing

    def add_children(self, slot: int, codes: list[int]) -> list[int]:
        """Give ``slot`` its children, all at once; ``codes`` ascend. Returns their slots."""
        check, least, largest = self.check, codes[0], codes[-1]
        at = self.free
        while True:
            self._reserve(at + largest - least)
            if check[at] < 0 and all(check[at - least + c] < 0 for c in codes):
                break
            at += 1
        self.base[slot] = at - least
        slots = [at - least + c for c in codes]
        for t in slots:
            check[t] = slot
        while self.free < len(check) and check[self.free] >= 0:
            self.free += 1
        return slots

    def child(self, slot: int, code: int) -> int:
        t = self.base[slot] + code
        return t if 0 <= t < len(self.check) and self.check[t] == slot and t != self.root else -1


def packed(sequences: list[list[int]], codes: int) -> DoubleArray:
    """The double array of sorted sequences of codes."""
    trie = DoubleArray(codes)
    waiting = [(trie.root, 0, len(sequences), 0)]
    while waiting:
        slot, lo, hi, depth = waiting.pop()
        while lo < hi and len(sequences[lo]) == depth:
            lo += 1
        if lo == hi:
            continue
        children, starts = [], []
        for i in range(lo, hi):
            code = sequences[i][depth]
            if not children or code != children[-1]:
                children.append(code)
                starts.append(i)
        slots = trie.add_children(slot, children)
        waiting += zip(slots, starts, [*starts[1:], hi], [depth + 1] * len(slots), strict=True)
    return trie


NODE = (
    "node binary, parent binary, parent_conv long, conv long, depth long, n_convs long, n_children long, n_leaves long, "
    "saved long, ends binary, single long"
)
ROOT = b"root"


def _step(name: bytes, turn: int) -> bytes:
    return hashlib.blake2b(name + turn.to_bytes(8, "little"), digest_size=16).digest()


def shard_nodes(rows: list[tuple]) -> list[tuple]:
    """Node rows of one shard. A row is (side, ids, words, n, least, name), sorted by ids; side -1 and 1
    mark the neighbours. Nodes that other shards may have carry a name and sums; of others the row is final."""
    dense = sorted({i for r in rows for i in r[1]})
    code = {turn: k for k, turn in enumerate(dense, 1)}
    sequences = [[code[i] for i in r[1]] for r in rows]
    trie = packed(sequences, len(dense))
    size, child = len(trie.check), trie.child
    shared = {trie.root: ROOT}  # slots that a neighbour passes through, by name
    earlier = set()  # and those an earlier shard has brought in
    paths = []
    for row, sequence in zip(rows, sequences, strict=True):
        slot, path = trie.root, [trie.root]
        for c in sequence:
            slot = child(slot, c)
            path.append(slot)
        paths.append(path)
        if row[0]:
            name = ROOT
            for slot, turn in zip(path[1:], row[1], strict=True):
                name = shared[slot] = _step(name, turn)
            if row[0] < 0:
                earlier.update(path)
    members, saved, leaves, children = [0] * size, [0] * size, [0] * size, [0] * size
    least, depth, ends, single = [None] * size, [0] * size, [None] * size, [None] * size
    passed = set()  # slots of own sequences seen so far
    for (side, _, words, n, first, name), path in zip(rows, paths, strict=True):
        if side:
            continue
        if n > 1:
            ends[path[-1]] = name
        else:
            single[path[-1]] = first
        leaf = trie.base[path[-1]] == 0
        # A turn that no earlier sequence brought in is read once; all other reading of it is saved, at
        # its node and at every node above.
        gain, brought = 0, False
        for k in range(len(path) - 1, -1, -1):
            slot = path[k]
            children[slot] += brought
            brought = slot not in passed and slot not in earlier
            if k:
                gain += (n - brought) * words[k - 1]
            saved[slot] += gain
            members[slot] += n
            leaves[slot] += leaf
            depth[slot] = k
            if least[slot] is None or first < least[slot]:
                least[slot] = first
        passed.update(path)
    out = []
    for slot in passed:
        parent = trie.check[slot] if slot != trie.root else -1
        up = shared.get(parent)
        out.append(
            (
                shared.get(slot), up, None if parent < 0 or up else least[parent], least[slot], depth[slot],
                members[slot], children[slot], leaves[slot], saved[slot], ends[slot], single[slot],
            )
        )
    return out


def _shards(sequences: DataFrame) -> DataFrame:
    """(shard, side, ids, words, n, least, name): stretches of the sorted sequences with their neighbours."""
    spark = sequences.sparkSession
    turns = sequences.agg(F.sum(F.size("ids"))).first()[0] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    ordered = sequences.repartitionByRange(count, "ids").sortWithinPartitions("ids").withColumn("row", F.monotonically_increasing_id())
    ordered = staged(ordered, "sorted-sequences")
    shard = F.shiftright("row", 33).cast("int")
    # Two numbers for each task of the sort.
    edges = sorted(tuple(r) for r in ordered.groupBy(shard.alias("shard")).agg(F.min("row"), F.max("row")).collect())
    beside = [(here[2], there[0], -1) for here, there in zip(edges, edges[1:])] + [(there[1], here[0], 1) for here, there in zip(edges, edges[1:])]
    own = ordered.select(shard.alias("shard"), F.lit(0).alias("side"), "ids", "words", "n", "least", "name")
    if not beside:
        return own
    neighbours = ordered.join(spark.createDataFrame(beside, "row long, shard int, side int"), "row")
    return own.unionByName(neighbours.select("shard", "side", "ids", "words", F.lit(0).cast("long").alias("n"), "least", "name"))


def _shard_table(table: pa.Table) -> pa.Table:
    columns = [table.column(c).to_pylist() for c in ("side", "ids", "words", "n", "least", "name")]
    nodes = shard_nodes(sorted(zip(*columns, strict=True), key=lambda r: (r[1], r[0])))
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.binary(), pa.int64()]
    names = [field.split()[0] for field in NODE.split(", ")]
    columns = zip(*nodes, strict=True) if nodes else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _joined_ids(batches):
    """Rows sorted by (name, conv) → SHA-256 of the ids of each name, joined by commas, an id at a time."""
    out, name, state = [], None, None
    for batch in batches:
        for key, conv in zip(batch.column("name").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if key != name:
                if state:
                    out.append((name, state.hexdigest()))
                name, state = key, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
    if state:
        out.append((name, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([h for _, h in out])], ["name", "sha"])


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every
    node over ``conversations`` (conv, ids, words)."""
    name = F.unhex(F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256))
    convs = staged(conversations.withColumn("name", name), "sequences")
    folded = convs.groupBy("name", "ids", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"))
    folded = staged(folded, "distinct-sequences")
    nodes = staged(_shards(folded).groupBy("shard").applyInArrow(_shard_table, NODE), "trie-nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    tops = [F.max(c).alias(c) for c in ("parent", "depth", "ends", "single")]
    upper = nodes.where("node IS NOT NULL").groupBy("node").agg(F.min("conv").alias("conv"), *sums, *tops)
    upper = staged(upper, "upper-nodes")
    parents = upper.select(F.col("node").alias("parent"), F.col("conv").alias("upper_conv"))
    measures = ["conv", "depth", "n_convs", "n_children", "n_leaves", "saved", "ends", "single"]
    inner = nodes.where("node IS NULL AND parent IS NULL").select(*measures, "parent_conv")
    under = nodes.where("node IS NULL AND parent IS NOT NULL").join(parents, "parent").select(*measures, F.col("upper_conv").alias("parent_conv"))
    above = upper.join(parents, "parent", "left").select(*measures, F.col("upper_conv").alias("parent_conv"))
    every = inner.unionByName(under).unionByName(above)

    # Ends of a single conversation need no other row; the ids of shared ends are sorted and streamed.
    shared = convs.join(folded.where("n > 1").select("name"), "name", "left_semi").select("name", "conv")
    digests = shared.repartition("name").sortWithinPartitions("name", "conv").mapInArrow(_joined_ids, "name binary, sha string")
    alone = every.where("ends IS NULL").withColumn("sha", F.coalesce(F.sha2(F.col("single").cast("string"), 256), F.lit(NO_ENDS)))
    ended = every.where("ends IS NOT NULL").join(staged(digests, "end-digests").withColumnRenamed("name", "ends"), "ends")
    return alone.unionByName(ended).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"),
    )


def conversation_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations of ``turns``; see ``trie_nodes``."""
    names = {conv_col: "conv", turn_col: "turn", role_col: "role", text_col: "text"}
    rows = turns.select(*[F.col(old).alias(new) for old, new in names.items()]).withColumn("conv", F.col("conv").cast("long"))
    return trie_nodes(rebuilt_conversations(rows))
