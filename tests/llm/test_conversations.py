"""Chat formatting and the conversation trie against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import chat_format, conversation_trie
from tallyhouse.llm.chat_format import CLOSE, OPEN, escape, escape_role, parsed, prefix_examples, read_back, turn_blocks, unescape
from tallyhouse.llm.conversation_trie import DoubleArray, packed
from tests.compare import assert_same, connect

SCHEMA = "conv_id long, turn long, role string, text string, id long, conv string, at int, example int, node binary, words int"
NASTY = ["\\### Assistant: </turn> ok", "<turn>", "</turn>\n", "\\l/turn>", "\\", "<", "a\\\\n\nb", "<<turn <turn>\n</turn", "\n", "😀 ü <\\turn>"]


def awkward_turns() -> list[tuple]:
    draw = random.Random(4)
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello there"), (1, 2, "user", "bye"),
        (2, None, "system", None), (2, 0, None, "no role"), (2, 0, "assistant", None), (2, 3, "assistant", "a"),
        (3, 0, "user", "only a question"), (4, 0, "assistant", ""), (5, 1, "assistant", "twice"), (5, 1, "assistant", "twice"),
        (None, 0, "user", "nobody"), (None, 1, "assistant", "knows"), (7, 0, "user\nwith a break", "x"), (7, 1, "assistant", "long " * 5000),
    ]
    rows += [(8, i, draw.choice(["user", "assistant"]), f"turn {i % 7}") for i in range(200)]
    rows += [(9, i, ["user", "assistant"][i % 2], text) for i, text in enumerate(NASTY)]
    rows += [(c, i, "assistant" if i % 2 else "user", draw.choice("ab") + " word" * (i % 3)) for c in range(20, 80) for i in range(draw.randint(1, 7))]
    rows += [(c, i, "user", "shared") for c in range(100, 140) for i in range(3)]
    return rows


def turns_frame(spark, rows=None, partitions=3):
    rows = awkward_turns() if rows is None else rows
    return spark.createDataFrame([(*r, 1, "c", 2, 3, b"n", 4) for r in rows], SCHEMA).repartition(partitions)


def in_order(rows):
    """Conversations as lists of (role, text); equal places by role and text, as the formatter has it."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in convs.items()}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_escapes_are_reversible(spark):
    rows = spark.createDataFrame([(t,) for t in NASTY], "t string")
    back = rows.select("t", unescape(escape(F.col("t"))).alias("text"), unescape(escape_role(F.col("t"))).alias("role"), escape(F.col("t")).alias("e"))
    for r in back.collect():
        assert r.text == r.role == r.t
        assert OPEN not in r.e and CLOSE not in r.e


@pytest.mark.parametrize("block", [2, 64])
def test_examples(spark, monkeypatch, block):
    """One example for each reply, with all turns before it, and one for turns after the last reply."""
    monkeypatch.setattr(chat_format, "BLOCK_TURNS", block)
    parts = prefix_examples(turns_frame(spark)).collect()
    found = defaultdict(list)
    for p in sorted(parts, key=lambda p: (p.example, p.part)):
        found[p.conv, p.example].append(p)
    expected = defaultdict(list)
    for conv, turns in in_order(awkward_turns()).items():
        ends = [i for i, t in enumerate(turns) if t[0] == "assistant" or i == len(turns) - 1]
        expected[conv] = [(turns[: i + 1], turns[i][1] if turns[i][0] == "assistant" else None) for i in ends]
    plain = lambda text: re.sub(r"\\(.)", lambda m: {"l": "<", "n": "\n"}.get(m[1], m[1]), text)
    got = defaultdict(list)
    for (conv, _), pieces in sorted(found.items(), key=lambda x: x[0][1]):
        assert all(p.loss_start is None for p in pieces[:-1])
        text = "".join(p.text for p in pieces)
        turns = [tuple(plain(x) for x in piece.removeprefix(OPEN).split("\n", 1)) for piece in text.split(CLOSE)[:-1]]
        last = pieces[-1]
        got[conv].append((turns, None if last.loss_start is None else plain(last.text[last.loss_start : last.loss_start + last.loss_chars])))
    assert got == expected


def test_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "BLOCK_TURNS", 3)
    examples = prefix_examples(turns_frame(spark))
    sizes = {r.conv: r.n for r in examples.groupBy("conv").agg(F.sum(F.length("text")).alias("n")).collect()}
    rows = {r.conv: r for r in read_back(examples).collect()}
    convs = in_order(awkward_turns())
    assert set(rows) == set(convs)
    for conv, turns in convs.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        expected = (len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss), sha(loss), sizes[conv])
        assert tuple(rows[conv])[1:] == expected


def test_blocks_hold_few_turns(spark):
    blocks = turn_blocks(turns_frame(spark, [(1, i, "user", "x") for i in range(1000)]))
    assert {len(r.turns) for r in blocks.collect()} <= set(range(1, 65))


def test_empty_tables(spark):
    nothing = turns_frame(spark, [])
    assert read_back(prefix_examples(nothing)).collect() == []
    assert conversation_trie.conversation_trie(nothing).collect() == []


def test_double_array_holds_exactly_its_sequences():
    draw = random.Random(2)
    for _ in range(50):
        sequences = sorted([draw.randint(1, 30) for _ in range(draw.randint(0, 6))] for _ in range(draw.randint(0, 60)))
        trie = packed(sequences, 30)
        assert isinstance(trie, DoubleArray)
        slots = {}
        for s in sequences:
            slot = trie.root
            for k, code in enumerate(s):
                slot = trie.child(slot, code)
                assert slot >= 0 and slots.setdefault(slot, s[: k + 1]) == s[: k + 1]
        nodes = {tuple(s[:k]) for s in sequences for k in range(1, len(s) + 1)}
        assert len(slots) == len(nodes)
        for node in nodes | {()}:
            slot = trie.root
            for code in node:
                slot = trie.child(slot, code)
            assert {c for c in range(1, 31) if trie.child(slot, c) >= 0} == {n[-1] for n in nodes if n[:-1] == node}


def expected_nodes(rows) -> set[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {conv: [t[3:] for t in sorted(turns)] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(own.get(conv - conv % 20, [])[:h] + turns[h:])
    members = defaultdict(set)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(conv)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    result = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = sorted(c for c in convs if rebuilt[c] == node)
        result.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            sum(not children[n] for n in below), saved, sha(",".join(map(str, ends))),
        ))
    return result


@pytest.mark.parametrize("shuffles", [1, 37])
def test_trie_over_few_and_many_shards(spark, shuffles):
    """With as many shards as sequences, most nodes are shared and every sum crosses shards."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffles))
    try:
        rows = conversation_trie.conversation_trie(turns_frame(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = expected_nodes(awkward_turns())
    assert len(rows) == len(expected)
    assert {tuple(r) for r in rows} == expected


@pytest.mark.parametrize("name", ["op11_chat_format", "op13_conversation_trie"])
def test_queries_match_their_oracles(spark, small, name):
    from tallyhouse.llm.queries import ORACLES, QUERIES

    assert_same(QUERIES[name](spark, small), connect(small), ORACLES[name])
