"""The conversation trie against plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from harkline.llm import conversations
from harkline.llm.common import table
from tests.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, depth string, pos int"


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        mine = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = mine + sum(saved[c] for c in below)
    return sorted(
        (m[0], len(node), members[node[:-1]][0] if node else -1, len(m), len(children[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, m in members.items()
    )


def told(frame):
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


def drawn_rows(seed, convs, most=12, texts=3):
    """Few texts, so that prefixes are shared to all depths; nulls, repeated rows, gaps between ids."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-20, 3 * convs), convs):
        for t in range(draw.randrange(1, most)):
            text = draw.choice([None, "", "ü", "yes", "no é 日"][:texts + 2])
            rows.append((c, t if draw.random() < 0.9 else None, draw.choice(["user", None, "tool"]) if texts > 1 else "u", text))
    rows += draw.sample(rows, 10) + [(None, 1, "user", "no conversation")]
    # ties between different turns have no order that the plain code knows
    seen = {}
    for c, t, role, text in rows:
        seen.setdefault((c, t), (role, text))
    return [(c, t, *seen[c, t], "x", 7) for c, t, _, _ in rows]


@pytest.mark.parametrize("bits", [28, 15])
@pytest.mark.parametrize("texts", [1, 3])
def test_against_dictionaries(spark, bits, texts):
    rows = drawn_rows(bits + texts, 300, texts=texts)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert told(conversations.prefix_trie(frame, most_bits=bits)) == plain_trie(rows)


def test_table(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").collect()]
    assert told(conversations.prefix_trie(table(spark, SMALL, "conversations"))) == plain_trie(rows)


def test_a_conversation_over_many_partitions(spark, monkeypatch):
    """A third of all turns is one conversation, another a copy of it with a different end."""
    monkeypatch.setattr(conversations, "BLOCK", 64)
    long = [(40, t, "user", f"turn {t % 7}") for t in range(1500)] + [(45, t, "user", f"turn {t % 7}") for t in range(1490)]
    rows = [(c, t, r, x, "x", 7) for c, t, r, x in long] + drawn_rows(3, 60)
    rows = [r for r in rows if r[0] not in (40, 45)] + [(c, t, r, x, "x", 7) for c, t, r, x in long]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = told(conversations.prefix_trie(frame))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == plain_trie(rows)


def test_one_common_conversation(spark, monkeypatch):
    """Two thousand copies end at one node; its ids are hashed in many stretches."""
    monkeypatch.setattr(conversations, "STRETCH", 16)
    rows = [(c, t, "user", f"same {t}", "x", 7) for c in range(2000) for t in range(9)]
    assert told(conversations.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4))) == plain_trie(rows)


def test_turnless_and_empty(spark):
    """9003 takes six turns of a conversation that is not there, and has fewer of its own."""
    rows = [(c, 0, "user", "only", "x", 7) for c in range(9001, 9005)]
    want = plain_trie(rows)
    assert told(conversations.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == want and want[0][1] == 0
    assert conversations.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conversations.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "x", 7)], SCHEMA)).count() == 0
