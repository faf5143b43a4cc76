import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brasstally.llm.conversation_trie as trie_module
from brasstally.llm.conversation_trie import NODE_COLUMNS, OP12_SQL, DoubleArray, op12_conversation_trie, trie_nodes, turn_rows, with_shared_openings
from sidebyside import compare

SCHEMA = "conv_id long, turn long, role string, text string"


def slow_turns(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            out[conv].append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[3] for t in sorted(own)] for c, own in out.items()}


def slow_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = int(c / 100) * 100
        out[c] = convs.get(first, [])[:h] + own[h:]
    return out


def slow_nodes(convs):
    """Each distinct prefix, its totals added up one by one."""
    members = defaultdict(list)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = own + sum(saved[x] for x in children[p])
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(who), len(p), up, len(who), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted([tuple(r[c] for c in NODE_COLUMNS) for r in df.collect()], key=str)


def made():
    """Many conversations with one first turn, copies, chains, equal turn numbers, nulls, and ids without a first of their family."""
    r = random.Random(3)
    out = []
    for c in [*range(0, 60), *range(100, 130), *range(430, 450), -5, -100, -101, 7_000]:
        for t in range(r.choice([1, 2, 4, 9])):
            text = "hello" if t == 0 and c % 3 else r.choice(["a", "bb", "ccc", "é𝒜", None, ""])
            out.append((c, t, r.choice(["user", "assistant", None]) if t else "user", text))
    for c in range(200, 260):  # copies of one conversation
        out += [(c, t, "user", f"same {t}") for t in range(8)]
    out += [(300, t, "user", f"long {t % 7}") for t in range(120)] + [(301, t, "user", f"long {t % 7}") for t in range(90)]
    out += [(500, None, "user", "first"), (500, 0, "user", "second"), (500, 0, "user", "tie"), (500, 0, "user", "tie"), (None, 0, "user", "no one"), (501, None, None, None)]
    return out


@pytest.mark.parametrize("shard", [1, 6, 50, 100_000])
def test_brute_force(spark, shard):
    given_rows = made()
    frame = spark.createDataFrame(given_rows, SCHEMA)
    convs = slow_turns(given_rows)
    assert rows(trie_nodes(turn_rows(frame), shard)) == slow_nodes(convs)
    assert rows(trie_nodes(with_shared_openings(turn_rows(frame)), shard)) == slow_nodes(slow_rebuilt(convs))


def test_same_as_sql(spark, duck, small):
    outcome = compare(op12_conversation_trie(spark, small), duck, OP12_SQL)
    assert outcome.startswith("OK"), outcome


def test_ids_of_a_large_class_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie_module, "IDS_IN_CHUNK", 7)
    given_rows = [(c, 0, "user", "x") for c in range(95, 400)]
    frame = spark.createDataFrame(given_rows, SCHEMA).repartition(13)
    assert rows(trie_nodes(turn_rows(frame))) == slow_nodes(slow_turns(given_rows))


def test_packed_arrays_lead_to_every_node(spark):
    """A node's slot is its parent's base and the turn; its CHECK names the parent's slot."""
    nodes = trie_nodes(turn_rows(spark.createDataFrame(made(), SCHEMA)), 50).where("shard IS NOT NULL").collect()
    at = {(bytes(n["shard"]), n["slot"]): n for n in nodes}
    assert len(at) == len(nodes) > 100
    for n in nodes:
        if n["slot"]:
            up = at[bytes(n["shard"]), n["check"]]
            assert up["depth"] == n["depth"] - 1 and up["conv_id"] == n["parent_conv_id"] and n["slot"] > up["base"]
    assert sum(n["check"] is None for n in nodes) == len({n["shard"] for n in nodes})


@settings(max_examples=200, deadline=None)
@given(st.sets(st.lists(st.integers(1, 9), max_size=6).map(tuple), min_size=1, max_size=40))
def test_double_array(sequences):
    sequences = sorted(list(s) for s in sequences)
    trie = DoubleArray(sequences)
    found = {(): 0}
    for s in sequences:
        slot = 0
        for k, turn in enumerate(s):
            slot = trie.child(slot, turn)
            assert slot > 0 and found.setdefault(tuple(s[: k + 1]), slot) == slot
    assert sorted(found.values()) == sorted(trie.slots)
    for p, slot in found.items():
        assert {t for t in range(1, 10) if trie.child(slot, t) > 0} == {q[-1] for q in found if q and q[:-1] == p}


def test_extra_and_clashing_columns_and_empty(spark):
    given_rows = made()
    frame = spark.createDataFrame(given_rows, SCHEMA).selectExpr("*", "1 as conv", "2 as pos", "3 as depth", "4 as digest", "5 as n", "6 as prefix")
    assert rows(trie_nodes(turn_rows(frame))) == slow_nodes(slow_turns(given_rows))
    empty = trie_nodes(with_shared_openings(turn_rows(frame.limit(0))))
    assert empty.columns[: len(NODE_COLUMNS)] == NODE_COLUMNS and empty.count() == 0
    assert trie_nodes(turn_rows(frame.where("conv_id IS NULL"))).count() == 0


def test_conversations_left_without_turns_end_at_the_root(spark):
    given_rows = [(c, 0, "user", "only") for c in (1, 2, 3, 4, 5, 6, 7)]
    got = rows(trie_nodes(with_shared_openings(turn_rows(spark.createDataFrame(given_rows, SCHEMA)))))
    assert got == slow_nodes(slow_rebuilt(slow_turns(given_rows)))
    assert any(r[1] == 0 and r[3] == 7 for r in got)
