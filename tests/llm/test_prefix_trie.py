"""The conversation prefix trie against a brute-force trie."""

import hashlib
import os
import random
import zlib

import pytest

from conftest import SF_SMALL
from plantlake.llm import prefix_trie, queries
from plantlake.llm.prefix_trie import ID_BYTES, Layout4, Layout16, Layout48, Layout256, radix_tree

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, __head string"


def brute(convs):
    """{conversation: [(role, text)]} -> rows."""
    nodes, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path in nodes:
        if path:
            kids[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(members) - 1) * (len(path[-1][1]) if path else 0)
            leaves[path[:d]] += not kids[path]
    out = []
    for path, members in nodes.items():
        text = ",".join(map(str, sorted(ends.get(path, []))))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), kids[path], leaves[path], saved[path], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            said = (role or "", text or "")
            tid = hashlib.sha256(f"{len(said[0])}:{said[0]}{said[1]}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), said[0], tid, said))
    own = {c: [said for *_, said in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def rows_of(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert tuple(df.columns) == columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def conversations(seed, n=230):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        if c == 100:
            continue  # an absent head
        for t in range(0 if c % 11 == 0 and c else pick.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t if pick.random() > 0.05 else None, pick.choice(["user", "assistant", None]), pick.choice(["a", "b", "", None, "ö 日"])))
    rows += [(c, t, "user", "same") for c in range(300, 420) for t in range(4)]  # a hot conversation
    rows += [(500, t, "user", "long") for t in range(700)] + [(501, t, "user", "long") for t in range(650)]
    rows += [(None, 0, "user", "nobody's"), (7, 0, "user", "twice"), (7, 0, "user", "twice")]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize(("part", "few"), [(100_000, 1_000_000), (40, 1_000_000), (150, 0)])
def test_equals_brute_force(spark, monkeypatch, part, few):
    monkeypatch.setattr(prefix_trie, "PART_TURNS", part)
    monkeypatch.setattr(prefix_trie, "FEW_OPEN", few)
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 40)
    rows = conversations(part)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = prefix_trie.prefix_trie(prefix_trie.with_shared_heads(prefix_trie.sequences(df)))
    assert rows_of(got) == brute(rebuilt(rows))


def test_nothing_one_turnless_and_copies(spark):
    def trie(rows):
        return rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id bigint, turns array<struct<id:string,chars:int>>")))

    assert trie([]) == []
    empty = prefix_trie.EMPTY_SHA
    assert trie([(4, [])]) == [(4, 0, None, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest())]
    turn = ("ab" * ID_BYTES, 5)
    both = hashlib.sha256(b"-3,12").hexdigest()
    assert trie([(12, [turn]), (-3, [turn])]) == sorted([(-3, 0, None, 2, 1, 1, 5, empty), (-3, 1, -3, 2, 0, 1, 5, both)], key=repr)


def test_layouts_grow_and_paths_are_compressed():
    for n, layout in ((3, Layout4), (4, Layout4), (5, Layout16), (16, Layout16), (17, Layout48), (48, Layout48), (49, Layout256), (256, Layout256)):
        pick = random.Random(n)
        keys = [b"\x01" * 40 + bytes([b]) + b"\x02" * 7 for b in pick.sample(range(256), n)]
        fork = radix_tree(keys).children()[0]
        assert fork.depth == 40 and type(fork.below) is layout
        assert [keys[k.model][40] for k in fork.children()] == sorted(k[40] for k in keys)


def test_tree_holds_exactly_its_strings():
    pick = random.Random(8)
    for _ in range(200):
        keys = list({bytes(pick.choice(b"abc") for _ in range(pick.randint(0, 6))) for _ in range(pick.randint(1, 60))})
        root = radix_tree(keys)
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.end is not None:
                assert len(keys[node.end]) == node.depth
                found.append(node.end)
            assert node.end is not None or len(node.children()) > 1 or node is root
            stack += node.children()
        assert sorted(found) == list(range(len(keys)))


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{os.path.join(SF_SMALL, 'conversations.parquet')}')")
    got = queries.op13_conversation_prefix_trie(spark, SF_SMALL)
    want = con.execute(queries.ORACLE["op13_conversation_prefix_trie"])
    names = [c[0] for c in want.description]
    assert rows_of(got) == sorted((tuple(r[names.index(c)] for c in got.columns) for r in want.fetchall()), key=repr)
