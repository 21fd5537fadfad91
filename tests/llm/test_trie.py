"""The prefix trie in parentheses against tries built as dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidewater.llm import conversation_trie as T

some = lambda t: tuple((x is not None, x) for x in t)


def nodes_of(seqs):
    """Rows of the contract for {conv_id: tuple of (role, text)}."""
    members, kids = defaultdict(list), defaultdict(set)
    for c, v in seqs.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for k in members:
        if k:
            kids[k[:-1]].add(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += not kids[k]
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(k)).encode()).hexdigest()) for k, m in members.items()), key=some)


def ordered(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append(((turn is not None, turn or 0), role or "", text or ""))
    digest = lambda r, x: hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
    return {c: tuple((r, x) for _, r, x in sorted(v, key=lambda t: (t[0], t[1], digest(t[1], t[2])))) for c, v in by.items()}


def rebuilt(seqs):
    out = {}
    for c, v in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = seqs.get(c - c % 100, ())[:h] + v[h:]
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=some)


@pytest.mark.parametrize("n", [1, 2, 3, 255, 256, 257, 6000])
def test_parentheses(n):
    rng = np.random.default_rng(n)
    for tall in (1, 2, 40):
        depths = [0]
        while len(depths) < n:
            depths.append(int(rng.integers(max(1, depths[-1] - tall + 1), depths[-1] + 2)))
        d = np.array(depths)
        trie = T.Parens(d)
        after = [next((j for j in range(i + 1, n) if d[j] <= d[i]), n) for i in range(n)]
        close = trie.find_close(trie.opens)
        assert (trie.excess[close] == trie.excess[trie.opens] - 1).all()
        a, leaves = trie.subtrees()
        assert a.tolist() == after
        leaf = np.cumsum([0] + [after[i] == i + 1 for i in range(n)])
        assert leaves.tolist() == [leaf[after[i]] - leaf[i] for i in range(n)]
        up, stack = [], []
        for i in range(n):
            stack = stack[:d[i]]
            up.append(stack[-1] if stack else -1)
            stack.append(i)
        assert T._parents(d).tolist() == up


def test_a_tall_chain():
    trie = T.Parens(np.arange(100_000))
    after, leaves = trie.subtrees()
    assert (after == 100_000).all() and (leaves == 1).all()


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_trie_of_odd_conversations(spark, partitions):
    r = random.Random(3)
    words = ["", "a", "é日\U0001F600", "the river " * 30]
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(words)) for c in range(0, 240, 3) for t in range(r.randrange(1, 6))]
    rows += [(c, t, "user", "same " * t) for c in range(1000, 1200) for t in range(4)]       # a group of copies
    rows += [(500, None, "user", "first"), (500, None, None, None), (500, 1, "user", "x"), (500, 1, "user", "x")]  # nulls, ties, repeats
    rows += [(None, 1, "user", "nobody"), (-7, 1, "user", "below"), (501, 5, "u", "one turn only")]
    rows += [(700, t, "user", f"{t % 7}") for t in range(150)]                                # a very long conversation
    df = spark.createDataFrame([(*x, "own", "own") for x in rows], "conv_id long, turn long, role string, text string, node string, depth string")
    seqs = ordered(rows)
    assert got(T.prefix_trie(df, partitions)) == nodes_of(seqs)
    back = {c: v for c, v in rebuilt({c: v for c, v in seqs.items() if c >= 0}).items()}
    assert got(T.trie_rows(df.where("conv_id >= 0"), partitions)) == nodes_of(back)
    assert any(not v for v in back.values())  # a turnless conversation is among them


def test_empty_and_whole_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.trie_rows(none).count() == 0
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(T.trie_rows(df, 7)) == nodes_of(rebuilt(ordered([tuple(r) for r in df.collect()])))


def test_role_and_text_are_kept_apart(spark):
    df = spark.createDataFrame([(1, 1, "ab", "c"), (2, 1, "a", "bc")], "conv_id long, turn long, role string, text string")
    assert T.prefix_trie(df).count() == 3
