"""Prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from care_episodes.llm import prefix_trie as P
from tests.llm.helpers import rows

SCHEMA = "conv_id long, turn long, role string, text string, hash string, n string"


def expected(data):
    own = defaultdict(list)
    for c, turn, role, text, *_ in data:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = sum(saved[k] for k in children[path]) + (len(members[path]) - 1) * size
    return sorted(
        (
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        )
        for p in members
    )


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def got(spark, data):
    df = spark.createDataFrame([(*r, "mine", "mine") for r in data], SCHEMA)
    return sorted(tuple(r[c] for c in COLUMNS) for r in rows(P.prefix_trie(df)))


def conversations(seed, n):
    rng = random.Random(seed)
    data = []
    for c in rng.sample(range(-20, 3 * n), n):
        length = rng.choice([1, 2, 3, 5, 12, 30])
        for t in range(length):
            data.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "ç" * rng.randrange(4), None, ""])))
    return data


@pytest.mark.parametrize(("chunk", "block", "run"), [(64, 8192, 4096), (3, 16, 2), (1, 5, 1), (64, 16, 3)])
def test_trie_matches_dictionary(spark, monkeypatch, chunk, block, run):
    monkeypatch.setattr(P, "CHUNK", chunk)
    monkeypatch.setattr(P, "BLOCK_ROWS", block)
    monkeypatch.setattr(P, "RUN", run)
    data = conversations(chunk + block, 70)
    data += [(1000 + k, t, "user", f"turn {t}") for k in range(40) for t in range(12)]  # equal ones
    data += [(2000, t, "user", f"turn {t}") for t in range(200)]  # a long one
    data += [(None, 0, "user", "nobody's"), *data[:30]]
    assert got(spark, data) == expected(data)


def test_one_turnless_conversation_and_no_rows(spark):
    lone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    data = [(lone, 0, "user", "taken away"), (lone, 1, None, None)]
    assert got(spark, data) == expected(data) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "a", "b")]) == []


def test_extents_match_scans():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 33):
        common = rng.integers(0, 5, n)
        common[0] = 0
        table = P.SparseTable(common)
        for at in range(n):
            for length in range(1, 6):
                left = at
                while left > 0 and common[left] >= length:
                    left -= 1
                right = at
                while right + 1 < n and common[right + 1] >= length:
                    right += 1
                one = np.array([at]), np.array([length])
                assert P.left_extents(table, *one)[0] == left and P.right_extents(table, *one)[0] == right
        ends = np.sort(rng.integers(0, n, (20, 2)), 1)
        assert (table.over(ends[:, 0], ends[:, 1]) == [common[a : b + 1].min() for a, b in ends]).all()
