"""The conversation trie against plain Python over all prefixes."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from valora.llm.turn_trie import trie, turn_rows, with_openings

SCHEMA = "conv_id long, turn long, role string, text string, id long, pos long, s int, h1 long, n long"


def brute(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], set()).add(node)
    out = []
    for node, ids in members.items():
        under = [m for m in members if m[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(paths[c]) == len(node)))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids.get(node, ())),
                    sum(m not in kids for m in under), sum((len(members[m]) - 1) * len(m[-1][1]) for m in under if m),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def paths_of(rows):
    paths = {}
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        paths.setdefault(c, []).append((role or "", text or ""))
    return paths


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)


def made(n, copies):
    """Conversations that share beginnings of all lengths, and a group of copies."""
    rows = []
    for c in range(n):
        size, x = 1 + c * 7 % 11, c * 2654435761 % 997
        for t in range(size):
            x = x * 31 % 997 if (x + t) % 4 == 0 else x
            rows.append((c - 5, t, "user" if t % 2 == 0 else "assistant", f"{'é' * (t % 3)}{x % 3} words"))
    rows += [(1000 + c, t, "user", "copied") for c in range(copies) for t in range(9)]
    return rows


ODD = [(None, 1, "user", "no id"), (5000, None, None, None), (5000, 1, "user", ""), (5001, 2, "user", "x" * 100_000),
       (5001, 1, "user", None), (5002, 1, "a", "bc"), (5003, 1, "ab", "c")]


@pytest.mark.parametrize("segment, shards", [(256, 7), (2, 5), (1, 3), (4, 1)])
def test_same_as_all_prefixes(spark, segment, shards):
    rows = made(60, 40) + ODD
    got = trie(turn_rows(frame(spark, rows)), segment, shards).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(paths_of(rows))


def test_a_long_conversation_and_its_snapshots(spark):
    long = [(1, t, "user", f"t{t}") for t in range(400)]
    rows = long + [(2, t, "user", f"t{t}") for t in range(150)] + [(3, t, "user", f"t{t}") for t in range(151)] \
        + [(4, 0, "user", "other")]
    got = trie(turn_rows(frame(spark, rows)), 16, 4).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(paths_of(rows))


def test_openings_are_those_of_the_base(spark):
    rows = made(130, 0) + [(c, 0, "user", "alone") for c in (204, 299, 300)] + [(777, None, "user", None)]
    own = paths_of(rows)
    paths = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = own.get(base, [])[:h] + path[h:]
    assert any(not p for p in paths.values())
    id_ = F.col("id")
    turns = with_openings(turn_rows(frame(spark, rows)), id_ - id_ % 100, id_ % 100 == 0,
                          F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(6)), 5)
    assert sorted((tuple(r) for r in trie(turns, shards=6).collect()), key=str) == brute(paths)


def test_repeated_rows_and_no_rows(spark):
    rows = [(1, 0, "user", "a")] * 3 + [(2, 0, "user", "a")] * 3
    assert sorted(map(tuple, trie(turn_rows(frame(spark, rows))).collect()), key=str) == brute(
        {1: [("user", "a")] * 3, 2: [("user", "a")] * 3})
    assert trie(turn_rows(frame(spark, []))).count() == 0
    assert trie(turn_rows(frame(spark, ODD[:1]))).count() == 0
