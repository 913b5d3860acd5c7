import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from helpers import spaced
from insight.llm import prefixtrie
from insight.llm.prefixtrie import last_turns, prefix_trie, rebuild

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, member string, a string, n string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "n", "w") for r in rows], SCHEMA)


def plain_paths(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def plain(rows):
    paths = plain_paths(rows)
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        words = len(spaced(p[-1][1])) if p else 0
        leaves, saved = int(not children[p]), (len(members[p]) - 1) * words
        for q in list(children[p]):
            a, b = below(q)
            leaves, saved = leaves + a, saved + b
        return leaves, saved
    out = []
    for p, m in members.items():
        leaves, saved = below(p)
        ends = ",".join(map(str, sorted(c for c in m if paths[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows):
    return sorted((tuple(r) for r in prefix_trie(*rebuild(frame(spark, rows))).collect()), key=repr)


def conversations(seed=3, n=150):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-60, 400), n):
        for t in range(rnd.choice([1, 2, 3, 3, 4, 6])):
            rows.append((c, rnd.choice([t, t, t, 0, None]), rnd.choice(["user", "assistant", None]),
                         rnd.choice(["hi", "hello there", "", None, "one two three", "École 漢字"])))
    return rows


def test_equals_the_plain_version(spark):
    rows = conversations()
    want = plain(rows)
    assert result(spark, rows) == want and len(want) > 150


def test_empty_table_null_ids_and_turnless_conversations(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, 1, "user", "lost")]) == []
    short = [(c, 0, "user", "a b") for c in range(1, 20)]  # nobody lends: those with h > 0 have no turn left
    want = plain(short)
    assert result(spark, short) == want and any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in want)


def test_repeated_rows_are_turns(spark):
    rows = [(0, 1, "user", "a")] * 5 + [(1, 1, "user", "a")] * 7 + [(2, 1, "user", "a")] * 5
    assert result(spark, rows) == plain(rows)


@pytest.mark.parametrize("chunk", [1, 3])
def test_one_long_conversation(spark, monkeypatch, chunk):
    """A third of all rows in one conversation, in many chunks, next to copies of its beginning."""
    monkeypatch.setattr(prefixtrie, "CHUNK", chunk)
    long = [(400, t, "user", f"turn {t % 5}") for t in range(120)]
    rows = long + [(c, t, "user", f"turn {t % 5}") for c in range(401, 412) for t in range(c % 7 + 1)]
    assert result(spark, rows) == plain(rows)


def test_one_sequence_of_most_conversations(spark):
    """Its end list comes in pieces; ids are ordered as numbers."""
    step = 1 << 15
    rows = [(c * step, t, "user", "same") for c in range(-30, 300) for t in range(4)] + [(c * step, 4, "user", "more") for c in range(3)]
    want = plain(rows)
    assert result(spark, rows) == want and max(r[3] for r in want) > 300


def test_role_and_text_are_kept_apart_and_come_back(spark):
    rows = [(0, 0, "a", "b"), (20, 0, "", "ab"), (40, 0, "ab", ""), (60, 0, None, "ab")]
    assert result(spark, rows) == plain(rows)
    turns, convs = rebuild(frame(spark, rows))
    out = last_turns(prefix_trie(turns, convs), turns).where("depth = 1").select("role", "text").collect()
    assert sorted(map(tuple, out)) == [("", "ab"), ("a", "b"), ("ab", "")]
