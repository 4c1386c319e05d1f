import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmill.llm.prefix_trie import (
    SpillingQueue,
    conversation_trie,
    rebuilt_turns,
    trie,
)

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Turn lists by conversation, the plain way."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(found)] for c, found in own.items()}
    out = {}
    for conv, turns in own.items():
        base = conv - (conv - 5 * int(conv / 5))
        head = zlib.crc32(str(conv).encode()) % 9
        out[conv] = own.get(base, [])[:head] + turns[head:]
    return out


def brute_force(rows):
    convs = rebuilt(rows)
    members, children = defaultdict(set), defaultdict(set)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    out = []

    def own_saved(node):
        return (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0

    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children[node]]
        leaves = sum(b[0] for b in below) if below else 1
        totals[node] = (leaves, own_saved(node) + sum(b[1] for b in below))
        ends = sorted(c for c in members[node] if len(convs[c]) == len(node))
        out.append(
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                len(children[node]),
                *totals[node],
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df.selectExpr("*", "1 AS depth", "'x' AS block", "2 AS p1", "3 AS n_convs", "4 AS base", "5 AS at")


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_up(seed):
    rng = random.Random(seed)
    words = ["", "a", "é", "hello\nthere", "x" * 40, "日本"]
    rows = []
    for conv in rng.sample(range(-60, 200), 120):
        first = rng.random()
        texts = ["hot"] if first < 0.4 else []
        texts += [rng.choice(words) for _ in range(rng.randint(0 if texts else 1, 9))]
        rows += [(conv, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(texts)]
    for conv in range(300, 340):  # a family of copies, longer than any head
        rows += [(conv, i, "user", f"same {i}") for i in range(14)]
    return rows


@pytest.mark.parametrize(("shard", "limit", "piece"), [(2, 2, 8), (7, 65_536, 32_768), (4096, 3, 40)])
def test_equals_brute_force(spark, shard, limit, piece):
    rows = made_up(shard)
    rows += [(1000, None, None, "first"), (1000, None, "user", None), (1000, 5, "user", "x"), (1000, 5, "user", "x")]
    rows += [(1001, 0, "user", "t"), (None, 0, "user", "nobody's"), (1000, -3, "b", "a"), (1000, -3, "a", "b")]
    rows += [(9223372036854775807, 0, "user", "hot"), (-9223372036854775808, 0, "user", "hot")]
    got = trie(*rebuilt_turns(table(spark, rows)), shard=shard, limit=limit, piece=piece)
    assert result(got) == brute_force(rows)


def test_long_conversations_span_blocks_and_chains(spark):
    rows = [(c, i, "user", f"turn {i}") for c in (10, 15, 20) for i in range(9000)]
    rows += [(20, 9000, "user", "one more"), (25, 0, "user", "turn 0")]
    got = result(conversation_trie(table(spark, rows)))
    assert got == brute_force(rows)


def test_turnless_conversations_one_row_and_no_rows(spark):
    alone = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:3]
    for rows in ([(c, 0, "user", "gone") for c in alone], [(5, 0, None, None)], [(alone[0], 0, "u", "t")]):
        assert result(conversation_trie(table(spark, rows))) == brute_force(rows)
    assert conversation_trie(table(spark, [(None, 0, "u", "t")])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50), st.none()), max_size=120), st.integers(1, 9))
def test_a_spilling_queue_gives_items_in_order(tmp_path_factory, steps, limit):
    folder = f"file://{tmp_path_factory.mktemp('queue')}"
    queue, plain = SpillingQueue(folder, limit), []
    for step in steps:
        if step is None and plain:
            assert queue.least() == min(plain)
            plain.remove(queue.pop())
        elif step is not None:
            item = (step, 1, -step, 2, len(plain))
            queue.push(item)
            plain.append(item)
    while plain:
        assert queue.least() == min(plain)
        plain.remove(queue.pop())
    assert queue.least() is None
    assert queue.spilled > 0 or len([s for s in steps if s is not None]) <= limit or None in steps
