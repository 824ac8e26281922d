"""Conversation repair against Dijkstra's search over (cost, edits) on whole conversations."""

import collections
import hashlib
import heapq
import random
import zlib

import pytest

from measlake.llm import dialogue
from measlake.llm.common import configure

TURNS = "conv_id bigint, turn bigint, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    found = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv] += []
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(sign for sign in text if sign not in ".!?")
        if kind == 4:
            role = "user"
        found[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return found


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.sha256(text.encode()).digest())


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        if not text.strip(SPACES):
            found.append("blank")
        elif (role, text) in seen:
            found.append("copy")
        else:
            found.append("" if text.rstrip(SPACES)[-1] in ".!?" else "cut")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, out
        if (i, state) in done:
            continue
        done.add((i, state))
        want, after = ("assistant", 3) if state == 2 else ("user", 2)
        heapq.heappush(heap, (cost + 3, audit + "I", i, after, (*out, (want, ""))))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
        if found[i] in ("blank", "copy"):
            continue
        extra = 3 if found[i] == "cut" else 0
        if role[:1] == want[0] or (role[:1] == "s" and state == 0):
            to = 1 if role[:1] == "s" else after
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, to, (*out, (role, text))))
        heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, after, (*out, (want, text))))


def plain(rows):
    result = {}
    for conv, turns in damaged(rows).items():
        turns = sorted(turns, key=order)
        found = faults(turns)
        known = {turn for turn, _, _ in turns if turn is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = cheapest(turns, found)
        text = "\n".join(f"{role}:{text}" for role, text in out)
        counts = [found.count(name) for name in ("blank", "copy", "cut")]
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return result


def result(turns):
    return {row[0]: tuple(row)[1:] for row in dialogue.digest(turns).collect()}


def random_rows(rnd, conv, n):
    texts = ["Hi.", "Yes!", " ", "no", "", None, "What? ", "x "]
    for turn in range(n):
        role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
        text = rnd.choice([*texts, f"{turn}.", f"{turn}!", f"{turn}"])
        yield conv, rnd.choice([turn, turn, turn, turn + 1, None]), role, text


@pytest.mark.parametrize("segment", [32, 3])
def test_repair_equals_dijkstra(spark, monkeypatch, segment):
    configure(spark)
    monkeypatch.setattr(dialogue, "SEGMENT", segment)
    rnd = random.Random(segment)
    rows = [row for conv in range(60) for row in random_rows(rnd, conv, rnd.randint(1, 9))]
    rows += [row for conv in (None, 60, 61) for row in random_rows(rnd, conv, 90)]
    rows += [(62, turn, ("user", "assistant")[turn % 2], f"{turn}.") for turn in range(100)]
    rows += [(63, None, "user", "same.")] * 40 + [(64, 5, "assistant", "x" * 200000 + ".")]
    # Every row of these is dropped or all are blank.
    gone = next(c for c in range(100, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Hi."), (65, 1, "user", " "), (65, 2, "assistant", "\t")]
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    assert result(turns) == plain(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert result(turns)[gone] == (0, 0, 0, 0, 0, 0, "", empty)


def test_costs_across_add_up():
    rnd = random.Random(4)
    for _ in range(60):
        codes = bytes(rnd.choice([0, 1, 2, 1, 2, 3, 5, 9, 13, 14]) for _ in range(rnd.randint(1, 10)))
        across = dialogue.costs_across(codes)
        for state in dialogue.STATES:
            whole = dialogue.Search(codes, dialogue.LAST).cheapest(state)[0]
            assert whole == min(across[4 * state + end] + dialogue.LAST[end] for end in dialogue.STATES)


def test_lower_bound_never_exceeds_the_cost():
    rnd = random.Random(5)
    for _ in range(300):
        codes = bytes(rnd.choice([0, 1, 2, 1, 2, 3, 5, 9, 13, 14]) for _ in range(rnd.randint(0, 8)))
        search = dialogue.Search(codes, dialogue.LAST)
        cost, path = search.cheapest(0)
        rows = [(0, ("s", "u", "a", "x")[c & 3], str(i)) for i, c in enumerate(codes)]
        found = [("", "blank", "copy", "cut")[c >> 2] for c in codes]
        best = cheapest(rows, found)
        assert search.rest[0] <= best[0]
        tail = "I" * (dialogue.LAST[dialogue.state_after(0, codes, path)] // 3)
        assert (cost, path + tail) == best[:2]


def test_empty_table_and_other_columns(spark):
    configure(spark)
    assert result(spark.createDataFrame([], TURNS)) == {}
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")]
    more = [(*row, "x", 1, 2) for row in rows]
    turns = spark.createDataFrame(more, TURNS + ", kind string, n int, part int")
    assert result(turns) == plain(rows)
