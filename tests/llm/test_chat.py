import heapq
import itertools
import random

import pytest

from scrubline.llm import chat

NAMES = (None, *chat.ROLES)


def cheapest(roles):
    """Shortest path over (turns used, last role); the legal order is stated anew here."""
    follows = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    seen, queue = set(), [(0, 0, "")]
    while queue:
        cost, used, last = heapq.heappop(queue)
        if (used, last) in seen:
            continue
        seen.add((used, last))
        if used == len(roles) and last in ("", "assistant"):
            return cost
        for new in follows[last or None]:
            if new != "system":
                heapq.heappush(queue, (cost + chat.INSERT, used, new))
            if used < len(roles):
                own = 0 if roles[used] == new else chat.NAME_UNKNOWN if roles[used] is None else chat.RELABEL
                heapq.heappush(queue, (cost + own, used + 1, new))
        if used < len(roles) and last:
            own = 0 if roles[used] == last else chat.NAME_UNKNOWN if roles[used] is None else chat.RELABEL
            heapq.heappush(queue, (cost + own + chat.MERGE, used + 1, last))


def repaired(names):
    return list(chat.repaired([chat.role_of(n) for n in names], list(names), ["x"] * len(names), list(range(len(names)))))


@pytest.mark.parametrize("length", range(1, 6))
def test_cost_is_the_least(length):
    for names in itertools.product(NAMES, repeat=length):
        rows = repaired(names)
        assert sum(r[4] for r in rows) == cheapest(names)


@pytest.mark.parametrize("length", range(0, 5))
def test_result_is_legal_and_keeps_every_turn(length):
    for names in itertools.product(NAMES, repeat=length):
        rows = repaired(names)
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert [r[5] for r in rows if r[3] != "insert"] == list(range(length))
        turns = [r[2] for r in rows if r[3] != "merge"]
        rest = turns[1:] if turns[:1] == ["system"] else turns
        assert rest == ["user", "assistant"] * (len(rest) // 2)
        text = "".join(r[8] for r in rows)
        assert text.count("<|end|>") == len(turns) and [t.split("|>")[0] for t in text.split("<|")[1::2]] == turns


def test_blocks_give_what_one_piece_gives(spark):
    dice = random.Random(4)
    rows = []
    for conv in [None, *range(12)]:
        for turn in range(dice.choice([1, 2, 7, 40, 300])):
            role = dice.choice(["user", "assistant", "user", "assistant", "system", None, "tool", " Human "])
            rows.append((conv, turn if dice.random() > 0.05 else None, role, dice.choice(["a", None, "<|end|>", "b c"])))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {tuple(r) for r in chat.repair(table, 10_000).collect()}
    for size in (1, 4, 64):
        found = chat.repair(table, size).collect()
        assert len(found) == len(whole) and {tuple(r) for r in found} == whole


def test_conversations_of_the_test_data(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = chat.repair(table).toPandas().sort_values(["conv_id", "seq"])
    given = table.toPandas().sort_values(["conv_id", "turn"])
    for conv, rows in found.groupby("conv_id"):
        source = given[given.conv_id == conv]
        assert rows.cost.sum() == cheapest(list(source.role))
        assert list(rows[rows.action != "insert"].text) == list(source.text)
