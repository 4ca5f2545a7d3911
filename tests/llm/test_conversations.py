from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from orderlens.llm import conversations as conv
from orderlens.llm.queries import QUERIES
from tests.llm.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]")
FORM = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        inside = WORD.findall(text)
        fault = "blank" if not inside else "duplicate" if (role, text) in seen else "truncated" if inside[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append(fault)
    return found


def cheapest(rows, kinds):
    """Dijkstra over (rows done, roles' initials so far): (cost, audit, lines). No states, spans or grammar of the operator's."""
    import heapq

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, shape, lines = heapq.heappop(heap)
        if i == len(rows) and FORM.fullmatch(shape):
            return cost, audit, lines
        last = shape[-1:] + ("." if shape else "")
        if (i, last, FORM.fullmatch(shape) is not None) in done:
            continue
        done.add((i, last, FORM.fullmatch(shape) is not None))

        def step(more, edit, role, text, ahead):
            longer = shape + role[:1]
            if any(FORM.fullmatch(longer + rest) for rest in ("", "a", "ua")):
                heapq.heappush(heap, (cost + more, audit + edit, i + ahead, longer, (*lines, f"{role}:{text}")))

        for role in ("user", "assistant"):
            step(5, "I", role, "", 0)
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, shape, lines))
            if kinds[i] not in ("blank", "duplicate"):
                extra = 5 if kinds[i] == "truncated" else 0
                if rows[i][0]:
                    step(extra, "K", *rows[i], 1)
                for role in ("user", "assistant"):
                    step(1 + extra, "R", role, rows[i][1], 1)
    raise AssertionError


def brute(rows):
    """(turn, role, text), in order -> the row of the query without its id."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    turns = {turn for turn, _, _ in rows if turn is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [(role, text) for _, role, text in rows]
    kinds = faults(pairs)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
    cost, audit, lines = cheapest(pairs, kinds)
    counts = tuple(kinds.count(kind) for kind in ("blank", "duplicate", "truncated"))
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def ordered(rows):
    def digest(row):
        return hashlib.md5(f"{len(row[1])}:{row[1]}{row[2]}".encode()).digest()

    return sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, digest(row)))


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def random_rows(rng, n):
    texts = ["Yes.", "No!", "cut off", "", "  ", "Why?", "So. ", "end.\n"] + [f"text {i}." for i in range(8)]
    return [(rng.choice((None, *range(n))), rng.choice(("user", "user", "assistant", "assistant", "system", "tool", "")), rng.choice(texts)) for _ in range(n)]


def test_block_cells_against_search():
    rng = random.Random(5)
    cached: dict = {}
    for n in [*range(1, 10)] * 30:
        rows = random_rows(rng, n)
        pairs = [(role, text) for _, role, text in rows]
        kinds = faults(pairs)
        faulty = [4 * conv.FAULTS.index(kind or "none") for kind in kinds]
        initials = [conv.INITIALS.index(role[0]) if role[:1] in (*"sua",) else 3 for role, _ in pairs]
        letters = "".join(conv.CODES[f + i] for f, i in zip(faulty, initials, strict=True))
        cell = conv.block_cell(letters, cached)
        assert min(cell[0, q] for q in conv.ACCEPTING if (0, q) in cell) == cheapest(pairs, kinds)[:2]


def test_any_bracketing_gives_the_same_cell():
    rng = random.Random(6)
    for _ in range(20):
        cells = [conv.terminal(rng.choice(conv.CODES)) for _ in range(7)]
        left = cells[0]
        for one in cells[1:]:
            left = conv.combined(left, one)
        right = cells[-1]
        for one in reversed(cells[:-1]):
            right = conv.combined(one, right)
        assert left == right == conv.by_length(cells)


@pytest.mark.parametrize(("block_rows", "fan"), [(512, 64), (3, 2), (1, 3)])
def test_repairs_against_search(spark, block_rows, fan):
    rng = random.Random(7)
    groups = {c: random_rows(rng, n) for c, n in zip([None, *range(24)], [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 30] * 3, strict=False)}
    rows = [(c, t, role or None, text or None, "conv", 1) for c, group in groups.items() for t, role, text in group]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, place long")
    repair = conv.repair_conversations(df, block_rows=block_rows, fan=fan)
    digests = {r.conv: r.sha256 for r in conv.line_digests(repair.turns).collect()}
    found = {r[0]: (*tuple(r)[1:], digests.get(r[0], hashlib.sha256(b"").hexdigest())) for r in repair.report.collect()}
    filled = {c: [(t, role or " ", text or " ") for t, role, text in group] for c, group in groups.items() if group}
    assert found == {c: brute(ordered(group)) for c, group in filled.items()}


def test_one_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"line {i}.") for i in range(3000)] + [(1, 3000, "user", "same.")] * 2000
    repair = conv.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), fan=4)
    row = repair.report.first()
    assert (row.duplicate, row.illegal, row.cost) == (1999, 1999, 1999 * 2 + 2)
    assert row.audit == "K" * 3000 + "D" * 2000
    assert repair.turns.count() == 3000


def test_empty_table(spark):
    repair = conv.repair_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert repair.report.count() == repair.turns.count() == conv.line_digests(repair.turns).count() == 0


def grouped(rows):
    groups: dict = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t, role, text))
    return groups


def test_query_against_search(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = grouped(damaged(rows))
    expected = {c: brute(ordered(after.get(c, []))) for c in {row[0] for row in rows}}
    found = {row[0]: tuple(row)[1:] for row in QUERIES["op11_conversation_repair"](spark, SMALL).collect()}
    assert found == expected


def test_query_with_nulls(spark, tmp_path):
    rows = [(None, None, None, None), (None, 1, "user", None), (2, None, "user", "a."), (2, None, "user", "a."), (3, 0, None, "b."), (3, 9, "assistant", "c.")]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(10, 60) for t in range(6)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    after = grouped(damaged(rows))
    found = {row[0]: tuple(row)[1:] for row in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()}
    assert found == {c: brute(ordered(after.get(c, []))) for c in {row[0] for row in rows}}
