"""Conversations brought into the form system? (user assistant)+ at the least cost, or to nothing at all.

The cheapest repair of a conversation is a weighted parse. Rows can be kept (0), given another role (1) or deleted (2);
blank rows and repeats must go; a truncated row that stays costs 5 more; empty turns can be put in anywhere (5 each).
Each edit leaves its initial in the audit, and of repairs with equal cost the one with the ASCII-least audit counts.

The grammar is in Chomsky normal form. Its symbols are [p, q]: what leads from state p to state q, the states being the
start, behind the system row, behind a user row, behind an assistant row. [p, q] -> [p, r] [r, q] are the binary rules; a
row is a terminal of the symbols its edits allow; symbols are closed under insertion on both sides. A span's cell holds
the least (cost, audit) of every symbol. Every split of a span gives the same cell here, as any derivation can be
bracketed anew, and least parts make a least whole: of two audits of one span with equal cost neither begins with the
other, since they would differ by insertions alone. So one split per span is enough, and cells are combined bottom-up by
span length: 1, 2, 4, ... rows.

A conversation may hold a third of all rows. Rows reach the parser without their texts, in ranges of (conversation, turn),
so that a long one is dealt over many tasks; each parses blocks of ``BLOCK_ROWS`` rows, and only the cells of blocks meet,
``FAN`` at a time. The texts are shuffled once, to be streamed in order beside the audit.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.staging import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK_ROWS = 512
FAN = 64

#: state -> {role's initial: next state}; the whole is accepted in states 0 (nothing) and 3 (behind an assistant row).
STATES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTING = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")

#: A row's code letter is number 4 * fault + initial of these.
INITIALS = "sua?"
FAULTS = ("none", "truncated", "blank", "duplicate")
CODES = "ABCDEFGHIJKLMNOP"

#: What a span is summed up as; the columns of a block.
SUMMARY = (
    "first_turn bigint, last_turn bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_initial string, last_initial string, costs array<bigint>, audits array<string>"
)
NAMES = tuple(column.split()[0] for column in SUMMARY.split(", "))
WHITE = "concat(' ', char(9), char(10), char(11), char(12), char(13))"


def _least(cell: dict, symbol: tuple[int, int], weight: tuple[int, str]) -> None:
    if symbol not in cell or weight < cell[symbol]:
        cell[symbol] = weight


def combined(left: dict, right: dict) -> dict:
    """The cell of two neighbouring spans."""
    cell: dict = {}
    for (p, r), (cost, audit) in left.items():
        for (s, q), (more, rest) in right.items():
            if r == s:
                _least(cell, (p, q), (cost + more, audit + rest))
    return cell


def insertions() -> dict:
    """The cell of no rows: the cheapest insertions that lead from state to state."""
    cell = {(p, p): (0, "") for p in range(len(STATES))}
    single = {(p, q): (INSERT, "I") for p, moves in enumerate(STATES) for initial, q in moves.items() if initial in ROLES}
    for _ in STATES:
        for symbol, weight in combined(cell, single).items():
            _least(cell, symbol, weight)
    return cell


def terminal(code: str) -> dict:
    """The cell of one row, closed under insertion."""
    fault, initial = divmod(CODES.index(code), 4)
    extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
    cell = {(p, p): (DELETE, "D") for p in range(len(STATES))}
    if FAULTS[fault] in ("none", "truncated"):
        for p, moves in enumerate(STATES):
            for role, q in moves.items():
                if role == INITIALS[initial]:
                    _least(cell, (p, q), (KEEP + extra, "K"))
                if role in ROLES:
                    _least(cell, (p, q), (REROLE + extra, "R"))
    closure = insertions()
    return combined(combined(closure, cell), closure)


def by_length(cells: list[dict], cached: dict | None = None, codes: str = "") -> dict:
    """One cell of neighbouring ones, bottom-up. Cells of equal ``codes`` are made once for spans of up to 16 rows."""
    width = 1
    while len(cells) > 1:
        width *= 2
        pairs = []
        for i in range(0, len(cells) - 1, 2):
            span = codes[i // 2 * width : (i // 2 + 1) * width] if cached is not None and width <= 16 else None
            cell = cached.get(span) if span else None
            if cell is None:
                cell = combined(cells[i], cells[i + 1])
                if span:
                    cached[span] = cell
            pairs.append(cell)
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


def block_cell(codes: str, cached: dict) -> dict:
    for code in set(codes) - cached.keys():
        cached[code] = terminal(code)
    if len(cached) > 100_000:
        for span in [span for span in cached if len(span) > 1]:
            del cached[span]
    return by_length([cached[code] for code in codes], cached, codes)


def _flat(cell: dict) -> tuple[list, list]:
    symbols = [(p, q) for p in range(len(STATES)) for q in range(len(STATES))]
    found = [cell.get(symbol, (None, None)) for symbol in symbols]
    return [cost for cost, _ in found], [audit for _, audit in found]


def _cell(costs: list, audits: list) -> dict:
    n = len(STATES)
    return {divmod(i, n): (costs[i], audits[i]) for i in range(n * n) if costs[i] is not None}


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL_PAIRS for i in range(len(initials) - 1))


def _blocks(block_rows: int):
    """Sorted rows (conversation, turn, digest, kind, copies, repeats) to blocks of one conversation each.

    ``kind`` is the row's code letter without regard to repeats, ``repeats`` how many of its copies have been seen before.
    """

    def run(batches) -> Iterator:
        import pyarrow as pa

        cached: dict = {}
        here: tuple | None = None  # conversation; start of the block: turn, digest, copy
        codes, turns, out = [], [], []

        def flush():
            text = "".join(codes)
            initials = "".join(INITIALS[CODES.index(code) % 4] for code in codes)
            counts = [sum(CODES.index(code) // 4 == i for code in codes) for i in range(4)]
            known = [turn for turn in turns if turn is not None]
            summed = (known[0] if known else None, known[-1] if known else None, len(set(known)), counts[2], counts[3], counts[1])
            out.append((*here, *summed, _illegal(initials), initials[0], initials[-1], *_flat(block_cell(text, cached))))
            codes.clear()
            turns.clear()

        def made():
            lists = [pa.list_(pa.int64()), pa.list_(pa.string())]
            batch = _rows(out, [*schema, *[pa.int64()] * 8, pa.string(), pa.string(), *lists], ("conv", "turn", "digest", "piece", *NAMES))
            out.clear()
            return batch

        schema = None
        for batch in batches:
            schema = [column.type for column in batch.columns[:3]]
            for conv, turn, digest, kind, copies, repeats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plain, again = CODES.index(kind), copies - repeats
                other = kind if FAULTS[plain // 4] == "blank" else CODES[12 + plain % 4]
                copy = 0
                while copy < copies:
                    if codes and (here[0] != conv or len(codes) >= block_rows):
                        flush()
                    if not codes:
                        here = (conv, turn, digest, copy)
                    stop = min(again if copy < again else copies, copy + block_rows - len(codes))
                    codes += [kind if copy < again else other] * (stop - copy)
                    turns.append(turn)
                    copy = stop
            if len(out) >= 4096:
                yield made()
        if codes:
            flush()
        if out:
            yield made()

    return run


def _joined(summaries: list[dict]) -> dict:
    """The summary of neighbouring blocks, in order."""
    first = dict(summaries[0])
    for one in summaries[1:]:
        first["turns"] += one["turns"] - (first["last_turn"] is not None and one["first_turn"] == first["last_turn"])
        first["first_turn"] = one["first_turn"] if first["first_turn"] is None else first["first_turn"]
        first["last_turn"] = first["last_turn"] if one["last_turn"] is None else one["last_turn"]
        for name in ("blank", "duplicate", "truncated"):
            first[name] += one[name]
        first["illegal"] += one["illegal"] + _illegal(first["last_initial"] + one["first_initial"])
        first["last_initial"] = one["last_initial"]
    cell = by_length([_cell(one["costs"], one["audits"]) for one in summaries])
    first["costs"], first["audits"] = _flat(cell)
    return first


def _meet(fan: int):
    """Sorted blocks (conv, place, summary) to one row per conversation and ``fan`` places."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (held[0]["conv"], held[0]["place"] // fan) != (row["conv"], row["place"] // fan):
                    out.append(_joined(held))
                    held = []
                held.append(row)
            schema = batch.schema
            yield pa.RecordBatch.from_pylist([{**one, "place": one["place"] // fan} for one in out], schema=schema)
        if held:
            last = _joined(held)
            yield pa.RecordBatch.from_pylist([{**last, "place": last["place"] // fan}], schema=schema)

    return run


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role and text with one space for null, and the digest by which equal rows are known."""
    named = rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    )
    return named.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def _coded(prepared: DataFrame) -> DataFrame:
    bare = F.expr(f"trim(TRAILING {WHITE} FROM text)")
    fault = F.when(bare == "", 2).when(F.right(bare, F.lit(1)).isin(*".!?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return prepared.select("conv", "turn", "digest", F.char(F.lit(ord(CODES[0])) + 4 * fault + number).alias("kind"))


def _parsed(coded: DataFrame, block_rows: int, fan: int) -> DataFrame:
    """conv and the summary of the whole conversation."""
    copies = coded.groupBy("conv", "turn", "digest").agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("copies"))
    distinct = written(copies, "turns")
    # The first occurrence by turn, nulls first: a least struct, combined in the tasks before it is shuffled.
    first = distinct.groupBy("conv", "digest").agg(F.min(F.struct("turn")).alias("at"))
    first = first.select(F.col("conv").alias("c"), F.col("digest").alias("d"), F.col("at.turn").alias("t"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    repeats = F.when(F.col("turn").eqNullSafe(F.col("t")), F.col("copies") - 1).otherwise(F.col("copies"))
    marked = distinct.join(first, same).select("conv", "turn", "digest", "kind", "copies", repeats.alias("repeats"))
    ordered = marked.repartitionByRange("conv", "turn", "digest").sortWithinPartitions("conv", "turn", "digest")
    head = [coded.schema["conv"], coded.schema["turn"], coded.schema["digest"], T.StructField("piece", T.LongType())]
    summary = T.StructType.fromDDL(SUMMARY).fields
    blocks = written(ordered.mapInArrow(_blocks(block_rows), T.StructType([*head, *summary])), "blocks")

    own = Window.partitionBy("conv")
    place = F.row_number().over(own.orderBy("turn", "digest", "piece")).cast("bigint") - 1
    placed = blocks.withColumns({"place": place, "n": F.count(F.lit(1)).over(own)})
    placed = placed.select("conv", "place", "n", *NAMES)
    largest = blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    whole, meeting = placed.where("n = 1").select("conv", *NAMES), placed.where("n > 1").drop("n")
    rounds = 0
    while fan**rounds < largest:
        near = meeting.repartition("conv", F.floor(F.col("place") / fan)).sortWithinPartitions("conv", "place")
        meeting = near.mapInArrow(_meet(fan), meeting.schema)
        rounds += 1
    return whole.unionByName(meeting.select("conv", *NAMES)) if rounds else whole


def _chosen(parsed: DataFrame) -> DataFrame:
    """conv, the counts, and cost and audit of the best symbol from the start to an accepting state."""
    ends = [F.struct(F.col("costs")[q].alias("cost"), F.col("audits")[q].alias("audit")) for q in ACCEPTING]
    best = F.array_min(F.filter(F.array(*ends), lambda end: end["cost"].isNotNull()))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    counts = ("blank", "duplicate", "truncated", "illegal")
    picked = parsed.withColumn("best", best)
    return picked.select("conv", gaps.alias("gaps"), *counts, F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"))


def _walk(batches) -> Iterator:
    """Sorted rows (conv, part, turn, digest, role, text), a conversation's audit first, to the rows of its repair."""
    import pyarrow as pa

    current, audit, at, state, position = None, "", 0, 0, 0

    def inserted():
        nonlocal at, state, position
        while at < len(audit) and audit[at] == "I":
            initial = "a" if state == 2 else "u"
            yield (current, position, "I", ROLES[initial], "")
            at, state, position = at + 1, STATES[state][initial], position + 1

    schema = None
    for batch in batches:
        schema, out = [batch.column(0).type, pa.int64(), pa.string(), pa.string(), pa.string()], []
        for conv, part, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5)), strict=True):
            if part == 0:
                out += inserted()  # what follows the last row of the conversation before
                current, audit, at, state, position = conv, text, 0, 0, 0
                continue
            out += inserted()
            edit, at = audit[at], at + 1
            if edit != "D":
                initial = role[:1] if edit == "K" else "a" if state == 2 else "u"
                out.append((conv, position, edit, role if edit == "K" else ROLES[initial], text))
                state, position = STATES[state][initial], position + 1
        yield _rows(out, schema, TURN_NAMES)
    if schema is not None:
        yield _rows(list(inserted()), schema, TURN_NAMES)


TURN_NAMES = ("conv", "position", "edit", "role", "text")


def _rows(out: list, types: list, names: tuple):
    import pyarrow as pa

    columns = list(zip(*out, strict=True)) if out else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=list(names))


def line_digests(turns: DataFrame) -> DataFrame:
    """conv and the sha256 (hex) of its ``role:text`` lines, joined by line ends, from ``Repair.turns``.

    Rows of a conversation must stand together and in order within a partition, as ``turns`` gives them. They are
    streamed, so a conversation of any length needs no more memory than a batch.
    """
    kind = turns.schema["conv"]

    def run(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        current, digest, types = None, None, None
        for batch in batches:
            types, out = [batch.column(0).type, pa.string()], []
            for conv, position, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if position == 0:
                    if digest is not None:
                        out.append((current, digest.hexdigest()))
                    current, digest = conv, hashlib.sha256()
                digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            yield _rows(out, types, ("conv", "sha256"))
        if digest is not None:
            yield _rows([(current, digest.hexdigest())], types, ("conv", "sha256"))

    return turns.mapInArrow(run, T.StructType([kind, T.StructField("sha256", T.StringType())]))


class Repair:
    """``report``: one row per conversation with at least one row. ``turns``: the rows of the repaired conversations."""

    def __init__(self, report: DataFrame, turns: DataFrame):
        self.report, self.turns = report, turns


def repair_conversations(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_rows: int = BLOCK_ROWS,
    fan: int = FAN,
) -> Repair:
    """Find faults and the cheapest repair of every conversation.

    Rows are taken by turn, nulls first; rows that share a turn in order of a digest of role and text, so that equal ones
    are neighbours. A null role or text is one space, an empty role cannot be kept; rows with a null conversation form one. A row's first fault
    counts: blank (white space only), duplicate (role and text stood earlier in the conversation), truncated (the last
    character that is not white space is none of ``. ! ?``).

    ``report``: conv, ``gaps`` (turn numbers missing between the least and the largest, 0 if all are null), ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` (neighbours whose roles' initials are none of su, ua, au), ``cost`` and
    ``audit``. ``turns``: conv, position from 0, edit, role, text; a conversation's rows stand together, in order, in one
    partition. A conversation that is deleted whole has no turns. An empty table gives empty results. Other columns are
    ignored, whatever their names.
    """
    prepared = _prepared(rows, conv, turn, role, text)
    report = written(_chosen(_parsed(_coded(prepared), block_rows, fan)), "repairs")
    none = F.lit(None)
    audits = report.select(
        "conv", F.lit(0).alias("part"), none.cast("bigint").alias("turn"), none.cast("binary").alias("digest"),
        F.lit("").alias("role"), F.col("audit").alias("text"),
    )
    beside = audits.unionByName(prepared.select("conv", F.lit(1).alias("part"), "turn", "digest", "role", "text"))
    ordered = beside.repartition("conv").sortWithinPartitions("conv", "part", "turn", "digest")
    turns = T.StructType([prepared.schema["conv"], *T.StructType.fromDDL("position bigint, edit string, role string, text string").fields])
    return Repair(report, ordered.mapInArrow(_walk, turns))
