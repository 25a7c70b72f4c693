"""Conversations brought into the form ``(s?(ua)+)?`` of role initials by the cheapest edits.

Keep costs 0, rerole to user or assistant 1, delete 2 (required for a blank or repeated row), insert an empty user
or assistant turn 5; a truncated row that is not deleted adds 5. A search finds the cheapest edits and, among them, those
whose initials (D, I, K, R in order) are the least in ASCII. It is a depth-first branch and bound: an explicit stack of
prefixes, lower bounds of what every suffix still costs, the incumbent (cost, audit), and for each node (row, role
expected next) the best prefix that reached it, which eliminates worse ones. When the stack is empty the incumbent is proved.

Rows are sorted and numbered over the whole table, so a conversation of any length is dealt over many tasks. It is searched in
blocks of at most BLOCK rows, since what a block needs from the rows before it is one of four states. A conversation with
several blocks is put together by solving each for every pair of states and joining neighbours, FAN at a time. Only block summaries and the
audit itself meet in one row; texts stay where their block is, and the hash over a repaired conversation takes them in order as a stream.

Defined results: a null text, role or id counts as one space in hashes and comparisons, the null conv_id forms one conversation and is
returned as null, null turns come first. Rows with the same turn are ordered by role and text, equal rows follow one another and all but
the first are duplicates. A kept row needs s, u or a as the first character of its role; an empty role has none. Empty and very
long texts are rows like others; columns beyond the four are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

BLOCK = 512
#: Block summaries put together at a time.
FAN = 16
#: Results of searches that a task keeps, for rows of short conversations that look alike.
REMEMBERED = 50_000
#: A stream of repaired text is handed on in pieces of about so many characters.
PIECE = 1 << 20

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The role that may follow each state apart from a leading system row, and the state after it.
_NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_LEGAL = ("su", "ua", "au")


def _moves(row: str, state: int) -> list[tuple[str, int, int]]:
    """What may be done with ``row`` in ``state``: (edit, cost, state after), by edit.

    A row is one character: its role initial (capital if truncated), ``x`` for any other role (``X``), ``-`` if it must go.
    """
    moves = [("D", DELETE, state)]
    if row == "-":
        return moves
    role, surplus = row.lower(), TRUNCATED if row.isupper() else 0
    wanted, after = _NEXT[state]
    if role == wanted:
        moves.append(("K", surplus, after))
    elif role == "s" and state == START:
        moves.append(("K", surplus, SYSTEM))
    moves.append(("R", REROLE + surplus, after))
    return moves


def _bounds(rows: str, ends: tuple[int, ...]) -> list[list[float]]:
    """What the rows from each place on cost at least, by state; a pass from the end, insertions included."""
    bounds: list[list[float]] = []
    here = [0.0 if state in ends else math.inf for state in range(4)]
    for at in range(len(rows), -1, -1):
        if at < len(rows):
            here = [min(cost + bounds[-1][after] for _, cost, after in _moves(rows[at], state)) for state in range(4)]
        for _ in range(2):  # two insertions in a row lead back to where a further one would start
            here = [min(here[state], INSERT + here[_NEXT[state][1]]) for state in range(4)]
        bounds.append(here)
    return bounds[::-1]


def search(rows: str, start: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Cost and audit of the best edits of ``rows`` that lead from ``start`` to one of ``ends``; None if none do."""
    bounds = _bounds(rows, ends)
    incumbent: tuple[float, str] = (math.inf, "~")
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + bounds[at][state]
        if least == math.inf or (least, audit) >= incumbent:
            continue
        known = reached.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[at, state] = (cost, audit)
        if at == len(rows) and state in ends:
            incumbent = min(incumbent, (cost, audit))
        steps = [("I", INSERT, at, _NEXT[state][1])]
        if at < len(rows):
            steps += [(edit, price, at + 1, after) for edit, price, after in _moves(rows[at], state)]
        # the most promising prefix is on top, of equal ones the least audit
        steps.sort(key=lambda step: (step[1] + bounds[step[2]][step[3]], step[0]), reverse=True)
        stack += [(then, after, cost + price, audit + edit) for edit, price, then, after in steps]
    return None if incumbent[0] == math.inf else (int(incumbent[0]), incumbent[1])


def repaired(audit: str, rows: list[tuple[str, str]], state: int = START) -> tuple[list[str], int]:
    """``role:text`` of what the edits leave of (role, text) rows, and the state after them."""
    out: list[str] = []
    at = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        wanted, after = _NEXT[state]
        if edit == "K" and role[:1] == "s":
            state = SYSTEM
        else:
            state = after
        if edit != "K":
            role = "user" if wanted == "u" else "assistant"
        out.append(f"{role}:{text}")
    return out, state


# --- rows and faults -------------------------------------------------------------------
_SPACE = "\x20\x09\x0A\x0B\x0C\x0D"


def _numbered(turns: DataFrame) -> DataFrame:
    """Rows in conversation order with ``pos``, a number that grows with it."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")),
        F.monotonically_increasing_id().alias("row"),  # lets a range end among equal rows
    )
    dealt = rows.repartitionByRange(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    numbered = dealt.sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    # numbered once: bounds of ranges come from a sample
    return durable(numbered.select("conv_id", "pos", "turn", "role", "text"))


def faults(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, turn, role, text, fault`` of all rows in order; fault is ``blank``, ``duplicate``, ``truncated`` or null."""
    rows = _numbered(turns)
    # the first row of each text, added up in the map tasks first; met by its number, so no text is a hot key
    text = F.sha2(F.concat_ws(":", F.col("role"), F.col("text")), 256)
    firsts = rows.groupBy("conv_id", text.alias("hash"), F.length("role").alias("cut")).agg(F.min("pos").alias("pos"))
    marked = rows.join(firsts.select("pos", F.lit(True).alias("first")), "pos", "left")
    last = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    return marked.select("conv_id", "pos", "turn", "role", "text", fault.alias("fault"))


# --- blocks ------------------------------------------------------------------------------
#: Of a stretch of a conversation: its first block and number of rows, turns, faults and initials, the rows as ``search`` reads them,
#: and what they cost (``paths``: from state, to state, cost, audit; only for conversations with several blocks).
_BLOCK = (
    "conv_id long, block long, n_rows long, first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, "
    "illegal long, first_role string, last_role string"
)
_SOLVED = f"{_BLOCK}, rows string, cost long, audit string, sha256 string"
_PATHS = "paths array<struct<start: int, end: int, cost: long, audit: string>>"
_JOINED = f"{_BLOCK}, {_PATHS}"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in ddl.split(", "))])


_SOLVED_ARROW = _schema(_SOLVED)
_JOINED_ARROW = pa.schema([
    *_schema(_BLOCK),
    ("paths", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


class _Searches:
    """``search`` with the results of rows that were seen before."""

    def __init__(self) -> None:
        self.known: dict = {}

    def best(self, rows: str, start: int = START, ends: tuple[int, ...] = ENDS):
        key = rows, start, ends
        if key not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[key] = search(rows, start, ends)
        return self.known[key]


def _letter(role: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return "-"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


def _summary(conv_id: int | None, block: int, rows: list[tuple]) -> dict:
    """Summary of neighbouring rows (turn, role, text, fault)."""
    turns = [t for t, *_ in rows if t is not None]
    initials = [role[:1] for _, role, _, _ in rows]
    kinds = [fault for *_, fault in rows]
    return {
        "conv_id": conv_id, "block": block, "n_rows": len(rows),
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "n_turns": len(set(turns)),
        **{kind: kinds.count(kind) for kind in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "first_role": initials[0], "last_role": initials[-1],
    }


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, block and place become a summary for each block, solved as if it were the whole conversation."""
    searches = _Searches()
    held: list[tuple] = []
    at = None

    def finish() -> dict:
        rows = "".join(_letter(role, fault) for _, role, _, fault in held)
        cost, audit = searches.best(rows)
        text = "\n".join(repaired(audit, [(role, text) for _, role, text, _ in held])[0])
        return _summary(*at, held) | {"rows": rows, "cost": cost, "audit": audit, "sha256": hashlib.sha256(text.encode()).hexdigest()}

    for batch in batches:
        out = []
        for conv_id, block, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "turn", "role", "text", "fault"))):
            if at != (conv_id, block):
                if held:
                    out.append(finish())
                at, held = (conv_id, block), []
            held.append((turn, role, text, fault))
        yield _batch(out, _SOLVED_ARROW)
    if held:
        yield _batch([finish()], _SOLVED_ARROW)


def _all_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block solved from every state to every state."""
    searches = _Searches()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            found = ((start, end, searches.best(row["rows"], start, (end,))) for start in range(4) for end in range(4))
            row["paths"] = [{"start": s, "end": e, "cost": best[0], "audit": best[1]} for s, e, best in found if best]
            out.append({n: row[n] for n in _JOINED_ARROW.names})
        yield _batch(out, _JOINED_ARROW)


def _join(left: dict, right: dict) -> dict:
    """Summary of two neighbouring stretches."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for one in left["paths"]:
        for two in right["paths"]:
            if one["end"] == two["start"]:
                whole = (one["cost"] + two["cost"], one["audit"] + two["audit"])
                key = one["start"], two["end"]
                best[key] = min(best.get(key, whole), whole)
    same_turn = left["last_turn"] is not None and left["last_turn"] == right["first_turn"]
    return {
        "conv_id": left["conv_id"], "block": left["block"],
        "first_turn": right["first_turn"] if left["first_turn"] is None else left["first_turn"],
        "last_turn": left["last_turn"] if right["last_turn"] is None else right["last_turn"],
        "n_turns": left["n_turns"] + right["n_turns"] - same_turn,
        **{n: left[n] + right[n] for n in ("n_rows", "blank", "duplicate", "truncated")},
        "illegal": left["illegal"] + right["illegal"] + (left["last_role"] + right["first_role"] not in _LEGAL),
        "first_role": left["first_role"], "last_role": right["last_role"],
        "paths": [{"start": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in best.items()],
    }


def _join_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by conversation, group and block: those of one group become one, which waits for no more than its group."""
    held = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            key = row["conv_id"], row.pop("group")
            if held and held[0] == key:
                held = (key, _join(held[1], row))
            else:
                if held:
                    out.append(held[1])
                held = (key, row)
        yield _batch(out, _JOINED_ARROW)
    if held:
        yield _batch([held[1]], _JOINED_ARROW)


def _put_together(blocks: DataFrame) -> DataFrame:
    """One summary with paths for each conversation of ``blocks``, joining FAN neighbouring stretches a round.

    Places within a conversation come from block numbers, which have gaps, so each round numbers the stretches anew.
    """
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = durable(blocks.mapInArrow(_all_paths, _JOINED))
    while True:
        most = joined.groupBy("conv_id").count().agg(F.max("count")).first()[0]
        if (most or 0) <= 1:
            return joined
        # a group starts anew every FAN blocks of the range a stretch stands in, whatever the gaps
        nth = F.expr("row_number() over (partition by conv_id order by block)")
        grouped = joined.withColumn("group", F.floor((nth - 1) / FAN))
        grouped = grouped.repartition(parts, "conv_id", "group").sortWithinPartitions("conv_id", "group", "block")
        joined = durable(grouped.mapInArrow(_join_neighbours, _JOINED))


# --- repaired conversations of several blocks -----------------------------------------------
_SLICE = "conv_id long, block long, state int, audit string"
_SLICE_ARROW = _schema(_SLICE)
_TEXT = "conv_id long, block long, piece long, repaired string"
_TEXT_ARROW = _schema(_TEXT)
_HASH = "conv_id long, sha256 string"
_HASH_ARROW = _schema(_HASH)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, each with its number of rows, and their conversation's audit on the first: the audit cut into that of each block."""
    conversation, audit, at, state = object(), "", 0, START
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["conv_id"] != conversation:
                conversation, audit, at, state = row["conv_id"], row["audit"], 0, START
            begin, left = at, row["n_rows"]
            while left:
                left -= audit[at] != "I"
                at += 1
            if row["is_last"]:
                at = len(audit)
            own = audit[begin:at]
            out.append({"conv_id": conversation, "block": row["block"], "state": state, "audit": own})
            # what decides the state is the letters of the block's rows
            rows = iter(row["rows"])
            for edit in own:
                letter = "" if edit == "I" else next(rows).lower()
                if edit != "D":
                    state = SYSTEM if edit == "K" and letter == "s" else _NEXT[state][1]
        yield _batch(out, _SLICE_ARROW)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block, the one with its audit first: the repaired text of the block in pieces of about PIECE characters."""
    held: list[str] = []
    size, number, conv_id, block, edits, state = 0, 0, None, None, iter(""), START

    def lines(role: str | None, text: str | None):
        """What stands in the repaired text up to and with this row; with None, after the last one."""
        nonlocal state
        for edit in edits:
            if edit == "D":
                return
            wanted, after = _NEXT[state]
            state = SYSTEM if edit == "K" and role[:1] == "s" else after
            if edit == "K":
                yield f"{role}:{text}"
                return
            name = "user" if wanted == "u" else "assistant"
            yield f"{name}:{text if edit == 'R' else ''}"
            if edit == "R":
                return

    def piece() -> dict:
        nonlocal held, size, number
        out = {"conv_id": conv_id, "block": block, "piece": number, "repaired": "\n".join(held)}
        held, size, number = [], 0, number + 1
        return out

    def close() -> list[dict]:
        held.extend(lines(None, None))
        return [piece()] if held else []

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["pos"] == -1:
                out += close()
                conv_id, block, edits, state, number = row["conv_id"], row["block"], iter(row["audit"]), row["state"], 0
                continue
            for line in lines(row["role"], row["text"]):
                held.append(line)
                size += len(line)
                if size >= PIECE:
                    out.append(piece())
        yield _batch(out, _TEXT_ARROW)
    yield _batch(close(), _TEXT_ARROW)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order: the hash of each conversation, taken as they pass."""
    state, conversation = None, None
    for batch in batches:
        out = []
        for conv_id, text in zip(batch.column("conv_id").to_pylist(), batch.column("repaired").to_pylist()):
            if state is not None and conv_id == conversation:
                state.update(b"\n" + text.encode())
            else:
                if state is not None:
                    out.append({"conv_id": conversation, "sha256": state.hexdigest()})
                state, conversation = hashlib.sha256(text.encode()), conv_id
        yield _batch(out, _HASH_ARROW)
    if state is not None:
        yield _batch([{"conv_id": conversation, "sha256": state.hexdigest()}], _HASH_ARROW)


def _hashes(rows: DataFrame, blocks: DataFrame, whole: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the repaired text of conversations of several blocks."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    audits = whole.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "audit")
    audited = blocks.drop("audit").join(audits, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
    last = F.expr("lead(block) over (partition by conv_id order by block) IS NULL")
    ordered = audited.select("conv_id", "block", "n_rows", "rows", "audit", last.alias("is_last"))
    ordered = ordered.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "block")
    slices = ordered.mapInArrow(_cut, _SLICE)
    with_audit = slices.select("conv_id", "block", F.lit(-1).cast("long").alias("pos"), "state", "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = rows.join(whole.select(F.col("conv_id").alias("c")), F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").select(
        "conv_id", "block", "pos", F.lit(0).alias("state"), F.lit(None).cast("string").alias("audit"), "role", "text"
    )
    together = with_audit.unionByName(texts).repartition(parts, "conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    pieces = together.mapInArrow(_repair, _TEXT)
    return pieces.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "block", "piece").mapInArrow(_digest, _HASH)


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def repair(turns: DataFrame) -> DataFrame:
    """One row for each conversation of ``conv_id, turn, role, text``.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = faults(turns).withColumn("block", F.expr(f"pos div {BLOCK}"))
    ordered = rows.repartition(parts, "conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    solved = durable(ordered.mapInArrow(_solve, _SOLVED))
    several = solved.groupBy("conv_id").count().filter("count > 1").select(F.col("conv_id").alias("c"))
    blocks = durable(solved.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi"))
    once = solved.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_anti").drop("rows")
    if blocks.isEmpty():
        return _result(once)
    best = F.expr("array_min(transform(filter(paths, p -> p.start = 0 and p.end in (0, 3)), p -> struct(p.cost, p.audit)))")
    whole = _put_together(blocks).withColumn("best", best).select("*", "best.cost", "best.audit").drop("paths", "best")
    whole = durable(whole)
    hashes = _hashes(rows, blocks, whole).select(F.col("conv_id").alias("c"), "sha256")
    hashed = whole.join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return _result(once.unionByName(hashed))


def _result(found: DataFrame) -> DataFrame:
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    return found.select(
        "conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults planted by the checksum of ``conv_id:turn``, for trying the repair."""
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")
