"""Conversation structure repair by auction shortest paths.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials: an optional system turn, then user and
assistant turns in pairs. Rows are kept (0), get the role that is due (2) or are deleted (3), and empty turns with the
role that is due are inserted (2); a row that breaks off costs 1 unless it is deleted, and blank and repeated rows
must be deleted. Edits are arcs of a lattice of nodes (row, state of the roles) with integer costs.

A shortest path is found by auction: a path grows from its origin; where the node it has reached is priced below its
cheapest arc (cost plus price of the arc's head), the price rises and the path is cut back by one node, otherwise it is
extended along that arc. Prices never exceed a distance and end equal to it at the origin, so every arc of every
shortest path is tight (price = cost + price of its head); among tight arcs that lead to the end, the trace takes the
least edit letter (D, I, K, R), which gives the least audit string.

The lattice is cut into runs of ``RUN`` rows. From the last run back, the auction is held from each of the four entry
states, with the prices of the run behind as prices of its end, so the work is linear in the rows; the traces are then
chained from the first run on.

What moves: digests of texts, not texts, are sorted into (conversation, turn) order, by ranges, so that a conversation
with a third of all rows is spread over tasks; each task packs its rows into one byte each. Equal rows of a turn are
counted before they are moved, and repetition is found by a grouped minimum. A conversation's rows are only gathered
as bytes, of which its audit has as many. Texts move once, to be written or hashed in order as they stream by;
the hash of a conversation is sequential by its definition, so one task reads its texts, one batch at a time.

Defined cases: a null role or text is one space; null turns come first; rows of one turn are ordered by role, then by
SHA-256 of the text (a repeated row directly follows); a null conv_id is a conversation of its own; turns may be
missing or repeat; roles other than s..., u..., a... cannot be kept; very long texts are hashed in pieces; columns beside the four
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch

#: Rows of a conversation that one auction covers, and that one piece of packed rows holds at most.
RUN, PIECE = 64, 65_536

#: States: nothing yet, after system, after user, after assistant. What comes next unless a system turn opens.
_NEXT, _NAMES = (2, 2, 3, 2), ("", "", "user", "assistant")
_ENDS = (0, None, None, 0)
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: A row as one letter: 4 * fault + initial.
_INITIALS, _FAULTS = "sua-", ("", "truncated", "blank", "duplicate")
_FIRST = 65


def _arcs() -> dict[str, tuple]:
    """Per letter and state: (edit, cost, rows passed, next state)."""
    table = {}
    for letter in range(16):
        fault, initial = divmod(letter, 4)
        states = []
        for state in range(4):
            arcs = [("D", 3, 1, state), ("I", 2, 0, _NEXT[state])]
            if fault < 2:
                kept = _KEPT.get((state, _INITIALS[initial]))
                if kept is not None:
                    arcs.append(("K", fault, 1, kept))
                arcs.append(("R", 2 + fault, 1, _NEXT[state]))
            states.append(tuple(arcs))
        table[chr(_FIRST + letter)] = tuple(states)
    return table


_ARCS = _arcs()


class _Run:
    """The lattice of some consecutive rows; ``ends`` prices the states behind them, None for no way on."""

    def __init__(self, letters: str, ends: tuple, last: bool):
        self.n, self.ends = len(letters), ends
        self.arcs: list[list[tuple]] = []  # (edit, cost, head), the head -1 being the end
        for i, letter in enumerate(letters):
            for arcs in _ARCS[letter]:
                self.arcs.append([(edit, cost, 4 * (i + rows) + state) for edit, cost, rows, state in arcs])
        for state in range(4):
            on = [("I", 2, 4 * self.n + _NEXT[state])] if last else []
            out = [("", ends[state], -1)] if ends[state] is not None else []
            self.arcs.append(on + out)
        self.prices = [0] * len(self.arcs) + [0]  # the last is the end, found as index -1

    def auction(self, origin: int) -> int:
        """The distance from ``origin`` to the end; prices of earlier auctions are kept."""
        prices, arcs, path = self.prices, self.arcs, [origin]
        while True:
            node = path[-1]
            least, head = min([(cost + prices[to], to) for _, cost, to in arcs[node]])
            if prices[node] < least:
                prices[node] = least
                if len(path) > 1:
                    path.pop()
            elif head < 0:
                return prices[origin]
            else:
                path.append(head)

    def traces(self) -> tuple[list[str], list[int]]:
        """Per entry state the least edits of a shortest path, and the state behind the last row."""
        prices = self.prices
        tight: list[list[tuple]] = [[] for _ in self.arcs]
        live = [False] * len(self.arcs) + [True]
        # Inserting leads from a state to the next of the same row, round a cycle of user and assistant: a state is
        # settled when those behind it are, so the four states of a row are gone over until nothing changes.
        for row in range(self.n, -1, -1):
            changed = True
            while changed:
                changed = False
                for node in range(4 * row, 4 * row + 4):
                    found = [arc for arc in self.arcs[node] if live[arc[2]] and arc[1] + prices[arc[2]] == prices[node]]
                    if len(found) > len(tight[node]):
                        tight[node], live[node], changed = found, True, True
        edits, behind = [], []
        for node in range(4):
            letters = []
            while True:
                edit, _, head = min(tight[node])
                if head < 0:
                    break
                letters.append(edit)
                node = head
            edits.append("".join(letters))
            behind.append(node - 4 * self.n)
        return edits, behind


@lru_cache(maxsize=50_000)
def _solved(letters: str, ends: tuple, last: bool) -> tuple[tuple, list[str], list[int]]:
    run = _Run(letters, ends, last)
    costs = tuple(run.auction(state) for state in range(4))
    return costs, *run.traces()


def repair(letters: str) -> tuple[int, str]:
    """Least cost and the least audit string of that cost."""
    starts = list(range(0, len(letters), RUN)) or [0]
    ends, base, runs = _ENDS, 0, []
    for start in reversed(starts):
        costs, edits, behind = _solved(letters[start : start + RUN], ends, start == starts[-1])
        runs.append((edits, behind))
        lowest = min(costs)
        base, ends = base + lowest, tuple(cost - lowest for cost in costs)
    state, audit = 0, []
    for edits, behind in reversed(runs):
        audit.append(edits[state])
        state = behind[state]
    return base + ends[0], "".join(audit)


def _plain(turns: DataFrame) -> DataFrame:
    """The four columns, nulls replaced; ``conv`` is a key without nulls."""
    conv = F.col("conv_id").cast("string")
    return turns.select(
        F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


_SPACES = " \t\n\x0b\x0c\r"
_ORDER = ["turn", "role", "digest"]  # ascending, nulls first


def _lettered(plain: DataFrame) -> DataFrame:
    """Distinct rows conv, turn, role, digest with their number n, the letter of the first and of the others."""
    rest = F.rtrim("text", F.lit(_SPACES))
    fault = F.when(rest == "", 2).when(F.substring(rest, -1, 1).isin(".", "!", "?"), 0).otherwise(1)
    same = ["conv", "role", "digest"]
    units = (
        plain.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), fault.alias("fault"))
        .groupBy("conv", "turn", "role", "digest", "fault")
        .agg(F.count("*").alias("n"))
    )
    units = scratch.keep(units, "units")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = units.where("fault < 2").groupBy(*same).agg(F.min(place).alias("first"), F.count("*").alias("k")).where("k > 1")
    initial = F.expr("if(role = '', 3, (locate(substring(role, 1, 1), 'sua') + 3) % 4)")
    later = F.coalesce(F.col("first") < place, F.lit(False)) & (F.col("fault") < 2)
    own = F.when(later, 3).otherwise(F.col("fault"))
    copies = F.when(F.col("fault") == 2, 2).otherwise(3)

    def letter(code):
        return F.char(code * 4 + initial + _FIRST)

    return units.join(again, same, "left").select(
        "conv", "turn", "role", "digest", "n", letter(own).alias("own"), letter(copies).alias("copies")
    )


def _pieces(lettered: DataFrame) -> DataFrame:
    """conv, piece (their order), letters, and the turns seen: low, high, distinct number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 32
        names = ["conv", "piece", "letters", "low", "high", "turns"]
        conv, letters, size, low, high, turns = None, [], 0, None, None, 0
        done: list[tuple] = []

        def close() -> None:
            nonlocal piece, letters, size, low, high, turns
            if conv is not None and size:
                done.append((conv, piece, "".join(letters), low, high, turns))
                piece += 1
            letters, size, low, high, turns = [], 0, None, None, 0

        def packed() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for key, turn, n, own, copies in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if key != conv or size >= PIECE:
                    close()
                    conv = key
                if turn is not None and turn != high:
                    low, high, turns = turn if low is None else low, turn, turns + 1
                letters.append(own)
                size += 1
                while n > 1:  # very many copies fill pieces of their own
                    more = min(n - 1, PIECE - size)
                    letters.append(copies * more)
                    size, n = size + more, n - more
                    if size >= PIECE and n > 1:
                        close()
                        letters.append(copies)
                        size, n = 1, n - 1
            if sum(len(row[2]) for row in done) > 1 << 20 or len(done) > 10_000:
                yield packed()
        close()
        if done:
            yield packed()

    ordered = lettered.repartitionByRange("conv", *_ORDER).sortWithinPartitions("conv", *_ORDER)
    schema = "conv string, piece long, letters string, low long, high long, turns long"
    return ordered.select("conv", "turn", "n", "own", "copies").mapInArrow(run, schema)


def judge(turns: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        legal = {"su", "ua", "au"}
        for batch in batches:
            out = []
            for conv, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                letters = "".join(p["letters"] for p in pieces)
                low = high = None
                turns = 0
                for p in pieces:
                    if p["turns"]:
                        turns += p["turns"] - (p["low"] == high)  # a turn may go on in the next piece
                        low, high = p["low"] if low is None else low, p["high"]
                count = {fault: 0 for fault in _FAULTS}
                roles = []
                for code in letters:
                    fault, initial = divmod(ord(code) - _FIRST, 4)
                    count[_FAULTS[fault]] += 1
                    roles.append(_INITIALS[initial])
                illegal = sum(a + b not in legal for a, b in zip(roles, roles[1:], strict=False))
                gaps = 0 if low is None else high - low + 1 - turns
                cost, audit = repair(letters)
                out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit))
            columns = list(zip(*out, strict=True)) or [[]] * 8
            types = [pa.string(), *[pa.int64()] * 6, pa.string()]
            names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    pieces = scratch.keep(_pieces(_lettered(_plain(turns))), "pieces")
    whole = pieces.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("piece", "letters", "low", "high", "turns"))).alias("pieces")
    )
    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return scratch.keep(whole.mapInArrow(run, schema), "judged")


def _streamed(plain: DataFrame, judged: DataFrame, start, step, close, schema: str) -> DataFrame:
    """Repaired rows conversation by conversation, in order: ``step(state, edit, turn, role, text)``.

    Each audit travels ahead of the rows of its conversation. ``close(state)`` and every step return rows to put out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = [(name, _ARROW[kind]) for name, kind in (part.split() for part in schema.split(", "))]
        out: list[tuple] = []
        state, audit, at, due, conv = None, "", 0, 0, None

        def inserted() -> None:
            nonlocal at, due
            while at < len(audit) and audit[at] == "I":
                due, at = _NEXT[due], at + 1
                out.extend(step(state, "I", None, _NAMES[due], ""))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            arrays = [pa.array(column, kind) for column, (_, kind) in zip(columns, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [name for name, _ in arrow])

        for batch in batches:
            for key, ahead, turn, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if ahead:
                    if conv is not None:
                        inserted()
                        out.extend(close(state))
                    conv, state, audit, at, due = key, start(key), text, 0, 0
                    continue
                inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    due = _KEPT[due, role[:1]]
                elif edit == "R":
                    due = _NEXT[due]
                    role = _NAMES[due]
                if edit != "D":
                    out.extend(step(state, edit, turn, role, text))
            if out:
                yield batch_of()
        if conv is not None:
            inserted()
            out.extend(close(state))
        if out:
            yield batch_of()

    ahead = judged.select(
        "conv", F.lit(True).alias("ahead"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.col("audit").alias("text"), F.lit(b"").alias("digest"),
    )
    rows = plain.withColumns({"ahead": F.lit(False), "digest": F.unhex(F.sha2("text", 256))})
    both = ahead.unionByName(rows).repartition("conv").sortWithinPartitions("conv", F.col("ahead").desc(), *_ORDER)
    return both.select("conv", "ahead", "turn", "role", "text").mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "long": pa.int64()}


def repaired(turns: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id (as text), place from 0, turn (null if inserted), role, text, edit."""
    plain = _plain(turns)

    def step(state, edit, turn, role, text):
        state[1] += 1
        return [(state[0], state[1] - 1, turn, role, text, edit)]

    schema = "conv string, place long, turn long, role string, text string, edit string"
    rows = _streamed(plain, judge(turns), lambda key: [key, 0], step, lambda state: [], schema)
    return rows.select(F.expr("if(conv = '', null, substring(conv, 2))").alias("conv_id"), "place", "turn", "role", "text", "edit")


def report(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``originals`` (by default of ``turns``) with its faults, cheapest edits and digest."""
    plain, judged = _plain(turns), judge(turns)

    def step(state, edit, turn, role, text):
        state[1].update(f"{state[2]}{role}:{text}".encode())
        state[2] = "\n"
        return []

    digests = _streamed(
        plain, judged, lambda key: [key, hashlib.sha256(), ""], step,
        lambda state: [(state[0], state[1].hexdigest())], "conv string, repaired_sha256 string",
    )
    faults = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    given = (turns if originals is None else originals).select("conv_id")
    key = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    known = given.groupBy(key.alias("conv")).agg(F.max("conv_id").alias("conv_id"))
    return known.join(judged, "conv", "left").join(digests, "conv", "left").select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in faults],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The conversations with faults put in by the CRC-32 of ``conv_id:turn``: for tests and figures."""
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    draw = F.crc32(name) % 20
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.where(draw != 0).select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")
