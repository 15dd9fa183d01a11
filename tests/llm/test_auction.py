"""Conversation repair against a sequential version with a plain dynamic programme."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import auction

TURNS = "conv_id long, turn long, role string, text string, audit string, conv string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if draw == 3 else 1)
    return out


def cheapest(items):
    """items: (initial, fault); (cost, audit) by a forward programme over prefixes."""
    keep = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    due = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserts(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                new = (cost + 2, audit + "I")
                if due[state] not in best or new < best[due[state]]:
                    best[due[state]] = new
        return best

    best = inserts({"": (0, "")})
    for initial, fault in items:
        after = {}

        def offer(state, cost, audit):
            if state not in after or (cost, audit) < after[state]:
                after[state] = (cost, audit)

        for state, (cost, audit) in best.items():
            offer(state, cost + 3, audit + "D")
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if (state, initial) in keep:
                    offer(keep[state, initial], cost + extra, audit + "K")
                offer(due[state], cost + 2 + extra, audit + "R")
        best = inserts(after)
    return min(best[state] for state in ("", "a") if state in best)


def brute(rows):
    groups = defaultdict(list)
    for conv, *row in damage(rows):
        groups[conv].append(row)
    out = []
    for conv in {row[0] for row in rows}:
        turns = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, items = set(), []
        for _, role, text in turns:
            bare = text.strip(SPACE)
            if not bare:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            items.append((role[:1], fault))
        known = {turn for turn, *_ in turns if turn is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(items, items[1:], strict=False))
        cost, audit = cheapest(items)
        left, state, repaired = list(turns), "", []
        names = {"u": "user", "a": "assistant"}
        for edit in audit:
            due = "a" if state == "u" else "u"
            if edit == "I":
                repaired.append(f"{names[due]}:")
                state = due
                continue
            _, role, text = left.pop(0)
            if edit == "K":
                repaired.append(f"{role}:{text}")
                state = role[0]
            elif edit == "R":
                repaired.append(f"{names[due]}:{text}")
                state = due
        assert not left
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        faults = [sum(fault == name for _, fault in items) for name in ("blank", "duplicate", "truncated")]
        out.append((str(conv), gaps, *faults, illegal, cost, audit, digest))
    return sorted(out)


def rows_of(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((str(r.conv_id), *[r[n] for n in names]) for r in frame.collect())


def data():
    draw = random.Random(11)
    rows = []
    for conv in range(150):
        for turn in range(draw.randrange(0, 9) if conv else 700):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = draw.choice(["Yes.", "no", " ", None, f"one {turn}!", f"two {turn}", "\t.\n", "Yes.\r\n", "ß?"])
            rows.append((conv, turn + draw.randrange(3) * 2, role, text))
    rows += [(200, None, "user", "a."), (200, None, "user", "a."), (200, 5, None, "b."), (200, 5, "assistant", "b.")]
    rows += [(None, 1, "user", "x."), (None, None, "assistant", "y."), (201, None, "system", None)]
    rows += [(202, t, "user" if t % 2 == 0 else "assistant", "word. " * 30000) for t in range(4)]
    rows += [(203, 7, "user", "same.")] * 300 + [(204, t, "user", "same.") for t in range(300)]
    rows += [(300 + t, 0, "user", "one turn.") for t in range(60)]  # some lose all their rows
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = data()
    turns = spark.createDataFrame([(*row, "x", "y") for row in rows], TURNS).repartition(5)
    assert rows_of(auction.report(auction.damaged(turns), turns)) == brute(rows)


def test_pieces_and_runs_are_chained(monkeypatch):
    draw = random.Random(5)
    letters = ["".join(chr(65 + draw.randrange(16)) for _ in range(draw.randrange(0, 200))) for _ in range(60)]
    names = {"-": "x"}
    for text in letters:
        items = [divmod(ord(c) - 65, 4) for c in text]
        want = cheapest([(names.get("sua-"[i], "sua-"[i]), auction._FAULTS[f]) for f, i in items])
        assert auction.repair(text) == want


def test_small_pieces(spark):
    rows = data()
    turns = auction.damaged(spark.createDataFrame([(*row, "x", "y") for row in rows], TURNS).repartition(5))
    pieces = auction._pieces(auction._lettered(auction._plain(turns)))
    joined = defaultdict(str)
    for row in sorted(pieces.collect(), key=lambda r: r.piece):
        joined[row.conv] += row.letters
    assert sum(map(len, joined.values())) == turns.count()


def test_repaired_rows_follow_the_grammar(spark):
    import re

    turns = spark.createDataFrame([(*row, "x", "y") for row in data()], TURNS)
    by = defaultdict(list)
    for row in auction.repaired(turns).collect():
        by[row.conv_id].append((row.place, row.role[:1], row.edit, row.turn, row.text))
    assert by
    for rows in by.values():
        rows.sort()
        assert [row[0] for row in rows] == list(range(len(rows)))
        assert re.fullmatch("(s?(ua)+)?", "".join(row[1] for row in rows))
        assert all(row[3] is None and row[4] == "" for row in rows if row[2] == "I")


def test_empty(spark):
    turns = spark.createDataFrame([], TURNS)
    assert auction.report(auction.damaged(turns), turns).count() == 0
    assert auction.repaired(turns).count() == 0


@pytest.mark.parametrize("text,want", [("", (0, "")), ("A", (3, "D")), ("B", (2, "KI")), ("BC", (0, "KK"))])
def test_small_cases(text, want):
    assert auction.repair(text) == want
