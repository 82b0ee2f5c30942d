"""Conversation repair against every sequence of edits, and against a plain
programme on whole strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

pytest.importorskip("plainweave.llm")

from plainweave.llm import conversations as C  # noqa: E402
from plainweave.llm import queries  # noqa: E402

SPACE = " \t\n\v\f\r"
GOOD = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Of rows (turn, role, text) in order: blank, duplicate, truncated or none."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_repair(rows):
    """Cheapest (cost, audit, turns) over all edits with at most two insertions in a place."""
    found = faults(rows)
    inserts = [()] + [(x,) for x in "ua"] + [(x, y) for x in "ua" for y in "ua"]
    options = []
    for (_, role, text), fault in zip(rows, found):
        own = [(3, "D", ())]
        if fault not in ("blank", "duplicate"):
            late = fault == "truncated"
            own += [(late, "K", ((role, text),))] + [(2 + late, "R", ((name, text),)) for name in ("user", "assistant")]
        options.append(own)
    best = None
    names = {"u": "user", "a": "assistant"}
    for edits in itertools.product(*options):
        for placed in itertools.product(inserts, repeat=len(rows) + 1):
            turns, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                turns += [(names[x], "") for x in placed[k]]
                audit += "I" * len(placed[k])
                cost += 2 * len(placed[k])
                if k < len(rows):
                    cost += edits[k][0]
                    audit += edits[k][1]
                    turns += edits[k][2]
            if best is not None and (cost, audit) > best[:2]:
                continue
            if all(r for r, _ in turns) and GOOD.fullmatch("".join(r[0] for r, _ in turns)):
                if best is None or (cost, audit) < best[:2]:
                    best = (cost, audit, turns)
    return best


def plain_repair(rows):
    """A programme on whole strings; one inserted turn is a step of its own."""
    grammar = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def closed(front):
        for _ in range(3):
            for state, (cost, audit, turns) in list(front.items()):
                for x in "ua":
                    to = grammar.get((state, x))
                    if to:
                        new = (cost + 2, audit + "I", turns + ((names[x], ""),))
                        front[to] = min(front.get(to, new), new)
        return front

    front = {"0": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults(rows)):
        out = {}

        def offer(state, new, out=out):
            out[state] = min(out.get(state, new), new)

        for state, (cost, audit, turns) in front.items():
            offer(state, (cost + 3, audit + "D", turns))
        if fault not in ("blank", "duplicate"):
            late = fault == "truncated"
            for state, (cost, audit, turns) in closed(dict(front)).items():
                to = grammar.get((state, role[:1]))
                if to:
                    offer(to, (cost + late, audit + "K", turns + ((role, text),)))
                for x in "ua":
                    to = grammar.get((state, x))
                    if to:
                        offer(to, (cost + late + 2, audit + "R", turns + ((names[x], text),)))
        front = out
    front = closed(front)
    return min(front[s] for s in ("0", "a") if s in front)


def damaged(rows):
    """Rows (conv, turn, role, text) after damage, by conversation and in order."""
    out = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            out[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rs in out.items()}


def expected(rows, repair=plain_repair):
    cost, audit, turns = repair(rows)
    found = faults(rows)
    known = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    text = "\n".join(f"{r}:{t}" for r, t in turns)
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(),
    }


SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [
    (None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None), (1, None, "user", "x"), (1, None, "assistant", "y."),
    (2, 0, "", "empty role."), (2, 1, "user", "é…"), (2, 2, "assistant", "fine! \n\t"), (3, 5, "system", "only."), (4, 0, "User", "odd case."),
    (4, 1, "assistant", "then."), (5, -3, "user", "low."), (5, 9, "assistant", "high."), (6, 1, "user", "q" * 100_000 + "."),
    (6, 2, "assistant", ("word " * 30_000) + "?"), (7, 1, "user", "same."), (7, 1, "user", "same."), (7, 1, "user", "same."), (7, 2, "user", "same."),
    (8, 1, "s", "short names."), (8, 2, "u", "ok."), (8, 3, "a", "ok."), (9, 1, "assistant", "starts wrong."), (9, 2, "user", "and ends."),
    (10, 1, "tool", "x."), (10, 2, "tool", "x."), (11, 1, "user", None), (11, 2, None, "unnamed."),
]


def noisy(seed, convs, most):
    draw = random.Random(seed)
    rows = []
    for conv in range(100, 100 + convs):
        turns = sorted(draw.sample(range(2 * most), draw.randint(1, most)))
        for turn in turns:
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            rows.append((conv, turn, role, draw.choice(["yes.", "no", "why?", "", " \n", "so be it."]) + draw.choice(["", f" {turn}", f"{turn}!"])))
    return rows


def check(got, rows):
    cut = damaged(rows)
    assert len(got) == len(cut)
    for r in got:
        assert r.asDict() == {"conv_id": r["conv_id"], **expected(cut[r["conv_id"]])}


def test_plain_programme_is_right():
    """Against every sequence of edits."""
    draw = random.Random(5)
    for _ in range(40):
        rows = [
            (k, draw.choice(["user", "assistant", "system", "tool"]), draw.choice(["yes.", "no", " ", "why?"]) + draw.choice(["", f"{k}."]))
            for k in range(draw.randint(0, 3))
        ]
        assert plain_repair(rows)[:2] == every_repair(rows)[:2]
        assert list(plain_repair(rows)[2]) == every_repair(rows)[2]


def test_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(queries.op12_conversation_repair(spark, sf).collect(), rows)


@pytest.mark.parametrize(("piece_rows", "range_rows"), [(C.PIECE_ROWS, C.RANGE_ROWS), (3, 40), (1, 25)])
def test_odd_and_noisy(spark, piece_rows, range_rows):
    rows = ODD + noisy(1, 60, 12) + noisy(2, 1, 400)[:0] + [(1000, t, r, x) for _, t, r, x in noisy(3, 1, 300)]
    given = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made = C.Repair(C.damage(given), given, piece_rows=piece_rows, range_rows=range_rows)
    check(made.digests().collect(), rows)
    texts = {}
    for r in made.turns().orderBy("conv_id", "place").collect():
        texts.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, own in damaged(rows).items():
        assert texts.get(conv, []) == list(plain_repair(own)[2])


def test_lost_conversations_and_empty(spark):
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    given = spark.createDataFrame([(lost, 0, "user", "gone.")], SCHEMA)
    (row,) = C.Repair(C.damage(given), given).digests().collect()
    assert row.asDict() == {
        "conv_id": lost, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
        "repaired_sha256": hashlib.sha256(b"").hexdigest(),
    }
    assert C.Repair(given.limit(0)).digests().count() == 0 and C.Repair(given.limit(0)).turns().count() == 0


def test_clashing_columns(spark):
    names = ["conv", "audit", "kind", "copies", "place", "head", "g", "h", "own", "first", "n"]
    frame = spark.createDataFrame(
        [("a", 1, "user", "hello.", *range(11)), ("a", 2, "assistant", "yes.", *range(11))],
        "id string, turn int, role string, body string, " + ", ".join(f"{n} int" for n in names),
    )
    (row,) = C.Repair(frame, conv_col="id", text_col="body").digests().collect()
    assert (row["id"], row["cost"], row["audit"]) == ("a", 0, "KK")


def test_equal_hashes_are_verified(monkeypatch):
    """With a hash that tells nothing apart, only verification is left."""
    monkeypatch.setattr(C, "PRIME", 1)
    for seed in range(30):
        rows = [r[1:] for r in noisy(seed, 1, 14)]
        piece, seen = C.Piece([C.START]), set()
        for (turn, role, text), fault in zip(rows, faults(rows)):
            piece.add(turn, role[:1], 1, fault == "blank", (role, text) in seen, fault == "truncated")
            seen.add((role, text))
        made = piece.finished(0)
        assert (made["cost"], made["audit"]) == plain_repair(rows)[:2]


def test_long_ties():
    """A thousand rows that any of several equally cheap edits could serve."""
    piece = C.Piece([C.START])
    for k in range(1000):
        piece.add(k, "t", 1, False, False, False)
    rows = [(k, "tool", f"{k}.") for k in range(1000)]
    assert piece.finished(0)["audit"] == plain_repair(rows)[1]
