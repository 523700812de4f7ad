"""Conversation repair against direct Python: every edit string of short conversations, string costs of long ones."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from designlab.llm import conversations as cv
from designlab.llm import registry

from ..conftest import SF_SMALL

WELL_FORMED = re.compile(r"(s?(ua)+)?")
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def rows_of(conv):
    """(role, text, fault) in order; conv has (turn, role, text)."""
    out, seen = [], set()
    for _, role, text in conv:
        last = SPACE.findall(text)
        fault = "blank" if not last else "dup" if (role, text) in seen else "cut" if last[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def play(edits, rows):
    """(cost, repaired rows) of an edit string, None where it is not allowed or gives no well-formed order."""
    out, cost, at = [], 0, 0
    for e in edits:
        follows = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if e == "I":
            out.append((follows, ""))
            cost += 3
            continue
        role, text, fault = rows[at]
        at += 1
        if e == "D":
            cost += 4
            continue
        if fault in ("blank", "dup"):
            return None
        cost += (3 if e == "R" else 0) + (3 if fault == "cut" else 0)
        out.append((role if e == "K" else follows, text))
    initials = "".join(r[:1] or "-" for r, _ in out)
    return (cost, out) if WELL_FORMED.fullmatch(initials) else None


def cheapest_of_all(rows):
    best = None
    gaps = ["", "I", "II"]
    letters = [[g + e for g in gaps for e in ("D" if f in ("blank", "dup") else "DKR")] for _, _, f in rows]
    for parts in itertools.product(*letters, gaps):
        edits = "".join(parts)
        got = play(edits, rows)
        if got and (best is None or (got[0], edits) < best[:2]):
            best = got[0], edits, got[1]
    return best


def cheapest_by_strings(rows):
    """The same by whole strings: the least (cost, string) per place after each row."""
    places = {"": (0, "")}

    def inserted(places):
        out = dict(places)
        for _ in range(3):
            for p, (c, s) in list(out.items()):
                to = "a" if p == "u" else "u"
                out[to] = min(out.get(to, (1 << 60, "")), (c + 3, s + "I"))
        return out

    for role, _, fault in rows:
        new = {}
        for p, (c, s) in inserted(places).items():
            options = [(p, 4, "D")]
            if fault not in ("blank", "dup"):
                extra = 3 if fault == "cut" else 0
                options.append(("a" if p == "u" else "u", 3 + extra, "R"))
                if role[:1] == ("a" if p == "u" else "u") or (role[:1] == "s" and p == ""):
                    options.append((role[:1], extra, "K"))
            for to, price, e in options:
                new[to] = min(new.get(to, (1 << 60, "")), (c + price, s + e))
        places = new
    cost, edits = min(v for p, v in inserted(places).items() if p in ("", "a"))
    return cost, edits, play(edits, rows)[1]


def direct(conv, cheapest):
    rows = rows_of(conv)
    initials = [r[:1] for r, _, _ in rows]
    turns = {t for t, _, _ in conv if t is not None}
    cost, audit, out = cheapest(rows)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f == x for _, _, f in rows) for x in ("blank", "dup", "cut")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


ROLES = ["user", "assistant", "system", "tool", "", "user", "assistant"]
TEXTS = ["Yes.", "no", " \t", "", "What? ", "Go!\n", "cut off", "x.", "é。", "Fine. \x85"]


def random_conversation(rng, n):
    return sorted(((rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def engine(conv):
    now = cv.Conversation(1)
    for (turn, role, text), (_, _, fault) in zip(conv, rows_of(conv), strict=True):
        now.add(turn, role, text, {"": cv.SOUND, "blank": cv.BLANK, "dup": cv.DUPLICATE, "cut": cv.CUT}[fault])
    return tuple(cv._summary(now.end()).values())[1:]


def test_every_edit_string_of_short_conversations():
    rng = random.Random(1)
    for i in range(150):
        conv = random_conversation(rng, i % 5)
        assert engine(conv) == direct(conv, cheapest_of_all), conv


def test_long_conversations_by_strings():
    rng = random.Random(2)
    for i in range(300):
        conv = random_conversation(rng, rng.randrange(40))
        assert engine(conv) == direct(conv, cheapest_by_strings), conv
    assert cv.step.cache_info().currsize < 1500


SCHEMA = "conv_id long, turn int, role string, text string, f int, part string, Copy int, fault string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


def edge_rows():
    rng = random.Random(3)
    rows = [(c, *r) for c in range(60) for r in random_conversation(rng, rng.randrange(30))]
    rows += [(None, 1, "user", "Hi."), (None, 0, "system", "S."), (100, None, None, None), (100, None, None, None),
             (101, 1, "user", "x" * 2_000_000 + "."), (101, 2, "assistant", "ok."), (102, 7, "user", None), (103, 1, None, "a.")]
    rows += [(200, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(400)]
    return rows


def grouped(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, x in out.items()}


@pytest.mark.parametrize("held", [(cv.HELD_ROWS, cv.HELD_BYTES), (4, 1 << 20), (1, 1)])
def test_summary_and_repair_on_edges(spark, held):
    rows = edge_rows()
    want = {c: direct(x, cheapest_by_strings) for c, x in grouped(rows).items()}
    got = {r["conv_id"]: tuple(r)[1:] for r in cv.summary(frame(spark, rows), held).collect()}
    assert got == want
    edits = {}
    for r in cv.repair(frame(spark, rows), held).orderBy("conv_id", "position").collect():
        edits.setdefault(r["conv_id"], []).append(r)
    for c, x in edits.items():
        assert [r["position"] for r in x] == list(range(len(x)))
        assert "".join(r["edit"] for r in x) == want[c][6]
        text = "\n".join(f"{r['role']}:{r['text']}" for r in x if r["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == want[c][7]


def damaged(rows):
    out = {}
    for c, t, role, text in rows:
        conv = out.setdefault(c, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        conv += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, x in out.items()}


def check_report(report, rows):
    want = {c: direct(x, cheapest_by_strings) for c, x in damaged(rows).items()}
    got = report.collect()
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want
    return want


def test_report_on_edges(spark):
    rows = edge_rows() + [(c, 0, "user", "A.") for c in range(300, 360)]  # some are dropped whole
    want = check_report(cv.op12_report(frame(spark, rows)), rows)
    assert sum(x == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for x in want.values()) > 1
    assert cv.op12_report(frame(spark, rows).limit(0)).count() == 0


def test_report_on_the_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    check_report(registry.queries()["op12_conversation_repair"](spark, SF_SMALL), rows)
