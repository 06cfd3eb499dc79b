import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from clickloom.llm import repair
from clickloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")
NAMES = ("user", "assistant")


def slow_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        found = WORD.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "" if found[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def slow_edits(rows, faults):
    """Least (cost, letters) and its roles and texts, from the end to the front."""
    @lru_cache(None)
    def best(i, place, inserts):
        found = [(0, "", ())] if i == len(rows) and place in ("", "ua") else []
        follow = {"": "su", "s": "u", "u": "a", "ua": "u"}[place]
        step = lambda c: {"s": "s", "u": "u", "a": "ua"}[c]
        given = follow[-1]
        name = NAMES["ua".index(given)]
        if inserts < 3:
            found.append(put(2, "I", (name, ""), best(i, step(given), inserts + 1)))
        if i < len(rows):
            _, role, text = rows[i]
            found.append(put(3, "D", None, best(i + 1, place, 0)))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                found.append(put(2 + more, "R", (name, text), best(i + 1, step(given), 0)))
                if role and role[0] in follow:
                    found.append(put(more, "K", (role, text), best(i + 1, step(role[0]), 0)))
        return min((f for f in found if f), key=lambda f: f[:2], default=None)

    def put(cost, letter, row, rest):
        return rest and (cost + rest[0], letter + rest[1], ((row,) if row else ()) + rest[2])

    for i in range(len(rows), -1, -1):      # from the end, so that the recursion stays flat
        for inserts in (3, 2, 1, 0):
            for place in ("", "s", "u", "ua"):
                best(i, place, inserts)
    return best(0, "", 0)


def exhaustive(rows, faults):
    """The same by trying every string of edits with up to two rows put in at each place."""
    found = []
    for letters in itertools.product("KRD", repeat=len(rows)):
        for puts in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * p + c for p, c in zip(puts, [*letters, ""]))
            if len(audit) > len(rows) + 3:
                continue
            cost, place, i, ok = 0, "", 0, True
            for c in audit:
                given = "a" if place.endswith("u") else "u"
                if c == "I":
                    cost, place = cost + 2, place + given
                    continue
                _, role, _ = rows[i]
                if c == "D":
                    cost += 3
                else:
                    ok &= faults[i] not in ("blank", "duplicate")
                    cost += (faults[i] == "truncated") + 2 * (c == "R")
                    place += given if c == "R" else role[:1] or "?"
                i += 1
            if ok and PATTERN.fullmatch(place):
                found.append((cost, audit))
    return min(found)


def slow_digest(conv_id, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = slow_faults(rows)
    cost, audit, kept = slow_edits(tuple(rows), tuple(faults))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


def slow_structure(rows):
    by_id = {}
    for conv, turn, role, text in rows:
        mine = by_id.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        mine += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return sorted(str(slow_digest(c, r)) for c, r in by_id.items())


def random_rows(rng, n, roles=("user", "assistant", "system", "tool", "")):
    texts = ["Yes.", "No!", "cut off", "", " \t\v", "What? ", "More. \n", "x"]
    return [(t, rng.choice(roles), rng.choice(texts) + (str(t) + "." if rng.random() < 0.7 else "")) for t in range(n)]


def audit_of(rows):
    talk = repair.Conversation(1)
    edits, faults = [], slow_faults(rows)
    for row, fault in zip(rows, faults):
        edits += talk.read(*row, fault or None)
    edits += talk.finish()
    kept = tuple((e[5], e[6]) for e in edits if e[5] is not None)
    return sum(e[7] for e in edits), "".join(e[2] for e in edits), kept


def test_every_string_of_edits_is_tried():
    rng = random.Random(1)
    for _ in range(150):
        rows = random_rows(rng, rng.randrange(5))
        assert audit_of(rows)[:2] == exhaustive(rows, slow_faults(rows)), rows


@pytest.mark.parametrize("window", [8, 96])
def test_long_conversations_and_narrow_windows(window, monkeypatch):
    monkeypatch.setattr(repair, "WINDOW", window)
    rng = random.Random(2)
    for n in [*range(30), 80, 150, 250]:
        rows = random_rows(rng, n, rng.choice([("user", "assistant"), ("user",), ("system", "tool"), ("user", "assistant", "system", "tool")]))
        assert audit_of(rows) == slow_edits(tuple(rows), tuple(slow_faults(rows))), rows


def test_paths_that_never_agree_make_room():
    """As many letters wait as needed: with nothing but one role the paths differ from the first row on."""
    for rows in ([(t, "tool", f"{t}.") for t in range(300)], [(t, "tool", "cut" + str(t)) for t in range(300)]):
        assert audit_of(rows) == slow_edits(tuple(rows), tuple(slow_faults(rows)))


def check(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(str(tuple(r)) for r in repair.structure(df).collect()) == slow_structure(rows)


def test_whole_table_equals_brute_force(spark):
    check(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    got = QUERIES["op12_repair"](spark, FOLDER)
    assert got.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)


def test_nulls_ties_and_clashing_columns(spark):
    rng, rows = random.Random(4), []
    for conv in [None, *range(40)]:
        for _ in range(rng.randrange(1, 12)):
            turn = rng.choice([None, *range(8)])
            role = rng.choice([None, "user", "assistant", "system"])
            rows.append((conv, turn, role, rng.choice([None, "", "A.", "B", "C!", "été ?", f"{rng.random()}."])))
    df = frame(spark, rows + rows[:20]).selectExpr("*", "1 AS fault", "2 AS _h", "3 AS edit", "4 AS cost", "5 AS _k")
    check(df)


def test_empty_table_and_dropped_conversations(spark):
    assert repair.structure(frame(spark, [])).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.structure(frame(spark, [(gone, 0, "user", "Hello.")])).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_texts_and_conversations(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "word " * (40_000 if t == 5 else 3) + ".") for t in range(2_000)]
    check(frame(spark, rows))
