"""Operator 11 against brute force."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from matchday.llm import op11_repair as R
from matchday.llm import queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
SPACES = " \t\n\x0b\x0c\r"


def _damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        got = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        got += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def _faults(rows):
    """(blank or duplicate, truncated) and the counts."""
    marks, seen, count = [], set(), [0, 0, 0]
    for _, role, text in rows:
        solid = text.strip(SPACES)
        blank, dup = not solid, bool(solid) and (role, text) in seen
        cut = bool(solid) and not dup and solid[-1] not in ".!?"
        seen.add((role, text))
        count = [count[0] + blank, count[1] + dup, count[2] + cut]
        marks.append((blank or dup, cut))
    return marks, count


def _all_edits(rows, marks):
    """Every edit sequence with up to two inserts in a gap: (cost, letters, repaired)."""
    options = []
    for (_, role, text), (gone, cut) in zip(rows, marks, strict=True):
        row = [(4, "D", None)]
        if not gone:
            row += [(3 * cut, "K", (role, text))] + [(3 + 3 * cut, "R", (r, text)) for r in ("user", "assistant")]
        options.append(row)
    inserts = [list(itertools.product(("user", "assistant"), repeat=k)) for k in range(3)]
    gaps = [g for some in inserts for g in some]
    for gap in itertools.product(gaps, repeat=len(rows) + 1):
        for pick in itertools.product(*options):
            cost, letters, out = 0, "", []
            for i, g in enumerate(gap):
                cost, letters, out = cost + 3 * len(g), letters + "I" * len(g), out + [(r, "") for r in g]
                if i < len(rows):
                    c, letter, row = pick[i]
                    cost, letters, out = cost + c, letters + letter, out + [row] * (row is not None)
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)) and all(r for r, _ in out):
                yield cost, letters, out


def _cheapest(rows, marks):
    """The best of all edits from the right: suffixes compare without their beginning."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 2:
            for r in "ua":
                if (state, r) in step:
                    c, a, out = best(i, step[state, r], inserts + 1)
                    found.append((c + 3, "I" + a, ((name[r], ""),) + out))
        if i < len(rows):
            (_, role, text), (gone, cut) = rows[i], marks[i]
            c, a, out = best(i + 1, state, 0)
            found.append((c + 4, "D" + a, out))
            if not gone:
                for r, price, letter, new in [(role[:1], 0, "K", role), ("u", 3, "R", "user"), ("a", 3, "R", "assistant")]:
                    if (state, r) in step:
                        c, a, out = best(i + 1, step[state, r], 0)
                        found.append((c + price + 3 * cut, letter + a, ((new, text),) + out))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    return best(0, "", 0)


def _want(by_conv):
    out = []
    for conv, rows in by_conv.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        marks, count = _faults(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, fixed = _cheapest(rows, marks)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, *count, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def _run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted((tuple(r) for r in R.repair(R.damaged(df)).collect()), key=repr)


def test_cheapest_of_all_edits():
    """The stream and the test's own recursion against every possible edit."""
    rng = random.Random(4)
    for _ in range(150):
        roles = [rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]) for _ in range(rng.randrange(4))]
        rows = [(i, r, rng.choice(["a.", "b.", "cut", " ", "c!"])) for i, r in enumerate(roles)]
        marks, _ = _faults(rows)
        least = min((c, a) for c, a, _ in _all_edits(rows, marks))
        assert _cheapest(rows, marks)[:2] == least
        c, seen = R.Conversation(), set()
        for turn, role, text in rows:
            c.add(turn, role, text, (role, text) in seen)
            seen.add((role, text))
        assert c.result()[5:7] == least


def test_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op11_conversation_repair"](spark, SMALL).collect()), key=repr)
    assert got == _want(_damage(rows))


def test_random_conversations(spark):
    rng = random.Random(11)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "User", "tool", "", None])
            text = rng.choice(["one.", "two!", "three", "", " \n", "é?", "x\ty ", None, f"own {conv} {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn // 2, None, 2 * turn]), role, text))
    rows += rows[::7] + [(None, 1, "user", "a."), (None, None, "assistant", "b."), (-5, 3, "user", "z" * 300_000)]
    assert _run(spark, rows) == _want(_damage(rows))


def test_long_conversation(spark):
    """Digits that all states share leave the numbers; many repeated texts."""
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["yes.", "no", f"t{t}."])) for t in range(250)]
    assert _run(spark, rows) == _want(_damage(rows))


def test_numbers_stay_small():
    c = R.Conversation()
    for t in range(5_000):
        c.add(t, "user" if t % 3 else "assistant", f"{t}." if t % 5 else "cut", False)
    assert c.width <= 4 * R._SLOT * R._SETTLE
    assert len(c.result()[6]) >= 5_000


def test_nothing_left(spark):
    gone = next(t for t in range(10_000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert _run(spark, [(7, gone, "user", "x.")]) == [(7, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    assert _run(spark, []) == []


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], SCHEMA)
    more = df.selectExpr("*", "1 as seen", "2 as copy", "'q' as _role", "true as dropped", "3 as fate")
    assert R.repair(R.damaged(df)).collect() == R.repair(R.damaged(more)).collect()


@pytest.mark.parametrize("roles,letters", [("sua", "KKK"), ("ua", "KK"), ("su", "KKI"), ("s", "D"), ("aua", "DKK"), ("uua", "DKK")])
def test_examples(roles, letters):
    name = {"s": "system", "u": "user", "a": "assistant"}
    c = R.Conversation()
    for i, r in enumerate(roles):
        c.add(i, name[r], f"{i}.", False)
    marks, rows = [(False, False)] * len(roles), [(i, name[r], f"{i}.") for i, r in enumerate(roles)]
    assert c.result()[5:7] == min((x, a) for x, a, _ in _all_edits(rows, marks))
    assert c.result()[6] == letters or c.result()[5:7] != (0, letters)
