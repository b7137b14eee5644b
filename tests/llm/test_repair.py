"""op11: damage and repair of conversations against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from stepwise.llm import repair as rp
from stepwise.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        out.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(initials, faults):
    """Every edit string of bounded length, the plain way: (cost, audit) least."""
    n, best = len(initials), None
    for inserts in range(4):
        for places in set(itertools.combinations_with_replacement(range(n + 1), inserts)):
            for letters in itertools.product("KRD", repeat=n):
                if any(f in (1, 2) and x != "D" for f, x in zip(faults, letters)):
                    continue
                audit = "".join("I" * places.count(k) + (letters[k] if k < n else "") for k in range(n + 1))
                kept = [x for x in audit if x != "D"]
                want = ("s" if len(kept) % 2 else "") + "ua" * (len(kept) // 2)
                if kept and len(kept) < 2:
                    continue
                at, fits, cost, k = 0, True, 0, 0
                for x in audit:
                    if x == "I":
                        fits &= want[at] in "ua"
                        at, cost = at + 1, cost + 5
                        continue
                    if x == "K":
                        fits &= want[at] == initials[k]
                    if x == "R":
                        fits &= want[at] in "ua"
                    cost += {"K": 0, "R": 1, "D": 2}[x] + (5 if faults[k] == 3 and x != "D" else 0)
                    at, k = at + (x != "D"), k + 1
                if fits:
                    best = min(best or (cost, audit), (cost, audit))
    return best


def suffixes(initials, faults):
    """The same by recursion from the end, for longer conversations."""
    n, best = len(initials), {}
    for k in range(n, -1, -1):
        here = {0: (0, ""), 3: (0, "")} if k == n else {}

        def offer(state, new):
            if new and (state not in here or new < here[state]):
                here[state] = new

        for state in range(4) if k < n else ():
            after = best[k + 1]
            plus = lambda to, cost, letter: (after[to][0] + cost, letter + after[to][1]) if to in after else None  # noqa: B023, E731
            offer(state, plus(state, 2, "D"))
            if faults[k] in (0, 3):
                extra = 5 * (faults[k] == 3)
                for initial, to in rp.NEXT[state].items():
                    if initials[k] == initial:
                        offer(state, plus(to, extra, "K"))
                    if initial in "ua":
                        offer(state, plus(to, extra + 1, "R"))
        for _ in range(4):
            for state in range(4):
                for initial, to in rp.NEXT[state].items():
                    if initial in "ua" and to in here:
                        offer(state, (here[to][0] + 5, "I" + here[to][1]))
        best[k] = here
    return best[0][0]


def expected(conversations):
    out = []
    for conv, given in conversations.items():
        rows = []
        for turn, role, text in given:
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            rows += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        key = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
        faults = faults_of([r[1:] for r in rows])
        initials = [r[1][:1] for r in rows]
        turns = {r[0] for r in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials))
        cost, audit = suffixes(initials, faults)
        n = len(audit) - audit.count("D")
        want = ["system"] * (n % 2) + ["user", "assistant"] * (n // 2)
        texts, k = [], 0
        for x in audit:
            if x == "I":
                texts.append(f"{want[len(texts)]}:")
                continue
            if x != "D":
                texts.append(f"{rows[k][1] if x == 'K' else want[len(texts)]}:{rows[k][2]}")
            k += 1
        out.append((conv, gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, conversations, partitions=3):
    rows = [(conv, *r) for conv, given in conversations.items() for r in given]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rp.repair(rp.damaged(frame.selectExpr("*", "'x' AS key", "'y' AS audit", "1 AS kind"))).select(*COLUMNS).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return sorted(map(tuple, found), key=repr)


def invented(seed, count, longest, start=0):
    rng, out = random.Random(seed), {}
    for conv in range(start, start + count):
        out[conv] = [
            (None if rng.random() < 0.05 else turn + (rng.random() < 0.1), rng.choice(["user", "assistant", "user", "assistant", "system", "unknown", "tool", "", None]), rng.choice(["Yes.", "No!", "well", " ", "", None, "ünd?\n", f"t{turn}."]))
            for turn in range(rng.randrange(1, longest))
        ]
    return out


def test_programme_finds_the_cheapest_and_first_edits():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randrange(0, 5)
        initials, faults = [rng.choice("suax") for _ in range(n)], [rng.choice([0, 0, 0, 1, 2, 3, 3]) for _ in range(n)]
        programme = rp.Programme()
        for initial, fault in zip(initials, faults, strict=True):
            programme.row(initial, fault)
        assert rp._best(programme.paths()) == cheapest(initials, faults) == suffixes(initials, faults)


@pytest.mark.parametrize("settle", [1, 7, 10_000])
def test_long_programmes_settle_and_join(monkeypatch, settle):
    monkeypatch.setattr(rp, "SETTLE", settle)
    rng = random.Random(settle)
    initials, faults = [rng.choice("uuaasx") for _ in range(300)], [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(300)]
    paths = [[0, ""], None, None, None]
    for a, b in ((0, 100), (100, 101), (101, 300)):
        parts = []
        for state in range(4):
            programme = rp.Programme(state)
            for k in range(a, b):
                programme.row(initials[k], faults[k])
            parts.append([x and list(x) for x in programme.paths()])
        paths = rp.joined(paths, parts)
    assert rp._best(paths) == suffixes(initials, faults)


def test_equal_hashes_of_unequal_strings_are_told_apart(monkeypatch):
    monkeypatch.setattr(rp, "_MASK", 1)  # every hash collides
    rng = random.Random(1)
    for _ in range(100):
        strings = ["".join(rng.choice("DIKR") for _ in range(rng.randrange(1, 20))) for _ in range(2)]
        same = next((k for k, (x, y) in enumerate(zip(*strings)) if x != y), min(map(len, strings)))
        assert rp.common(*_one_root(strings)) == same


def _one_root(strings):
    root, out = rp.Edit("", None), []
    for s in strings:
        at = root
        for letter in s:
            at = rp.Edit(letter, at)
        out.append(at)
    return out


def test_repair_equals_plain_python(spark):
    conversations = invented(3, 120, 9) | {None: [(0, "user", "a."), (None, None, None)], -5: [(0, "user", "x" * 300_000 + ".")], 999: [(k, "user", "Same.") for k in range(400)]}
    conversations[1000] = [(3, "user", "Hi."), (3, "user", "Hi."), (3, "assistant", "Ho."), (9, "assistant", "Ha!")]
    assert run(spark, conversations, 7) == expected(conversations)


def test_one_conversation_over_many_partitions(spark):
    conversations = {7: invented(9, 1, 2)[0] + [(k, random.Random(k).choice(["user", "assistant", "system"]), random.Random(k).choice([f"{k}.", "no", "", "Yes."])) for k in range(3000)], 8: [(0, "user", "a.")]}
    assert run(spark, conversations, 9) == expected(conversations)


def test_empty_table_and_conversation_without_rows(spark):
    assert run(spark, {}) == []
    conv = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert run(spark, {conv: [(0, "user", "Gone.")]}) == [(conv, 0, 0, 0, 0, 0, 0, "", empty)]


def test_messages_come_in_order(spark):
    rows = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "assistant", "A.")], "conv_id long, turn long, role string, text string")
    got = rp.repaired(rows, rp.edits(rows)).collect()
    assert [tuple(r) for r in got] == [(1, 0, "user", "S.", "R"), (1, 1, "assistant", "A.", "K")]


def test_query_on_the_tables(spark, sf):
    conversations = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        conversations.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    got = QUERIES["op11_conversation_repair"](spark, sf).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == expected(conversations)
