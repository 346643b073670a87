"""Conversation repair against an exhaustive search on small conversations."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewright.llm import conversations
from tidewright.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SOME = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit) and its rows, by best-first search over whole audits."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        found = SOME.findall(text)
        faults.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    names = {"u": "user", "a": "assistant"}
    # of the initials only the end matters: none, s, u or ua
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, lines = heapq.heappop(heap)
        state = (i, initials)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return faults, cost, audit, lines
        if state in done:
            continue
        done.add(state)
        ways = [("I", 5, 0, x, names[x], "") for x in "ua"]
        if i < len(rows):
            _, _, role, text = rows[i]
            ways.append(("D", 2, 1, "", None, None))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                ways.append(("K", extra, 1, role[:1], role, text))
                ways += [("R", 1 + extra, 1, x, names[x], text) for x in "ua"]
        for edit, price, step, initial, role, text in ways:
            read = initials + initial
            if edit != "D" and (not initial or not re.fullmatch("(s?(ua)*u?)?", read)):
                continue
            heapq.heappush(heap, (cost + price, audit + edit, i + step, read if read in ("", "s") else "u" if read[-1] == "u" else "ua", lines if edit == "D" else (*lines, (edit, role, text))))
    raise AssertionError("no audit")


def expected(rows):
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r[0]].append(r)
    out = {}
    for conv, mine in by_conv.items():
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        faults, cost, audit, lines = cheapest(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        initials = [r[2][:1] for r in mine]
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit, "lines": list(lines)}
    return out


def hash_of(lines):
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " ", "\t\n", None, "end.  \n", "a. b", "Über…", "?", "twice.", "twice."]
    roles = ["system", "user", "assistant", "user", "assistant", "user", "assistant", None, "", "tool", "superuser", "User"]
    out = []
    for conv in [None, *range(150)]:
        n = rng.choice([1, 1, 2, 3, 4, 5, 6, 8, 12])
        for k in range(n):
            turn = rng.choice([None, 0, 3, 3]) if rng.random() < 0.1 else k
            good = conv is not None and conv % 3 == 0
            role = ["user", "assistant"][k % 2] if good and rng.random() < 0.8 else rng.choice(roles)
            out.append((conv, turn, role, f"Line {k} of {conv}." if good and rng.random() < 0.6 else rng.choice(texts)))
    out += [(900, k, "user", "same.") for k in range(40)] + [(901, None, "user", "x.")] * 6 + [(902, None, None, None)] * 3
    out += [(903, k, ["user", "assistant"][k % 2], f"{k} " + "long words " * 3000 + ".") for k in range(6)]
    out += [out[5], out[9]]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def check(got, want, digest):
    assert {r.conv_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        w = want[r.conv_id]
        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"):
            assert r[c] == w[c], (r, w)
        assert digest(r) == hash_of(w["lines"]), (r, w)


def test_undamaged_rows(table, rows):
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = expected(plain)
    given = conversations.clean(table)
    reports = conversations.report(given)
    sums = {r.conv_id: r.repaired_sha256 for r in conversations.digests(given, reports).collect()}
    check(reports.collect(), want, lambda r: sums[r.conv_id])
    lines = defaultdict(dict)
    for r in conversations.repaired(given, reports).collect():
        lines[r.conv_id][r.step] = (r.edit, r.role, r.text)
    for conv, w in want.items():
        assert [lines[conv][k] for k in range(len(lines[conv]))] == w["lines"]


def test_query(spark, table, rows, tmp_path):
    wide = table.withColumns({c: F.lit(1) for c in ("same", "copies", "first", "audit", "signature", "blank", "kind")})
    wide.write.parquet(f"{tmp_path}/conversations.parquet")
    want = expected(damaged(rows))
    nothing = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"audit": "", "lines": []}
    want |= {c: nothing for c in {r[0] for r in rows} - set(want)}
    assert any(w is nothing for w in want.values())
    check(QUERIES["op11_repair"](spark, str(tmp_path)).collect(), want, lambda r: r.repaired_sha256)


def test_whole_table(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(damaged(given))
    nothing = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"audit": "", "lines": []}
    want |= {c: nothing for c in {r[0] for r in given} - set(want)}
    check(QUERIES["op11_repair"](spark, SMALL).collect(), want, lambda r: r.repaired_sha256)


def test_all_signatures_of_five_letters(spark):
    """Costs and audits of every signature, whose nodes many share."""
    letters = {"x": ("user", ""), "s": ("system", "{}."), "u": ("user", "{}."), "a": ("assistant", "{}."), "o": ("tool", "{}."),
               "S": ("system", "{}"), "U": ("user", "{}"), "A": ("assistant", "{}"), "O": ("", "{}")}
    rng = random.Random(4)
    words = {"".join(rng.choice(list(letters)) for _ in range(n)) for n in (0, 1, 2, 3, 5, 5, 5, 5) for _ in range(60)}
    found = {r.signature: r for r in conversations.audits(spark.createDataFrame([(w,) for w in words], "signature string")).collect()}
    assert set(found) == words
    for w in words:
        rows = [(0, k, letters[c][0], letters[c][1].format(k)) for k, c in enumerate(w)]
        _, cost, audit, _ = cheapest(rows)
        assert (found[w].cost, found[w].audit) == (cost, audit), w


def test_empty_table_and_text_ids(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    reports = conversations.report(conversations.clean(nothing))
    assert reports.count() == 0 and conversations.digests(conversations.clean(nothing), reports).count() == 0
    named = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho."), ("b", 0, "user", "Hi")], "conv_id string, turn int, role string, text string")
    got = {r.conv_id: (r.cost, r.audit) for r in conversations.report(conversations.clean(named)).collect()}
    assert got == {"a": (0, "KK"), "b": (2, "D")}


def test_a_long_conversation(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn "), F.col("id").cast("string"), F.lit(".")).alias("text"))
    reports = conversations.report(rows)
    r = reports.first()
    assert (r.cost, r.audit, r.gaps, r.illegal) == (0, "K" * n, 0, 0)
    lines = [("K", ["user", "assistant"][k % 2], f"turn {k}.") for k in range(n)]
    assert conversations.digests(rows, reports).first().repaired_sha256 == hash_of(lines)
