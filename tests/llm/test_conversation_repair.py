"""Role repair against all edit sequences, tried one by one or by (rows, roles) with whole audits."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from ledgerlake.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, content string, copies string"
LEGAL = re.compile(r"(s?(ua)+)?")
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "p"}, "p": {"u": "u"}}
WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    """{conv: rows (turn, role, text) after damage, in order}"""
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16])
    return {c: sorted(r, key=order) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        plain = text.strip(WHITE)
        out.append("blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """(cost, audit, output rows), by the rows taken and the last role, with whole audits."""
    best = {"": (0, "", ())}

    def inserted(best):
        todo = list(best.items())
        for state, (cost, audit, out) in todo:
            for x, to in NEXT[state].items():
                if x != "s":
                    new = (cost + 2, audit + "I", (*out, ("user" if x == "u" else "assistant", "")))
                    if to not in best or new[:2] < best[to][:2]:
                        best[to] = new
                        todo.append((to, new))
        return best

    for (_, role, text), mark in zip(rows, marks):
        after = {}
        for state, (cost, audit, out) in inserted(best).items():
            moves = [(state, cost + 3, audit + "D", out)]
            if mark not in ("blank", "duplicate"):
                for x, to in NEXT[state].items():
                    more = cost + (mark == "truncated")
                    if role[:1] == x:
                        moves.append((to, more, audit + "K", (*out, (role, text))))
                    if x != "s":
                        moves.append((to, more + 2, audit + "R", (*out, ("user" if x == "u" else "assistant", text))))
            for to, *new in moves:
                if to not in after or tuple(new[:2]) < after[to][:2]:
                    after[to] = tuple(new)
        best = after
    return min(v for k, v in inserted(best).items() if k in ("", "p"))


def every_edit(rows, marks, inserts=3):
    """The same by trying every edit sequence with up to so many inserts."""
    found = []
    for letters in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product(range(inserts + 1), repeat=len(rows) + 1):
            if sum(gaps) > inserts:
                continue
            audit = "".join("I" * g + x for g, x in zip(gaps, [*letters, ""]))
            options, k = [], 0
            for x in audit:
                if x == "I":
                    options.append([(2, (r, "")) for r in ("user", "assistant")])
                    continue
                (_, role, text), mark, k = rows[k], marks[k], k + 1
                cut = mark == "truncated"
                if x != "D" and mark in ("blank", "duplicate"):
                    options.append([])
                else:
                    options.append([(3, None)] if x == "D" else [(cut, (role, text))] if x == "K" else [(2 + cut, (r, text)) for r in ("user", "assistant")])
            for pick in itertools.product(*options):
                out = tuple(o for _, o in pick if o)
                if LEGAL.fullmatch("".join(o[0][:1] or "?" for o in out)):
                    found.append((sum(c for c, _ in pick), audit, out))
    return min(found)


def expected(conv, rows):
    marks = faults(rows)
    cost, audit, out = cheapest(rows, marks)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (conv, gaps, *(marks.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def made(seed, n, roles=("user", "assistant", "system", "tool", "User", "", None), texts=("Yes.", "no", " ", "", "Why?", None, "a.\n")):
    rnd = random.Random(seed)
    return [(rnd.choice([None, *range(n)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(rnd.randint(0, n))]


def compared(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = cr.repair(cr.damaged(df, "conv_id", "turn", "role", "text")).collect()
    want = [expected(c, r) for c, r in damage(rows).items()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_brute_force_agrees_with_itself():
    for seed in range(60):
        rows = [(t, r or " ", x or " ") for t, r, x in made(seed, 3)]
        assert cheapest(rows, faults(rows)) == every_edit(rows, faults(rows))


def test_automaton_accepts_the_grammar():
    for n in range(7):
        for word in itertools.product("sua", repeat=n):
            state = 0
            for x in word:
                state = None if state is None else cr.AUTOMATON.shift[state].get(x)
            assert (state in cr.AUTOMATON.accepting) == bool(LEGAL.fullmatch("".join(word)))


def test_small_conversations(spark):
    rows = [(seed if seed else None, *r) for seed in range(250) for r in made(seed, 9)]
    compared(spark, rows + rows[5:9])


@pytest.mark.parametrize("buffer", [3, 4096])
def test_conversations_over_many_ranges(spark, monkeypatch, buffer):
    monkeypatch.setattr(cr, "BUFFER_ROWS", buffer)
    rnd = random.Random(5)
    one = [(7, k // 2, rnd.choice(["user", "assistant", "user", "assistant", "system"]), rnd.choice(["Yes.", "no", f"t{k}.", f"u{k}", f"v{k}!"])) for k in range(900)]
    same = [(9, 3, "user", "again.")] * 40
    others = [(seed, *r) for seed in range(20, 60) for r in made(seed, 6)]
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compared(spark, one + same + others)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)


def test_dropped_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    compared(spark, [(gone, 0, "user", "Hi.")])
    compared(spark, [])


def test_long_texts_and_alternation(spark):
    long = "word " * 400_000 + "."
    compared(spark, [(1, k, "user" if k % 2 == 0 else "assistant", long + str(k) + ".") for k in range(4)] + [(2, None, "user", long)])


def test_query_on_given_tables(spark):
    import pyarrow.parquet as pq

    folder = "/root/testdata/sf0.001"
    t = pq.read_table(f"{folder}/conversations.parquet").to_pydict()
    want = [expected(c, r) for c, r in damage(zip(t["conv_id"], t["turn"], t["role"], t["text"])).items()]
    got = cr.op13(spark, folder)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
