import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations, repair_grammar

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm:
            row = (conv, turn, "user" if harm == 4 else role, "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text)
            out += [row] * (2 if harm == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Dijkstra over (row, roles so far as a state): the least (cost, audit), with the repaired lines."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        for r, name in (("u", "user"), ("a", "assistant")):
            if r in after[state]:
                heapq.heappush(queue, (cost + 2, audit + "I", i, r, (*lines, f"{name}:")))
        if i == len(rows):
            continue
        _, _, role, text = rows[i]
        heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, lines))
        if found[i] in ("blank", "duplicate"):
            continue
        late = found[i] == "truncated"
        if role[:1] in after[state]:
            heapq.heappush(queue, (cost + late, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
        for r, name in (("u", "user"), ("a", "assistant")):
            if r in after[state]:
                heapq.heappush(queue, (cost + 2 + late, audit + "R", i + 1, r, (*lines, f"{name}:{text}")))


def expected(original):
    damaged, out = plain_damage(original), {}
    for conv in {r[0] for r in original}:
        rows = [r for r in damaged if r[0] == conv]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        found = faults(rows)
        turns = {r[1] for r in rows} - {None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, lines = cheapest(rows, found)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def drawn(rng, n, ids=30, longest=14):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "Why?", "and then", "", " \t\n", None, "Well. \n", "日本。", "Fine.", "One.", "Two.", "Three", "Four.", "Five."]
    rows = []
    for conv in range(n):
        turn = rng.choice([0, 1, -3])
        for _ in range(rng.randint(1, longest)):
            rows.append((None if conv == ids else conv, None if rng.random() < 0.05 else turn, rng.choice(roles), rng.choice(texts)))
            turn += rng.choice([0, 1, 1, 1, 1, 2])
    return rows


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("digest", "letter", "block", "symbols", "kind", "code", "first", "later", "harm", "copies", "blank"):
        df = df.withColumn(name, F.col("turn"))
    return df


@pytest.mark.parametrize("block, rounds", [(4096, 16), (3, 2)])
def test_repair_against_shortest_paths(spark, block, rounds):
    rng = random.Random(21)
    rows = drawn(rng, 60)
    rows += [(100, i, ["user", "assistant"][i % 2], f"Line {i}.") for i in range(300)] + [(101, None, "user", "No turn.")] * 3
    rng.shuffle(rows)
    df = table(spark, rows).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(conversations.damage(df), df, block, rounds).collect()}
    assert got == expected(rows)


def test_all_rows_dropped_and_empty_table(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = table(spark, [(dropped, 0, "user", "Gone.")])
    got = conversations.repair(conversations.damage(df), df).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    none = df.where("conv_id < 0")
    assert conversations.repair(conversations.damage(none), none).count() == 0


def test_a_hot_conversation_is_spread(spark):
    rows = [(7, i, ["user", "assistant"][i % 2], f"{i // 2}.") for i in range(4000)] + [(i, 0, "user", "Hello.") for i in range(100, 160)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = conversations.blocks(conversations._flagged(conversations.plain(df)), 500)
    assert made.where("conv_id = 7").select(F.shiftright("block", 40)).distinct().count() > 3
    got = conversations.repair(conversations.plain(df), df, block=500).where("conv_id = 7").first()
    assert got.audit == "K" * 4000 and got.cost == 0 and got.illegal == 0 and got.gaps == 0


def test_grammar_gives_the_sequences_back(spark):
    rng = random.Random(3)
    seqs = ["".join(rng.choice("uauauaUAxD") for _ in range(rng.randint(1, 40))) for _ in range(200)] + ["ua" * 1000, "u"]
    coded, rules = repair_grammar.compress(spark.createDataFrame([(s,) for s in seqs * 2], "symbols string"))

    def spelled(code):
        return "".join(spelled(rules[ord(c) - 0xE000]) if ord(c) >= 0xE000 else c for c in code)

    got = {r.symbols: r.code for r in coded.collect()}
    assert set(got) == set(seqs) and all(spelled(c) == s for s, c in got.items())
    assert len(got["ua" * 1000]) < 20 and len(rules) > 20
    known = repair_grammar.Grammar(rules)
    letters = repair_grammar.Grammar([])
    for s in [*seqs[:20], "ua" * 1000]:
        a, b = known.matrix(got[s]), letters.matrix(s)
        flat = [[None if c is None else (c[0], "".join(repair_grammar.pieces(c[1]))) for c in row] for row in a]
        assert flat == [[None if c is None else (c[0], "".join(repair_grammar.pieces(c[1]))) for c in row] for row in b]
