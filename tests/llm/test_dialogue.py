"""Conversation repair against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import dialogue as D

GOAL = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"(s?(ua)*u?)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    out = []
    for i, (_, role, text) in enumerate(rows):
        body = BLANK.findall(text)
        if not body:
            out.append("blank")
        elif any((role, text) == r[1:] for r in rows[:i]):
            out.append("duplicate")
        else:
            out.append(None if body[-1] in ".!?" else "truncated")
    return out


def cheapest(rows):
    """Every way of editing, cheapest and least first."""
    found = faults(rows)
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, roles, out = heapq.heappop(queue)
        if i == len(rows) and GOAL.fullmatch(roles):
            return cost, audit, out
        if (i, roles, audit) in done:
            continue
        done.add((i, roles, audit))
        step = lambda c, e, k, r, line: PREFIX.fullmatch(roles + r) and heapq.heappush(
            queue, (cost + c, audit + e, i + k, roles + r, (*out, line) if line is not None else out)
        )
        for name in ("user", "assistant"):
            step(3, "I", 0, name[0], f"{name}:")
        if i < len(rows):
            _, role, text = rows[i]
            step(4, "D", 1, "", None)
            if found[i] not in ("blank", "duplicate"):
                extra = 3 if found[i] else 0
                if role[:1] in ("s", "u", "a"):
                    step(extra, "K", 1, role[:1], f"{role}:{text}")
                for name in ("user", "assistant"):
                    step(3 + extra, "R", 1, name[0], f"{name}:{text}")


def quick(rows):
    """The same by suffixes: least (cost, audit) to the end for each state, with the lines."""
    found = faults(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ()), "a": (0, "", ()), "u": (3, "I", ("assistant:",)), "s": (6, "II", ("user:", "assistant:"))}
    for i in range(len(rows) - 1, -1, -1):
        _, role, text = rows[i]
        gone, extra = found[i] in ("blank", "duplicate"), 3 * (found[i] == "truncated")
        now = {}
        for q in best:
            add = lambda c, e, line, to: (c + to[0], e + to[1], ((line,) if line is not None else ()) + to[2])
            ways = [add(4, "D", None, best[q])]
            if not gone:
                ways.append(add(3 + extra, "R", f"{name[after[q]]}:{text}", best[after[q]]))
                if role[:1] == after[q]:
                    ways.append(add(extra, "K", f"{role}:{text}", best[after[q]]))
                if role[:1] == "s" and q == "":
                    ways.append(add(extra, "K", f"{role}:{text}", best["s"]))
            now[q] = min(ways)
        for _ in range(3):
            now = {
                q: min(v, (3 + now[after[q]][0], "I" + now[after[q]][1], (f"{name[after[q]]}:", *now[after[q]][2])))
                for q, v in now.items()
            }
        best = now
    return best[""]


def damage(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        order = (turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest())
        groups[conv] += []
        new = {1: "", 2: re.sub(r"[.!?]", "", text)}.get(fault, text)
        groups[conv] += [(order, turn, "user" if fault == 4 else role, new)] * {0: 0, 3: 2}.get(fault, 1)
    return {c: [r[1:] for r in sorted(g, key=lambda r: r[0])] for c, g in groups.items()}


def brute(rows, solve=quick, damaged=damage):
    out = Counter()
    for conv, kept in damaged(rows).items():
        found = Counter(faults(kept))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, lines = solve(kept)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv, gaps, found["blank"], found["duplicate"], found["truncated"], illegal, cost, audit, digest] += 1
    return out


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", "unit", None]
TEXTS = ["One.", "Two!", "Three?", "half", "  \t\n", "", "end. \n", "é…", None, "One."]


def rows_for(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            proper = ["system", "user", "assistant"][0 if t == 0 and c % 3 == 0 else 1 + (t + c) % 2]
            role = proper if rng.random() < 0.7 else rng.choice(ROLES)
            text = f"Say {t}." if rng.random() < 0.6 else rng.choice(TEXTS)
            rows.append((c, rng.choice([t, t, t, 2 * t, None]), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)


def report(spark, rows):
    return Counter(map(tuple, D.repair_report(D.repair(D.damaged(D.prepared(frame(spark, rows))))).collect()))


def test_quick_version_equals_all_ways():
    rng = random.Random(1)
    for _ in range(300):
        rows = [(t, rng.choice(ROLES) or " ", rng.choice(TEXTS) or " ") for t in range(rng.randint(0, 4))]
        assert quick(rows) == cheapest(rows), rows


def test_report_equals_brute_force(spark):
    rows = rows_for(2, 400, 12) + [(None, 1, "user", "Hi."), (None, None, None, None), (7, 1, "user", "Hi.")] * 3
    rows += [(900, t, "user", "") for t in range(30)]
    assert report(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [1, 3, 17])
def test_conversations_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_ROWS", block)
    rows = rows_for(3, 25, 40)
    hot = [(500, t, ["user", "assistant"][(t // 3) % 2], f"Turn {t % 200}{'.' * (t % 5 > 0)}") for t in range(400)]
    rows += hot + [(501, None, "user", "Same.")] * 300 + [(502, 5, "system", "a."), (502, 5, "system", "b.")] * 40
    assert report(spark, rows) == brute(rows)


def test_turns_left(spark):
    rows = rows_for(4, 60, 9)
    pieces = D.repair(D.prepared(frame(spark, rows)))
    got = defaultdict(list)
    for r in sorted(D.repaired_turns(pieces).collect(), key=lambda r: (r.piece, r.position)):
        got[r.conv_id].append(f"{r.role}:{r.text}")
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv].append(((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest()), turn, role, text))
    for conv, group in groups.items():
        lines = quick([r[1:] for r in sorted(group, key=lambda r: r[0])])[2]
        assert tuple(got[conv]) == lines
        assert GOAL.fullmatch("".join(x[0] for x in lines))


def test_ranks_order_least_audits():
    rng = np.random.default_rng(5)
    lengths = rng.integers(0, 9, 40)
    n = int(lengths.sum())
    chains = D.Chains(rng.integers(0, 4, n), rng.random(n) < 0.2, rng.random(n) < 0.3, lengths)
    go = chains.costs(np.broadcast_to(D.END, (40, 4)))
    label, target = chains.least_arcs(go, np.ones(40, bool))
    paths, last, rank = D.least_paths(label, target, np.arange(len(label)))
    audits = [label[p].tolist() for p in paths]
    assert (label[last] == 0).all()
    for a in range(0, len(audits), 7):
        for b in range(0, len(audits), 11):
            assert (rank[a] < rank[b]) == (audits[a] < audits[b])


def test_dropped_and_empty(spark):
    c = next(c for c in range(500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = D.repair_report(D.repair(D.damaged(D.prepared(frame(spark, [(c, 0, "user", "Hi.")]))))).collect()
    assert [tuple(r) for r in got] == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert report(spark, rows_for(1, 1, 1)[:0]) == Counter()


def test_clashing_names_and_long_texts(spark):
    rows = [(1, 1, "user", "x" * 3_000_000 + "."), (1, 2, "assistant", "y" * 3_000_000), (2, 1, "user", "z!")]
    extra = frame(spark, rows).withColumns({"piece": F.lit(1), "copy": F.lit("a"), "there": F.lit(None), "_spread": F.lit(0)})
    got = D.repair_report(D.repair(D.damaged(D.prepared(extra)))).collect()
    assert Counter(map(tuple, got)) == brute(rows)
