"""Conversation repair against a plain search over whole conversations."""

import hashlib
import re
import zlib
from functools import lru_cache

import pytest

from millrace.llm import repair
from millrace.llm.queries import QUERIES

COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def damaged(rows):
    said = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows):
    """One conversation: rows (turn, role, text), damaged."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", hashlib.sha256(r[2].encode()).hexdigest()))
    rows = [(t, r or " ", x) for t, r, x in rows]
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserted=0):
        """(cost, audit, repaired) from row i on; at most two inserts in a row can help."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        turn = "a" if state == "u" else "u"
        name = {"a": "assistant", "u": "user"}[turn]
        if inserted < 2:
            c, a, r = best(i, turn, inserted + 1)
            found.append((c + 3, "I" + a, (f"{name}:", *r)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, r = best(i + 1, state)
            found.append((c + 4, "D" + a, r))
            if faults[i] in ("", "truncated"):
                extra = 3 * (faults[i] == "truncated")
                if role[0] in follow[state]:
                    c, a, r = best(i + 1, role[0])
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *r)))
                c, a, r = best(i + 1, turn)
                found.append((c + 3 + extra, "R" + a, (f"{name}:{text}", *r)))
        return min(found, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # from the end, so that the search never goes deep
        for state in follow:
            best(i, state)
    cost, audit, made = best(0, "")
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][0] + b[1][0] for a, b in zip(rows, rows[1:], strict=False)]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()


def expected(rows, all_ids):
    return {c: brute([r[1:] for r in rows if r[0] == c]) for c in all_ids}


def found(frame):
    assert frame.columns == COLUMNS
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_conversation_repair"](spark, sf_dir)) == expected(damaged(rows), {r[0] for r in rows})


ROLES = ["system", "user", "assistant", "tool", "", None, "user", "assistant"]
TEXTS = ["Yes.", "No!", "cut", "", None, " \t\x0b", "Yes.", "end?\n", "é…", "a.\x0b", "x. y"]


def odd_rows():
    rows = [(c, (t * 3 + c) % 7 if c % 3 else t, ROLES[(c * t + c + t) % 8], TEXTS[(c * 7 + t * t + t) % 11]) for c in range(60) for t in range(c % 13)]
    rows += [(None, None, "user", "a."), (None, None, "user", "b."), (None, 5, "assistant", "c."), (None, 5, "assistant", "c.")]
    return rows + [(100, None, "user", "only" * 30_000), (101, 3, "abc", "Kept."), (101, 1, "ugly", "Kept."), (102, -5, "system", "S.")] + [(103, 1, "user", "same.")] * 9


@pytest.mark.parametrize("block", [1, 2, 3, 1024])
def test_odd_rows_and_any_block_size(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "PORTION", 16)
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, digest string, copies int")
    clean = [(c, t, r or " ", " " if x is None else x) for c, t, r, x in rows]
    assert found(repair.digest(repair.repair(frame))) == expected(clean, {r[0] for r in rows})


def test_damage_keeps_lost_conversations(spark):
    rows = [(c, t, ROLES[(c + t) % 8], TEXTS[(c + 3 * t) % 11]) for c in range(200) for t in range(1 + c % 3)] + [(None, None, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    hurt = repair.damage(frame)
    assert sorted(map(repr, map(tuple, hurt.collect()))) == sorted(map(repr, damaged(rows)))
    assert found(repair.with_lost(repair.digest(repair.repair(hurt)), frame)) == expected(damaged(rows), {r[0] for r in rows})
    assert any(not [r for r in damaged(rows) if r[0] == c] for c in range(200))
    assert repair.with_lost(repair.digest(repair.repair(hurt.limit(0))), frame.limit(0)).count() == 0


def test_long_conversation_crosses_blocks(spark):
    rows = [(7, t, ["user", "assistant", "tool", "assistant", "user"][t * t % 5], f"said {t % 200}" + ".!,"[t % 3]) for t in range(1500)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = repair.repair(frame)
    ((conv, *row),) = [tuple(r) for r in repair.digest(done).collect()]
    assert conv == 7 and tuple(row) == brute([r[1:] for r in rows])
    turns = repair.apply(done).orderBy("position").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns))
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns).encode()).hexdigest() == row[-1]


def test_edits_must_cost_something():
    with pytest.raises(ValueError, match="cost"):
        repair.Costs(insert=0)
