"""Spelling variants against plain neighbourhoods."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import spelling
from millrace.llm.queries import QUERIES

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(docs, least_length=5, least_count=3, every=97):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= least_count}
    near, masks = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            masks[w[:k], w[k + 1 :]].add(w)
            cut = w[:k] + w[k + 1 :]
            if cut in counts:
                near[w].add(cut)
                near[cut].add(w)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None)
    return out


def found(frame):
    rows = frame.collect()
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = brute(docs)
    assert found(QUERIES["op12_spelling_variants"](spark, sf_dir)) == expected
    assert any(f for f, *_ in expected.values()) and any(n > 1 for *_, n, _ in expected.values())


def made_docs():
    draw = np.random.default_rng(3)
    base = ["colour", "harbour", "naïveté", "garçon", "straße", "aaaaaa", "x" * 70, "ÿÿÿÿÿ", "theatre"]
    docs = []
    for i in range(400):
        words = []
        for w in draw.choice(base, 30, p=[0.4, 0.2, 0.1, 0.1, 0.05, 0.05, 0.05, 0.025, 0.025]):
            w, p = str(w), int(draw.integers(0, len(w)))
            kind = draw.integers(0, 12)
            w = w[:p] + w[p + 1 :] if kind == 0 else w[:p] + "z" + w[p:] if kind == 1 else w[:p] + "é" + w[p + 1 :] if kind == 2 else w
            words.append(w.capitalize() if kind == 3 else w)
        docs.append((i, " ,".join(words)))
    docs += [(1000, None), (1001, ""), (1002, "12 34 Ābcdefā ×÷×÷× İstanbul"), (None, docs[0][1]), (3, docs[3][1]), (3, docs[3][1])]
    return docs + [(2000 + i, "k" * 3_000 + " " + "k" * 2_999) for i in range(5)]


@pytest.mark.parametrize("small", [False, True])
def test_odd_words_in_any_number_of_rounds(spark, monkeypatch, small):
    docs = made_docs()
    if small:  # several pieces, rounds and flushes; filters of few bits let much pass
        for name, value in {"PIECE": 20, "ROUND_BYTES": 200, "BITS": 4, "HOLD": 2_000, "PROBES": 500, "LENGTHS": 7, "LONG_TEXT": 50}.items():
            monkeypatch.setattr(spelling, name, value)
        docs = [(i, t) for i, t in docs if i is None or i < 2000]
    frame = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, n int")
    expected = brute(docs)
    assert found(spelling.spelling_variants(spelling.vocabulary(frame))) == expected
    assert max(n for *_, n, _ in expected.values()) > 3 and len(expected) > 50


def test_nothing_to_group(spark):
    schema = "doc_id long, text string"
    for rows in ([], [(1, None)], [(1, "short words only")]):
        assert spelling.spelling_variants(spelling.vocabulary(spark.createDataFrame(rows, schema))).count() == 0
    alone = spark.createDataFrame([(i, "lonely") for i in range(50)], schema)
    assert found(spelling.spelling_variants(spelling.vocabulary(alone, misspell=None))) == {"lonely": (None, "lonely", 50, 0, None)}


def test_forms_chain_to_the_last(spark):
    rows = [("aaaaa", 3), ("aaaab", 6), ("aaabb", 12), ("aabbb", 24), ("abbbb", 48), ("bbbbb", 96), ("ccccc", 5), ("ccccd", 9)]
    frame = spark.createDataFrame([(0, " ".join([w] * n)) for w, n in rows], "doc_id long, text string")
    got = found(spelling.spelling_variants(spelling.vocabulary(frame, misspell=None)))
    assert {w: r[1] for w, r in got.items()} == {**{w: "bbbbb" for w, _ in rows[:6]}, "ccccc": "ccccc", "ccccd": "ccccd"}
