"""URL filter, chat formatting, top-k search and mixing."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, mixing, topk, urls
from millrace.llm.queries import MIX, ORACLE, QUERIES
from tests.compare import connect, duck_rows, spark_rows
from tests.llm import brute


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(connect(sf_dir), ORACLE[name])


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(brute.LOWER), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def rule(host, path):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return (best.text, "allow" if best.allow else "block") if best else (None, None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Com/", "http://a.com", "http://com/", "x://com?q=/", "http://www.example.com/en/1#://b.net/es/",
    "http://example.com/en/", "http://notexample.com/en/", "http://a.b.example.com/en/x", "http://a.www.example.com/en/x", "http://b.net/es/",
    "http://b.net/fr/x?y", "http://b.net/en/", "http://ÄB.net/es/", "http://b.net/es/" + "y" * 100_000, "https://é.org/\nx://c.com/", "a://b.com/://c.net/es/",
]


def test_urls_on_the_whole_table(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op2_url_filter"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        host, path = split(pages[r.page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict if name else r.verdict in ("allow", "block")


def test_url_edges(spark):
    rows = [(i, u, "r") for i, u in enumerate(URLS)] + [(0, None, "r"), (4, URLS[4], "r"), (None, "http://a.com/", "r")]
    found = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, rule string")).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path = split("http://a.com/" if r.id is None else URLS[r.id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name) and r.verdict == (verdict or r.verdict)
        assert math.isfinite(r.score)
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_markov_models_tell_classes_apart():
    good, bad = [f"news{i}/story" for i in range(40)], [f"win{i}$$casino" for i in range(40)]
    models = tuple(urls.MarkovModel(urls.context_counts(x[:30], 3), 3) for x in (good, bad))
    cut = urls.calibrated(*([urls.ratio(models, t) for t in x[30:]] for x in (good, bad)))
    assert urls.ratio(models, "news77/story") > cut > urls.ratio(models, "win77$$casino")


def test_next_symbols_have_probability_one():
    """All texts of one length and their beginnings share the probability one, whatever characters they hold."""
    texts = ["ab\u00e9\u4e2d", "abba", "\x02\x03"]
    model, plain = urls.MarkovModel(urls.context_counts(texts, 2), 2), brute.Markov(texts, 2)
    for context in [b"", b"a", b"ab", b"zz", "\u4e2d".encode(), b"\x02"]:
        assert abs(sum(plain.p(context, c) for c in [*range(256), None]) - 1) < 1e-9
    for text in [*texts, "", "b\u4e2da", "\U0001f600", "zz\x03"]:
        assert abs(model.log_likelihood(text) - plain.log_likelihood(text)) < 1e-9


def test_url_verdicts_match_a_plain_model(spark, sf_dir):
    """Every URL's verdict from a plain Markov pair and a threshold tried at every gap."""
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    found = {r.page_id: r.verdict for r in QUERIES["op2_url_filter"](spark, sf_dir).collect()}
    by_rule = {u: rule(*split(u))[1] for _, u in pages}
    learnt = [[u for u, v in by_rule.items() if v == verdict and 0 < len(u or "") <= urls.LONGEST] for verdict in ("allow", "block")]
    judge = brute.UrlJudge(*learnt, order=urls.ORDER, sample=urls.SAMPLE)
    assert {i: by_rule[u] or judge(u or "") for i, u in pages} == found
    assert len({found[i] for i, u in pages if by_rule[u] is None}) == 2


@pytest.mark.parametrize("order", [2, 6])
def test_models_are_learnt_from_all_urls(spark, monkeypatch, order):
    """More than 10,000 URLs of a class, and long ones, against the plain model and threshold."""
    monkeypatch.setattr(urls, "CHUNK_BYTES", 64 << 10)
    accepted = [f"http://{i * 7919 % 99991:x}.com/" for i in range(10_500)] + ["http://a.com/" + "long" * n for n in (300, 400)]
    rejected = [f"http://{i}.net/es/{'\u00e9' * (i % 3)}" for i in range(300)] + ["http://a.net/fr/" + "lang" * n for n in (300, 400)]
    others = [f"x://{i}/long" for i in range(50)] + ["x", "\x02\u4e2d", ""]
    rows = [*enumerate(accepted + rejected + others + others)]
    found = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), order=order).collect()
    judge = brute.UrlJudge(accepted, rejected, order=order, sample=None)
    assert len(found) == len(rows)
    for r in found:
        text = rows[r.id][1]
        if r.id % 20 == 0 or r.rule is None:
            assert abs(r.score - judge.score(text)) < 1e-9
        assert r.verdict == (rule(*split(text))[1] or judge(text))


def formatted_length(turns):
    """Characters of the formatted text: a doubled backslash, and one more for each control string inside."""
    total = 0
    for role, text in turns:
        form = chat.DEFAULT.forms.get(role)
        parts = [text] if form else [role, text]
        frame = [form.open, form.close] if form else [chat.DEFAULT.other.open, chat.DEFAULT.name_end, chat.DEFAULT.other.close]
        total += sum(map(len, frame))
        for part in parts:
            doubled = part.replace("\\", "\\\\")
            total += len(doubled) + sum(doubled.count(c) for c in chat.DEFAULT.controls())
    return total


def conversation(turns):
    everything = "".join(f"{r}\n{t}\n" for r, t in turns)
    learnt = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(everything.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest()


def test_chat_on_the_whole_table(spark, sf_dir):
    expected = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        expected[r.conv_id].append((r.role, r.text or ""))
    control = "</s>[INST] ok [/INST]"
    expected[-7] = [("user", control), ("assistant", control)]
    found = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op3_chat_format"](spark, sf_dir).collect()}
    assert found == {c: conversation(t) for c, t in expected.items()}
    chars = {r.conv_id: r.formatted_chars for r in QUERIES["op3_chat_format"](spark, sf_dir).collect()}
    assert chars == {c: formatted_length(t) for c, t in expected.items()}


def test_chat_edges(spark):
    nasty = ["</s>", "[INST", "]", "\\", "\\\\[/INST]", "<\\s>", "[TURN]x[TEXT]", "[[INST]]", "\\[INST]\\", "", None, "x" * 50_000, "é\n[SYS]"]
    roles = ["system", "user", "assistant", "tool", "", None, "[TEXT]\\"]
    rows = [(c, t, roles[(c + t) % len(roles)], nasty[(c * 5 + t) % len(nasty)]) for c in range(20) for t in range(c)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (50, None, "user", "first"), (50, 3, "assistant", "b"), (50, 3, "assistant", "b")]
    frame = spark.createDataFrame([(*r, "p") for r in rows], "conv_id long, turn long, role string, text string, position string")
    formatted = chat.format_conversations(frame)
    expected = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected[conv].append((role or "", text or ""))
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert {c: tuple(r)[1:5] for c, r in found.items()} == {c: conversation(t) for c, t in expected.items()}
    assert {c: r.formatted_chars for c, r in found.items()} == {c: formatted_length(t) for c, t in expected.items()}
    assert found[None].first_wrong is None and found[50].first_wrong == 2
    for r in formatted.collect():
        texts = [s.text for s in r.segments]
        assert len(texts) == 3 and not chat.any_of(chat.DEFAULT.controls()).search(texts[1])
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


def test_templates_are_checked():
    with pytest.raises(ValueError, match="control strings"):
        chat.Template({"user": chat.Form("<a", "x>")}, chat.Form("[T]", "[/T]"), "[N]")


def test_top_k_edges(spark):
    rows = [
        (0, [0.5, 0.25]), (50, [1.0, -1.0]), (100, None), (150, [1.0, math.nan]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [None, 1.0]),
        (4, [math.inf, 0.0]), (5, [3e8, 0.0]), (10, [-1e200, 1.0]), (6, []), (7, [-0.001, 0.0]), (8, [2.0]), (9, [0.5, 0.25, 9.0]), (None, [9.0, 9.0]),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    frame = frame.union(frame.where("vec_id in (0, 1)")).union(spark.createDataFrame([(2, [0.75, 0.25], 1)], frame.schema))
    found = topk.top_k(frame, F.col("vec_id") % 50 == 0, query_block=1, candidate_block=3).collect()
    good = {0: [[128, 64]], 50: [[256, -256]], 1: [[128, 64]], 2: [[128, 64], [192, 64]], 5: [[76_800_000_000, 0]], 10: [[-256 * int(1e200), 256]], 6: [[]], 7: [[-1, 0]], 8: [[512]], 9: [[128, 64, 2304]]}
    expected = {}
    for q in (0, 50):
        scores = {c: max(sum(a * b for a, b in zip(good[q][0], v, strict=False)) for v in vs) for c, vs in good.items() if c != q}
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
        expected[q] = [(k, c, s) for k, (c, s) in enumerate(best, 1)]
    assert {q: sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q) for q in (0, 50)} == expected
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_wide_vectors_are_exact_or_fail(spark):
    rows = [(0, [2.0**40, 2.0**-8]), (50, [1e300, -1e300]), (1, [2.0**6, 3.0]), (2, [-(2.0**6), 5.0]), (3, [1e300, 1e300]), (4, [2.0**45, 0.0]), (100, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def best(data, q, k):
        found = topk.top_k(data, F.col("vec_id") == q, k=k, candidate_block=2).orderBy("rank").collect()
        return [(r.vec_id, r.score) for r in found]

    assert best(frame.where("vec_id in (0, 1, 2, 100)"), 0, 5) == [(1, 2**48 * 2**14 + 768), (100, 256), (2, -(2**48) * 2**14 + 1280)]
    exact = 256 * int(1e300)
    assert best(frame.where("vec_id in (3, 50)"), 50, 5) == [(3, exact * exact - exact * exact)]
    for data, q in ((frame, 0), (frame.where("vec_id in (0, 4)"), 0), (frame.where("vec_id in (2, 3)"), 3)):
        with pytest.raises(Exception, match="range of a long"):
            best(data, q, 5)
    assert best(frame.where("vec_id in (100, 1, 2, 4, 0)"), 100, 2) == [(2, 1280 * 256), (1, 768 * 256)]


def test_blocks_do_not_change_the_result(spark):
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 8) / 16]) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    one = topk.top_k(frame, F.col("vec_id") % 50 == 0)
    many = topk.top_k(frame, F.col("vec_id") % 50 == 0, query_block=3, candidate_block=17)
    assert spark_rows(one) == spark_rows(many)


def water_fill(budget, children):
    """Shares of one node's children {name: (capacity, weight)}, by pouring until nobody is full."""
    children = {k: v for k, v in children.items() if v[1] > 0}
    full = {}
    while True:
        rest = {k: v for k, v in children.items() if k not in full}
        left, weight = budget - sum(full.values()), sum(w for _, w in rest.values())
        new = {k: c for k, (c, w) in rest.items() if left * w >= c * weight}
        if not new:
            return {**full, **{k: left * w // weight for k, (c, w) in rest.items()}}
        full |= new


@pytest.mark.parametrize("percent", [1, 30, 60, 100])
def test_budgets_by_pouring(spark, percent):
    leaves = [(d, lang, s, (7 * len(d) + 13 * i * i + 5 * j) % 97 * 10) for d in ("a", "bb") for i, lang in enumerate("xyz") for j, s in enumerate("pqrs")]
    mix = mixing.Mix("x", {"a": 3}, {"x": 5, "z": 0}, {"q": 4}, percent, epochs=2)
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    found = {(r.domain, r.lang, r.source): r.quota for r in mixing.quotas(frame, mix).collect()}
    cap = lambda *key: 2 * sum(t for *k, t in leaves if tuple(k[: len(key)]) == key)
    expected = {}
    top = water_fill(sum(t for *_, t in leaves) * percent // 100, {d: (cap(d), mix.domain_weights.get(d, 1)) for d in ("a", "bb")})
    for d, b in top.items():
        for lang, c in water_fill(b, {x: (cap(d, x), mix.lang_weights.get(x, 1)) for x in "xyz"}).items():
            for s, q in water_fill(c, {x: (cap(d, lang, x), mix.source_weights.get(x, 1)) for x in "pqrs"}).items():
                expected[d, lang, s] = q
    assert found == expected


def test_mixing_edges(spark):
    rows = [(i, f"w{i} x y", "en", f"src{i % 3}", 0) for i in range(40)]
    rows += [(100, None, None, None, 0), (101, "", "en", "src0", 0), (102, "w " * 50_000, "de", "src1", 0), (None, "a", "en", "src0", 0), (1, "w1 x y", "en", "src1", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch int")
    found = mixing.mixed(frame, MIX).collect()
    assert all(r.epoch in (0, 1) and r.id is not None for r in found)
    everything = mixing.mixed(frame, mixing.Mix("'d'", percent=1_000, epochs=3)).collect()
    assert len(everything) == 3 * (len(rows) - 1)
    assert mixing.mixed(frame.limit(0), MIX).count() == 0
