"""License scans against plain word lists."""

import re

import pytest

from millrace.llm import licenses
from millrace.llm.licenses import PHRASES, TEMPLATES

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts = [(i, p.label) for p in PHRASES for i in range(len(words)) if words[i : i + len(p.words)] == p.words]
    best, labels = 0.0, {label for _, label in starts}
    for t in TEMPLATES:
        wanted = set(t.words)
        for start in range(0, len(words), t.step):
            part = len(wanted & set(words[start : start + 2 * t.step])) / len(wanted)
            if part >= 0.9:
                best = max(best, part)
                labels.add(t.label)
    at = [i for i, _ in starts]
    base = ",".join(sorted({label for _, label in starts}))
    return len(words), len(at), min(at, default=None), max(at, default=None), base, ",".join(sorted(labels)), 1.0 if at else best


def texts():
    notices = [t.text for t in TEMPLATES]
    cut = [" ".join(t.words[:k] + t.words[k + 1 :]) for t in TEMPLATES for k in range(0, len(t.words), 3)]
    moved = [f"{'pad ' * k}{n}{' pad' * (k % 5)}" for k, n in enumerate(notices * 8)]
    turned = [" ".join(reversed(t.words)) for t in TEMPLATES]
    return notices + cut + moved + turned + [
        None, "", " \t\n", "MIT", "mit license", "MIT-License!", "xmit license", "mit licenses", "mit\x00license\x7fmit license", "MIT licen\u212ae wor\u212a", "Apache  LICENSE apache license",
        "general public license general public", "general general public license", "é mit license ü", "mit é license", "the mit license and the Apache License and the GNU general public license " * 3,
        "mit " * 5_000, "released under the mit license " * 2_000, "the " * 20_000 + "Licensed under CC BY-NC 4.0.", "9" * 100_000, "İs LİCENSE É",
        "This wor\u212a is licensed under the GNU General Public License, version 3.",
    ]


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [(None, "mit license"), (None, None), (3, rows[3][1]), (3, "another text of id 3, Licensed under CC BY-NC 4.0"), (None, "mit license")]
    frame = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, words string, h int")
    found = rows_of(licenses.license_scan(frame))
    assert sorted(map(repr, found)) == sorted(repr((i, *brute(t))) for i, t in rows)
    assert sum(r[6] == "cc-by-nc" for r in found) > 3 and any(0.9 <= r[7] < 1 for r in found)


def test_matches_name_their_blocks(spark):
    text = "pad " * 37 + "Licensed under CC BY-NC 4.0"
    base = licenses.license_scan
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = frame.select("doc_id", "text").withColumnRenamed("doc_id", "id")
    rows = rows.select("id", licenses.F.xxhash64("text").alias("h"), licenses.normal(licenses.F.col("text")).alias("line"))
    found = {(r.start, r.template, r.containment) for r in licenses.block_matches(rows).collect()}
    assert found == {(32, 2, 1.0)} and base(frame).first().labels == "cc-by-nc"


def test_nothing_to_scan(spark):
    assert licenses.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_runs(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    plan = QUERIES["op13_license_scan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions|ExistingRDD", plan) and "BroadcastHashJoin" in plan


def test_notices_are_checked():
    for text in ("é license", " .. "):
        with pytest.raises(ValueError, match="ASCII"):
            licenses.Notice("x", text)


def test_least_overlap():
    assert [licenses.need_of(n, 0.9) for n in (1, 5, 7, 8, 10, 12, 20)] == [1, 5, 7, 8, 9, 11, 18]
