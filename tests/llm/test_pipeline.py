import corpus_pipeline
from millrace.llm import mixing, quality
from millrace.llm.queries import table, tokenizer
from tests.llm import brute


def test_stages_against_brute_force(spark, sf_dir):
    import sentencepiece

    docs = table(spark, sf_dir, "documents")
    steps, given = dict(corpus_pipeline.STAGES), {}
    for name, step in corpus_pipeline.STAGES:
        given[name] = [r.asDict() for r in docs.collect()]
        columns = docs.columns
        docs = spark.createDataFrame([tuple(r) for r in step(spark, docs, sf_dir).collect()], step(spark, docs.limit(0), sf_dir).schema)
        if name != "tokens":
            assert docs.columns == columns
    assert len(steps) == 5
    final = docs.collect()

    scores = {r.id: r.predicted for r in quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).collect()}
    assert {r["doc_id"] for r in given["near_duplicates"]} == {i for i, p in scores.items() if p}
    groups = brute.ngram_join([(r["doc_id"], r["text"]) for r in given["near_duplicates"]], percent=80, size=5)
    assert {r["doc_id"] for r in given["substrings"]} == {i for i, (_, c) in groups.items() if i == c}
    cut = brute.substring_dedup([(r["doc_id"], r["text"]) for r in given["substrings"]], 50)
    texts = {r["doc_id"]: r["text"] for r in given["mixture"]}
    before = {r["doc_id"]: r["text"] for r in given["substrings"]}
    assert {i: brute.sha(" ".join(brute.words(texts[i]))) for i, *_ in cut} == {i: h for i, _, _, h in cut}
    assert all(texts[i] == before[i] for i, _, removed, _ in cut if not removed)
    assert all(r["n_chars"] == len(r["text"]) for r in given["mixture"])
    chosen = {r.id for r in mixing.mixed(spark.createDataFrame(given["mixture"]), corpus_pipeline.PIPELINE_MIX).collect()}
    assert {r["doc_id"] for r in given["tokens"]} == chosen and 0 < len(chosen) < len(texts)
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    assert {r.doc_id: r.ids for r in final} == {i: library.encode(texts[i]) for i in chosen}


def test_empty_and_null_rows_pass(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "src0", 0), (2, "", None, None, None), (2, "", None, None, None)], schema)
    for docs in (odd, odd.limit(0)):
        for _, step in corpus_pipeline.STAGES:
            step(spark, docs, sf_dir).collect()


def test_run_gives_the_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert rows.count() == rows.select("doc_id").distinct().count() > 0


def test_near_copies_by_five_words_and_four_fifths(spark, sf_dir):
    words = [f"w{k}" for k in range(100)]
    two = ["x" if k in (30, 70) else w for k, w in enumerate(words)]
    three = ["y" if k in (20, 50, 80) else w for k, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(two)), (3, " ".join(three)), (4, "a b c d"), (5, "A b  c d")]
    four, five = ([brute.shingles(t, size) for _, t in rows] for size in (4, 5))
    similar = lambda s, a, b: len(s[a] & s[b]) / len(s[a] | s[b])
    assert similar(four, 0, 1) < 0.85 and similar(five, 0, 1) >= 0.8 and max(similar(five, 0, 2), similar(five, 1, 2)) < 0.8
    schema = table(spark, sf_dir, "documents").schema
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], schema)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf_dir)
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4}
