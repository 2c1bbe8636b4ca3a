import random

import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from millrace.llm import pieces
from millrace.llm.queries import QUERIES, tokenizer
from tests.llm import brute

ODD = [
    "", " ", "  ", "   a   b ", "a▁b▁▁", "▁", "\n\n a", "\0x", "日本語テキスト 汉字🙂🙂", "a" * 3000, "é" * 700 + " x", "x\ty  \r\n",
    "▁▁ ▁", "ab" * 900, " " * 500 + "z", "é ﬁ ①　  ", "<s> </s> <0x41> <unk>", "ABC! " * 40,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer())


def random_texts(n):
    draw = random.Random(3)
    return ["".join(draw.choice("ab ▁thein\n日é🙂.") for _ in range(draw.randint(1, 400))) for _ in range(n)]


def test_ids_equal_the_library_and_spans_hold_the_pieces(library):
    model = pieces.load(tokenizer())
    own = pieces.Encoder(model)
    texts = ODD + random_texts(300)
    ids, begins, ends, cuts = own.encode(texts)
    for text, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
        assert ids[a:b].tolist() == library.encode(text)
        raw, reached = text.encode(), 0
        for i, begin, end in zip(ids[a:b].tolist(), begins[a:b].tolist(), ends[a:b].tolist(), strict=True):
            piece = model.pieces[i]
            if model.kinds[i] == 6:
                assert int(piece[3:5], 16) in raw[begin:end] and len(raw[begin:end].decode()) == 1
            else:
                source = raw[begin:end].decode().replace(" ", "▁")
                assert source == piece or begin == 0 and "▁" + source == piece
            assert begin <= reached or begin == reached
            reached = end
        assert reached == len(raw)


def test_heap_and_lockstep_agree():
    merges = pieces.Merges(pieces.load(tokenizer()))
    units = ["▁" + t.replace(" ", "")[:60] for t in random_texts(200)]
    owner, symbol = merges.lockstep(units)
    for k, unit in enumerate(units):
        assert symbol[owner == k].tolist() == merges.heap(unit).tolist()


@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_compiled_map_normalises_as_the_library(rule, squeeze):
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    n = proto.ModelProto.FromString(theirs.serialized_model_proto()).normalizer_spec
    ours = pieces.Normalizer(pieces.Model(b"", [], [], [], n.precompiled_charsmap, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces))
    for text in ODD + random_texts(60) + ["Ａ１ ｱ ẞ İ", "e\u0301 \u1e9b\u0323", "\u200b x\u00a0y"]:
        normal, source = ours(text)
        assert normal == theirs.normalize(text)
        assert len(source) == len(normal) + 1 and list(source) == sorted(source) and source[-1] <= len(text.encode())


def test_whole_table_matches_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op7_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids)))


def test_edges(spark, library):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x" * 300_000, "c"), (3, "x" * 300_000, "c"), (None, "a b", "d"), (4, " tie  tie ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = pieces.encode(docs, tokenizer(), carry=["ids"]).collect()
    assert sorted((r.id or 0, r.row.ids or "") for r in found) == sorted((i or 0, x or "") for i, _, x in rows)
    for r in found:
        text = {1: "", 2: "", 3: "x" * 300_000, 4: " tie  tie ", None: "a b"}[r.id]
        assert r.ids == library.encode(text) and r.decoded == library.decode(r.ids)
    assert pieces.encode(docs.limit(0), tokenizer()).count() == 0


def test_slices_are_bounded():
    from millrace.llm.words import slices

    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (10, 10, 500, 10, 10, 10)]})
    assert [p.num_rows for p in slices(batch, "text", 2, 25)] == [2, 1, 2, 1]
    assert list(slices(batch.slice(0, 0), "text", 2, 25)) == []


def test_long_texts_are_encoded_in_small_parts(library):
    texts = [f"w{k} " + "some words of a plain text, " * 150 for k in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts), pa.nulls(200, pa.int32())], names=["id", "text", "row"])
    parts = list(pieces.encoder(pieces.load(tokenizer()))(iter([batch])))
    assert max(sum(len(texts[i]) for i in part.column("id").to_pylist()) for part in parts) <= 1 << 18
    assert [ids for part in parts for ids in part.column("ids").to_pylist()] == library.encode(texts)
