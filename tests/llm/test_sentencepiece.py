import hashlib

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import clashing, rows_of
from webloom.llm import catalog, sentencepiece_codec

SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    out = []
    for i, text in rows:
        ids = SP.encode(text or "")
        out.append((repr(sha(SP.decode(ids))), repr(i), repr(sha(",".join(map(str, ids)))), repr(len(ids))))
    return sorted(out)


def test_every_whole_text_is_encoded_as_the_library_does(documents):
    got = sentencepiece_codec.codec_digest(clashing(documents))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows_of(got) == expected([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_the_query_over_the_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(catalog.op1_sentencepiece(spark, sf_dir)) == expected(rows)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab cé▁\n\t\r 　日🙂.0\x00́<|>ﬁ")), max_size=40))
def test_any_text(text):
    codec = sentencepiece_codec.codec(public_tokenizers.path("piece_bpe_32k.model"))
    assert codec.separable
    (got,) = codec.encode([text])
    assert list(memoryview(got).cast("i")) == SP.encode(text)


def test_a_model_whose_pieces_cross_markers_is_encoded_text_by_text():
    codec = sentencepiece_codec.Codec(public_tokenizers.path("piece_bpe_32k.model"))
    codec.separable = False
    assert list(memoryview(codec.encode(["two words"])[0]).cast("i")) == SP.encode("two words")


def test_decode_and_clashing_output_columns(spark):
    df = spark.createDataFrame([(1, "hello  world", "old"), (2, None, "old")], "doc_id long, text string, piece_ids string")
    both = sentencepiece_codec.decode(sentencepiece_codec.encode(df))
    assert both.columns == ["doc_id", "text", "piece_ids", "decoded"]
    assert {r["doc_id"]: r["decoded"] for r in both.collect()} == {1: SP.decode(SP.encode("hello  world")), 2: ""}


def test_an_empty_table(documents):
    assert sentencepiece_codec.codec_digest(documents.where("false")).collect() == []
