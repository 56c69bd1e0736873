import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from pairloom.llm import sentencepieces as S
from pairloom.llm.queries import tokenizer_model


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def odd_texts():
    rng = random.Random(1)
    fixed = ["", " ", "  a  b ", "a▁b", "日本語 😀 \x00 é", "a\n\n b\t c", "x" * 5000, "a " * 3000, "<s> </s> <unk> <0x41>", " nbsp"]
    return fixed + ["".join(rng.choice(" abAé😀▁\n​") for _ in range(rng.randrange(1, 40))) for _ in range(500)]


def test_ids_spans_and_decoding_equal_the_library(processor):
    encoder = S.Encoder(tokenizer_model())
    texts = odd_texts()
    got = list(encoder.encode(texts))
    for text, (ids, start, end) in zip(texts, got, strict=True):
        assert ids.tolist() == processor.encode(text)
        pieces = processor.encode(text, return_type="proto").pieces
        assert [(p.begin, p.end) for p in pieces] == list(zip(start.tolist(), end.tolist(), strict=True))
    assert encoder.decode([g[0] for g in got]) == [processor.decode(processor.encode(t)) for t in texts]


def test_compiled_map_normalises_like_the_library():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    mine = S.Normalizer(sentencepiece_model_pb2.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec)
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice(" aﬁ①Ａé　ガｶﾞ㍿\n​") for _ in range(rng.randrange(30)))
        out, source = mine.normalize(text)
        assert out.decode() == library.normalize(text)
        assert len(source) == len(out) + 1 and source == sorted(source) and source[-1] <= len(text.encode())


def test_operator_keeps_rows(docs, rows, no_docs, processor):
    got = S.encode(docs, tokenizer_model()).collect()
    assert len(got) == len(rows)
    text_of = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            assert r.ids == processor.encode(text_of[r.doc_id])
            assert r.decoded == processor.decode(r.ids)
            assert not r.ends or r.ends[-1] == len(text_of[r.doc_id].encode())
    assert S.encode(no_docs, tokenizer_model(), results=S.digest, schema=S.DIGEST).collect() == []
