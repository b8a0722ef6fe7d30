import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402

from drayline.llm import sentencepiece_codec  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(MODEL)


def brute(codec, text):
    n = len(text)
    best, back = [0.0] + [None] * n, [0] * (n + 1)
    for i in range(n):
        single = False
        for j in range(i + 1, n + 1):
            if text[i:j] in codec.pieces:
                single |= j == i + 1
                total = best[i] + codec.pieces[text[i:j]][0]
                if best[j] is None or total > best[j]:
                    best[j], back[j] = total, i
        if not single and (best[i + 1] is None or best[i] + codec.unknown > best[i + 1]):
            best[i + 1], back[i + 1] = best[i] + codec.unknown, i
    return codec._path(text, back, 0, n)


def test_search_against_whole_table(codec, monkeypatch):
    rnd = random.Random(3)
    signs = ["a", "the", "ing", "▁", "▁▁▁", "é", "漢", "\n", "tion", "x", "\U0001f600"]
    for every in (64, 3):
        monkeypatch.setattr(sentencepiece_codec, "LOOK_EVERY", every)
        for _ in range(60):
            text = "".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 150)))
            assert codec.search(text) == brute(codec, text)


def test_window_is_bounded(codec):
    seen = []
    original = codec._convergence

    def spy(score, back, base, at):
        seen.append(len(score))
        return original(score, back, base, at)

    codec._convergence = spy
    try:
        codec.search("thequickbrown" * 3000)
    finally:
        del codec._convergence
    assert len(seen) > 400 and max(seen) < 1000


def test_never_below_the_library_as_unigram_model(codec):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    scores = [p.score for p in model.pieces]
    model.trainer_spec.model_type = 1  # unigram: the library then looks for a large score too
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    rnd, same = random.Random(5), 0
    parts = ["the", "er", "nd", "ion", "é", "sch", "q", "ing", "ou", "st", "heit", "la", "we"]
    for _ in range(400):
        word = "".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 5)))
        ours, other = np.frombuffer(codec.encode(word), "<u4").tolist(), library.encode(word)
        assert sum(scores[i] for i in ours) >= sum(scores[i] for i in other)
        same += ours == other
    assert same > 200


def test_round_trip(codec, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    monkeypatch.setattr(sentencepiece_codec, "CACHED_STRETCHES", 5)
    for text in ["", " ", "  two  spaces ", "line\nbreak\ttab", "漢字 😀 é", "x" * 5000, "\x00\x01"]:
        ids = codec.encode(text)
        assert codec.decode(ids) == text == library.decode(np.frombuffer(ids, "<u4").tolist())
    for text in ["Ordinary text, as usual.", "ümläut"]:
        assert codec.decode(np.array(library.encode(text), "<u4").tobytes()) == text


def test_documents(spark, messy, nothing):
    got = sentencepiece_codec.round_trip(messy, MODEL).collect()
    assert len(got) == 10 and all(r.same_text for r in got) and {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    back = sentencepiece_codec.decode_documents(sentencepiece_codec.encode_documents(messy, MODEL, ids_col="block"), MODEL, "block").collect()
    assert all(r.decoded == r.text for r in back)
    assert sentencepiece_codec.round_trip(nothing, MODEL).collect() == []
