import collections
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from drayline.llm import range_coder, token_files, tokens  # noqa: E402
from drayline.llm.packing import TournamentTree, first_fit_decreasing, pack_documents  # noqa: E402
from drayline.session import RunFolder  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def test_word_by_word_equals_whole_text(tokenizer, monkeypatch):
    encoder = tokens.WordEncoder(VOCABULARY)
    rnd = random.Random(1)
    signs = [*"abZÉéßſK İıσςΣ́  \x1c\x0b\t\r\n.,,'’!?0١漢 語", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", " ", "ẞ", "한하", "Word", "word,", "word. "]
    for k in range(1500):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 30)))
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        if k == 700:
            monkeypatch.setattr(tokens, "CACHED_WORDS", 10)


def test_byte_ranks_make_the_same_merges(tokenizer):
    encoder = tokens.WordEncoder(VOCABULARY)
    assert encoder.ranked is not None
    words = [w for t in tokenizer.get_vocab() if tokens._LATIN.fullmatch(w := t.removesuffix("</w>"))]
    rnd = random.Random(8)
    words += ["".join(rnd.choice("aeiourstnlßéÀzqx") for _ in range(rnd.randrange(1, 25))) for _ in range(3000)]
    words += [w + p for w in words[::40] for p in (".", ",", "..", "1.")]
    for at in range(0, len(words), 500):
        part = words[at : at + 500]
        expected = [x.ids for x in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(part)] == expected


def test_special_tokens_in_another_case(tokenizer):
    encoder = tokens.WordEncoder(VOCABULARY)
    for sign in ("<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|STARTOFTEXT|>"):
        for text in (sign, f"One Word {sign} and Another, one.", f"Word{sign}Word {sign.lower()} é", f"Word{sign}word {sign.lower()}\nEnd."):
            assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_tournament_tree_is_first_fit():
    rnd = random.Random(2)
    lengths = np.array([rnd.randrange(1, 40) for _ in range(300)])
    got, offset = first_fit_decreasing(lengths, 40)
    room, expected = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        at = next((k for k, r in enumerate(room) if r >= lengths[i]), None)
        if at is None:
            at, room = len(room), [*room, 40]
        expected[i] = (at, 40 - room[at])
        room[at] -= lengths[i]
    assert {i: (got[i], offset[i]) for i in range(300)} == expected
    assert TournamentTree(1, 5).place(5) == 0


@pytest.mark.parametrize("group_rows", [20_000, 7])
def test_packing_keeps_every_id(spark, run, tokenizer, messy, group_rows):
    rows = [(100 + i, "word " * (37 * i % 90)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pack_documents(docs, run, VOCABULARY, capacity=64, group_rows=group_rows).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in rows:
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            piece = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(piece), piece)
            at += r.length
        assert at == len(ids)
    for sequence in by_sequence.values():
        at = 0
        for r in sorted(sequence, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64


def test_packing_messy_and_empty(messy, nothing, run, spark):
    got = pack_documents(messy, run, VOCABULARY, want_ids=False).collect()
    assert len({(r.doc_id, r.start, r.sequence_id, r.offset) for r in got}) == len(got)
    assert [r.length for r in got if r.doc_id in (1, 2, 3)] == [1, 1, 1] and sum(r.doc_id == 5 for r in got) == 2
    assert "block" in got[0].asDict()
    other = RunFolder(spark, "test")
    assert pack_documents(nothing, other, VOCABULARY).collect() == []
    other.close()


@pytest.mark.parametrize("n", [0, 1, 5, 8192, 8193, 20000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 65536, n), np.minimum(rng.geometric(0.01, n), 49407), np.zeros(n, int), np.tile(rng.integers(0, 50000, 50), n // 50 + 1)[:n]):
        coded = range_coder.encode(ids)
        assert (range_coder.decode(coded) == ids).all()
    if n > 8000:
        assert len(coded) < n / 2  # what repeats costs little


def test_coder_notices_damage():
    ids = np.random.default_rng(0).integers(0, 50000, 9000)
    coded = range_coder.encode(ids)
    with pytest.raises(ValueError):
        range_coder.encode(np.array([70000]))
    for bad in (b"", b"XXXX" + coded[4:], coded[:-2], coded[:200], coded[:60] + bytes([coded[60] ^ 1]) + coded[61:]):
        with pytest.raises(range_coder.Corrupt):
            range_coder.decode(bad)


def test_blocks_stand_alone():
    ids = np.tile(np.arange(300), 60)[:16384]
    assert range_coder.encode(ids)[12 + 24 :] == range_coder.encode(ids[:8192])[12 + 12 :] + range_coder.encode(ids[8192:])[12 + 12 :]


def test_coder_models_the_ids_themselves():
    """Ids drawn without any order cost little more than their entropy; magnitude classes alone cost over a bit more."""
    rng = np.random.default_rng(5)
    frequent = rng.permutation(49000)[:300]
    share = 1 / np.arange(1, 301)
    ids = rng.choice(frequent, 5 * 8192 + 100, p=share / share.sum())
    coded = range_coder.encode(ids)
    assert (range_coder.decode(coded) == ids).all()
    entropy = -(share / share.sum() * np.log2(share / share.sum())).sum()
    assert 8 * len(coded) / len(ids) < entropy + 1.2


def test_coder_extremes_side_by_side():
    """Blocks of all new ids, of one id, of a cycle and of long memory in one group, and one that ends early."""
    rng = np.random.default_rng(6)
    blocks = [rng.permutation(65536)[:8192], np.full(8192, 65535), np.tile(np.arange(65536 - 64, 65536), 128), np.arange(8192) * 8, np.zeros(8192, int)]
    ids = np.concatenate([*blocks, *blocks, rng.integers(0, 65536, 777)])
    coded = range_coder.encode(ids)
    assert (range_coder.decode(coded) == ids).all()
    alone = [range_coder.encode(b)[24:] for b in blocks]
    assert coded[12 + 12 * 11 :].startswith(b"".join(alone + alone))  # the same bytes as alone
    assert len(alone[1]) < 900 and len(alone[4]) < 900
    for seed in range(12):  # damage anywhere in the words is noticed
        at = 12 + 12 * 11 + int(np.random.default_rng(seed).integers(0, len(coded) - 12 - 12 * 11 - 6))
        with pytest.raises(range_coder.Corrupt):
            range_coder.decode(coded[:at] + bytes([coded[at] ^ (1 << seed % 8)]) + coded[at + 1 :])


@pytest.mark.parametrize("block_ids", [1, 100, 9000])
def test_coder_block_sizes(block_ids, monkeypatch):
    monkeypatch.setattr(range_coder, "LANES", 7)
    rng = np.random.default_rng(block_ids)
    ids = np.minimum(rng.geometric(0.002, 9 * block_ids + 3), 49407)
    assert (range_coder.decode(range_coder.encode(ids, block_ids)) == ids).all()


@pytest.mark.parametrize("partition_bytes,segment", [(400, 50), (1 << 25, 1 << 23)])
def test_token_files(spark, run, tokenizer, monkeypatch, partition_bytes, segment):
    monkeypatch.setattr(token_files, "PARTITION_BYTES", partition_bytes)
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment)
    rows = [((7 * i) % 101, None if i == 3 else "some words " * (i % 9)) for i in range(101)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, token_files.round_trip(docs, run, VOCABULARY).collect()))
    expected, at = [], 0
    for doc, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        raw = np.array(ids, "<u4").tobytes()
        expected.append((doc, at, len(ids), zlib.crc32(raw), bytearray(raw)))
        at += len(ids)
    assert got == expected


def test_token_files_messy_and_empty(messy, nothing, run, spark):
    got = token_files.round_trip(messy, run, VOCABULARY, want_ids=False).collect()
    assert len(got) == 10 and min(r.start for r in got) == 0 and [r.start for r in got if r.doc_id is None] == [0]
    other = RunFolder(spark, "test")
    assert token_files.round_trip(nothing, other, VOCABULARY).collect() == []
    other.close()
