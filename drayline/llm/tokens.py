"""Token ids of whole texts with a tokenizers vocabulary, word by word.

The vocabulary's merges never cross white space, so the ids of a text are the
ids of its space-separated words one after another.  A worker tokenises each
different word once and keeps its ids in two generations: when the younger is
full it becomes the elder, and words that are met again move back.  The cache is
bounded, and what it holds changes the speed only.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct

import numpy as np

#: Words and characters of one generation of the cache.
CACHED_WORDS = 200_000
CACHED_CHARS = 16 << 20
#: Characters of text that are words side by side at a time; so few that the words stay in the processor's caches.
LOT_CHARS = 1 << 16
WORDS_AT_A_TIME = 500
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Signs at the end of a word of Latin letters are always a token run of their own; an apostrophe may belong to letters.
_SIGNED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)")
#: Stands for the end of a word in the byte form of the vocabulary; no UTF-8 text holds this byte.
_WORD_END = b"\xff"


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    Words of Latin letters only are lower-cased here and go through the same
    merges without the normaliser and the splitting pattern, which leave them
    as they are; all other words go through the whole tokenizer.  Where ids
    and merges of the vocabulary are in one order, the merges are made by rank over
    bytes, with one more byte for the end of a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.plain.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        self.closing[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.shortcut = bool(suffix)
        self.ranked = self._ranked(path, suffix)
        self.packs = [struct.Struct(f"<{n}I").pack for n in range(65)]
        #: Added tokens are matched in the text as it is, so a text that holds one in any case is not lower-cased.
        self.special = [x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        self.elder: dict[str, bytes] = {}
        self.held = 0

    def _ranked(self, path: str, suffix: str):
        """The merges as byte ranks, ``None`` where ids and merges are not in one order."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        alphabet = [*plain, *(b for b in range(256) if b not in set(plain))]
        signs = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(alphabet[len(plain) :])}
        bases = [vocabulary.get(c) for c in signs] + [vocabulary.get(c + suffix) for c in signs]
        in_order = all(vocabulary.get("".join(m)) == 512 + i for i, m in enumerate(merges))
        if not suffix or sorted(x for x in bases if x is not None) != list(range(512)) or not in_order or model.get("ignore_merges"):
            return None
        ranks = {}
        for token, i in vocabulary.items():
            if i < 512 + len(merges):
                end = token.endswith(suffix) and token != suffix
                ranks[bytes(signs[c] for c in (token.removesuffix(suffix) if end else token)) + (_WORD_END if end else b"")] = i
        if len(ranks) != 512 + len(merges):
            return None
        return tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def _learn(self, words: list[str]) -> None:
        """Make ``known`` hold these words, none of which it or ``elder`` has."""
        if self.shortcut:
            signed = [m for m in map(_SIGNED.fullmatch, words) if m]
            if signed:
                self._find({x for m in signed for x in m.groups()})
                known = self.known
                known.update((m.string, known[m[1]] + known[m[2]]) for m in signed)
                words = [w for w in words if w not in known]
        latin = [w for w in words if _LATIN.fullmatch(w)] if self.shortcut else []
        simple = set(latin)
        other = [w for w in words if w not in simple] if simple else words
        for at in range(0, len(other), WORDS_AT_A_TIME):
            part = other[at : at + WORDS_AT_A_TIME]
            for word, made in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[word] = np.array(made.ids, dtype="<u4").tobytes()
        if self.ranked is not None:
            merge, pack = self.ranked.encode_single_piece, self.packs
            for word in latin:
                ids = merge(word.lower().encode() + _WORD_END)
                self.known[word] = pack[len(ids)](*ids) if len(ids) < 64 else np.array(ids, dtype="<u4").tobytes()
            return
        for at in range(0, len(latin), WORDS_AT_A_TIME):
            part = latin[at : at + WORDS_AT_A_TIME]
            made = self.plain.encode_batch_fast([" ".join(part).lower()], add_special_tokens=False)
            ids = np.array(made[0].ids, dtype="<u4")
            raw, begin = ids.tobytes(), 0
            for word, end in zip(part, (np.flatnonzero(self.closing[ids]) + 1).tolist(), strict=True):
                self.known[word] = raw[4 * begin : 4 * end]
                begin = end

    def _find(self, words: set[str]) -> None:
        """Make ``known`` hold these words, from ``elder`` where that has them."""
        new = words.difference(self.known)
        again = self.elder.keys() & new
        self.known.update((w, self.elder[w]) for w in again)
        self._learn(list(new - again))
        self.held += sum(map(len, new))

    def encode(self, texts: list[str]) -> list[bytes]:
        made = dict.fromkeys(texts, b"")  # equal texts once
        lot, size = [], 0
        for text in made:
            lot.append(text)
            size += len(text)
            if size >= LOT_CHARS:
                self._encode(lot, made)
                lot, size = [], 0
        self._encode(lot, made)
        return [made[text] for text in texts]

    def _encode(self, texts: list[str], made: dict[str, bytes]) -> None:
        if len(self.known) > CACHED_WORDS or self.held > CACHED_CHARS:
            self.elder, self.known, self.held = self.known, {"": b""}, 0
        split = []
        for text in texts:
            plain = text
            if text.isascii():
                lower = text.lower()
                if not any(x in lower for x in self.special):
                    plain = lower
            split.append(plain.replace("\n", " ").split(" "))
        self._find(set().union(*split))
        look = self.known.__getitem__
        for text, words in zip(texts, split, strict=True):
            made[text] = b"".join(map(look, words))


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One encoder for each vocabulary and worker."""
    return WordEncoder(path)
