"""Token ids of words without white space, each distinct word and pre-token encoded once.

A tokenizer that normalises by NFC, white space and lower case and cuts words
by one pattern is taken apart: distinct words are cut together, by the pattern
of its own file, and only distinct pre-tokens go through its merges. Words with
characters whose case or class is not the same in all Unicode versions (beyond
Latin letters), and words of other tokenizers, go through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex

from tickflow.llm.arrow_text import gather, objects, words_of

# Printable characters up to Latin Extended-B: NFC leaves them alone, and none is white space.
_TOGETHER = 1024  # parts encoded in one call
_PLAIN = regex.compile("[\x21-\x7e\xa1-ɏ]+")
# Fixed value: contractions, runs of letters, single digits, runs of other signs.
_LETTERS_OR_SIGNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NFC_SPACE_LOWER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def cutting_pattern(path: str) -> str | None:
    """The pattern that cuts normalised words, if the tokenizer is of the kind described above."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or []
    if (spec["normalizer"] or {}).get("normalizers") != _NFC_SPACE_LOWER or len(steps) != 2:
        return None
    cut, to_bytes = steps
    kept = cut["type"] == "Split" and cut["behavior"] == "Removed" and cut["invert"]
    plain = to_bytes["type"] == "ByteLevel" and not to_bytes["add_prefix_space"] and not to_bytes["use_regex"]
    return cut["pattern"].get("Regex") if kept and plain else None


class _Runs:
    """Runs of token ids by key. Up to `most` keys are remembered from one call to the next."""

    def __init__(self, most: int):
        self.most = most
        self.known: dict = {}
        self.firsts, self.lengths, self.tokens = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def look_up(self, keys: list, encode) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct keys: where their tokens start, how many they are, and the array these are in."""
        known = len(self.firsts)
        at = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(at < 0)
        unknown = [keys[i] for i in new.tolist()]
        more, ids = encode(unknown)
        lengths = np.concatenate([self.lengths, more])
        firsts = np.concatenate([self.firsts, np.cumsum(more) - more + len(self.tokens)])
        tokens = np.concatenate([self.tokens, ids])
        at[new] = known + np.arange(len(new))
        if known + len(new) <= self.most:
            self.known.update(zip(unknown, range(known, known + len(new))))
            self.firsts, self.lengths, self.tokens = firsts, lengths, tokens
        return firsts[at], lengths[at], tokens


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return lengths, np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))


class WordTokens:
    """Up to `most` words and as many pre-tokens are remembered from one run of documents to the next."""

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer, pre_tokenizers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # Parts go through the merges many at a time, a line each; where words have an end of their own, it tells lines apart.
        self.lines = Tokenizer.from_file(path)
        self.lines.encode_special_tokens = True
        self.lines.normalizer = None
        self.lines.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), self.as_bytes])
        suffix = getattr(self.lines.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.lines.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for token, i in self.lines.get_vocab().items() if token.endswith(suffix)]] = True
        pattern = cutting_pattern(path)
        self.cut = regex.compile(rf"\n|{pattern}") if pattern else None
        # With this pattern a sign behind a letter or digit is a part of its own, and case does not count.
        self.apart = b".,;:!?" if pattern == _LETTERS_OR_SIGNS else b""
        self.words, self.parts = _Runs(most), _Runs(most)

    def units_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """`words_of` the texts, cut further where that leaves the tokens as they are, so that fewer are distinct."""
        return words_of(texts, lower=bool(self.apart), apart=self.apart)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.words.look_up(words, lambda unknown: self.encode([w.decode() for w in unknown]))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens, and the tokens."""
        if not words or self.cut is None:
            return self._whole(words)
        if _PLAIN.fullmatch("".join(words)):
            return self._cut(words)
        plain = np.fromiter((_PLAIN.fullmatch(w) is not None for w in words), bool, len(words))
        sorts = [np.flatnonzero(plain), np.flatnonzero(~plain)]
        done = [how([words[i] for i in at.tolist()]) for how, at in zip((self._cut, self._whole), sorts)]
        lengths, firsts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        before = 0
        for at, (n, ids) in zip(sorts, done):
            lengths[at], firsts[at] = n, np.cumsum(n) - n + before
            before += len(ids)
        return lengths, np.concatenate([ids for _, ids in done])[gather(firsts, lengths)]

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.whole.encode_batch_fast(words, add_special_tokens=False)])

    def _cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return _flat([])
        # Lower case character by character: a final sigma is no exception there.
        parts = pa.array(self.cut.findall("\n".join(words).replace("Σ", "σ").lower() + "\n"), pa.large_string())
        coded = parts.dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), objects(coded.dictionary)
        end = distinct.index("\n")
        distinct[end] = ""
        firsts, lengths, tokens = self.parts.look_up(distinct, self._merged)
        runs = lengths[codes]
        per_word = np.diff(np.cumsum(runs)[codes == end], prepend=0)
        return per_word, tokens[gather(firsts[codes], runs)]

    def _merged(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        groups = [parts[i:i + _TOGETHER] for i in range(0, len(parts), _TOGETHER)]
        encoded = self.lines.encode_batch_fast(["\n".join(group) for group in groups], add_special_tokens=False)
        lengths, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for group, line in zip(groups, encoded):
            ids = np.array(line.ids, np.uint32)
            last = np.flatnonzero(self.ends[ids])
            there = np.array([part != "" for part in group])
            if len(last) == there.sum():
                each = np.zeros(len(group), np.int64)
                each[there] = np.diff(last, prepend=-1)
            else:
                each, ids = _flat([e.ids for e in self.lines.encode_batch_fast(group, add_special_tokens=False)])
            lengths.append(each)
            tokens.append(ids)
        return np.concatenate(lengths), np.concatenate(tokens)


_LOADED: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]
