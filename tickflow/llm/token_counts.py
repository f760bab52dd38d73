"""Token counts by a unigram model, with the forward scores of shared prefixes computed once.

Pre-tokens are the words between white space, each behind a word mark. The
distinct pre-tokens of a run of documents are sorted, which lays them out as a
trie: a word shares its nodes with the word before it as far as they agree. The
forward recursion runs over the trie level by level, for all nodes of a level
at once: the best score of a prefix is the best over all pieces that may end
there, of the score where the piece starts plus the piece's. Each node keeps
the number of tokens on its best path; the number at a word's last node is the
word's count, and a document adds up its words' counts.

Of equally good paths the one with fewer tokens counts. A character that no
piece covers costs `unknown` below the least score and is as many tokens as it
has UTF-8 bytes (byte fallback). The vocabulary file is a parameter; if it
holds merge ranks in place of log probabilities, pieces get Zipf's.

Words are laid out in three tries by length (12, 24 and 64 characters); the few
that are longer go through the same recursion one by one. No rows move between
tasks and a task holds one run of documents.

Defined cases: a null or empty text has 0 words and 0 tokens; a null doc_id is
carried through; repeated rows are counted alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.arrow_text import slices, words_of

MARK = "▁"
_UNKNOWN = 10.0
_SLICE_BYTES = 4 << 20
_WIDTHS = (12, 24, 64)  # words are laid out with others of about their length
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def public_pieces(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def piece_scores(path: str) -> dict[str, float]:
    """Pieces and their log probabilities."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
    if all(float(s).is_integer() for s in scores.values()):
        ranked = sorted(scores, key=lambda p: (-scores[p], p))
        total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
        scores = {p: -math.log(r) - total for r, p in enumerate(ranked, 1)}
    return scores


def _code_points(words: list[str], width: int) -> np.ndarray:
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


class UnigramCounts:
    def __init__(self, scores: dict[str, float]):
        pieces = list(scores)
        self.longest = max(map(len, pieces))
        self.unknown = min(scores.values()) - _UNKNOWN
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array([scores[p] for p in pieces])[order]
        assert (np.diff(self.keys) > 0).all(), "two pieces share a hash"
        self.powers = np.array([pow(int(_BASE), i, 1 << 64) for i in range(max(self.longest, max(_WIDTHS)) + 2)], np.uint64)
        self.by_piece = scores

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
        return h

    def _look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Scores of pieces, minus infinity where there is none."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.scores[at], -np.inf)

    def counts(self, words: list[str]) -> np.ndarray:
        """Numbers of tokens of distinct words."""
        out = np.zeros(len(words), np.int64)
        marked = [MARK + w for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        low = 0
        for width in _WIDTHS:
            mine = np.flatnonzero((sizes > low) & (sizes <= width))
            if len(mine):
                out[mine] = self._over_trie([marked[i] for i in mine], width)
            low = width
        for i in np.flatnonzero(sizes > low):
            out[i] = self._one(marked[i])
        return out

    def _over_trie(self, words: list[str], width: int) -> np.ndarray:
        order = np.array(sorted(range(len(words)), key=words.__getitem__))
        chars = _code_points([words[i] for i in order], width)
        sizes = np.array([len(words[i]) for i in order])
        alike = np.logical_and.accumulate(chars[1:] == chars[:-1], axis=1).sum(axis=1)
        shared = np.append(0, np.minimum(alike, sizes[:-1]))  # characters in common with the word before
        # node[t][w]: the node of word w after t characters; level 0 is the root.
        node = [np.zeros(len(words), np.int64)]
        score, tokens, prefix = [np.zeros(1)], [np.zeros(1, np.int64)], [np.zeros(1, np.uint64)]
        for t in range(1, int(sizes.max()) + 1):
            new = (shared < t) & (sizes >= t)
            node.append(np.maximum(np.cumsum(new) - 1, 0))
            word = np.flatnonzero(new)
            here = prefix[t - 1][node[t - 1][word]] * _BASE + chars[word, t - 1] + np.uint64(1)
            prefix.append(here)
            best, count = np.full(len(word), -np.inf), np.zeros(len(word), np.int64)
            for size in range(1, min(t, self.longest) + 1):
                start = node[t - size][word]
                piece = self._look_up(here - prefix[t - size][start] * self.powers[size])
                step = 1
                if size == 1:
                    bare = np.isneginf(piece)
                    piece = np.where(bare, self.unknown, piece)
                    step = np.where(bare, _utf8_length(chars[word, t - 1]), 1)
                total, through = score[t - size][start] + piece, tokens[t - size][start] + step
                better = (total > best) | ((total == best) & (through < count))
                best, count = np.where(better, total, best), np.where(better, through, count)
            score.append(best)
            tokens.append(count)
        out = np.zeros(len(words), np.int64)
        for t in range(1, len(node)):
            ends = np.flatnonzero(sizes == t)
            out[order[ends]] = tokens[t][node[t][ends]]
        return out

    def _one(self, word: str) -> int:
        """The same for a single, very long word."""
        best = [(0.0, 0)]
        for t in range(1, len(word) + 1):
            found = []
            for size in range(1, min(t, self.longest) + 1):
                piece, step = self.by_piece.get(word[t - size:t]), 1
                if piece is None:
                    if size > 1:
                        continue
                    piece, step = self.unknown, len(word[t - 1].encode())
                before, tokens = best[t - size]
                found.append((-(before + piece), tokens + step))
            least = min(found)
            best.append((-least[0], least[1]))
        return best[-1][1]


def _utf8_length(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


_LOADED: dict[str, UnigramCounts] = {}


def _counter(path: str) -> UnigramCounts:
    """One per worker process."""
    if path not in _LOADED:
        _LOADED[path] = UnigramCounts(piece_scores(path))
    return _LOADED[path]


def _count(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _SLICE_BYTES):
            counts, codes, distinct = words_of(batch.column("text"))
            each = _counter(path).counts([w.decode() for w in distinct.to_pylist()])
            running = np.append(0, np.cumsum(each[codes]))
            ends = np.cumsum(counts)
            tokens = running[ends] - running[ends - counts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(tokens)], names=["doc_id", "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return texts.mapInArrow(_count(vocabulary or public_pieces()), "doc_id long, n_words long, n_tokens long")
