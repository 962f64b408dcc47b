"""Token ids of whole texts. Each distinct word is tokenized once per worker, then looked up."""

from __future__ import annotations

import os

import numpy as np

from .words import find_words

#: Words that a worker keeps at most (about 60 bytes each).
CACHE_WORDS = 1_000_000


class WordTokenizer:
    """Ids of texts by a tokenizer whose tokens never cross white space ``[\\x20\\x09-\\x0D]``, which it drops,
    and which lower-cases: the ids of a text are those of its words, one after the other.

    Words are cut further between an ASCII letter and ASCII punctuation other than an apostrophe, where such
    a tokenizer always cuts. Texts that may hold a special token (with ``<|``) are neither cut nor lower-cased.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # hashes of known words, sorted
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        pool = np.fromiter((i for one in ids for i in one), np.uint32, int(lengths.sum()))
        if len(self.keys) + len(keys) > CACHE_WORDS:
            self._clear()
        keys = np.concatenate([self.keys, keys])
        starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
        lengths = np.concatenate([self.lengths, lengths])
        self.pool = np.concatenate([self.pool, pool])
        order = np.argsort(keys)
        self.keys, self.starts, self.lengths = keys[order], starts[order], lengths[order]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by id 0, and the edges between the texts."""
        plain = not any(b"<|" in t for t in texts)
        words = find_words(texts, lower=plain, cut=plain)
        unique, index = np.unique(words.hashes, return_inverse=True)
        place = np.zeros(len(unique), np.int64)
        place[index] = np.arange(len(index))
        known = np.isin(unique, self.keys, assume_unique=True)
        if not known.all():
            new = unique[~known]
            spans = zip(words.starts[place[~known]].tolist(), words.ends[place[~known]].tolist())
            strings = [str(words.raw[a:b], "utf-8") for a, b in spans]
            if len(self.keys) + len(new) > CACHE_WORDS:  # the old ones go: all words of these texts are needed
                self._clear()
                spans = zip(words.starts[place].tolist(), words.ends[place].tolist())
                new, strings = unique, [str(words.raw[a:b], "utf-8") for a, b in spans]
            self._learn(new, strings)
        at = np.searchsorted(self.keys, unique)[index]
        lengths = self.lengths[at]
        total = int(lengths.sum())
        doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
        doc_of_id = np.repeat(doc, lengths)
        source = np.arange(total) + np.repeat(self.starts[at] - (np.cumsum(lengths) - lengths), lengths)
        ids = np.zeros(total + len(texts), np.uint32)
        ids[np.arange(total) + doc_of_id] = self.pool[source]
        per_doc = np.bincount(doc_of_id, minlength=len(texts)) + 1
        return ids, np.concatenate([[0], np.cumsum(per_doc)])


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for this vocabulary file."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]
