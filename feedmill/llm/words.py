"""Token ids of texts by a word-level tokenizer file, each distinct word encoded once per worker."""

from __future__ import annotations

import os

import numpy as np

CACHE_WORDS = 500_000
BATCH_WORDS = 30_000
WORD_END = "</w>"


class Known(dict):
    """Ids by word. A word that is not there is noted and stands as a hole, empty until its ids are put in."""

    def __init__(self, *args):
        super().__init__(*args)
        self.holes: dict[bytes, bytearray] = {}

    def __missing__(self, word: bytes) -> bytearray:
        return self.holes.setdefault(word, bytearray())


class WordEncoder:
    """Encodes texts by a tokenizer that drops white space and never joins words across it.

    Such a tokenizer's ids for a text are those of its white-space-separated parts in turn, so parts
    are looked up in a table; when it holds ``cache_words``, only those of the texts at hand stay. Parts are cut only at ASCII
    white space; any other kind stays inside a part for the tokenizer itself to drop.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cache = Known()
        self.cache_words = cache_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, many encoded as one text and cut after each word's last id."""
        groups = [words[at : at + 100] for at in range(0, len(words), 100)]
        out: list[bytes] = []
        for group, found in zip(groups, self._each([" ".join(g) for g in groups])):
            ends = np.flatnonzero(self.ends_word[np.frombuffer(found, "<u4")]) + 1
            if ends.size != len(group) or 4 * ends[-1] != len(found):
                out += self._each(group)  # folding the case of some letter has split its word
                continue
            cuts = (4 * ends).tolist()
            out += [found[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]
        return out

    def _learn(self, fresh: list[bytes]) -> None:
        """Encode new words. A letter and the punctuation behind it never share a token."""
        tailed, need = [], set()
        for word in fresh:
            core = word.rstrip(b".,;:!?")
            if len(core) < len(word) and core and core.decode()[-1].isalpha():
                tailed.append((word, core))
                need.add(core)
            else:
                need.add(word)
        texts = [w.decode() for w in need.difference(self.cache)]
        letters = [t for t in texts if t.isalpha()]
        odd = [t for t in texts if not t.isalpha()]
        self.cache.update(zip(map(str.encode, letters), self._together(letters)))
        self.cache.update(zip(map(str.encode, odd), self._each(odd)))
        tails = list({w[len(c) :] for w, c in tailed})
        ids = dict(zip(tails, self._each([t.decode() for t in tails])))
        self.cache.update((w, self.cache[c] + ids[w[len(c) :]]) for w, c in tailed)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [t.split() for t in texts]
        if len(self.cache) > self.cache_words:
            self.cache = Known({w: self.cache[w] for w in set().union(*parts).intersection(self.cache)})
        self.cache.holes = holes = {}
        found = [list(map(self.cache.__getitem__, p)) for p in parts]  # one look-up a word, new ones as holes
        fresh = list(holes)
        for at in range(0, len(fresh), BATCH_WORDS):
            self._learn(fresh[at : at + BATCH_WORDS])
        for word, hole in holes.items():
            hole += self.cache[word]
        self.cache.holes = {}
        return [b"".join(ids) for ids in found]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
