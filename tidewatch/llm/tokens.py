"""Token ids of whole texts, with the vocabulary files of public tokenizers."""

from __future__ import annotations

import gc
import os
from array import array
from contextlib import contextmanager
from functools import lru_cache

import numpy as np

#: A character that is no white space, letter or digit; it marks the borders between words.
MARK = "\x01"
TAIL = ".,!?;:|#$%&*()"


def _folded(text: str) -> str:
    """The text in lower case if all its letters are Latin-1, where every library folds case alike."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


@contextmanager
def _no_cycles():
    """Without the search for cyclic garbage: strings and bytes form none, and each search would walk all remembered words."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(256 + k) for k, byte in enumerate(others)}


BYTE_LETTERS = _byte_letters()
#: The lower-case letters beyond ASCII that every library folds alike.
LATIN = "".join(c for c in map(chr, range(128, 256)) if c.isalpha() and c == c.lower())


def _as_bytes(core: str) -> str:
    """A word as byte-level vocabularies spell it."""
    return core.encode("utf-8").decode("latin-1").translate(BYTE_LETTERS)


class WordBytes(dict):
    """Ids of words as bytes, learnt when a word is first asked for.

    Beyond ``remember`` words a new generation begins, to which the last one's words return when they are met again: words
    that occur often are kept, the memory is two generations.
    """

    def __init__(self, learn, remember: int):
        super().__init__()
        self.learn, self.remember, self.last = learn, remember, {}

    def __missing__(self, word: str) -> bytes:
        found = self.last.get(word)
        if found is None:
            found = self.learn(word)
        if len(self) >= self.remember:
            self.last = dict(self)
            self.clear()
        self[word] = found
        return found


class WordTokenizer:
    """Encodes texts word by word and remembers the words.

    Serves vocabularies that drop white space before they split a text, so a text's ids are its
    words' ids in order. What the tokenizers library returns for a word is kept (``WordBytes``), so the
    memory is bounded by twice ``remember`` words. Other vocabularies (``by_word`` is false) get whole texts.
    """

    def __init__(self, path: str, remember: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.known = WordBytes(self._learn, remember)
        alone, mark = (self._ids(text) for text in ("Ab", MARK))
        # Probes whether white space is dropped, case folded and punctuation split off.
        self.by_word = len(mark) == 1 and self._ids(f"Ab {MARK} ab.\n Ab") == [*alone, *mark, *alone, *self._ids("."), *alone]
        # And whether letters beyond ASCII are spelt by their bytes.
        probes = [LATIN, *LATIN, *(f"a{c}b" for c in LATIN)]
        self.by_byte = self.by_word and all(self._ids(x.upper() if x.upper().lower() == x else x) == self._core(_as_bytes(x)) for x in probes)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _core(self, core: str) -> list[int]:
        return [token.id for token in self.model.tokenize(core)]

    def _bytes(self, ids) -> bytes:
        return array(self.kind, ids).tobytes()

    def _learn(self, word: str) -> bytes:
        """The ids of a word.

        Letters alone are one word of the vocabulary's own splitting, and so is the punctuation behind them; such
        words go straight to the library's merges. These are a-z, and those of Latin-1 where they are spelt by bytes.
        """
        core = word.rstrip(TAIL)
        if not core.isalpha() or not (core.isascii() or self.by_byte and max(core) <= "\xff"):
            return self._bytes(self._ids(word))
        lower = core.lower()
        if lower != word:
            return self.known[lower] + self.known[word[len(core):]]
        return self._bytes(self._core(core if core.isascii() else _as_bytes(core)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids (``dtype``) of every text."""
        if not self.by_word:
            return [self._bytes(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = self.known.__getitem__
        with _no_cycles():
            return [b"".join(map(ids, _folded(text).replace("\n", " ").split(" "))) for text in texts]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker."""
    return WordTokenizer(path)


def default_vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
