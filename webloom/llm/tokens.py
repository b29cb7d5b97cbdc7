"""Token ids of whole texts, each distinct word tokenised once per Python worker.

The tokenizer splits at white space and drops it, so the ids of a text are the ids
of its words in a row. A word's ids are kept as bytes, and a text's ids are one
``bytes.join``. ``word_ids`` asks the tokenizer itself unless the word is made of
plain Latin letters and signs, for which its steps (lower case, split pattern,
bytes, merges) are short enough to call one by one. Both caches are emptied when
they reach ``CACHE_WORDS``, which bounds a worker's memory.
"""

from __future__ import annotations

import re

CACHE_WORDS = 400_000
LONGEST_CACHED = 64

# Latin letters and signs below U+0180 without controls and white space: canonical
# composition leaves them as they are, and lower case needs no context.
_PLAIN = re.compile("[!-~¡-įĲ-ſ]+")
# The split pattern of the tokenizer file, for the characters above.
_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d"
    "|[A-Za-zªµºÀ-ÖØ-öø-ſ]+"
    "|[0-9²³¹¼-¾]"
    "|[^0-9A-Za-zª²³µ¹º¼-¾"
    "À-ÖØ-öø-ſ]+"
)
_SPECIAL = "<|"


def byte_characters() -> dict[int, int]:
    """How byte-level vocabularies write a byte: itself if visible, else from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + k for k, b in enumerate(hidden)}


class WordTokens:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.characters = byte_characters()
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def _bytes(ids) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            text = piece
            if not piece.isascii():
                text = piece.encode().decode("latin-1").translate(self.characters)
            found = self._bytes([t.id for t in self.model.tokenize(text)])
            self.pieces[piece] = found
        return found

    def word_ids(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if len(word) <= LONGEST_CACHED and _PLAIN.fullmatch(text) and _SPECIAL not in text:
            found = b"".join([self._piece(p) for p in _PIECES.findall(text.lower())])
        else:
            found = self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
            if len(word) > LONGEST_CACHED:
                return found
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        self.words[word] = found
        return found

    def ids(self, text: bytes) -> bytes:
        known, ask = self.words, self.word_ids
        return b"".join([known[w] if w in known else ask(w) for w in text.split()])


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per worker process."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
