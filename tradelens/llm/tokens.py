"""Token ids of a public tokenizer, encoded piece by piece."""

from __future__ import annotations

import re
import zlib
from array import array
from functools import cache

import numpy as np

TOKENIZER = "word_bpe_49k.json"
END = 1
#: Pieces of one generation of the table of known pieces.
_CACHE = 200_000
#: Texts of one batch that the tokenizer takes whole.
_BATCH = 64
#: The tokenizer's splitter on lower-case text of Latin-1 characters: runs of letters, contractions, single digits, runs of the rest.
_PIECES = re.compile("[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
#: What the piecewise path leaves to the tokenizer: characters beyond Latin-1, and what may be a special token.
_OTHER = re.compile("[^\x00-\xff]|<\\|")
_PROBES = (
    "Hello, world! It's 42 o'clock... ÉCLAIR straße ÿèñ",
    "they'll've DON'T 'sup x''s a1b2 $$$%%% #tag, a_b-c d\x0be\x1cf\x85g ªµº ²³¼ · « » \x00\x7f",
    "thntionhe password=d42260c9a6 info@example.org 4758-5284 |a|b| <a href='#'>x</a>",
)


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the n-th other byte for character 256 + n."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + n for n, b in enumerate(others)}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """Ids of each piece as bytes. Pieces are kept for two generations: the older one is dropped when the younger is full."""

    def __init__(self, learn):
        super().__init__()
        self.learn, self.older = learn, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.learn(piece)
        if len(self) >= _CACHE:
            self.older = self.copy()
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts as the tokenizer gives them without special tokens, then an end id.

    The tokenizer drops case and white space and splits a text into pieces before it forms tokens, so the text's
    ids are those of its pieces in turn, and pieces that came before are looked up. Words with characters beyond
    Latin-1 or with marks of special tokens are encoded by the tokenizer as they stand, each as a piece. A tokenizer that
    does not work this way (its ids of some probes differ) encodes whole texts instead.
    """

    def __init__(self, path: str, end: int = END):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype, self.code = (np.uint32, "I") if wide else (np.uint16, "H")
        self.end = array(self.code, [end]).tobytes()
        self.letters = _byte_letters()
        self.known, self.whole = _Known(self._piece), _Known(self._word)
        self.direct = all(self._ids(p) == self._word(p) for p in _PROBES)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece: its bytes as letters, merged."""
        if not (piece.isascii() and piece.isalnum()):
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _ids(self, text: str) -> bytes:
        if not _OTHER.search(text):
            return b"".join(map(self.known.__getitem__, _PIECES.findall(text.lower())))
        if "<|" in text:
            return self._word(text)
        parts = (self.whole[w] if _OTHER.search(w) else self._ids(w) for w in text.split(" "))
        return b"".join(parts)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if self.direct:
            return [np.frombuffer(self._ids(t or "") + self.end, self.dtype) for t in texts]
        out = []
        for i in range(0, len(texts), _BATCH):
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts[i : i + _BATCH]], add_special_tokens=False)
            out += [np.frombuffer(array(self.code, e.ids).tobytes() + self.end, self.dtype) for e in found]
        return out


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this process; a worker's later tasks find the pieces that earlier ones met."""
    return Encoder(path)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
