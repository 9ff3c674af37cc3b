"""Encoding whole texts through the ``tokenizers`` library with a bounded memo of words.

A text is cut only where no token can span the cut, each piece between cuts is encoded once per
worker process, and its ids are joined as bytes.  Pieces the cut rule doesn't cover, and characters
whose class may differ between Unicode versions, go to the library's own ``encode`` as they are.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import regex

#: The published pre-tokenizer patterns of the two vocabularies.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: Pieces of these characters alone are split here; others by the library.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]+")
#: ASCII characters that are neither letters, digits nor white space; no pattern tells one from another at a word's end.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Entries of each memo in a worker process: some 100 bytes each.
MEMO_ENTRIES = 400_000


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Memo(dict):
    """A dict that computes what it lacks, and stops growing at ``limit`` entries."""

    def __init__(self, make: Callable, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.limit and len(key) <= 64:
            self[key] = value
        return value


def plain_letters(word: str) -> bool:
    """Letters alone, of alphabets whose classes no Unicode version changes."""
    return word.isalpha() and (word.isascii() or max(word) < "Ā")


class SpaceLed:
    """Ids of texts whose words carry the space before them (byte-level vocabularies).

    ``token(text)`` encodes what the pre-tokenizer leaves whole, ``piece(text)`` any text on its own.
    A space between two characters that aren't white space always opens a token, so the parts
    between such spaces are independent; so are letters and the punctuation that ends a word.
    """

    def __init__(self, token: Callable[[str], bytes], piece: Callable[[str], bytes]):
        self.token, self.piece = token, piece
        self.led, self.ends = Memo(self._led), Memo(token)

    def _led(self, word: str) -> bytes | None:
        if plain_letters(word):
            return self.token(" " + word)
        base = word.rstrip(PUNCTUATION)
        if plain_letters(base):
            return self.led[base] + self.ends[word[len(base) :]]
        return self.piece(" " + word) if word and not word[0].isspace() and not word[-1].isspace() else None

    def __call__(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self._apart(text)
        try:
            return self.piece(first) + b"".join(map(self.led.__getitem__, rest))
        except TypeError:  # a part with white space at its end
            return self._apart(text)

    def _apart(self, text: str) -> bytes:
        first, *rest = BETWEEN.split(text)
        return b"".join([self.piece(first), *(self.piece(" " + x) for x in rest)])


class SpaceDropped:
    """Ids of texts whose white space yields no token: words are independent."""

    ODD = re.compile("[\x1c-\x1f\x85\u180e\ufeff]")  # white space to one side only

    def __init__(self, normalize: Callable[[str], str], token: Callable[[str], bytes], piece: Callable[[str], bytes]):
        self.normalize, self.token, self.piece = normalize, token, piece
        self.words, self.ends = Memo(self._word), Memo(token)

    def _word(self, word: str) -> bytes:
        if plain_letters(word) and plain_letters(normal := word.lower() if word.isascii() else self.normalize(word)):
            return self.token(normal)
        base = word.rstrip(PUNCTUATION)
        if base != word and plain_letters(base):
            return self.words[base] + self.ends[word[len(base) :]]
        return self.piece(word)

    def __call__(self, text: str) -> bytes:
        if self.ODD.search(text):
            return self.piece(text)
        return b"".join(map(self.words.__getitem__, text.split()))


class LibraryEncoder:
    """``ids(text)``: little-endian ids (``dtype``) of a whole text, as ``Tokenizer.encode`` gives them
    with ``add_special_tokens=False`` and without truncation or padding; null counts as empty."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = f"<u{self.width}"
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.added = [x["content"] for x in spec["added_tokens"]]
        pre, normal = spec["pre_tokenizer"], spec["normalizer"]
        self.normalize = self.tokenizer.normalizer.normalize_str if normal else str
        if normal is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.split, self.whole = regex.compile(BYTE_PATTERN).findall, SpaceLed(self._part, self.piece)
        elif normal and pre["type"] == "Sequence" and pre["pretokenizers"][0].get("pattern", {}).get("Regex") == WORD_PATTERN:
            self.split, self.whole = regex.compile(WORD_PATTERN).findall, SpaceDropped(self.normalize, self._part, self.piece)
        else:
            self.split, self.whole = None, self.encode
        self.parts = Memo(self._part, MEMO_ENTRIES // 10)

    def pack(self, ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(self.width, "little") for i in ids)

    def encode(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        return self.pack([t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(self.letters))])

    def piece(self, text: str) -> bytes:
        if not text:
            return b""
        if self.split is None or not PLAIN.fullmatch(text) or any(x in text for x in self.added):
            return self.encode(text)
        return b"".join(map(self.parts.__getitem__, self.split(self.normalize(text))))

    def ids(self, text: str | None) -> bytes:
        return self.whole(text) if text else b""


_encoders: dict[str, LibraryEncoder] = {}


def encoder(path: str) -> LibraryEncoder:
    """One encoder for each vocabulary file and worker process."""
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]
