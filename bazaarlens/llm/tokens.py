"""Texts to token ids inside Python tasks. Ids of frequent pieces of text are remembered."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
# Entries a worker remembers of each kind: some 200 bytes each, twice at most, without effect on results.
CHUNKS, PIECES = 1 << 17, 1 << 19
# Rows of a batch that a worker holds as Python objects at once.
ROWS_AT_ONCE = 512
# Longer chunks are not remembered.
LONGEST = 64
# The pattern that the byte-level pre-tokenizer has built in (fixed value).
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Latin text of characters whose class, case and composed form no Unicode version changed, and white space of ASCII.
PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-\xac\xae-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f]*")
LETTERS, DIGITS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9"
# What the classes of a tokenizer's pattern are in plain text.
IN_PLAIN = {
    r"[^\s\p{L}\p{N}]": f"[^\\s{LETTERS}{DIGITS}]",
    r"[\p{L}]": f"[{LETTERS}]",
    r"\p{L}": f"[{LETTERS}]",
    r"[\p{N}]": f"[{DIGITS}]",
    r"\p{N}": f"[{DIGITS}]",
}


def plain_pattern(pattern: str) -> re.Pattern:
    for general, plain in IN_PLAIN.items():
        pattern = pattern.replace(general, plain)
    return re.compile(pattern)


def few_rows(batches):
    """Arrow batches in slices of few rows, since texts may be long."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Remembered(dict):
    """Values by key, made when missing. When ``room`` is used up the entries become old ones, which still count until the
    next time, so frequent keys are never made anew."""

    def __init__(self, make, room: int, longest: int = LONGEST):
        super().__init__()
        self.make, self.room, self.longest, self.old = make, room, longest, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > self.longest:
                return found
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Ids:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, equal to those of the tokenizers library.

    Plain text is cut into pieces by the tokenizer's own pattern, and its model is asked for each piece. Other text is cut
    into chunks where no token can cross; of these the plain ones are cut further, and only the rest goes through the whole
    tokenizer.
    """

    def __init__(self, path: str, chunks: int = CHUNKS, pieces: int = PIECES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The string of a special token in a text is ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.pattern = plain_pattern(self.split_pattern())
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in (*range(0x09, 0x0E), *range(0x20, 0x250))}
        self.pieces = Remembered(self.of_piece, pieces)
        self.chunks = Remembered(self.of_chunk, chunks)

    def split_pattern(self) -> str:
        raise NotImplementedError

    def of_piece(self, piece: str) -> bytes:
        return _bytes([token.id for token in self.model.tokenize(piece.translate(self.shown))])

    def of_plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def of_whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _bytes(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if numbers.itemsize != 4:
        raise RuntimeError("this platform has no unsigned 32-bit array")
    return numbers.tobytes() if _LITTLE else _swapped(numbers)


_LITTLE = array("I", [1]).tobytes()[0] == 1


def _swapped(numbers: array) -> bytes:
    numbers.byteswap()
    return numbers.tobytes()


class ByteIds(Ids):
    """Byte-level BPE with spaces in its tokens. No token crosses the place between a character and a single space before
    the next character."""

    BETWEEN = re.compile(r"(?<=\S) (?=\S)")

    def split_pattern(self) -> str:
        return BYTE_PATTERN

    def of_chunk(self, chunk: str) -> bytes:
        return self.of_plain(chunk) if PLAIN.fullmatch(chunk) else self.of_whole(chunk)

    def encode(self, text: str) -> bytes:
        if PLAIN.fullmatch(text):
            return self.of_plain(text)
        chunks = text.split(" ")
        # The common case: words set apart by single spaces. Line breaks inside a chunk do no harm.
        if not all(c and not c[0].isspace() and not c[-1].isspace() for c in chunks):
            chunks = self.BETWEEN.split(text)
        first, rest = chunks[0], chunks[1:]
        return b"".join([self.chunks[first] if first else b"", *[self.chunks[" " + c] for c in rest]])


class WordIds(Ids):
    """BPE over words in lower case. White space is dropped, so no token crosses it."""

    def split_pattern(self) -> str:
        splits = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        return next(s["pattern"]["Regex"] for s in splits if s["type"] == "Split")

    def of_chunk(self, chunk: bytes) -> bytes:
        word = chunk.decode("utf-8", "replace")
        return self.of_plain(word.lower()) if PLAIN.fullmatch(word) else self.of_whole(word)

    def encode(self, text: bytes) -> bytes:
        """Ids of a text in UTF-8. Bytes split at just the white space of ASCII."""
        whole = text.decode("utf-8", "replace")
        if PLAIN.fullmatch(whole):
            return self.of_plain(whole.lower())
        return b"".join(map(self.chunks.__getitem__, text.split()))


@lru_cache(maxsize=1)
def byte_ids(path: str, chunks: int = CHUNKS, pieces: int = PIECES) -> ByteIds:
    return ByteIds(path, chunks, pieces)


@lru_cache(maxsize=1)
def word_ids(path: str, chunks: int = CHUNKS, pieces: int = PIECES) -> WordIds:
    return WordIds(path, chunks, pieces)
