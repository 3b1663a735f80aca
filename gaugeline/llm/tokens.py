"""Whole texts to token ids, with the pieces between spaces encoded once.

A pre-token of either tokenizer never goes on past a space that a non-space
follows, so a text's ids are those of the pieces cut before such spaces, one
after another. Each worker keeps the ids of pieces it has met, up to a bound;
beyond it further pieces are encoded anew, with the same result. A text that
may hold one of the tokenizer's added tokens goes through the tokenizer whole.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache

import regex
from tokenizers import Tokenizer

KEPT_PIECES = 500_000
SAFE_CUT = re.compile(r" (?=\S)")
UNSAFE_SPACE = re.compile(r" (?!\S)")
LAST_PLAIN = "\u024f"  # up to here characters are in normal form and their classes are old
CHANGES_LENGTH = "\u0130"  # becomes two characters in lower case

# The patterns by which the two tokenizers cut a text.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in prints]
    return {byte: chr(byte) for byte in prints} | {byte: chr(256 + place) for place, byte in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else b"".join(i.to_bytes(4, "little") for i in ids)


class Pieces(dict):
    """Ids of pieces, as little-endian 32-bit bytes, encoded when first asked for.

    A piece of printable characters up to ``LAST_PLAIN`` is cut by the
    tokenizer's own pattern, and its runs of letters go to the model directly;
    any other piece goes through the whole tokenizer. Both give the same ids.
    """

    def __init__(self, tokenizer: Tokenizer, lead: str, lower: bool, pattern: str):
        super().__init__()
        self.tokenizer, self.lead, self.lower = tokenizer, lead, lower
        self.pattern = regex.compile(pattern)
        self.parts: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.encode(piece)
        if len(self) < KEPT_PIECES:
            self[piece] = found
        return found

    def encode(self, piece: str) -> bytes:
        if not piece.replace("\n", "").isprintable() or max(piece, default="") > LAST_PLAIN or CHANGES_LENGTH in piece:
            return self.whole(self.lead + piece)
        plain = piece.lower() if self.lower else piece
        if plain.isalpha():
            return self.part(self.lead + plain)
        return b"".join(map(self.part, self.pattern.findall(self.lead + plain)))

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if part.lstrip(" ").isalpha():
                shown = part.encode().decode("latin-1").translate(BYTE_CHARACTERS)
                found = _packed([token.id for token in self.tokenizer.model.tokenize(shown)])
            else:
                found = self.whole(part)
            if len(self.parts) < KEPT_PIECES:
                self.parts[part] = found
        return found

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


class Encoder:
    """Encodes texts with a tokenizer file; ids come as little-endian 32-bit bytes."""

    def __init__(self, path: str, spaces_count: bool):
        """``spaces_count``: whether a space belongs to the word after it (byte-level) or is dropped."""
        tokenizer = Tokenizer.from_file(path)
        # What every text with an added token contains: the beginning of one, in any case.
        self.marks = {regex.match(r"\P{L}*", token.content)[0] for token in tokenizer.get_added_tokens_decoder().values()}
        self.tokenizer = tokenizer
        self.spaces_count = spaces_count
        if spaces_count:
            self.after_space = Pieces(tokenizer, " ", False, BYTE_PATTERN)
            self.at_start = Pieces(tokenizer, "", False, BYTE_PATTERN)
        else:
            self.after_space = Pieces(tokenizer, "", True, WORD_PATTERN)

    def encode(self, text: str) -> bytes:
        for mark in self.marks:
            if mark in text:
                return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if not self.spaces_count:
            return b"".join(map(self.after_space.__getitem__, text.replace("\n", " ").split(" ")))
        pieces = SAFE_CUT.split(text) if UNSAFE_SPACE.search(text) else text.split(" ")
        if text.startswith(" "):
            start = b""
            if not pieces[0]:
                del pieces[0]
            else:
                start, pieces = self.at_start[pieces[0]], pieces[1:]
        else:
            start, pieces = self.at_start[pieces[0]], pieces[1:]
        return start + b"".join(map(self.after_space.__getitem__, pieces))


@lru_cache(maxsize=4)
def encoder(path: str, spaces_count: bool) -> Encoder:
    """One for the life of a worker."""
    return Encoder(path, spaces_count)
