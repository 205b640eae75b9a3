"""Cutting texts where no pre-token can span, so that pieces can be encoded once and remembered."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Sequence

import regex

#: Fixed value: the pattern by which byte-level tokenizers of this kind cut texts.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 32]
_CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """The text in parts whose pre-tokens are those of the whole: cut before each space that stands alone.

    The pattern of byte-level tokenizers lets a token begin with one space and otherwise end at white space, so a
    boundary before a space between two other characters is a boundary of every tokenization. Python's white space
    includes all that the pattern calls so.
    """
    if not text:
        return []
    crowded = "  " in text or any(b in text and (b + " " in text or " " + b in text) for b in _BLANKS)
    if not crowded and text[0] != " ":
        if "\0" not in text:
            return text.replace(" ", "\0 ").split("\0")
        first, *rest = text.split(" ")
    else:
        first, *rest = _CUT.split(text)
    return [first, *[" " + p for p in rest]]


def cutter(pattern: str) -> Callable[[str], Sequence[str]]:
    """The pre-tokens of a piece, not empty. For the byte-level pattern, letters with punctuation behind need no matching."""
    find, marks = regex.compile(pattern).findall, string.punctuation
    if pattern != BYTE_LEVEL:
        return find

    def cut(piece: str) -> Sequence[str]:
        word = piece.rstrip(marks)
        if (word[1:] if word[:1] == " " else word).isalpha():
            return (word,) if len(word) == len(piece) else (word, piece[len(word) :])
        return find(piece)

    return cut
