"""Splitting texts into pre-tokens as a tokenizer file does, in any process.

The installed ``regex`` and the tokenizer library know different releases of Unicode. Where
a text holds a character outside the ranges on which both agree (tested over every code
point), the library itself splits it.
"""

from __future__ import annotations

import os
import re
import unicodedata

import regex

#: Ranges on which both libraries classify and fold every character alike.
AGREED = (
    "\u0000-\u052F\u0590-\u0887\u0900-\u0C5B\u0D80-\u1C88\u1E00-\u205F\u20A0-\u20BF\u2190-\u23FF"
    "\u2500-\u2BFF\u3000-\uA4CF\uAC00-\uD7A3\uFE00-\uFE0F\uFF00-\uFFEF\U0001F300-\U0001F5FF")
UNSURE = regex.compile(f"[^{AGREED}]")

#: The split patterns of the tokenizer files.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

_BYTE_SPLIT = regex.compile(BYTE_PATTERN).findall
_WORD_SPLIT = regex.compile(WORD_PATTERN).findall

# The same for texts of plain Latin letters, which the standard library splits faster: there the classes can be written
# out, and letters can be tried first, as no other alternative begins with one.
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F"
_NOT_LATIN = re.compile(f"[^\\x00-\\x1B\\x20-\\x7F{_LETTERS}]")
_LATIN_BYTE_SPLIT = re.compile(
    rf" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^ \t-\r{_LETTERS}0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+").findall
_LATIN_WORD_SPLIT = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \t-\r{_LETTERS}0-9]+").findall


def byte_pretokens(text: str, tokenizer) -> list[str]:
    """Pre-tokens of a text without special strings, for a byte-level tokenizer."""
    if not _NOT_LATIN.search(text):
        return _LATIN_BYTE_SPLIT(text)
    if not UNSURE.search(text):
        return _BYTE_SPLIT(text)
    return [text[i:j] for _, (i, j) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def word_pretokens(text: str, tokenizer) -> list[str]:
    """Words of a text without special strings: composed, lower case, no white space."""
    if not _NOT_LATIN.search(text):
        return _LATIN_WORD_SPLIT(text.lower())
    if not UNSURE.search(text):
        # each capital is lowered for itself, also a sigma at the end of a word
        return _WORD_SPLIT(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
    text = tokenizer.normalizer.normalize_str(text)
    return [text[i:j] for _, (i, j) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def split_special(text: str, special: tuple) -> list[str]:
    """Texts between special strings and those strings, in turn (odd places are special)."""
    start, pattern = special
    return pattern.split(text) if start in text else [text]


def special_pattern(tokens: list) -> tuple:
    """What ``split_special`` looks for: the letters that all added tokens begin with, and their pattern.

    Longer names come first, as the library prefers the longest. Added tokens that take
    white space along, ask for word borders or are compared after normalising are an error.
    """
    for t in tokens:
        if t.lstrip or t.rstrip or t.single_word or t.normalized:
            raise ValueError(f"added token {t.content!r}: lstrip, rstrip, single_word and normalized are not supported")
    names = sorted((t.content for t in tokens), key=len, reverse=True)
    if not names:
        return "", regex.compile("((?!))")
    return os.path.commonprefix(names), regex.compile("(" + "|".join(map(regex.escape, names)) + ")")
