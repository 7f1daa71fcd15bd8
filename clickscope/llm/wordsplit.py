"""Splitting a text into the words that a word-level BPE merges on their own.

Follows the tokenizer file: its special tokens are cut out first, then the
text is normalised (NFC, white space, lower case) and cut by the pattern of
the pre-tokenizer.  Texts with characters that need Unicode rules go through
the library's normalizer and pre-tokenizer.  The value of every word is
remembered in a cache of bounded size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import TypeVar

Value = TypeVar("Value")

#: Entries of a cache of words; a full cache is emptied and filled anew.
CACHE_ENTRIES = 400_000

# Plain characters need no Unicode rules: ASCII, and the letters of Latin-1,
# which NFC leaves as they are (in UTF-8 the byte C3 and one more).
_PLAIN_ASCII = bytes([*range(9, 14), *range(32, 127)])
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9ß-öø-ÿ]+")


def is_plain(text: bytes) -> bool:
    rest = text.translate(None, _PLAIN_ASCII)
    if not rest:
        return True
    leads = rest.count(b"\xc3")
    return len(rest) == 2 * leads and b"\xc3\x97" not in rest and b"\xc3\xb7" not in rest


class Remembered(dict):
    """``self[key]`` computes a missing value once; of bounded size."""

    def __init__(self, compute: Callable, entries: int = CACHE_ENTRIES) -> None:
        super().__init__()
        self.compute, self.entries = compute, entries

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.entries:
            self.clear()
        self[key] = value
        return value


class WordSplitter:
    """Cuts texts into words and maps each through ``of_word``.

    ``of_word`` gets a word as a string, or the id of a special token.
    """

    def __init__(self, path: str, of_word: Callable[[str | int], Value]) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            self.special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._contents = [s.encode() for s in self.special]
        self.of_word = Remembered(of_word)

    def _words(self, text: str) -> list[str]:
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def values(self, text: bytes) -> list[Value]:
        """The values of the words of a whole text, in order."""
        if is_plain(text) and not any(s in text for s in self._contents):
            return list(map(self.of_word.__getitem__, _PIECES.findall(text.decode().lower())))
        out: list[Value] = []
        for part in self._cut.split(text.decode()) if self.special else [text.decode()]:
            if part in self.special:
                out.append(self.of_word[self.special[part]])
            elif part:
                out.extend(self.of_word[w] for w in self._words(part))
        return out
