"""Encoding of whole texts word by word."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable
from typing import Generic, TypeVar

from tokenizers import Tokenizer

Encoded = TypeVar("Encoded")

#: Characters for which NFC is the identity, lower-casing needs no context, and white space is the same everywhere.
PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\u012f\\u0131-\\u0148\\u014a-\\u017f–—‘’“”…€]*")

#: Words whose encoding a worker keeps (twice, for two generations); longer ones are not worth keeping.
KEPT_WORDS = 250_000
KEPT_LENGTH = 64


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, with truncation and padding off."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def word_pattern(path: str) -> re.Pattern:
    """The pattern by which a tokenizer file splits words off a text, for PLAIN text; letters and digits by name."""
    with open(path, encoding="utf-8") as file:
        steps = json.load(file)["pre_tokenizer"]["pretokenizers"]
    pattern = next(s for s in steps if s["type"] == "Split")["pattern"]["Regex"]
    plain = [c for c in map(chr, range(0x2200)) if PLAIN.fullmatch(c)]
    for kind in "LN":
        members = "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind)
        pattern = pattern.replace(rf"[\p{{{kind}}}]", f"[{members}]").replace(rf"\p{{{kind}}}", members)
    return re.compile(pattern)


class Words(dict, Generic[Encoded]):
    """Encodings of words, computed on demand.

    When there are `KEPT_WORDS` of them they become the old generation, out of which those asked for again return;
    the old generation before is dropped.
    """

    def __init__(self, encode: Callable[[str], Encoded]):
        super().__init__()
        self.encode = encode
        self.old: dict[str, Encoded] = {}

    def __missing__(self, word: str) -> Encoded:
        encoded = self.old.get(word)
        if encoded is None:
            encoded = self.encode(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = encoded
        return encoded


class TextEncoder(Generic[Encoded]):
    """Texts to the encodings of their parts, in order; equal to encoding them whole.

    `of_word` encodes a word of plain text in lower case, `of_text` any other text without special tokens (as several
    parts), `of_special` the id of a special token.
    """

    def __init__(
        self,
        path: str,
        tokenizer: Tokenizer,
        of_word: Callable[[str], Encoded],
        of_text: Callable[[str], Iterable[Encoded]],
        of_special: Callable[[int], Encoded],
    ):
        self.find = word_pattern(path).findall
        self.words = Words(of_word)
        self.of_text = of_text
        special = {t.content: of_special(i) for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.special = special
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def parts(self, text: str) -> list[Encoded]:
        sections = self.splits.split(text) if self.splits else [text]
        out: list[Encoded] = []
        for i, section in enumerate(sections):
            if i % 2:
                out.append(self.special[section])
            elif PLAIN.fullmatch(section):
                out += map(self.words.__getitem__, self.find(section.lower()))
            else:
                out += self.of_text(section)
        return out
