"""Token ids of whole texts, each distinct word encoded once per task."""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

from tokenizers import Tokenizer

#: The splitting pattern of the word vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A single space between two other characters always begins a token of a byte-level vocabulary.
BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")
#: Letters that are one code point in every normal form and in either case.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-þ]+")
#: Signs that stand together in one token, apart from letters, where they end a word.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words remembered per task, in each of two generations.
WORDS_KEPT = 400_000


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: visible Latin-1 signs as they are, others from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(other)}


BYTE_LETTERS = _byte_letters()


#: Ready formats of short lists of ids.
PACKERS = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _packed(ids: list[int]) -> bytes:
    n = len(ids)
    return PACKERS[n](*ids) if n < len(PACKERS) else struct.pack(f"<{n}I", *ids)


def _latin(text: str) -> bool:
    """Whether all signs are Latin-1, where lower case is one sign for one and normal forms change nothing."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Words(dict):
    """Ids of a word, encoded when first asked for; words long unused are forgotten."""

    def __init__(self, tokenizer: Tokenizer, lead: str, fold: bool, short: bool):
        self.tokenizer, self.lead, self.fold, self.short = tokenizer, lead, fold, short
        self.tokenize, self.mark = tokenizer.model.tokenize, "Ġ" if lead else ""
        self.signs: dict[str, bytes] = {}
        self.sign = {c: _packed([t.id for t in self.tokenize(c)]) for c in SIGNS} if short else {}
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if (ids := self.old.get(word)) is None:
            if not (self.short and word.isascii()):
                ids = self.encode(word)
            elif word.isalpha():
                if self.fold and not word.islower():
                    ids = self[word.lower()]
                else:
                    ids = _packed([t.id for t in self.tokenize(self.mark + word)])
            elif (stem := word[:-1]).isalpha() and (sign := self.sign.get(word[-1])):
                ids = self[stem] + sign
            else:
                ids = self.encode(word)
        self[word] = ids
        return ids

    def encode(self, word: str) -> bytes:
        if self.short and (stem := word.rstrip(SIGNS)) and LETTERS.fullmatch(stem):
            if len(stem) < len(word):
                tail = word[len(stem) :]
                if tail not in self.signs:
                    if len(self.signs) > WORDS_KEPT:
                        self.signs.clear()
                    self.signs[tail] = _packed([t.id for t in self.tokenize(tail)])
                return self[stem] + self.signs[tail]
            if self.fold and not word.islower():
                return self[word.lower()]
            return _packed([t.id for t in self.tokenize(self.mark + word.encode().decode("latin-1").translate(BYTE_LETTERS))])
        return _packed(self.tokenizer.encode(self.lead + word, add_special_tokens=False).ids)

    def age(self) -> None:
        if len(self) > WORDS_KEPT:
            self.old = dict(self)
            self.clear()


class Encoder:
    """`encode(text)` gives the same ids as the tokenizer over the whole text.

    Special tokens' strings in a text are ordinary text. Where the vocabulary's rules let no
    token cross a blank, words are encoded one by one and remembered; other vocabularies
    and texts with unusual blanks take the longer way with the same result.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        config = json.loads(self.tokenizer.to_str())
        splits = config.get("pre_tokenizer") or {}
        first = (splits.get("pretokenizers") or [{}])[0]
        folds = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])]
        self.kind = ""
        if first.get("pattern") == {"Regex": WORD_PATTERN} and folds == ["NFC", "Replace", "Lowercase"]:
            self.kind = "words"
        elif splits.get("type") == "ByteLevel" and not splits["add_prefix_space"] and not config.get("normalizer"):
            self.kind = "bytes"
        self.first = _Words(self.tokenizer, "", self.kind == "words", self.kind != "")
        self.rest = _Words(self.tokenizer, " ", False, self.kind != "")
        self.newline = self.whole("\n") if self.kind == "bytes" else b""

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        self.first.age()
        self.rest.age()
        if self.kind == "words":
            if _latin(text):
                text = text.lower()  # as the vocabulary does; fewer words to know
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))
        if self.kind != "bytes":
            return self.whole(text)
        out = []
        for line in text.split("\n"):
            words = line.split(" ")
            if words != line.split():
                return b"".join(
                    self.rest[part[1:]] if part[0] == " " and part[1:2] > " " else self.first[part]
                    for part in BEFORE_SPACE.split(text)
                )
            out.append(self.first[words[0]] + b"".join(map(self.rest.__getitem__, words[1:])))
        return self.newline.join(out)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a worker process, which keeps the words it knows from one task to the next."""
    return Encoder(path)
