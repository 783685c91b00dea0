"""Whole texts to token ids with the ``tokenizers`` library, asked once per distinct word.

A text is cut into chunks that no token crosses, so the ids of a text are the ids of its chunks one after the other.
Words repeat, so nearly every chunk is a dictionary look-up. Two cuts are offered:

* ``spaces``: before a single space between two characters that are not white space, the space going to the right
  chunk. For byte-level vocabularies, where a token may begin with a space but never holds one further in.
* ``white space``: at blanks, tabs and line ends, which are dropped. For vocabularies that drop white space.

Keys of the dictionary are chunks without their space; a chunk that has none in front is marked. A chunk not met
before that is a run of letters is one pre-token and goes to the library's model as it is; letters with marks behind
them are two; anything else, special strings too, goes through the whole library.
"""

from __future__ import annotations

import os
import re
from array import array

_JOINT = re.compile("(?<=[^\\s᠎]) (?=[^\\s᠎])")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įıĲ-ɏ]+")  # one pre-token whatever the pattern, and unchanged by NFC
_LETTERS_MARKS = re.compile("([A-Za-zÀ-ÖØ-öø-įıĲ-ɏ]+)([!-&(-/:-@\\[-`{-~]+)")  # two: any apostrophe would tell otherwise
_BARE = "\0"  # in front of a key: the chunk has no space before it
_RARE_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\0"
_WIDE_SPACE = " ᠎               　"
_LONGEST_KEPT = 64
_MOST_KEPT = 1_000_000

#: Byte-level vocabularies write a byte as itself if it prints, else as the next character from 256 on.
_PRINTS = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE = [chr(b) if b in _PRINTS else chr(256 + sum(x not in _PRINTS for x in range(b))) for b in range(256)]

_loaded: dict[int, Encoder] = {}


def at_spaces(text: str) -> list[str]:
    """Keys of the chunks; joined in order they make the text."""
    plain = not any(x in text for x in ("  ", "\n\n", " \n", "\n ", *_RARE_SPACE)) and (text.isascii() or not any(x in text for x in _WIDE_SPACE))
    if plain and not text[0].isspace() and not text[-1].isspace():
        return (_BARE + text.replace("\n", f" {_BARE}\n {_BARE}")).split(" ")
    first, *rest = _JOINT.split(text)
    return [_BARE + first, *rest]


def at_white_space(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def lowered(text: str) -> str:
    """Lower case where that leaves the ids of a lower-case vocabulary as they are."""
    return text if "<|" in text or "Σ" in text else text.lower()


class Encoder:
    """Ids of texts as little-endian 32-bit words."""

    def __init__(self, definition: str, cut: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.spaced = cut == "spaces"
        self.known: dict[str, bytes] = {"": b""}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.spaced and _BARE in text:  # the mark of keys itself
            return self._whole(text)
        keys = at_spaces(text) if self.spaced else at_white_space(lowered(text))
        found = list(map(self.known.get, keys))
        if None in found:
            found = [self._of(k) if b is None else b for k, b in zip(keys, found, strict=True)]
        return b"".join(found)

    def _of(self, key: str) -> bytes:
        if (ids := self.known.get(key)) is not None:
            return ids
        bare = self.spaced and key[:1] == _BARE
        chunk = key[1:] if bare else " " + key if self.spaced else key
        word = key[1:] if bare else key
        if _LETTERS.fullmatch(word):
            seen = word if word.isascii() else "".join([_BYTE[b] for b in word.encode()])
            if self.spaced:
                ids = self._model("Ġ" + seen if not bare else seen)
            else:
                ids = self._model(seen) if word == word.lower() else self._whole(chunk)
        elif two := _LETTERS_MARKS.fullmatch(word):
            ids = self._of(key[: -len(two[2])]) + self._of((_BARE if self.spaced else "") + two[2])
        else:
            ids = self._whole(chunk)
        if len(key) <= _LONGEST_KEPT:
            if len(self.known) > _MOST_KEPT:
                self.known = {"": b""}
            self.known[key] = ids
        return ids

    def _model(self, pre_token: str) -> bytes:
        return array("I", [x.id for x in self.model.tokenize(pre_token)]).tobytes()

    def _whole(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()


def encoder(definition: str, cut: str) -> Encoder:
    """The worker's own encoder, made once and used by all its tasks."""
    key = hash((definition, cut))
    if key not in _loaded:
        _loaded[key] = Encoder(definition, cut)
    return _loaded[key]


def definition_of(path: str) -> str:
    """The tokenizer's file as text; it travels to the executors with the function that uses it."""
    with open(path, encoding="utf-8") as file:
        return file.read()
