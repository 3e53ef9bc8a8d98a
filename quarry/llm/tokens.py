"""Token ids for the operators that encode with the ``tokenizers`` library.

Encoding a long text anew is slow, as most of it repeats: a text is cut where an ASCII blank follows another
character, which no pre-token of the supported tokenizers spans, and the ids of a piece are kept. What is kept
belongs to the worker process and serves all its tasks; beyond a bound, what was not used of late is dropped. A piece
that is new is first cut further where pre-tokens end for certain: behind white space that no word takes in, and
between a letter and the signs at the end. Texts with other Unicode white space, for which the cut is not proven, are
encoded whole, and so is every text if the tokenizer's file is not of one of the two kinds for which the cuts are
proven: :func:`kind_of` reads its normaliser, pre-tokenizer and model.

Ids are those of the library with ``add_special_tokens=False`` and, as the vocabularies' own description has it,
``encode_special_tokens = True``: the strings of special tokens in a text are ordinary text, so that no text can put
an end of document into the ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

#: With a leading blank: pieces of byte-level vocabularies, whose pre-tokens may begin with one.
_PIECE = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_OTHER_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
#: A letter or digit, then signs up to the end; an apostrophe is none of them, as it may begin a contraction.
_SIGNS = re.compile(rb"(.*(?:[A-Za-z0-9]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([!-&(-/:-@\[-`{-~]+)", re.S)
_SPACE_FIRST = re.compile(rb"([ \t-\r]+)([^ \t-\r].*)", re.S)
#: One pre-token for certain: letters, with a blank before them or not.
_LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
MOST_KEPT = 1_200_000
LONG = 256


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it can be seen, else the next one
    from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


#: The parts of a tokenizer's file for which pieces are proven to give the ids of the whole.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORD_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_WORD_LEVEL = {"type": "Sequence", "pretokenizers": [_WORD_SPLIT, _BYTE_LEVEL | {"use_regex": False}]}


def kind_of(path: str) -> str | None:
    """``bytes`` (byte-level, blanks kept), ``words`` (small letters, white space dropped), or none of these."""
    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    model, special = own["model"], all(t["special"] and not t["normalized"] for t in own.get("added_tokens") or [])
    plain = model["type"] == "BPE" and special and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    plain = plain and not own.get("truncation") and not own.get("padding")
    if plain and own.get("normalizer") is None and own.get("pre_tokenizer") == _BYTE_LEVEL and not model.get("end_of_word_suffix"):
        return "bytes"
    if plain and own.get("normalizer") == _WORD_NORMAL and own.get("pre_tokenizer") == _WORD_LEVEL and model.get("end_of_word_suffix"):
        return "words"
    return None


class Encoder(dict):
    """Pieces, as bytes, to ids, as little-endian unsigned 32-bit integers. Two generations: when the young one is
    full it becomes the old one, from which what is asked for again comes back."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = kind_of(path)
        self.drops_space = self.kind == "words"
        self.model, self.letters = self.tokenizer.model, byte_letters()

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters_only(self, piece: bytes) -> bytes:
        """The model alone does for a single pre-token, without normalisation and splitting, which cost most."""
        if self.drops_space and piece != (small := piece.decode().lower().encode()):
            return self[small]
        word = piece.decode() if piece.isalpha() else "".join(map(self.letters.__getitem__, piece))
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _parts(self, piece: bytes) -> list[bytes]:
        """The piece, or parts of it whose ids follow each other."""
        if signs := _SIGNS.fullmatch(piece):
            return [signs[1], signs[2]]
        if self.drops_space:
            text = piece.decode()
            if max(text) < "\u0100":  # the tokenizer makes letters small, one by one
                return [text.lower().encode()]
        elif space := _SPACE_FIRST.fullmatch(piece):
            blanks, body = space[1], space[2]
            if blanks[-1:] != b" ":
                return [blanks[:-1], blanks[-1:], body] if blanks[:-1] else [blanks, body]
            if blanks[:-1]:
                return [blanks[:-1], b" " + body]
        return [piece]

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            if _LETTERS.fullmatch(piece):
                ids = self.letters_only(piece)
            else:
                parts = self._parts(piece)
                ids = self.whole(piece.decode()) if parts == [piece] else b"".join(map(self.__getitem__, parts))
        if len(piece) <= LONG:
            if len(self) >= MOST_KEPT // 2:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.kind is None or _OTHER_SPACE.search(text):
            return self.whole(text)
        raw = text.encode()
        return b"".join(map(self.__getitem__, raw.split() if self.drops_space else _PIECE.findall(raw)))


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)
