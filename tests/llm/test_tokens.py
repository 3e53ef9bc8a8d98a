import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import tokens

PARTS = (
    "the The THE don't we'll x's 's ' '' word, word. (word) [a]! *** *a* é Éa été, à? ÷ × a× a÷, naïve.) 12 1,2 3.14 a1! 日本 語。 İ ı ß ẞ J̌ é é, ́ ﬁ µ ª º "
    "<|endoftext|> <|x|> a_b a-b a/b, http://x.y/z? ... .' '. ,' a', a'! 🙂 🙂, ¡hola! «a» a… Ω ΑΣ ς"
).split()
SPACES = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "   ", "\x0b", " ", "　", "\x1c", ""]


@pytest.mark.parametrize(("name", "drops"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_pieces_give_the_ids_of_the_whole(name, drops, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_KEPT", 60)
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    e = tokens.Encoder(public_tokenizers.path(name))
    assert e.drops_space == drops
    rng = random.Random(4)
    for k in range(3000):
        spaces = SPACES if k % 5 == 0 else SPACES[:10] + [""]
        text = "".join(rng.choice(spaces) + rng.choice(PARTS) for _ in range(rng.randint(0, 8))) + rng.choice(spaces)
        want = t.encode(text, add_special_tokens=False).ids
        got = e.encode(text)
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want, repr(text)


def test_an_unknown_tokenizer_is_asked_for_whole_texts(tmp_path):
    import json

    own = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    own["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(own), encoding="utf-8")
    e = tokens.Encoder(str(path))
    assert e.kind is None
    text = "The Quick BROWN fox, don't 12!"
    want = Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids
    got = e.encode(text)
    assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_without_special_strings_have_the_ids_of_the_unchanged_library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    e = tokens.Encoder(public_tokenizers.path(name))
    rng = random.Random(5)
    parts = [p for p in PARTS if "<|" not in p]
    for _ in range(1000):
        text = "".join(rng.choice(SPACES) + rng.choice(parts) for _ in range(rng.randint(0, 12)))
        got = e.encode(text)
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == t.encode(text, add_special_tokens=False).ids
