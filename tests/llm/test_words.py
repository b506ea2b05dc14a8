"""Words that go straight to the model get the ids the whole tokenizer gives them."""

from array import array

import pytest

from tallymart.llm.tokens import LETTERS_END, MARKS, Ids, byte_bpe_path, signs


def expected(ids: Ids, text: str) -> bytes:
    return array(ids.kind, ids.model.encode(text, add_special_tokens=False).ids).tobytes()


def test_words_of_all_letters():
    ids = Ids(byte_bpe_path())
    assert ids.merge is not None  # the short way is taken
    letters = [chr(c) for c in range(ord(LETTERS_END) + 0x100) if chr(c).isalpha()]
    words = [x for c in letters for x in (c, f" {c}", f"ab{c}", f" {c}a{c}", f" x{c}{c}.")]
    assert ids.encode_all(words) == [expected(ids, w) for w in words]


@pytest.mark.parametrize("text", [
    "", " ", "...", "a", " a", "it's we'll don't", "a1 b2 3c 4", "Ünïcode naïve, straße!", "a\nb\n\nc d",
    "<|endoftext|> x <|endoftext|>", "x<|endoftext|>y", "слово 文字 ɐ", "a  b", "a b", "ab́c", "ªº µ ŉ ƻ ǀ",
    "one.,;:!? two!!", "ab\tcd",
])
def test_texts(text):
    ids = Ids(byte_bpe_path())
    for _ in range(2):  # once new, once remembered
        assert ids.encode(text) == expected(ids, text)


def test_signs_only_for_latin_words():
    assert (signs("ab"), signs(" ab")) == ("ab", "Ġab")
    assert signs(" é") == "ĠÃ©"
    assert not any(signs(x) for x in ("", " ", "a1", "a b", "a.", "\na", "слово", "  a", *MARKS))
