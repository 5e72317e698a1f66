import pytest

from tallyport.llm import token_files

WORDS = ["CUMHUR\u0130YET\u0130.", "\u0130.", "\u091c\u095c,", "\u0958,", "\u095f.", "caf\u00e9.", "cafe\u0301.", "\u00c9T\u00c9,", "plain.", "\u0391\u03a3.", "\u03a3,", "\ufb1d.", "\u01f0,", "a.b.", "..", "\u0939\u093f\u0928\u094d\u0926\u0940,"]


def test_words_with_a_sign_behind_them():
    """A stem whose normal form holds a mark is one piece with the sign behind it."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, words = Tokenizer.from_file(path), token_files.Words(path)
    for word in [*WORDS, " ".join(WORDS)]:
        assert words.ids(word).tolist() == tokenizer.encode(word, add_special_tokens=False).ids, word


def test_letters_with_a_sign_behind_them():
    """Every letter of Unicode before a full stop and a comma."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, words = Tokenizer.from_file(path), token_files.Words(path)
    texts = [f"a{c}{sign}" for c in map(chr, range(0x80, 0x2FA20)) if c.isalpha() and not 0x3400 <= ord(c) <= 0x9FFF and not 0xAC00 <= ord(c) <= 0xD7A3 and ord(c) < 0x10000 for sign in ".,"]
    wrong = [t for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True) if words.ids(t).tolist() != e.ids]
    assert wrong == []
