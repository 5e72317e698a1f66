import numpy as np
import pyarrow as pa
import pytest

from tallyport.llm import word_ids

TEXTS = [
    "ÀÉ.,ß. Ÿ ÿ, x× ÷. µ. ª, ºs ǰ. é.́ É, Ĳ.", None, "", " \n",
    "CAFÉ. café, Café. don't É's. <|STARTOFTEXT|> É.", "naïve.Ö.ö,,Ö.. a.É é́.", "café Straße plain.",
]


def test_plain_words_are_not_sent_through_the_tokenizer():
    """The model gets words of plain letters, and the ids are those of whole texts."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer = word_ids.WordIds(path, 0), Tokenizer.from_file(path)
    asked = []

    class Asked:
        model = words.tokenizer.model

        def encode_batch_fast(self, some, add_special_tokens):
            asked.extend(some)
            return tokenizer.encode_batch_fast(some, add_special_tokens=add_special_tokens)

    words.tokenizer = Asked()
    ids, sizes = words.ids(pa.array(TEXTS))
    expected = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in TEXTS]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expected
    asked.clear()
    ids, _ = words.ids(pa.array(["ÉCOLE cafés. Plain wording, Straßen."]))
    assert ids.tolist() == [*tokenizer.encode("ÉCOLE cafés. Plain wording, Straßen.").ids, 0]
    assert not {w for w in asked if w not in {".", ","}}
