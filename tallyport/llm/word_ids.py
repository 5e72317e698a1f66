"""Token ids of many texts at once: words are cut in bulk and each distinct one is asked for once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

# Bytes of text a task tokenizes at once.
TEXT_BYTES = 4 << 20
# Distinct words whose ids a task remembers.
REMEMBERED = 800_000
# Words the tokenizer is asked for at once; what it returns for each is large.
ASKED = 1000
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 13, 32]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
STOP = np.zeros(256, bool)
STOP[list(b"!#$%&*,./:;=?@")] = True
# The second byte of the letters from U+00C0 to U+00FF, whose first is C3.
ACCENTED = np.zeros(256, bool)
ACCENTED[128:192] = True
ACCENTED[[0x97, 0xB7]] = False
# Lower-case letters that no normal form changes, alone or side by side, and a word of them.
LETTERS = "".join(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
CAPITALS = "".join(c.upper() for c in LETTERS if c not in "\xdf\xff")
PLAIN = re.compile(f"[{LETTERS}]+")


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an array of strings and where each begins and the last ends; a null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or bounds[-1] == bounds[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with the capitals of ASCII and Latin-1 in lower case."""
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    data = LOWER[data]
    data[second[ACCENTED[data[second]] & (data[second] < 0x9F)]] += 32
    return data


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and how many each text has.

    White space parts words; a stop or another such sign right behind a letter of ASCII or Latin-1 begins a new
    one, since no tokenizer of words joins the two.
    """
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = np.flatnonzero(STOP[data[1:]]) + 1
    before = data[stops - 1]
    begins[stops[LETTER[before] | (ACCENTED[before] & (data[stops - 2] == 0xC3))]] = True
    first = bounds[:-1][bounds[:-1] < len(data)]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    offsets = np.append(np.cumsum(inside)[starts] - 1, inside.sum()).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    return words, np.diff(np.searchsorted(starts, bounds))


class WordIds:
    """Ids by a tokenizer that drops white space and never joins what white space parts.

    Words of plain letters are given to the tokenizer's model, if its normalisation and its division into
    pieces turn each such letter into one sign or several and leave a word whole; all others go through the tokenizer.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.lowers = all(self._pieces(c) == self._pieces(c.lower()) for c in CAPITALS)
        self.signs = self._signs()
        self._forget()

    def _pieces(self, text: str) -> list[str]:
        normalizer, parts = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [piece for piece, _ in parts.pre_tokenize_str(text)] if parts else [text]

    def _signs(self) -> dict[int, str] | None:
        """What the model sees of each plain letter; None if it must not be asked directly."""
        signs = {ord(c): "".join(self._pieces(c)) for c in LETTERS}
        whole = LETTERS.translate(signs)
        alone = self._pieces(LETTERS) == [whole] and all(self._pieces(LETTERS + stop)[:-1] == [whole] for stop in ".,")
        added = any(PLAIN.fullmatch(t.content.lower()) for t in self.tokenizer.get_added_tokens_decoder().values())
        return signs if alone and not added else None

    def _forget(self) -> None:
        # a word's place among those known; where the ids of each begin, and the ids; the first is the end of a text
        self.known: dict[str, int] = {}
        self.begins, self.flat = np.array([0, 1]), np.array([self.end], np.int32)

    def _learn(self, plain: list[str], others: list[str]) -> None:
        sizes, ids = [], []
        if plain:
            model, signs = self.tokenizer.model.tokenize, self.signs
            for word in plain:
                found = [token.id for token in model(word.translate(signs))]
                sizes.append(len(found))
                ids += found
        for k in range(0, len(others), ASKED):
            for encoded in self.tokenizer.encode_batch_fast(others[k : k + ASKED], add_special_tokens=False):
                found = encoded.ids
                sizes.append(len(found))
                ids += found
        first = len(self.known) + 1
        self.known.update(zip(chain(plain, others), range(first, first + len(sizes)), strict=True))
        self.begins = np.append(self.begins, self.begins[-1] + np.cumsum(np.array(sizes, np.int64)))
        self.flat = np.append(self.flat, np.array(ids, np.int32))

    def _places(self, words: list[str]) -> np.ndarray:
        places = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(places < 0)
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = np.arange(len(words))
        if len(new):
            unknown = [words[k] for k in new]
            is_plain = np.fromiter((self.signs is not None and PLAIN.fullmatch(w) is not None for w in unknown), bool, len(new))
            order = np.argsort(~is_plain, kind="stable")
            places[new[order]] = np.arange(len(new)) + len(self.known) + 1
            n = int(is_plain.sum())
            self._learn([unknown[k] for k in order[:n]], [unknown[k] for k in order[n:]])
        return places

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, `end` behind each text's, and how many each text has."""
        data, bounds = bytes_of(texts)
        if self.lowers and not ((data[:-1] == 60) & (data[1:] == 124)).any():  # "<|": the case of a special token's name counts
            data = lowered(data)
        words, per_text = words_of(data, bounds)
        encoded = words.dictionary_encode()
        places = self._places(encoded.dictionary.to_numpy(zero_copy_only=False).tolist())
        upto = np.cumsum(per_text + 1)
        each = np.zeros(len(words) + len(per_text), np.int64)
        is_word = np.ones(len(each), bool)
        is_word[upto - 1] = False
        each[is_word] = places[encoded.indices.to_numpy(zero_copy_only=False)]
        # the ids of each known word as a list, taken in bulk
        known = pa.LargeListArray.from_arrays(pa.array(self.begins), pa.array(self.flat))
        taken = known.take(pa.array(each))
        ends = taken.offsets.to_numpy()[upto]
        return taken.flatten().to_numpy(), np.diff(ends, prepend=0)


def encoded_texts(batches: Iterator[pa.RecordBatch], words: WordIds) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Document ids, all ids and how many each document has, for some batches of (id, text) at a time."""
    docs: list[pa.Array] = []
    texts: list[pa.Array] = []
    size = 0
    for batch in batches:
        docs.append(batch.column(0).cast(pa.int64()))
        texts.append(batch.column(1).cast(pa.large_string()))
        size += texts[-1].nbytes
        if size >= TEXT_BYTES:
            yield pa.concat_arrays(docs), *words.ids(pa.concat_arrays(texts))
            docs, texts, size = [], [], 0
    if docs:
        yield pa.concat_arrays(docs), *words.ids(pa.concat_arrays(texts))
