import zlib

import numpy as np

from tallyport.llm import token_codec


def test_blocks_of_earlier_files_are_read(monkeypatch):
    ids = np.random.default_rng(5).integers(0, 50, 200_000) ** 2
    counts = np.array([150_000, 50_000])
    assert token_codec.pack([1, None], counts, ids, 3000)[:4] == b"TKB2"
    monkeypatch.setattr(token_codec, "MAGIC", b"TKB1")
    old = token_codec.pack([1, None], counts, ids, 3000)
    monkeypatch.undo()
    docs, found, back = token_codec.unpack(old)
    assert docs == [1, None] and (found == counts).all() and (back == ids).all()


def test_values_are_looked_up_in_any_order():
    rng = np.random.default_rng(8)
    for vocabulary, most in ((3, 2), (49_000, 900), (70_000, 1 << 40)):
        sums = np.append(0, np.cumsum(rng.integers(1, most, vocabulary)))
        values = np.concatenate([rng.integers(0, sums[-1], 9000), sums[:-1], sums[1:] - 1])
        assert (token_codec._looked_up(sums, values) == np.searchsorted(sums, values, side="right") - 1).all()


def test_block_is_coded_as_before():
    ids = np.random.default_rng(9).integers(0, 300, 60_000) ** 2 // 300
    assert zlib.crc32(token_codec.encode(ids, 400)) == 4097623974
