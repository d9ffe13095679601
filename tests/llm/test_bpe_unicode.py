"""Every code point between letters, encoded as the library does."""

import numpy as np
import pytest

from vellumry.llm import bpe


def test_every_code_point_is_encoded_as_by_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.tokenizer_path()
    library, own = tokenizers.Tokenizer.from_file(path), bpe.Encoder(path)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    wrong = []
    for k in range(0, len(points), 20_000):
        texts = [f"a{chr(c)}b" for c in points[k : k + 20_000]]
        for text, x in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            if np.frombuffer(own.encode(text), "<u4").tolist() != x.ids:
                wrong.append(hex(ord(text[1])))
    assert wrong == []
