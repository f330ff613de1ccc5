"""Whole-text and piecewise encoders against the tokenizers library on random Unicode."""

import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from catalith.llm.segments import Encoder  # noqa: E402

PARTS = ["don't", "I'LL", "_", "__x_", "12", "３", "½", "Ⅷ", " ", "  ", "\n", "\r\n", "\t", " ", " ", "é", "É", "ß", "İ", "ŉ", "Ⱥ", "中文", "한글",
         "á", "👍🏽", "<|endoftext|>", "<|startoftext|>", "</w>", "word", "Straße", "naïve", "x" * 40, "...", "!?", "​", "\x00", "ﬁ", "ǅ"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_random_texts(name):
    from tokenizers import Tokenizer

    rng, own, tok = random.Random(7), Encoder(P.path(name)), Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    texts += [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(8)) for _ in range(1000)]
    texts += ["".join(chr(c) for c in rng.sample([*range(1, 0xD800), *range(0xE000, 0x20000)], 20)) for _ in range(500)]
    for t, want in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own.ids(t), "<u4").tolist() == want.ids, t
