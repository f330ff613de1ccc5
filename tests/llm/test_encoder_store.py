import itertools

import public_tokenizers as P

from catalith.llm.segments import Encoder, _Store


def test_words_met_again_are_not_encoded_again():
    """Some 200,000 words of a few documents outgrew the store, so most were encoded at each meeting."""
    enc = Encoder(P.path("word_bpe_49k.json"))
    made, words = [], ["".join(w) for w in itertools.islice(itertools.product("abcdefghijklmnop", repeat=5), 190_000)]
    make = enc.bare.make
    enc.bare = _Store(lambda piece: made.append(piece) or make(piece))
    first = enc.ids(" ".join(words))
    assert enc.ids(" ".join(words)) == first
    assert len(made) == len(words)


def test_words_and_their_ends_equal_the_library():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok, enc = Tokenizer.from_file(path), Encoder(path)
    words = ["a", "Été", "naïve", "Straße", "İx", "ñ", "x1", "don't", "we'll", "_a", "e.g", "漢字", "á", "", "Ω", "ŉ", "ﬁ"]
    for word, end in itertools.product(words, [*".,;:!?", "", "...", "?!", "'s.", ".̸", "-", "_."]):
        for text in (word + end, f"{word}{end} {word}", f"x {end}{word}{end}\n{word}"):
            assert list(memoryview(enc.ids(text)).cast("I")) == tok.encode(text, add_special_tokens=False).ids, text
