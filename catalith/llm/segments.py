"""Encoding of whole texts by a tokenizer file.

A byte-level file whose ids count up in the order of its merges is a table of ranks: the
tiktoken library then encodes whole texts with the file's own split pattern, and no piece is
kept.  Spans, and ids of other files, are made piece by piece with a bounded memory.

Both pre-tokenizers used here never match across a single space that stands
between two other characters, so the pieces on either side of it encode alone.
Words recur, so their ids are kept; when the store is full, pieces not met lately
are forgotten, which changes no result.
"""

from __future__ import annotations

import gc
import json
import os
import re
from functools import lru_cache
from struct import pack, unpack

import numpy as np

#: Pieces whose ids a worker keeps (some 200 bytes each).
KEPT_PIECES = 400_000
#: Two separators in a row, or white space other than space and line end.
_ODD = re.compile(r"[ \n][ \n]|[^\S \n]")
_SAFE = re.compile(r"(?<=\S)(?= \S)")
#: Letters, then ASCII punctuation but the underscore: both pre-tokenizers end a match between them.
_MIXED = re.compile(r"([^\W\d_]+)([!-/:-@\[-^`{-~].*)", re.DOTALL)
#: Forms of few ids.
_FORMATS = [f"<{n}I" for n in range(32)]
#: ASCII punctuation that mostly ends a word.
_ENDS = frozenset(".,;:!?")


#: Fixed value: the split pattern of byte-level pre-tokenizers, without needless backtracking.
_BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Bytes of lower-case Latin letters, and the byte that stands for each at the end of a word.
_LATIN = [*range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]
_LAST = {b: b + 128 if b < 0x80 else b - 128 for b in _LATIN if b < 0xC0}


def _byte_letters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if visible, else the next from 256 up."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _ranked(model: dict) -> list[tuple[str, str]] | None:
    """The merges of a BPE model if its ids count up in their order, each giving another token; then lower ids merge first."""
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [model["vocab"].get(a + b, -1) for a, b in merges]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    counts_up = len(set(ids)) == len(ids) and ids == sorted(ids) and -1 not in ids
    return merges if model["type"] == "BPE" and plain and counts_up else None


def _whole_texts(spec: dict):
    """tiktoken over the ranks of a byte-level file; None for other files."""
    merges, pre = _ranked(spec["model"]), spec.get("pre_tokenizer") or {}
    asked = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if merges is None or spec.get("normalizer") or spec["model"].get("end_of_word_suffix") or any(pre.get(k) != v for k, v in asked.items()):
        return None
    import tiktoken

    letters, vocab = _byte_letters(), spec["model"]["vocab"]
    made = [*letters, *(a + b for a, b in merges)]
    if any(t not in vocab for t in made):
        return None
    return tiktoken.Encoding("byte-level", pat_str=_BYTE_LEVEL, mergeable_ranks={bytes(map(letters.get, t)): vocab[t] for t in made}, special_tokens={})


def _lower_words(spec: dict):
    """Ids of words of lower-case Latin letters (as UTF-8) by the ranks of a file with word ends; None for other files.

    The last byte of a word is another symbol than the same byte inside, so it gets a byte of its own.
    """
    merges, end = _ranked(spec["model"]), spec["model"].get("end_of_word_suffix")
    if merges is None or not end:
        return None
    from tiktoken._tiktoken import CoreBPE

    vocab, letters = spec["model"]["vocab"], _byte_letters()
    written = {b: c for c, b in letters.items()}
    symbols = {written[b]: bytes([b]) for b in _LATIN} | {written[b] + end: bytes([to]) for b, to in _LAST.items()}
    for a, b in merges:
        if a in symbols and b in symbols:
            symbols[a + b] = symbols[a] + symbols[b]
    if not symbols.keys() <= vocab.keys():
        return None
    encode = CoreBPE({to: vocab[t] for t, to in symbols.items()}, {}, r"\S+").encode_single_piece
    last = {b: bytes([to]) for b, to in _LAST.items()}
    return lambda word: encode(word[:-1] + last[word[-1]])


class _Store(dict):
    """What ``make`` gives for a piece; pieces not met again for a while go."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
        if len(self) >= KEPT_PIECES // 2:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value


class Encoder:
    """Ids (and character spans) of texts by one tokenizers file; special-token strings are ordinary text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        self.whole, self.words = _whole_texts(spec), _lower_words(spec)
        self.tok.encode_special_tokens = True
        self.model, self.pre, self.norm = self.tok.model, self.tok.pre_tokenizer, self.tok.normalizer
        #: True if white space leaves no ids, so that runs of separators need no care.
        self.drops_space = not self.tok.encode(" \n", add_special_tokens=False).ids
        self.letters = self._letters()
        self.letter_set = frozenset(map(chr, self.letters))
        self.widths = {chr(c): len(to.encode()) for c, to in self.letters.items()}
        bytes_of = _byte_letters()
        #: Latin letters as one character a byte of what the pre-tokenizer makes of them, where ``words`` knows these bytes.
        self.latin = {c: made for c, to in self.letters.items() if set(to) <= bytes_of.keys()
                      for made in ["".join(chr(bytes_of[x]) for x in to)] if set(map(ord, made)) <= set(_LATIN)}
        self.latin_set = frozenset(map(chr, self.latin))
        self.plain = self._plain()
        self.lead = {"": "", " ": "" if self.drops_space else self.pre.pre_tokenize_str(" a")[0][0][:-1]}
        self.bare = self._id_store("")
        self.spaced = self.bare if self.drops_space else self._id_store(" ")
        self.spans_bare = self._span_store("")
        self.spans_spaced = self._span_store(" ")

    def _letters(self) -> dict[int, str]:
        """Latin letters that stay one pre-token, with what the pre-tokenizer makes of them."""
        out = {}
        for c in map(chr, range(0x41, 0x250)):
            if c.isalpha():
                parts = self.pre.pre_tokenize_str(self.norm.normalize_str(c) if self.norm else c)
                if len(parts) == 1:
                    out[ord(c)] = parts[0][0]
        return out

    def _plain(self):
        """What the pre-tokenizer makes of a word of ASCII letters, as one cheap call; None if it keeps not every such letter."""
        ascii_letters = {c: self.letters.get(c) for c in range(0x41, 0x7B) if chr(c).isalpha()}
        if None in ascii_letters.values():
            return None
        for made in (str, str.lower):
            if all(made(chr(c)) == to for c, to in ascii_letters.items()):
                return made
        return lambda word: word.translate(self.letters)

    def _id_store(self, lead: str) -> _Store:
        """Ids of pieces after ``lead`` (nothing or a space).

        Words of Latin letters need no pre-tokenizer; a word and what follows it from
        its first ASCII punctuation on encode apart.
        """
        tokenize, head, plain, letters, known = self.model.tokenize, self.lead[lead], self.plain, self.letters, self.letter_set
        words, latin, latins = self.words if self.drops_space else None, self.latin, self.latin_set

        def make(piece: str) -> bytes:
            if words and piece:
                if latins.issuperset(piece):
                    ids = words(piece.translate(latin).encode("latin-1"))
                    return pack(_FORMATS[len(ids)] if len(ids) < len(_FORMATS) else f"<{len(ids)}I", *ids)
                if piece[-1] in _ENDS and len(piece) > 1 and latins.issuperset(word := piece[:-1]):
                    return store[word] + self.bare[piece[-1]]
            if piece.isalpha():
                if plain and piece.isascii():
                    ids = [t.id for t in tokenize(head + plain(piece))]
                    return pack(_FORMATS[len(ids)] if len(ids) < len(_FORMATS) else f"<{len(ids)}I", *ids)
                if known.issuperset(piece):
                    ids = [t.id for t in tokenize(head + piece.translate(letters))]
                    return pack(f"<{len(ids)}I", *ids)
            elif (parts := _MIXED.fullmatch(piece)) and known.issuperset(parts[1]):
                return store[parts[1]] + self.bare[parts[2]]
            return self._other(lead + piece)

        store = _Store(make)
        return store

    def _other(self, text: str) -> bytes:
        """Ids of any text that may be cut out of its document."""
        if not text:
            return b""
        text = self.norm.normalize_str(text) if self.norm else text
        ids = [t.id for part, _ in self.pre.pre_tokenize_str(text) for t in self.model.tokenize(part)]
        return pack(f"<{len(ids)}I", *ids)

    def _span_store(self, lead: str) -> _Store:
        """Character spans of the tokens of pieces after ``lead``, counted from the lead's start."""
        def make(piece: str) -> bytes:
            text = lead + piece
            if not text:
                return b""
            word = text[1:] if text[0] == " " else text
            if self.plain and word.isascii() and word.isalpha():
                # The model counts bytes of the mapped word: one a character, but for the mapped space.
                mapped = self.lead[text[:len(text) - len(word)]]
                off = len(mapped.encode()) - (len(text) - len(word))
                flat = [x - off for t in self.model.tokenize(mapped + self.plain(word)) for x in t.offsets]
                if mapped:
                    flat[0] = 0
                return pack(f"<{len(flat)}i", *flat)
            if word.isalpha() and self.letter_set.issuperset(word):
                # A token that holds part of a character's bytes spans the whole character.
                before = len(text) - len(word)
                mapped = self.lead[text[:before]]
                at = [0] * len(mapped.encode()) + [i for i, c in enumerate(word, before) for _ in range(self.widths[c])]
                flat = [x for t in self.model.tokenize(mapped + word.translate(self.letters)) for a, b in (t.offsets,) for x in (at[a], at[b - 1] + 1)]
                return pack(f"<{len(flat)}i", *flat)
            if (parts := _MIXED.fullmatch(word)) and self.letter_set.issuperset(parts[1]):
                own = len(text) - len(parts[2])
                rest = self.spans_bare[parts[2]]
                return store[piece[:len(piece) - len(parts[2])]] + pack(f"<{len(rest) // 4}i", *[x + own for x in unpack(f"<{len(rest) // 4}i", rest)])
            return np.array(self.tok.encode(text, add_special_tokens=False).offsets, dtype="<i4").tobytes()

        store = _Store(make)
        return store

    def ids(self, text: str) -> bytes:
        """All ids of ``text`` as little-endian unsigned 32-bit integers."""
        if self.whole:
            return self.whole.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        bare, spaced, parts = self.bare, self.spaced.__getitem__, []
        if self.drops_space:
            return b"".join(map(bare.__getitem__, text.replace("\n", " ").split(" ")))
        if _ODD.search(text):
            return b"".join(map(bare.__getitem__, _SAFE.split(text)))
        for k, line in enumerate(text.split("\n")):
            if k:
                parts.append(bare["\n"])
            words = line.split(" ")
            parts.append(bare[words[0]])
            parts += map(spaced, words[1:])
        return b"".join(parts)

    def spans(self, text: str) -> np.ndarray:
        """``(tokens, 2)`` character starts and ends of all tokens of ``text``."""
        bare, spaced, parts, sizes = self.spans_bare, self.spans_spaced.__getitem__, [], []
        if _ODD.search(text) or self.drops_space:
            pieces = _SAFE.split(text)
            parts, sizes = list(map(bare.__getitem__, pieces)), list(map(len, pieces))
        else:
            for k, line in enumerate(text.split("\n")):
                if k:
                    parts.append(bare["\n"])
                    sizes.append(1)
                words = line.split(" ")
                parts.append(bare[words[0]])
                sizes.append(len(words[0]))
                parts += map(spaced, words[1:])
                sizes += [len(w) + 1 for w in words[1:]]
        counts = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 8
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if sizes else np.zeros(0, dtype=np.int64)
        flat = np.frombuffer(b"".join(parts), dtype="<i4").reshape(-1, 2).astype(np.int64)
        return flat + np.repeat(starts, counts)[:, None]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    gc.set_threshold(200_000)  # the store's many strings hold no cycles worth looking for
    return Encoder(path)
