"""Spelling variants: words within one edit, found in a bidirectional FM-index.

The vocabulary is written as one text with a delimiter before and after every word.  A
bidirectional index keeps, for the string matched so far, its interval of suffix ranks in
the text and in the reversed text, and grows the string on either side.  With one error
allowed, one half of a word is free of it, so there are two search schemes: match the
first half exactly from its end to the delimiter, then extend to the right with one error
in the second half; and the mirror image.  A pair that both schemes see is kept by the
first only.

The index is cut into shards that Spark builds and searches side by side.  A word goes to
the shards of the half-length prefixes (and suffixes) that a neighbour of its length could
match exactly, and is searched in the shard of its own half.  Shards have about ``WORDS``
words; one that holds more, because many words share a half, is cut into blocks of that
size, each searched for all blocks of patterns.  A task hands on one row a pattern: how
many near words, and the most frequent one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.llm.common import ascii_lower, stored
from catalith.llm.registry import query

#: Letters of a run; one run in REMOVE loses a code point; shortest word; fewest occurrences; times a form is more frequent.
RUN, REMOVE, SHORTEST, FEWEST, TIMES = r"[A-Za-zÀ-ÿ]+", 97, 5, 3, 2
#: Words of a shard, and patterns searched at once.
WORDS, STEP = 20_000, 2048
_DELIMITER = 0


class BitRanks:
    """For a sequence of symbols, how many of the first ``i`` are smaller than a symbol."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        blocks = len(symbols) // 64 + 1
        padded = np.full(blocks * 64, alphabet, dtype=np.int64)
        padded[:len(symbols)] = symbols
        smaller = padded[None, :] < np.arange(alphabet + 1)[:, None]
        self.bits = np.packbits(smaller.reshape(alphabet + 1, blocks, 64), axis=2, bitorder="little").view("<u8")[..., 0]
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.cumsum(counts, axis=1) - counts

    def __call__(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        block, bit = i >> 6, (i & 63).astype(np.uint64)
        inside = self.bits[symbol, block] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[symbol, block] + np.bitwise_count(inside)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``text`` in sorted order, by doubling the compared length."""
    rank, n, width = text.astype(np.int64), len(text), 1
    while True:
        pair = rank * (int(rank.max()) + 2) + np.roll(rank, -width)
        order = np.argsort(pair, kind="stable")
        fresh = np.cumsum(np.diff(pair[order], prepend=pair[order[0]] - 1) != 0) - 1
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or width >= n:
            return order
        width *= 2


class BidirectionalIndex:
    """FM-index of the delimited ``words`` (arrays of symbols from 1 up) and of their reversal."""

    def __init__(self, words: list[np.ndarray], alphabet: int) -> None:
        self.alphabet = alphabet
        gap = np.array([_DELIMITER])
        text = np.concatenate([x for w in words for x in (gap, w)])
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
        self.n = len(text)
        self.order = suffix_order(text)
        #: Number of the word that begins after the delimiter at a place of the text.
        self.word_at = np.full(self.n, -1, dtype=np.int64)
        self.word_at[starts] = np.arange(len(words))
        self.left = BitRanks(text[self.order - 1], alphabet)
        back = text[::-1]
        self.right = BitRanks(back[suffix_order(back) - 1], alphabet)
        self.first = np.searchsorted(np.sort(text), np.arange(alphabet + 1))

    def grow(self, state: tuple[np.ndarray, np.ndarray, np.ndarray], symbol: np.ndarray, rightward: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(low, low in the reversal, size)`` of every matched string with ``symbol`` added on one side."""
        low, back, size = state
        ranks, own, other = (self.right, back, low) if rightward else (self.left, low, back)
        least, most = ranks(symbol, own), ranks(symbol, own + size)
        a, b = ranks(symbol + 1, own) - least, ranks(symbol + 1, own + size) - most
        own, other = self.first[symbol] + a, other + most - least
        return (other, own, b - a) if rightward else (own, other, b - a)

    def every(self, low: np.ndarray, back: np.ndarray, size: np.ndarray, rightward: bool) -> tuple[np.ndarray, np.ndarray, tuple]:
        """All ways to add a letter on one side: which string, the letter, and the states."""
        letters = np.arange(1, self.alphabet)
        who, letter = np.repeat(np.arange(len(low)), len(letters)), np.tile(letters, len(low))
        grown = self.grow((low[who], back[who], size[who]), letter, rightward)
        some = grown[2] > 0
        return who[some], letter[some], tuple(x[some] for x in grown)

    def near(self, patterns: np.ndarray, length: np.ndarray, rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(pattern, word)`` pairs one edit apart, the edit in the second half (``rightward``) or the first; a pair may repeat.

        ``patterns``: symbols, a row each, filled up on the right.
        """
        half = length // 2
        todo = np.where(rightward, half, length - half)

        def symbol(p: np.ndarray, exact: bool, k: np.ndarray) -> np.ndarray:
            """The k-th letter away from the middle, in the exact half or the other; the delimiter after the last."""
            to_right = rightward != exact
            at = half[p] + k if to_right else half[p] - 1 - k
            end = (at >= length[p]) if to_right else (at < 0)
            return np.where(end, _DELIMITER, patterns[p, np.clip(at, 0, patterns.shape[1] - 1)])

        p = np.arange(len(patterns))
        state = (np.zeros(len(p), dtype=np.int64), np.zeros(len(p), dtype=np.int64), np.full(len(p), self.n))
        for k in range(int(todo.max(initial=0)) + 1):
            moves = k <= todo[p]
            grown = self.grow(state, symbol(p, True, np.full(len(p), k)), not rightward)
            state = tuple(np.where(moves, g, s) for g, s in zip(grown, state))
            some = state[2] > 0
            p, state = p[some], tuple(x[some] for x in state)
        rest = length - todo
        # Strings with the error behind them: pattern, letters of the other half used, state.
        wrong = [np.zeros(0, dtype=np.int64)] * 5
        found: list[tuple[np.ndarray, np.ndarray]] = []
        k = 0
        while len(p) or len(wrong[0]):
            if len(p):
                who, letter, grown = self.every(*state, rightward)
                at = np.full(len(who), k)
                change = (letter != symbol(p[who], False, at)) & (k < rest[p[who]])
                gone = k < rest[p]
                wrong = [np.concatenate(z) for z in zip(
                    wrong, (p[who], at, *grown),                                                                # one letter more
                    (p[who][change], at[change] + 1, *(x[change] for x in grown)),                             # another letter
                    (p[gone], np.full(int(gone.sum()), k + 1), *(x[gone] for x in state)))]                    # one letter fewer
            # Every string whose next letter is number k goes on; the error-free ones too.
            now = wrong[1] == k
            going, later = [x[now] for x in wrong], [x[~now] for x in wrong]
            last = going[1] == rest[going[0]]
            grown = self.grow(tuple(going[2:]), symbol(going[0], False, going[1]), rightward)
            some = grown[2] > 0
            hit = last & some
            # A whole word between delimiters: its suffix rank gives its place.
            found.append((going[0][hit], self.word_at[self.order[grown[0][hit]]]))
            on = some & ~last
            wrong = [np.concatenate(z) for z in zip(later, (going[0][on], going[1][on] + 1, *(x[on] for x in grown)))]
            if len(p):
                state = self.grow(state, symbol(p, False, np.full(len(p), k)), rightward)
                more = (state[2] > 0) & (k < rest[p])
                p, state = p[more], tuple(x[more] for x in state)
            k += 1
        pairs = np.unique(np.concatenate([np.column_stack(f) for f in found] or [np.zeros((0, 2), dtype=np.int64)]), axis=0)
        return pairs[:, 0], pairs[:, 1]


def _points(words: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(w.encode("utf-32-le"), dtype="<u4").astype(np.int64) for w in words]


def search(entries: list[str], counts: np.ndarray, patterns: list[str], prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near words of ``patterns`` among ``entries``, the error in the second half where ``prefix``, else in the first.

    Returns, by pattern, how many there are and the entry of the largest count (ties: the smallest word), -1 if none.
    """
    order = sorted(range(len(entries)), key=lambda i: entries[i])
    words = _points([entries[i] for i in order])
    counts = counts[order]
    names, coded = np.unique(np.concatenate(words), return_inverse=True)
    words = np.split(coded + 1, np.cumsum([len(w) for w in words])[:-1])
    # One symbol more, for letters that no entry has.
    index = BidirectionalIndex(words, len(names) + 2)
    n_near, top = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), -1, dtype=np.int64)
    for side in (True, False):
        mine = np.flatnonzero(prefix == side)
        for s in range(0, len(mine), STEP):
            some = mine[s:s + STEP]
            asked = _points([patterns[i] for i in some])
            length = np.array([len(a) for a in asked])
            table = np.zeros((len(asked), int(length.max())), dtype=np.int64)
            table[np.arange(table.shape[1])[None, :] < length[:, None]] = np.concatenate(asked)
            at = np.searchsorted(names, table).clip(0, len(names) - 1)
            table = np.where(names[at] == table, at + 1, len(names) + 1)
            p, w = index.near(table, length, side)
            if not side:
                # The first scheme has the words that begin like the pattern's first half.
                first = np.array([entries[order[j]][:length[i] // 2] != patterns[some[i]][:length[i] // 2] for i, j in zip(p, w)], dtype=bool)
                p, w = p[first], w[first]
            n_near[some] += np.bincount(p, minlength=len(some))
            by = np.lexsort((w, -counts[w], p))
            lead = by[np.flatnonzero(np.diff(p[by], prepend=-1))]
            top[some[p[lead]]] = w[lead]
    return n_near, np.array([order[t] if t >= 0 else -1 for t in top], dtype=np.int64)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", run: str = RUN, remove: int = REMOVE,
               shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """``(word, n)``: runs of letters, A-Z lower-cased, ``shortest`` code points and ``fewest`` occurrences at least.

    A run whose crc32 with its row's key is divisible by ``remove`` loses the code point that
    the crc32 names; a null key counts as the empty text, as does a null text.
    """
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(run), 0)).alias("run"))
    plain = F.octet_length("run") == F.length("run")
    runs = runs.withColumn("run", F.when(plain, F.lower("run")).otherwise(ascii_lower(F.col("run"))))
    # A run only gets shorter.
    runs = runs.filter(F.length("run") >= shortest)
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "k", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, int(h % length(run)))"), F.expr("substring(run, int(h % length(run)) + 2)"))
    words = runs.select(F.when((F.col("h") % remove == 0) & (at >= 0), cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= fewest)


def _routes(words: DataFrame, shards: int) -> DataFrame:
    """Rows ``(shard, asks, prefix, word, n)``: where a word lies, and where it is searched."""
    def half(side: str, letters: Column) -> Column:
        part = F.substring(F.col("word"), F.lit(1), letters) if side == "p" else F.expr("word").substr(F.length("word") - letters + 1, letters)
        return F.pmod(F.xxhash64(F.lit(side), part), F.lit(shards)).cast("int")

    size = F.length("word")
    down, up = (lambda x: F.floor(x / 2).cast("int")), (lambda x: F.ceil(x / 2).cast("int"))
    lies = F.array_distinct(F.array(*(half("p", down(size + d)) for d in (-1, 0, 1)), *(half("s", up(size + d)) for d in (-1, 0, 1))))
    stays = words.select(F.explode(lies).alias("shard"), F.lit(False).alias("asks"), F.lit(False).alias("prefix"), "word", "n")
    asks = words.select(F.explode(F.array(*(
        F.struct(half(side, letters).alias("shard"), F.lit(side == "p").alias("prefix"))
        for side, letters in (("p", down(size)), ("s", up(size)))))).alias("to"), "word", "n")
    return stays.unionByName(asks.select("to.shard", F.lit(True).alias("asks"), "to.prefix", "word", "n"))


def near_words(words: DataFrame, shard_words: int = WORDS) -> DataFrame:
    """``(word, n_near, near, near_n)`` for the words of ``words(word, n)`` with a near word: how many, and the most frequent."""
    total = words.count()
    routes = _routes(words, max(1, -(-total * 4 // shard_words)))
    full = (routes.filter(~F.col("asks")).groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / (2 * shard_words)).cast("int").alias("blocks"))
            .filter("blocks > 1"))
    # Shards of many words with one half only; there are fewer than words / shard_words of them.
    placed = routes.join(full, "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    each = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = placed.withColumn("other", F.explode(each)).select(
        "shard", F.when(F.col("asks"), F.col("other")).otherwise(own).alias("lies_in"),
        F.when(F.col("asks"), own).otherwise(F.col("other")).alias("asked_in"), "asks", "prefix", "word", "n")

    def within(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        lies, asked = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
        if not lies.num_rows or not asked.num_rows:
            return pa.table({"word": pa.array([], pa.string()), "found": pa.array([], pa.int64()), "near": pa.array([], pa.string()), "near_n": pa.array([], pa.int64())})
        entries, patterns = lies.column("word").to_pylist(), asked.column("word").to_pylist()
        counts = lies.column("n").to_numpy()
        n_near, top = search(entries, counts, patterns, asked.column("prefix").to_numpy(zero_copy_only=False))
        told = np.flatnonzero(n_near)
        return pa.table({"word": asked.column("word").take(pa.array(told)), "found": n_near[told],
                         "near": lies.column("word").take(pa.array(top[told])), "near_n": counts[top[told]]})

    found = placed.groupBy("shard", "lies_in", "asked_in").applyInArrow(within, "word string, found long, near string, near_n long")
    # Largest count first, then the smallest word: a struct of the two, the count turned round, has that order.
    lead = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return found.groupBy("word").agg(F.sum("found").alias("n_near"), lead.alias("lead")).select(
        "word", "n_near", F.col("lead.near").alias("near"), (-F.col("lead.less")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for every word of ``forms(word, form)``: the end of its chain of forms.

    Frequencies at least double along a chain, so chains are short and each round doubles the step.
    """
    step = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = materialize(step.join(after, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        step = step.select("word", "root")


def variant_groups(words: DataFrame, times: int = TIMES, shard_words: int = WORDS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every row of ``words(word, n)``, words distinct and not null.

    ``form``: the near word of largest n (ties: the smallest in code-point order), if that is
    ``times`` the word's own or more; ``root``: the end of the chain of forms, the word itself without one.
    An empty table gives an empty result.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    near = stored(near_words(words, shard_words), "near")
    is_form = F.col("near_n") >= times * F.col("n")
    full = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n"))
    full = materialize(full, "variants")
    roots = _roots(full.filter(F.col("form").isNotNull()))
    return full.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


@query("op13_spelling")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return variant_groups(vocabulary(spark.read.parquet(f"{folder}/documents.parquet"))).select(
        "word", "n", "n_near", "form", "form_n", "root")
