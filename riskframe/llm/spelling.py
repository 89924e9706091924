"""Spelling variant grouping: all pairs of words at distance one, by search schemes on bidirectional FM-indexes.

Vocabulary: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` (only A-Z lower-cased) are counted by Spark over whole texts; of
a run whose ``crc32("<doc_id>:<run>")`` is divisible by 199 the code point number ``crc32 % length`` is deleted
first (a null id is written as nothing). Words are the results of at least 6 code points and 5 occurrences.

Search: a word is cut into two halves. A word that differs by one inserted, deleted or replaced code point has the left
half or the right half unchanged at the same end, so there are two schemes: match the left half exactly and extend to
the right with one error, or match the right half and extend to the left. Words that can meet in a scheme share the
unchanged half, so each word is written as a query under its own half and into the index under every half that a word
of one code point less, as many or one more may ask for (two of them per scheme). Halves are dealt out to groups of
about SHARD_SYMBOLS code points; a half that alone has more is split into several groups, to each of which its
queries go. One Spark task builds the index of a group and searches it for all the group's queries together.

The index of a group is a bidirectional FM-index over its delimited words ``$w1$w2$...$``: the Burrows-Wheeler
transforms of the text and of the reversed text as wavelet matrices, and synchronised suffix-rank intervals in both. The
exact half is matched from its inner end to the delimiter, then the direction turns and the other half is matched with
one error: every symbol that occurs next in the interval opens a branch (replacement, insertion, deletion), each taken
at the last place of a run of equal symbols only, so that a word is reached once. The suffix rank of a whole ``$v$`` is
the word's rank among the group's words. Words that both schemes reach are taken from the first one.

Forms: a word's form is its near word of the largest n (ties: the first in code-point order) if that n is 5 times its own
or more; the root is reached by joins that double the step, since n grows by 5 on each step.

Null and empty texts have no words; rows that repeat an id count each; an empty table or vocabulary gives no
rows; further columns are ignored. Memory: a text and its words at a time while counting, one group's words while
searching (a word longer than a group is a group of its own).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import store
from riskframe.llm.winnow import LOWER, UPPER

# fixed values of the contract
MIN_POINTS, MIN_COUNT, TYPO_MOD, FORM_TIMES = 6, 5, 199, 5
#: Code points of the words in one index, about.
SHARD_SYMBOLS = 1 << 18
#: Queries searched at once.
QUERY_BLOCK = 1 << 14
#: Texts are exploded into runs of at least MIN_POINTS code points; shorter ones never make a word.
RUNS = r"[A-Za-z\x{C0}-\x{FF}]{%d,}" % MIN_POINTS


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words and their occurrences."""
    runs = docs.where("text is not null").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUNS), F.lit(0))).alias("r"))
    low = F.when(F.length("r") == F.octet_length("r"), F.lower("r")).otherwise(F.translate("r", UPPER, LOWER))
    runs = runs.select("doc_id", low.alias("r"))
    runs = runs.select("r", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("r"))).alias("h"))
    at = (F.col("h") % F.length("r")).cast("int")
    cut = F.concat(F.substring("r", F.lit(1), at), F.substring("r", at + 2, F.length("r")))
    words = runs.select(F.when(F.col("h") % TYPO_MOD == 0, cut).otherwise(F.col("r")).alias("word")).where(F.length("word") >= MIN_POINTS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes of ``text`` (small integers), by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        sorted_key = key[order]
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank, step = fresh, step * 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class Wavelet:
    """The Burrows-Wheeler transform of a text as a wavelet matrix: ranks and counts of smaller symbols by bit planes."""

    def __init__(self, text: np.ndarray, bits: int):
        order = suffix_array(text)
        last = text[order - 1]  # of the suffix at 0: the text's last symbol
        self.planes, current = [], last
        for b in reversed(range(bits)):
            bit = current >> b & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
            self.planes.append((b, ones, np.int64(len(text) - ones[-1])))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        counts = np.bincount(text, minlength=1 << bits)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        symbols = np.arange(1 << bits)
        at = np.zeros(1 << bits, np.int64)
        for b, ones, zeros in self.planes:
            below = ones[at]
            at = np.where(symbols >> b & 1, zeros + below, at - below)
        self.shift = self.first - at

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray):
        """Intervals of the patterns with ``c`` put before them, and how many smaller symbols stand there."""
        less = np.zeros(len(lo), np.int64)
        for b, ones, zeros in self.planes:
            lo1, hi1 = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            bit = (c >> b & 1).astype(bool)
            less += np.where(bit, (hi - hi1) - (lo - lo1), 0)
            lo, hi = np.where(bit, zeros + lo1, lo - lo1), np.where(bit, zeros + hi1, hi - hi1)
        shift = self.shift[c]
        return lo + shift, hi + shift, less

    def symbols(self, lo: np.ndarray, hi: np.ndarray):
        """Every symbol that stands before the patterns: (which pattern, symbol, interval, smaller symbols)."""
        src, sym, less = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for b, ones, zeros in self.planes:
            lo1, hi1 = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            lo0, hi0 = lo - lo1, hi - hi1
            a, z = hi0 > lo0, hi1 > lo1
            src, sym = np.concatenate([src[a], src[z]]), np.concatenate([sym[a], sym[z] | 1 << b])
            less = np.concatenate([less[a], less[z] + (hi0 - lo0)[z]])
            lo, hi = np.concatenate([lo0[a], zeros + lo1[z]]), np.concatenate([hi0[a], zeros + hi1[z]])
        shift = self.shift[sym]
        return src, sym, lo + shift, hi + shift, less


class Index:
    """Bidirectional FM-index of distinct words. An interval is (lo, hi) among the suffixes and ``rlo``, where its mirror
    image starts among the suffixes of the reversed text."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in self.words]
        joined = np.concatenate([np.concatenate([np.zeros(1, np.uint32), p]) for p in points] + [np.zeros(1, np.uint32)])
        self.alphabet, text = np.unique(joined, return_inverse=True)  # the delimiter 0 is the smallest
        text = text.astype(np.int64)
        bits = max(1, int(len(self.alphabet) - 1).bit_length())
        self.n, self.left, self.right = len(text), Wavelet(text, bits), Wavelet(text[::-1].copy(), bits)

    def codes(self, word: str) -> np.ndarray:
        """The word's symbols, -1 for code points that no word of the index has."""
        points = np.frombuffer(word.encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, -1)

    def to_left(self, lo, hi, rlo, c):
        new_lo, new_hi, less = self.left.extend(lo, hi, c)
        return new_lo, new_hi, rlo + less

    def to_right(self, lo, hi, rlo, c):
        new_rlo, new_rhi, less = self.right.extend(rlo, rlo + (hi - lo), c)
        return lo + less, lo + less + (new_rhi - new_rlo), new_rlo

    def next_right(self, lo, hi, rlo):
        src, sym, new_rlo, new_rhi, less = self.right.symbols(rlo, rlo + (hi - lo))
        return src, sym, lo[src] + less, lo[src] + less + (new_rhi - new_rlo), new_rlo


def near_words(index: Index, queries: list[str], halves: list[int], own: np.ndarray) -> Iterator[tuple[int, int]]:
    """(query, word) numbers: the words that share the query's first ``halves`` code points and differ by one further on.

    ``own``: whether the query itself is a word of the index; an interval of one suffix then holds nothing else."""
    if not queries:
        return
    coded = [index.codes(q) for q in queries]
    size = np.array([len(c) for c in coded])
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    flat = np.concatenate([np.append(c, 0) for c in coded])  # each ends in the delimiter
    half = np.array(halves)
    gone = flat < 0

    q = np.arange(len(queries))
    lo, hi, rlo = np.zeros(len(q), np.int64), np.full(len(q), index.n, np.int64), np.zeros(len(q), np.int64)
    for back in range(int(half.max()) + 1):  # from the inner end of the half outwards, then the delimiter
        going = back <= half[q]
        place = half[q] - 1 - back
        c = np.where(place >= 0, flat[start[q] + np.maximum(place, 0)], 0)
        going &= c >= 0
        done = back > half[q]
        a, b, r = index.to_left(lo[going], hi[going], rlo[going], c[going])
        lo[going], hi[going], rlo[going] = a, b, r
        keep = (going & (hi > lo) & ((hi - lo > 1) | ~own[q])) | done
        q, lo, hi, rlo = q[keep], lo[keep], hi[keep], rlo[keep]
        if not len(q):
            return

    # exact: intervals of $ and the first at[q] code points; tried: those with one error, which go on exactly
    at = half[q]
    tried = tuple(np.zeros(0, np.int64) for _ in range(5))  # query, place, lo, hi, rlo
    while len(q) or len(tried[0]):
        branches = []
        if len(q):
            want = flat[start[q] + at]
            src, sym, nlo, nhi, nrlo = index.next_right(lo, hi, rlo)
            other = (sym != want[src]) & (sym != 0)
            inside = at < size[q]
            branches.append((q[src[other]], at[src[other]], nlo[other], nhi[other], nrlo[other]))  # inserted
            swap = other & inside[src]
            branches.append((q[src[swap]], at[src[swap]] + 1, nlo[swap], nhi[swap], nrlo[swap]))  # replaced
            drop = inside & (flat[start[q] + np.minimum(at + 1, size[q])] != want) | (inside & gone[start[q] + at])
            branches.append((q[drop], at[drop] + 1, lo[drop], hi[drop], rlo[drop]))  # deleted
            on = (sym == want[src]) & inside[src]
            on &= (nhi - nlo > 1) | ~own[q[src]]
            branch_q = q
            q, at, lo, hi, rlo = branch_q[src[on]], at[src[on]] + 1, nlo[on], nhi[on], nrlo[on]
        tried = tuple(np.concatenate([t, *[b[i] for b in branches]]) for i, t in enumerate(tried))
        tq, tat, tlo, thi, trlo = tried
        c = flat[start[tq] + tat]
        ok = c >= 0
        tq, tat, tlo, thi, trlo, c = (x[ok] for x in (tq, tat, tlo, thi, trlo, c))
        nlo, nhi, nrlo = index.to_right(tlo, thi, trlo, c)
        found = nhi > nlo
        ended = found & (tat == size[tq])
        for a, b in zip(tq[ended].tolist(), nlo[ended].tolist()):
            yield a, b - 1  # the suffix "$" alone is the first, then the words in order
        found &= ~ended
        tried = (tq[found], tat[found] + 1, nlo[found], nhi[found], nrlo[found])


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """The near pairs of one group; its words of scheme 1 are reversed, so that the unchanged half is always the left one."""
    flip = bool(rows["side"].iloc[0])
    turn = (lambda w: w[::-1]) if flip else (lambda w: w)
    held = rows.loc[rows["indexed"], ["word", "n"]].drop_duplicates("word")
    count = dict(zip(map(turn, held["word"]), held["n"]))
    out: list[tuple[str, str, int]] = []
    if count:
        index = Index(list(count))
        asked = sorted(set(map(turn, rows.loc[rows["asks"], "word"])), key=len)
        for at in range(0, len(asked), QUERY_BLOCK):
            block = asked[at:at + QUERY_BLOCK]
            halves = [(len(w) + 1) // 2 if flip else len(w) // 2 for w in block]
            own = np.array([w in count for w in block])
            for i, j in near_words(index, block, halves, own):
                word, near = block[i], index.words[j]
                if flip:
                    # the first scheme has those that share the left half
                    a, b = turn(word), turn(near)
                    if a[:len(a) // 2] == b[:len(a) // 2]:
                        continue
                    out.append((a, b, count[near]))
                else:
                    out.append((word, near, count[near]))
    return pd.DataFrame(out, columns=["word", "near", "near_n"])


def _ship() -> None:
    """Python workers get this module by value: the package need not be installed on executors."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def near_pairs(words: DataFrame, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """(word, near, near_n): all ordered pairs of ``words`` (distinct ``word``, ``n``) that differ by exactly one code point."""
    _ship()
    size = F.length("word")

    def halves(side: int) -> Column:
        up = F.lit(side)  # the left half is the shorter one
        lengths = F.array_distinct(F.transform(F.array(size - 1, size, size + 1), lambda m: F.floor((m + up) / 2).cast("int")))
        own = F.floor((size + up) / 2).cast("int")
        text = (lambda k: F.right(F.col("word"), k)) if side else (lambda k: F.left(F.col("word"), k))
        return F.transform(lengths, lambda k: F.struct(F.lit(side).alias("side"), text(k).alias("half"), (k == own).alias("asks")))

    rows = words.select("word", "n", F.inline(F.concat(halves(0), halves(1))))
    rows = rows.select("word", "n", "side", "asks", F.xxhash64("half", "side").alias("key"))
    rows = store(rows, "spelling-halves")
    symbols = F.sum(F.length("word") + 1).cast("long")
    per_key = rows.groupBy("side", "key").agg(symbols.alias("s"))
    total = per_key.agg(F.sum("s")).first()[0] or 0
    groups = max(1, math.ceil(total / 2 / shard_symbols))
    # at most one row for each shard_symbols code points
    large = per_key.where(F.col("s") > shard_symbols).select("side", "key", F.ceil(F.col("s") / shard_symbols).cast("int").alias("cut"))
    rows = rows.join(large, ["side", "key"], "left")
    mine = F.pmod(F.xxhash64("word"), F.col("cut")).cast("int")
    split = F.when(F.col("cut").isNull(), F.array(F.lit(-1))).when(F.col("asks"), F.sequence(F.lit(0), F.col("cut") - 1)).otherwise(F.array(mine))
    rows = rows.select("word", "n", "side", "asks", "cut", mine.alias("mine"), F.explode(split).alias("part"),
                       F.when(F.col("cut").isNull(), F.pmod("key", F.lit(groups))).otherwise(F.col("key")).alias("place"))
    rows = rows.select("word", "n", "side", "asks", "place", "part", (F.col("cut").isNull() | (F.col("mine") == F.col("part"))).alias("indexed"))
    return rows.groupBy("side", "place", "part").applyInPandas(_search, "word string, near string, near_n long")


def variants(docs: DataFrame, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of ``docs``."""
    words = store(vocabulary(docs), "spelling-words")
    pairs = near_pairs(words, shard_symbols)
    best = F.min(F.struct((-F.col("near_n")).alias("back"), F.col("near").alias("near")))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    far = -F.col("best.back") >= FORM_TIMES * F.col("n")
    rows = store(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(far, F.col("best.near")).alias("form"),
        F.when(far, -F.col("best.back")).alias("form_n")), "spelling-forms")
    # a form has 5 times the n, from MIN_COUNT on: so many steps at most, and each round doubles the step
    largest = words.agg(F.max("n")).first()[0] or 0
    steps = math.floor(math.log(max(largest, 1) / MIN_COUNT, FORM_TIMES) + 1e-9) if largest >= MIN_COUNT else 0
    root = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(steps - 1, 0).bit_length()):
        beyond = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        root = store(root.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return rows.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
