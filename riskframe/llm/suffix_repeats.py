"""Repeated substrings from a common-prefix interval tree over an enhanced suffix array.

A byte is removed if a string of ``length`` bytes covers it that also starts anywhere else.

Only suffixes at anchors are kept (see anchors.py): every string of ``length`` bytes holds one, at
the same place in all its occurrences. What a string through an anchor can reach is the anchor's
context, ``length`` bytes from it on and as many before it as a string can start earlier.
1. Anchors whose k-gram occurs once are dropped (partial counts, then a join).
2. Equal contexts are counted: where one occurs twice, every string through the anchor is
   repeated, so the whole context is covered; one representative of it goes on.
3. Representatives that share a k-gram with another context are grouped by cores: a core is what
   all strings starting in the same half of the possible offsets have in common; a member of a
   core's group carries what that half's strings reach.
4. In a group, the suffixes from the anchor on are sorted; a stack scan over their common-prefix
   lengths yields the intervals. In each, the bytes before the anchor are treated the same way from
   right to left: an interval of that second tree is where the extension to the left is diverse. A
   pair of nodes is a maximal repeat with all its occurrences in the group. A member's spans of
   ``length`` and more all hold its anchor, so their union is one run: the widest left and right ends
   over its deepest nodes.
Before 4, members of a core that carry the same bytes are counted, as in 2, whatever the size of the
group: all of them are covered whole and one goes on. A core that more than ``group_rows`` different
members are left with is not gathered: its half of the offsets is halved, which lengthens the core, and
the members go through 3 and 4 again. A core of one offset is the string itself; so this ends.

Texts are UTF-8 bytes; matches never cross documents. Null and empty texts have nothing to remove.
Each row is a document, so rows repeated in id and text are copies of each other and both lose
their bytes; ties have no order. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.anchors import byte_values, joined_anchors, merged
from riskframe.llm.common import bounded_batches, map_rows, row_key, store

K = 48
CORES = 2
GROUP_ROWS = 4_096
JOINED_BYTES = 1 << 18
MEMBER = "dk long, pos long, lo int, hi int, core long, whole binary, left binary, right binary"


def shared_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def prefix_intervals(lcps: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common-prefix length, first, last) of every interval of two or more sorted texts, from neighbours' lengths."""
    stack: list[tuple[int, int]] = []
    for i, lcp in enumerate([*lcps, 0]):
        first = i
        while stack and stack[-1][0] > lcp:
            size, first = stack.pop()
            yield size, first, i
        if lcp and (not stack or stack[-1][0] < lcp):
            stack.append((lcp, first))


class SuffixGroup:
    """The suffixes of a group's (left, right) contexts from the anchor on, sorted, and the order of what lies before it."""

    def __init__(self, members: list[tuple[bytes, bytes]]):
        before = [left[::-1] for left, _ in members]
        self.order = sorted(range(len(members)), key=lambda m: members[m][1])
        self.by_left = np.array(sorted(range(len(members)), key=before.__getitem__))
        self.rank = np.empty(len(members), np.int64)
        self.rank[self.by_left] = np.arange(len(members))
        self.right = [shared_prefix(members[a][1], members[b][1]) for a, b in zip(self.order, self.order[1:])]
        ordered = self.by_left.tolist()
        self.left = np.array([shared_prefix(before[a], before[b]) for a, b in zip(ordered, ordered[1:])], np.int64)
        self.ranks = self.rank[self.order]

    def nodes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bytes right, members in the order of their left sides, left lengths between neighbours) of every interval."""
        for right, first, last in prefix_intervals(self.right):
            inside = np.sort(self.ranks[first:last + 1])
            yield right, self.by_left[inside], np.minimum.reduceat(self.left[:inside[-1]], inside[:-1])


def maximal_repeats(members: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes left of the anchor, bytes right, members) of maximal repeats; members are (left, right) contexts."""
    for right, inside, lefts in SuffixGroup(members).nodes():
        if right >= length:
            yield 0, right, inside.tolist()
        for left, lo, hi in prefix_intervals(lefts.tolist()):
            if left + right >= length:
                yield left, right, inside[lo:hi + 1].tolist()


def member_runs(members: list[tuple[bytes, bytes]], length: int) -> list[tuple[int, int, int]]:
    """(member, bytes left of the anchor, bytes right): the union of each member's maximal repeats, which all hold the anchor."""
    if len(members) == 2:
        (a, b), (c, d) = members
        left, right = shared_prefix(a[::-1], c[::-1]), shared_prefix(b, d)
        return [(0, left, right), (1, left, right)] if left + right >= length else []
    reach = np.full((2, len(members)), -1, np.int64)
    for right, inside, lefts in SuffixGroup(members).nodes():
        deepest = np.maximum(np.concatenate([lefts, [0]]), np.concatenate([[0], lefts]))  # where the left side is diverse
        long = deepest + right >= length
        at = inside[long]
        reach[0, at] = np.maximum(reach[0, at], deepest[long])
        reach[1, at] = np.maximum(reach[1, at], right)
    at = np.flatnonzero(reach[1] >= 0)
    return list(zip(at.tolist(), reach[0, at].tolist(), reach[1, at].tolist()))


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    """(dk, pos, h, ctx) of every anchor: its k-gram's hash and its context's hash."""
    reach, values = length - K, byte_values()
    arrow = pa.schema([(c, pa.int64()) for c in ("dk", "pos", "h", "ctx")])

    def found(keys: list[int], texts: list[bytes]) -> pa.RecordBatch:
        import xxhash

        data, sizes = b"".join(texts), np.array([len(t) for t in texts])
        pos, owner, h = joined_anchors(values[np.frombuffer(data, np.uint8)], sizes, K, reach + 1)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        lo = np.maximum(starts[owner], pos - reach)
        hi = np.minimum(ends[owner], pos + length)
        ctx = [xxhash.xxh64_intdigest(data[a:b], seed)
               for a, b, seed in zip(lo.tolist(), hi.tolist(), (pos - lo).tolist())]
        columns = [np.array(keys, np.int64)[owner], pos - starts[owner], h.view(np.int64), np.array(ctx, np.uint64).view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for dk, text in zip(part.column("dk").to_pylist(), part.column("text").to_pylist()):
                    if text and len(text) >= length:
                        keys.append(dk)
                        texts.append(text)
                        size += len(text)
                    if size >= JOINED_BYTES:
                        yield found(keys, texts)
                        keys, texts, size = [], [], 0
        if texts:
            yield found(keys, texts)

    bounded_batches(docs.sparkSession)
    return docs.select("dk", "text").mapInArrow(run, "dk long, pos long, h long, ctx long")


def repeated_spans(docs: DataFrame, length: int, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(texts, spans) of documents with repeats: (dk, text, fully), stored, and (dk, s, e); ``docs`` has dk and text as bytes."""
    reach = length - K
    step = -(-(reach + 1) // CORES)
    found = store(_contexts(docs, length), "suffix-anchors")
    often = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    again = store(found.join(often, "h"), "suffix-repeated")
    classes = store(again.groupBy("h", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("dk", "pos")).alias("rep")),
                    "suffix-contexts")
    whole = again.join(classes.where("n > 1").select("h", "ctx"), ["h", "ctx"]).select("dk", "pos", F.lit(True).alias("all"))
    several = classes.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h")
    some = classes.join(several, "h").select("rep.dk", "rep.pos", F.lit(False).alias("all"))
    marks = whole.union(some).groupBy("dk").agg(F.collect_set(F.struct("pos", "all")).alias("marks"))

    def contexts(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            text, spans = row["text"], []
            for mark in row["marks"]:
                p = mark["pos"]
                left, right = text[max(0, p - reach):p], text[p:p + length]
                if mark["all"]:
                    spans.append((p - len(left), p + len(right)))
                    continue
                for lo in range(0, reach + 1, step):
                    for part in _part(left, right, lo, min(lo + step - 1, reach), length):
                        yield (row["dk"], p, *part, None, None)
            yield row["dk"], *[None] * 7, text, [x for span in merged(spans) for x in span]

    # rows that repeat id and text have been counted: one of them stands for all from here on
    split = store(map_rows(docs.dropDuplicates(["dk"]).join(marks, "dk"), contexts,
                           f"{MEMBER}, text binary, fully array<long>"), "suffix-texts")
    texts = split.where("text is not null").select("dk", "text", "fully")
    return texts, _member_spans(split.where("pos is not null").drop("text", "fully"), length, group_rows)


def _part(left: bytes, right: bytes, lo: int, hi: int, length: int) -> Iterator[tuple]:
    """(lo, hi, core, whole, left, right) of the strings that start ``lo`` to ``hi`` bytes before an anchor, if there are any."""
    import xxhash

    if len(left) < lo or len(right) < length - hi:
        return
    core = xxhash.xxh64_intdigest(left[len(left) - lo:] + right[:length - hi], lo << 16 | hi) - (1 << 63)
    left, right = left[max(0, len(left) - hi):], right[:length - lo]
    if len(left) + len(right) >= length:
        yield lo, hi, core, xxhash.xxh3_128_digest(left + right, len(left)), left, right


def _member_spans(members: DataFrame, length: int, group_rows: int) -> DataFrame:
    """(dk, s, e) of the strings that members of a core's group share; a round per halving of the groups that are too large."""

    def scan(rows: Iterator[dict]) -> Iterator[tuple]:
        for _, group in groupby(rows, key=lambda r: r["core"]):
            held = list(group)  # at most group_rows
            for m, left, right in member_runs([(r["left"], r["right"]) for r in held], length):
                yield held[m]["dk"], held[m]["pos"] - left, held[m]["pos"] + right

    def halves(rows: Iterator[dict]) -> Iterator[tuple]:
        for r in rows:
            mid = (r["lo"] + r["hi"]) // 2
            for lo, hi in ((r["lo"], mid), (mid + 1, r["hi"])):
                for part in _part(r["left"], r["right"], lo, hi, length):
                    yield r["dk"], r["pos"], *part

    found = []
    while True:
        kinds = store(members.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("dk", "pos")).alias("rep")),
                      "suffix-kinds")
        ends = members.select("core", "whole", "dk", (F.col("pos") - F.octet_length("left")).alias("s"),
                              (F.col("pos") + F.octet_length("right")).alias("e"))  # no bytes go through this join
        found.append(ends.join(kinds.where("n > 1").select("core", "whole"), ["core", "whole"]).select("dk", "s", "e"))
        several = kinds.groupBy("core").agg(F.count("*").alias("k")).where("k > 1")
        go_on = kinds.join(several, "core").select("core", "rep.dk", "rep.pos", "k")
        shared = store(members.join(go_on, ["core", "dk", "pos"]), "suffix-members")
        small = shared.where(F.col("k") <= group_rows).select("dk", "pos", "core", "left", "right")
        found.append(map_rows(small.repartition("core").sortWithinPartitions("core"), scan, "dk long, s long, e long"))
        large = shared.where(F.col("k") > group_rows)
        if large.isEmpty():  # at the latest when lo is hi, as all of a group are then equal
            return reduce(DataFrame.union, found)
        members = store(map_rows(large, halves, MEMBER), "suffix-halves")


def remove_repeats(docs: DataFrame, length: int = 200, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row; kept is the remaining bytes if any were removed."""
    src = docs.select("doc_id", row_key().alias("dk"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts, spans = repeated_spans(src.select("dk", "text"), length, group_rows)
    lists = spans.groupBy("dk").agg(F.collect_set(F.struct("s", "e")).alias("spans"))

    def cut(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            text, full = row["text"], row["fully"]
            runs = merged([*zip(full[::2], full[1::2]), *((x["s"], x["e"]) for x in row["spans"] or ())])
            ends = [0, *(x for run in runs for x in run), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
            yield row["dk"], len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept

    done = map_rows(texts.join(lists, "dk", "left"), cut,
                    "dk long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    base = src.select("doc_id", "dk", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    return base.join(done, "dk", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        "kept")
