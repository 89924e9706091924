"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's features are shares of byte classes, word
lengths and repetition of the line and of its two neighbours; a transition weight links
neighbouring labels. Weak line labels are the document's label. The field is fitted by gradient
steps (Adam) on the exact likelihood, computed by forward-backward passes. A document's score is
the mean of its lines' marginal probabilities of "good", weighted by line length.

Fitting takes at most ``sample_docs`` labelled documents, those with the smallest hashed ids, and of
them at most ``sample_lines`` lines in all, in hash order. A text of more than a twentieth of
``sample_lines`` gives the fit only its first lines up to that number, so no text ends or fills the
sample; the document that fills it gives what is left. Scoring covers every row, whole texts. Null
and empty texts are one empty line and get a score like any other. Labels that are null, or whose id
is null or not in the table, are not used; an id with several labels counts by the largest. With no
labelled document at all every score is 0.5. Repeated rows give repeated result rows. Empty table: no rows.
Further columns are ignored; nothing but the text enters a score.

A very long text is scored in blocks of whole lines: the forward messages at the block edges are kept, then
the blocks are gone through backwards, each one's features made again and the backward message carried on.
Beside the text itself a task holds one block, three copies of its longest line and that line's distinct words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import map_rows

SAMPLE_DOCS = 6_000
SAMPLE_LINES = 120_000
#: A text gives the fit at most this part of the sample's lines.
SHARE = 20
#: Chains are fitted in batches of at most this many padded lines (one chain may be longer).
BATCH_LINES = 1 << 19
#: A block of a text ends with the first line that ends after this many bytes.
BLOCK_BYTES = 32 << 10
#: A line's words are taken in pieces that end at the first white space after this many bytes.
PIECE_BYTES = 64 << 10

# fixed values: byte classes
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123)) + bytes(range(128, 256))
DIGIT = b"0123456789"
SPACE = b" \t\r\x0b\x0c"
STOPS = b".,;:'\"-?()"
GAP = re.compile(b"[" + SPACE + b"]")


def line_words(line: bytes) -> tuple[int, int, int]:
    """(words, distinct words, words that repeat the one before)."""
    n, again, seen, last, at = 0, 0, set(), None, 0
    while at < len(line):
        gap = GAP.search(line, at + PIECE_BYTES)
        end = gap.start() if gap else len(line)
        words = line[at:end].split()
        if words:
            n, again = n + len(words), again + (words[0] == last) + sum(map(eq, words, words[1:]))
            seen.update(words)
            last = words[-1]
        at = end
    return n, len(seen), again


def line_features(line: bytes) -> list[float]:
    n = len(line)
    if not n:
        return [1.0] + [0.0] * 11
    upper, lower, digit, space, stops = (n - len(line.translate(None, c)) for c in (UPPER, LOWER, DIGIT, SPACE, STOPS))
    words, distinct, again = line_words(line)
    k = max(1, words)
    return [0.0, upper / n, lower / n, digit / n, space / n, stops / n, (n - upper - lower - digit - space - stops) / n,
            distinct / k, again / k, min(n / k, 40.0) / 10.0, min(k, 200) / 50.0, 1.0 if k < 4 else 0.0]


def text_blocks(text: bytes) -> list[tuple[int, int]]:
    """(start, end) of the blocks of whole lines; the newline between two blocks belongs to neither."""
    out, at = [], 0
    while (end := text.find(b"\n", at + BLOCK_BYTES)) >= 0:
        out.append((at, end))
        at = end + 1
    return [*out, (at, len(text))]


def block_features(text: bytes, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, line weights) of the lines of ``text[start:end]``: a line's own features, the previous
    line's, the next line's (zeros before the first and after the last line of the text), a constant."""
    lines = text[start:end].split(b"\n")
    own = np.array([line_features(x) for x in lines])
    before, after, follows = np.zeros((1, own.shape[1])), np.zeros((1, own.shape[1])), b""
    if start:
        before = np.array([line_features(text[text.rfind(b"\n", 0, start - 1) + 1:start - 1])])
    if end < len(text):
        stop = text.find(b"\n", end + 1)
        follows = text[end + 1:stop if stop >= 0 else len(text)]
        after = np.array([line_features(follows)])
    same = np.array([1.0 if a and a == b else 0.0 for a, b in zip(lines, lines[1:] + [follows])])[:, None]
    x = np.hstack([own, np.vstack([before, own[:-1]]), np.vstack([own[1:], after]), same, np.ones((len(lines), 1))])
    return x, np.array([len(a) for a in lines], float) + 1.0


def marginals(scores: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over padded chains: P(good) per line, expected transitions, log-likelihood's log Z.

    ``scores`` (chains x lines) is the score of "good" against 0 for "bad"; chains are sorted by falling length.
    """
    n, t = scores.shape
    unary = np.stack([np.zeros_like(scores), scores], axis=2)
    alpha, beta = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    alpha[:, 0] = unary[:, 0]
    live = [int((lengths > i).sum()) for i in range(t)]
    for i in range(1, t):
        m = live[i]
        step = alpha[:m, i - 1, :, None] + trans
        alpha[:m, i] = np.logaddexp(step[:, 0], step[:, 1]) + unary[:m, i]
    pairs = np.zeros((2, 2))
    last = alpha[np.arange(n), lengths - 1]
    log_z = np.logaddexp(last[:, 0], last[:, 1])
    for i in range(t - 1, 0, -1):
        m = live[i]
        ahead = trans + (unary[:m, i] + beta[:m, i])[:, None, :]
        beta[:m, i - 1] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
        pairs += np.exp(alpha[:m, i - 1, :, None] + ahead - log_z[:m, None, None]).sum(axis=0)
    good = np.exp(alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None])
    return good, pairs, float(log_z.sum())


def fit(chains: list[tuple[np.ndarray, int]], steps: int = 150, rate: float = 0.1, decay: float = 1e-3,
        batch_lines: int = BATCH_LINES) -> dict:
    """Weights from (features, label) of documents; deterministic. Chains are padded in batches of similar length."""
    chains = sorted(chains, key=lambda c: -len(c[0]))
    lengths = np.array([len(x) for x, _ in chains])
    labels = np.array([y for _, y in chains], float)
    flat = np.vstack([x for x, _ in chains])
    mean, std = flat.mean(axis=0), flat.std(axis=0)
    mean[std < 1e-9], std[std < 1e-9] = 0.0, 1.0  # the constant stays
    flat = (flat - mean) / std
    row, col = np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths])
    batches, ends = [0], np.r_[0, np.cumsum(lengths)]
    while batches[-1] < len(lengths):
        batches.append(min(len(lengths), batches[-1] + max(1, batch_lines // int(lengths[batches[-1]]))))
    y = np.repeat(labels, lengths)
    truth = np.array([[((lengths - 1) * (1 - labels)).sum(), 0.0], [0.0, ((lengths - 1) * labels).sum()]])
    w, total = np.zeros(flat.shape[1] + 4), float(len(y))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        scores, good, pairs = flat @ w[:-4], np.zeros(len(y)), np.zeros((2, 2))
        for a, b in zip(batches, batches[1:]):
            own = slice(ends[a], ends[b])
            at = row[own] - a, col[own]
            padded = np.zeros((b - a, lengths[a]))
            padded[at] = scores[own]
            part, moves, _ = marginals(padded, w[-4:].reshape(2, 2), lengths[a:b])
            good[own], pairs = part[at], pairs + moves
        grad = np.r_[flat.T @ (y - good), (truth - pairs).ravel()] / total - decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"mean": mean, "std": std, "w": w[:-4], "trans": w[-4:].reshape(2, 2)}


def forward(good: list[float], ahead: tuple[float, float], moves: list[list[float]]) -> tuple[list[float], tuple[float, float]]:
    """P(good) of each line given the lines up to it, and the message (bad, good) to the line after the last.
    ``good`` is the weight of "good" against 1 - it for "bad", ``ahead`` the message to the first line."""
    (t00, t01), (t10, t11) = moves
    b, g = ahead
    out = []
    for p in good:
        y = g * p
        y /= b * (1.0 - p) + y
        out.append(y)
        b, g = (1.0 - y) * t00 + y * t10, (1.0 - y) * t01 + y * t11
    return out, (b, g)


def score(model: dict | None, text: bytes) -> float:
    """Mean of the lines' P(good) weighted by line length, by forward-backward over the whole text, block by block."""
    if model is None:
        return 0.5
    moves = np.exp(model["trans"] - model["trans"].max()).tolist()
    (t00, t01), (t10, t11) = moves

    def block(start: int, end: int) -> tuple[list[float], list[float]]:
        x, weight = block_features(text, start, end)
        return (0.5 + 0.5 * np.tanh(((x - model["mean"]) / model["std"]) @ model["w"] / 2)).tolist(), weight.tolist()

    cuts, messages = text_blocks(text), [(1.0, 1.0)]
    for cut in cuts[:-1]:
        messages.append(forward(block(*cut)[0], messages[-1], moves)[1])
    b, g, total, size = 1.0, 1.0, 0.0, 0.0  # (b, g): the backward message to the line at hand
    for cut, ahead in zip(reversed(cuts), reversed(messages)):
        good, weight = block(*cut)
        sofar, _ = forward(good, ahead, moves)
        for p, y, w in zip(reversed(good), reversed(sofar), reversed(weight)):
            total += w * y * g / ((1.0 - y) * b + y * g)
            size += w
            u, v = (1.0 - p) * b, p * g
            b, g = t00 * u + t01 * v, t10 * u + t11 * v
            b, g = b / (b + g), g / (b + g)
    return min(1.0, max(0.0, total / size))


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample_docs: int = SAMPLE_DOCS,
          sample_lines: int = SAMPLE_LINES) -> dict | None:
    """The field fitted to labelled rows for which ``usable`` (on doc_id) holds; None only if there are none."""
    marks = (labels.where("doc_id is not null and quality is not null").where(usable).groupBy("doc_id")
             .agg(F.max("quality").alias("quality")).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
             .withColumn("h", F.md5(F.col("doc_id").cast("string"))).orderBy("h", "doc_id").limit(sample_docs))
    longest = max(1, sample_lines // SHARE)
    src = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(marks), "doc_id")

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            # one line more, as the last line's features look at the next
            head = (row["text"] or b"").split(b"\n", longest + 1)[:longest + 1]
            head = b"\n".join(head)
            x = block_features(head, 0, len(head))[0][:longest]
            yield row["h"], int(row["quality"]), len(x), x.astype("<f4").tobytes()

    feats = map_rows(src, run, "h string, y int, n int, x binary").orderBy("h", "n", "x")
    chains, lines = [], 0
    for r in feats.toLocalIterator():
        n = min(r["n"], sample_lines - lines)
        lines += n
        chains.append((np.frombuffer(r["x"], "<f4").reshape(r["n"], -1)[:n].astype(float), r["y"]))
        if lines >= sample_lines:
            break
    return fit(chains) if chains else None


def quality_scores(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, score) for every row."""
    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield row["doc_id"], score(model, row["text"] or b"")

    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_rows(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: dict | None, least: float) -> DataFrame:
    """The rows of ``docs`` (all columns) with a score of at least ``least``; the text is scored where the row is."""
    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([score(model, t or b"") for t in part], dtype="float64")

    return docs.where(scored(F.col("text").cast("binary")) >= least)
