"""Token counts of whole texts without materialising ids.

A text is cut into pre-tokens that no vocabulary piece can straddle. The pieces of each distinct
pre-token are counted once; the counts are joined to the per-document pre-token frequencies and
summed. Pre-tokens of a bounded dictionary of frequent ones (chosen on a hashed sample, an
efficiency choice that cannot change a result) are counted on the map side, so the hottest keys
never reach the shuffle; all others take the join.

Nulls count as empty text, an empty text has no tokens, repeated rows give repeated result rows,
an empty table gives an empty result, further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import map_rows, store

#: Number of frequent pre-tokens that are counted on the map side (broadcast with the function).
DICTIONARY = 262_144
#: Documents expected in the hashed sample that picks them.
DICTIONARY_DOCS = 16_384
SPACE = "▁"


class PieceCounter:
    """Counts the pieces of one pre-token with a sentencepiece BPE model with a dummy prefix.

    Pre-tokens start at a run of spaces that follows something else; a line feed stands alone.
    That is exact because no piece of the vocabulary crosses such a border, which is checked.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or ("\n" in p and p != "\n") for p in pieces):
            raise ValueError("a vocabulary piece crosses a pre-token border; this model can't be counted by pre-token")
        if self.model.encode("a", out_type=str)[0][0] != SPACE or self.model.encode("  a ") == self.model.encode("a"):
            raise ValueError("the model must add a space before the text and keep repeated spaces")
        self.cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall

    def pretokens(self, text: str) -> list[str]:
        return self.cut(SPACE + text.replace(" ", SPACE)) if text else []

    def counts(self, pretokens: list[str]) -> list[int]:
        # the model itself adds the first space; without one, a line feed (two pieces with that space) goes before
        given = [p[1:] if p[0] == SPACE else "\n" + p for p in pretokens]
        less = [0 if p[0] == SPACE else 2 for p in pretokens]
        whole = [p == SPACE for p in pretokens]  # an empty text would have no piece at all
        return [1 if w else len(ids) - n for ids, n, w in
                zip(self.model.encode([g or " " for g in given], num_threads=1), less, whole)]


def token_counts(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                 dictionary: int = DICTIONARY, dictionary_docs: int = DICTIONARY_DOCS) -> DataFrame:
    """(id_col, n_bytes, n_tokens) for every row of ``docs``; ``model`` is the serialised tokenizer."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    step = max(1, src.count() // max(1, dictionary_docs))

    def frequent(rows: Iterator[dict]) -> Iterator[tuple]:
        counter, seen = PieceCounter(model), Counter()
        for row in rows:
            seen.update(counter.pretokens(row["text"]))
            if len(seen) > 2_000_000:
                yield from seen.items()
                seen = Counter()
        yield from seen.items()

    sample = src.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0)
    top = (map_rows(sample, frequent, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "pretoken").limit(dictionary))
    common = [r[0] for r in top.select("pretoken").collect()]
    counter = PieceCounter(model)
    known = dict(zip(common, counter.counts(common))) if common else {}

    def split(rows: Iterator[dict]) -> Iterator[tuple]:
        counter = PieceCounter(model)
        rid = TaskContext.get().partitionId() << 40
        for row in rows:
            text, sure, rid = row["text"], 0, rid + 1
            for pretoken, n in Counter(counter.pretokens(text)).items():
                pieces = known.get(pretoken)
                if pieces is None:
                    yield (rid, None, None, None, pretoken, n)
                else:
                    sure += n * pieces
            yield (rid, row["id"], len(text.encode()), sure, None, None)

    id_type = src.schema["id"].dataType.simpleString()
    parts = store(map_rows(src, split, f"rid long, id {id_type}, n_bytes long, sure long, pretoken string, n long"),
                  "token-parts")

    @F.pandas_udf("long")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter(model)
        for batch in batches:
            yield pd.Series(counter.counts(batch.tolist()), dtype="int64")

    rare = parts.where("pretoken is not null").select("rid", "pretoken", "n")
    counted = rare.select("pretoken").distinct().withColumn("pieces", pieces("pretoken"))
    more = (rare.join(counted, "pretoken").groupBy("rid").agg(F.sum(F.col("n") * F.col("pieces")).alias("more")))
    return (parts.where("n_bytes is not null").join(more, "rid", "left")
            .select(F.col("id").alias(id_col), "n_bytes",
                    (F.col("sure") + F.coalesce("more", F.lit(0))).alias("n_tokens")))
