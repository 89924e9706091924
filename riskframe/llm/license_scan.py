"""License scan with ordered signature rules, in DataFrame functions only; no shuffle.

Words are runs of digits, a-z (after lower-casing A-Z) and everything beyond ASCII. Of a text that holds one of the
rules' stems, the anchor words ("license", "copyright", "hereby", ...) are looked up; around each, a window of SIDE
words to either side is written out with the anchor marked, and of the anchor's rules those whose keyword stands
in the window are run. A rule's match holds the marked word, so each match is found at exactly one anchor, and no
pattern is run over a whole text. A match is a detection: first and last word, rule.

Detections that overlap are resolved by priority and containment: one is dropped if it lies in another of its own tier
or a better one (of equal ones the earlier rule stays), or if its first or last word lies in one of a better tier,
whether or not that one is dropped itself. Two sweeps decide it, from either side, each a fold that carries the
furthest last word of each tier; they go over blocks of BLOCK detections, so the work grows with their number.

Base phrases are looked up in the words themselves and always keep their label. The score is the strength of the best
tier among the kept detections; a base place counts as a plain name.

Null and empty texts: no words, no places, empty labels, score 0. Rows are kept as they are, repeated ids and null ids
too. Empty table: no rows. Further columns are ignored. Long texts: a task holds a text, its words and its detections;
windows are made one at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.license_rules import SIDE, STEMS, STRENGTH, rules
from riskframe.llm.winnow import LOWER, SEPARATORS, UPPER

#: Separators in a text that is not lower-cased yet.
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Detections folded at once.
BLOCK = 256
#: Phrases that are always reported: their words and the label. The last word of each must be an anchor.
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
NAME_TIER = 3
FIELDS = ("first", "last", "tier", "rule", "label")
KEPT = "struct<first:int,last:int,tier:int,rule:int,label:string>"
SPAN = KEPT[:-1] + ",dead:boolean>"


def bind(value: Column, fn) -> Column:
    """``fn`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" ")))


def anchor_rules(signatures) -> Column:
    """Map of anchor word to its rules, a literal of the plan."""
    by: dict[str, list[Column]] = {}
    for rank, tier, label, anchor, keyword, pattern in signatures:
        by.setdefault(anchor, []).append(F.struct(F.lit(rank).alias("rule"), F.lit(tier).alias("tier"), F.lit(label).alias("label"),
                                                  F.lit(keyword).alias("keyword"), F.lit(pattern).alias("pattern")))
    return F.create_map(*[x for a, r in by.items() for x in (F.lit(a), F.array(*r))])


def detections_at(i: Column, of: Column) -> Column:
    """The matches of the rules ``of`` (a map) at the anchor word number ``i`` of the array column w."""
    start = F.greatest(i - SIDE, F.lit(0))
    window = F.concat(F.lit(" "), F.array_join(F.slice("w", start + 1, i - start), " "), F.when(i > 0, " ").otherwise(""),
                      F.lit("@"), F.array_join(F.slice("w", i + 1, F.lit(SIDE + 1)), " "), F.lit(" "))

    def run(win: Column) -> Column:
        gated = F.filter(F.element_at(of, F.get("w", i)), lambda r: F.contains(win, r["keyword"]))
        found = F.transform(gated, lambda r: F.struct(r.alias("r"), F.call_function("regexp_extract", win, r["pattern"], F.lit(0)).alias("m")))

        def place(d: Column) -> Column:
            # the match is unique in the window, since the marker is
            first = start + spaces(F.substring(win, F.lit(1), F.instr(win, d["m"]) - 1))
            return bind(first, lambda f: F.struct(
                f.cast("int").alias("first"), (f + spaces(d["m"]) - 2).cast("int").alias("last"),
                d["r"]["tier"].alias("tier"), d["r"]["rule"].alias("rule"), d["r"]["label"].alias("label"), F.lit(False).alias("dead")))

        return F.transform(F.filter(found, lambda d: d["m"] != ""), place)

    return bind(window, run)


def swept(found: Column) -> Column:
    """``found`` with ``dead`` set where a detection that is not after it settles it: in order of (first, tier, last
    descending, rule), what it lies in, or what its first word lies in, comes before it."""
    order = ("first", "tier", "back", "rule", "last", "label", "dead")
    ranked = F.array_sort(F.transform(found, lambda d: F.struct(*[(-d["last"] if n == "back" else d[n]).alias(n) for n in order])))
    none = F.array().cast(f"array<{SPAN}>")

    def fold(block: Column, reach: Column) -> Column:
        def step(acc: Column, d: Column) -> Column:
            within = F.array_max(F.slice(acc["reach"], F.lit(1), d["tier"] + 1)) >= d["last"]
            crossed = F.coalesce(F.array_max(F.slice(acc["reach"], F.lit(1), d["tier"])) >= d["first"], F.lit(False))
            own = F.array(F.struct(*[d[n].alias(n) for n in FIELDS], (d["dead"] | within | crossed).alias("dead")))
            further = F.transform(acc["reach"], lambda v, k: F.when(k == d["tier"], F.greatest(v, d["last"])).otherwise(v))
            return F.struct(further.alias("reach"), F.concat(acc["done"], own).alias("done"))

        return F.aggregate(block, F.struct(reach.alias("reach"), none.alias("done")), step)

    def blocks(all_of: Column) -> Column:
        zero = F.struct(F.array(*[F.lit(-(1 << 31))] * len(STRENGTH)).alias("reach"), F.array().cast(f"array<array<{SPAN}>>").alias("done"))

        def step(acc: Column, b: Column) -> Column:
            part = fold(F.slice(all_of, b * BLOCK + 1, F.lit(BLOCK)), acc["reach"])
            return bind(part, lambda x: F.struct(x["reach"].alias("reach"), F.concat(acc["done"], F.array(x["done"])).alias("done")))

        return F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor((F.size(all_of) - 1) / BLOCK).cast("int")), zero, step)["done"])

    return bind(ranked, blocks)


def resolved(found: Column) -> Column:
    """The detections of the array ``found`` that stay: one sweep from the left, one over the mirrored words."""
    mirror = lambda x: F.transform(x, lambda d: F.struct((-d["last"]).alias("first"), (-d["first"]).alias("last"),
                                                         *[d[n].alias(n) for n in (*FIELDS[2:], "dead")]))
    both = lambda x: bind(mirror(swept(x)), lambda y: mirror(swept(y)))
    kept = F.transform(F.filter(both(found), lambda d: ~d["dead"]), lambda d: F.struct(*[d[n].alias(n) for n in FIELDS]))
    return F.when(F.size(found) > 0, F.array_sort(kept)).otherwise(F.array().cast(f"array<{KEPT}>"))


def scan(docs: DataFrame, signatures=None, phrases=PHRASES) -> DataFrame:
    """Per row: doc_id, n_words, base (array of first word and label), detections (array of first, last, tier, rule, label)."""
    signatures = signatures if signatures is not None else rules()
    anchors = F.array(*[F.lit(a) for a in sorted({r[3] for r in signatures} | {words[-1] for words, _ in phrases})])
    of = anchor_rules(signatures)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("t"))
    n_words = F.size(F.array_remove(F.split("t", RAW_SEPARATORS), "")).cast("long")
    low = F.when(F.length("t") == F.octet_length("t"), F.lower("t")).otherwise(F.translate("t", UPPER, LOWER))
    gated = F.col("t").rlike("(?i)" + "|".join(STEMS))
    rows = rows.select("doc_id", n_words.alias("n_words"),
                       F.when(gated, F.array_remove(F.split(low, SEPARATORS), "")).otherwise(F.array().cast("array<string>")).alias("w"))
    rows = rows.withColumn("at", F.when(F.size("w") > 0, F.filter(
        F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.array_contains(anchors, F.get("w", i)))).otherwise(F.array().cast("array<int>")))

    def places(words, label) -> Column:
        here = lambda i: sum((F.coalesce(F.get("w", i - j) == word, F.lit(False)).cast("int")
                              for j, word in enumerate(reversed(words))), F.lit(0)) == len(words)
        return F.transform(F.filter("at", here), lambda i: F.struct((i - (len(words) - 1)).alias("first"), F.lit(label).alias("label")))

    known = F.filter("at", lambda i: F.map_contains_key(of, F.get("w", i)))
    rows = rows.withColumn("base", F.concat(*[places(words, label) for words, label in phrases]))
    rows = rows.withColumn("found", F.flatten(F.transform(known, lambda i: detections_at(i, of))))
    return rows.select("doc_id", "n_words", "base", resolved(F.col("found")).alias("detections"))


def license_labels(docs: DataFrame, signatures=None, phrases=PHRASES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections) per row."""
    rows = scan(docs, signatures, phrases)
    strength = F.array(*[F.lit(x) for x in STRENGTH])
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    base, named = F.transform("base", lambda b: b["label"]), F.transform("detections", lambda d: d["label"])
    best = F.array_max(F.concat(F.transform("detections", lambda d: F.get(strength, d["tier"])), F.when(
        F.size("base") > 0, F.array(F.lit(STRENGTH[NAME_TIER]))).otherwise(F.array().cast("array<double>"))))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["first"])).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, named)).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"), F.size("detections").cast("long").alias("n_detections"))
