"""Each text operator against its plain version: a small table, and hand-made rows with nulls, empty and
long texts, repeated rows, ties, near copies, shared passages and columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from brute import SF_SMALL
from riskframe.llm import (debruijn, line_crf, mixing, queries, rans_output, simhash_dedup, suffix_repeats, token_counts,
                           vector_topk, warc, winnow)

DOCS = "doc_id long, text string, source string, n_chars long, h string, dk string, pos int, w int, id string, size int"


def edge_texts():
    rnd = random.Random(7)
    vocab = ["".join(rnd.choice("abcdefgäéñ") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, base, line = say(90), say(300), say(14)
    edited = base.split()
    edited[150] = "EDITED"
    texts = [None, "", " \n\t ", "one", "two words", "Two WORDS", base, base, base.upper(), " ".join(edited),
             say(40) + " " + passage + " " + say(30), passage + "\n" + say(80), say(20) + "\n" + passage,
             line + "\n" + say(60), line + "\n" + say(61), line + "\n" + say(62), "ha " * 700, "ab" * 900, "x" * 1000,
             "<|endoftext|> a<|startoftext|>b <s> ▁x  a b\x00c d\x1ce   ½ ﬁ 'S don't 12.5),.", say(9000),
             "a\nb\n\n c\r\nd;\r", "é́ İİ Σς", passage * 3]
    return texts


@pytest.fixture(scope="module")
def edge(spark):
    texts = edge_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, texts[6]), (None, texts[9]), (None, None), (40, texts[10])]
    full = [(d, t, ["a", "b", None][i % 3], 1, "h", "dk", 1, 2, "id", 3) for i, (d, t) in enumerate(rows)]
    return rows, spark.createDataFrame(full, DOCS).repartition(5)


@pytest.fixture(scope="module")
def small(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return [(r.doc_id, r.text) for r in df.collect()], df


@pytest.fixture(scope="module")
def none(spark):
    return [], spark.createDataFrame([], DOCS)


def same(df, expected):
    def key(r):
        return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)

    got = sorted((tuple(r) for r in df.collect()), key=key)
    assert got == sorted(expected, key=key)


@pytest.fixture(scope="module", params=["edge", "small", "none"])
def corpus(request):
    return request.getfixturevalue(request.param)


def model():
    with open(queries.tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def test_token_counts(corpus):
    rows, df = corpus
    for dictionary in (0, 50):
        got = token_counts.token_counts(df, model(), dictionary=dictionary)
        same(got, [r[:3] for r in brute.op1(rows)])


def test_simhash(corpus):
    rows, df = corpus
    same(simhash_dedup.near_duplicates(df), brute.op2(rows))


def test_simhash_links_every_close_pair(spark):
    rnd = random.Random(3)
    prints = set()
    for _ in range(60):
        fp = rnd.getrandbits(64)
        for _ in range(4):
            prints.add(fp)
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                fp ^= 1 << b
    prints = [p - (1 << 63) for p in prints]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    mask = (1 << 64) - 1
    close = [(a, b) for a in prints for b in prints if a < b and ((a & mask) ^ (b & mask)).bit_count() <= 4]
    assert close
    same(simhash_dedup.linked_pairs(df, 4), close)


def test_simhash_joins_are_not_broadcast(spark):
    """A frame of few bytes, which is many rows behind the explode: Spark's estimate would broadcast it."""
    prints = spark.range(50).select(F.xxhash64("id").alias("fp"))
    named = simhash_dedup.rooted(prints.withColumn("least", F.col("fp")), 4)
    for df in (simhash_dedup.linked_pairs(prints, 4), named, simhash_dedup.keep_first(
            prints.select(F.col("fp").alias("doc_id"), F.lit("a b").alias("text")))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_keep_first_takes_one_row_of_each_component(spark):
    """Several texts under a null id, a null-id copy of a text with an id, one id on two texts, repeated rows."""
    rnd = random.Random(9)
    a, b, c, d, e, f = (" ".join(f"w{rnd.randrange(10_000)}" for _ in range(60)) for _ in range(6))
    rows = [(None, a), (None, b), (None, c), (None, c), (None, d), (4, d), (7, d), (2, e), (2, f), (2, f), (9, f),
            (None, None), (None, "")]
    df = spark.createDataFrame([(i, t, "s", "__row") for i, t in rows], "doc_id long, text string, source string, id string")
    kept = simhash_dedup.keep_first(df.repartition(5))
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(None, a), (None, b), (None, c), (4, d), (2, e), (2, f), (None, "")], key=str)
    prints = {(i, t or ""): p for (i, t), (_, p, _) in zip(rows, brute.op2(rows))}
    assert len({prints[r] for r in got}) == len(got)


def test_keep_first(corpus):
    rows, df = corpus
    kept = simhash_dedup.keep_first(df).select("doc_id", "text").collect()
    assert {tuple(r) for r in kept} <= set(rows)
    prints = [int(p, 16) for _, p, _ in brute.op2(rows)]
    alike = lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4
    comp = {}
    for i in range(len(rows)):
        near = {comp[j] for j in range(i) if alike(i, j)}
        comp = {j: i if k in near else k for j, k in comp.items()} | {i: i}
    groups = {}
    for i, k in comp.items():
        groups.setdefault(k, []).append(rows[i])
    least = [min((d for d, _ in g if d is not None), default=None) for g in groups.values()]
    assert sorted((r.doc_id for r in kept), key=str) == sorted(least, key=str)


def test_suffix_repeats(corpus):
    rows, df = corpus
    expected = brute.op6(rows)
    for group_rows in (1_024, 1):  # 1: every group is counted in pieces and strings
        same(suffix_repeats.remove_repeats(df, group_rows=group_rows).drop("kept"), expected)


def test_suffix_repeats_of_a_frequent_passage(spark):
    """Members of a group that is too large get a row per halving at most, not one per few string starts."""
    r = random.Random(5)
    passage = "".join(r.choices("abcdefghij", k=900))
    noise = lambda n: "".join(r.choices("klmnopqrst", k=n))
    rows = [(i, noise(400) + passage + noise(400)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    docs = df.select(F.col("doc_id").alias("dk"), F.col("text").cast("binary").alias("text"))
    counts = [suffix_repeats.repeated_spans(docs, 200, group_rows)[1].count() for group_rows in (1_024, 4)]
    assert counts[1] <= 4 * counts[0], counts
    same(suffix_repeats.remove_repeats(df, group_rows=4).drop("kept"), brute.op6(rows))


def test_maximal_repeats_lists_all_occurrences():
    members = [(b"xxab", b"cdefg"), (b"yyab", b"cdefh"), (b"zzab", b"cdezz"), (b"q", b"r")]
    found = {(left, right, tuple(sorted(group))) for left, right, group in suffix_repeats.maximal_repeats(members, 5)}
    assert found == {(2, 4, (0, 1)), (2, 3, (0, 1, 2))}


def test_debruijn(corpus):
    rows, df = corpus
    same(debruijn.remove_repeated_windows(df).drop("kept"), brute.op8(rows))


def test_winnowing(corpus, spark):
    rows, df = corpus
    texts = edge_texts()
    some = [t for _, t in rows if t and len(t) > 800][:3]
    items = [(1, " ".join(texts[10].split()[40:75])), (2, "two words"), (10, " ".join(texts[6].split()[:10])),
             (3, "one"), (4, None), (None, "one"), (5, ""), (6, " ".join(texts[6].split()[7:22])), (1, "one"),
             *((20 + i, " ".join(t.split()[3:24])) for i, t in enumerate(some)), (30, "absent words here")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, cls string")
    same(winnow.decontaminate(df, bench), brute.op5(rows, items))
    same(winnow.decontaminate(df, bench.limit(0)), brute.op5(rows, []))
    clean = winnow.clean_documents(df, bench)
    assert clean.columns == df.columns
    bad = {(r[0], r[1]) for r in brute.op5(rows, items) if r[5]}
    kept = [r for r in rows if (r[0], len(brute.bench_words(r[1]))) not in bad]
    same(clean.select("doc_id", "text"), kept)


def sources(df):
    out = {}
    for r in df.select("source", "text").collect():
        out[r.source] = out.get(r.source, 0) + len(brute.words(r.text))
    return out


def test_mixing(corpus):
    rows, df = corpus
    sizes = sources(df)
    goals = brute.targets(sizes)
    for block in (512, 7):
        got = mixing.mix(df, block=block).collect()
        same(mixing.mix(df, block=block).select("doc_id", "size"), [(d, len(brute.words(t))) for d, t in rows])
        taken = {}
        for r in got:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(goals[r.source])
            assert 0 <= r.taken <= 2 * r["size"]
            taken[r.source] = taken.get(r.source, 0) + r.taken
        for s, n in taken.items():
            assert abs(n - goals[s]) <= 1


def test_mix_schedule_is_even(spark):
    goals = spark.createDataFrame([(0, "a", 60_000, 1, 100_000.0), (1, "b", 30_000, 1, 45_000.0), (2, "c", 0, 1, 0.0),
                                   (3, "d", 9_000, 1, 5_000.0)], "src int, source string, source_size long, n_docs long, target double")
    rows = sorted(mixing.schedule(goals, 100).collect())
    total, seen = 150_000, {0: 0, 1: 0, 3: 0}
    assert [r.slot for r in rows] == sorted({r.slot for r in rows})
    for i, r in enumerate(rows):
        seen[r.src] += 1
        for src, goal in ((0, 100_000), (1, 45_000), (3, 5_000)):
            assert abs(seen[src] - (i + 1) * goal / total) < 8
    for src, goal in ((0, 100_000), (1, 45_000), (3, 5_000)):
        own = [r for r in rows if r.src == src]
        assert [r.rank for r in own] == list(range(len(own))) and sum(r.words for r in own) == goal


def test_mix_blocks_are_not_broadcast(corpus):
    """A document explodes into its blocks, which Spark's estimate does not count."""
    plan = mixing.mix(corpus[1])._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join [" in x and "block#" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)


def test_mixed_documents(corpus):
    rows, df = corpus
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        got[(r.doc_id, r.source)] = got.get((r.doc_id, r.source), 0) + len(brute.words(r.text))
    expected = {}
    for r in mixing.mix(df).where("taken > 0").collect():
        expected[(r.doc_id, r.source)] = expected.get((r.doc_id, r.source), 0) + r.taken
    assert got == expected


def test_rans_files(corpus):
    rows, df = corpus
    got = rans_output.token_files(df, queries.word_tokenizer())
    expected = brute.op10(rows)
    # rows with the same id may stand in either order: their starts are compared as a set of intervals
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got.collect()) == sorted(
        (d is None, d or 0, n, c) for d, _, n, c in expected)
    at = 0
    order = got.orderBy(F.asc_nulls_first("doc_id"), "start").collect()
    for r in order:
        assert r.start == at
        at += r.n_tokens


def test_rans_round_trip_and_damage():
    import numpy as np

    rnd = np.random.default_rng(5)
    for n in (1, 2, 7, 2_048, 2_049, 40_000):
        ids = rnd.zipf(1.3, n) % 49_408
        table = rans_output.shared_table({int(s): int(c) for s, c in zip(*np.unique(ids, return_counts=True))})
        assert table[1].sum() == 1 << rans_output.SCALE and table[1].min() >= 1
        coder = rans_output.Coder(*table)
        assert (coder.decode(*coder.encode(ids), n) == ids).all()
        block = coder.block([(3, ids.astype("<u4").tobytes()), (None, b""), (4, ids[:1].astype("<u4").tobytes())])
        assert [d for d, _ in coder.unblock(block)] == [3, None, 4]
        with pytest.raises(ValueError):
            list(coder.unblock(block[:-1] + bytes([block[-1] ^ 1])))
    many = rans_output.shared_table({i: 1 if i else 10**9 for i in range(200_000)})
    assert many[1].sum() == 1 << rans_output.SCALE and many[1].min() == 1


def test_encoder_equals_the_library(monkeypatch):
    """Strings of every kind of character, one and many at a time, cut into small groups and pieces, with a tiny cache."""
    import numpy as np
    import public_tokenizers as P
    import pyarrow as pa
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    encoder = rans_output.ChunkEncoder(whole.to_str(), cache=20)
    rnd = random.Random(10)
    atoms = [" ", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\x00", "\x7f", "a", "B", "the", "Zoo", "É", "é", "ß", "×", "÷", "e\u0301", "µ", "x9", "2024",
             "don't", "'S", "''", "$$", "##*", "<", "|", "[", "<|endoftext|>", "(", ")-", "你好", "İ", "😀", "q" * 300]
    texts = ["".join(rnd.choice(atoms) for _ in range(rnd.randrange(14))) for _ in range(3_000)] + ["", " ", "\n\n"]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(rans_output, "GROUP_BYTES", size)
        got = list(encoder.groups(pa.array(texts)))
        ids, n = np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got])
        assert sum(g[0] for g in got) == len(texts) and n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert list(encoder.groups(pa.array([], pa.string()))) == []


def test_quality_scores(corpus, spark):
    rows, df = corpus
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    fitted = line_crf.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), labels, queries.usable())
    got = line_crf.quality_scores(df, fitted).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in got)) == sorted((d is None, d or 0) for d, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)
    again = {(d, t): brute.op7_score(fitted, (t or "").encode()) for d, t in rows}
    assert sorted(r.score for r in got) == pytest.approx(sorted(again[x] for x in rows))
    assert line_crf.train(df, labels.limit(0), queries.usable()) is None
    assert {r.score for r in line_crf.quality_scores(df, None).collect()} <= {0.5}


def test_quality_holds_out(spark):
    """Scores of rows that were kept from the fit tell good from bad (all labelled rows of a middle table)."""
    d = SF_SMALL.replace("0.001", "0.01")
    got = queries.op7_quality_crf(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in got) / len(got)
    assert right >= 0.9, right


def test_quality_fit_goes_on_after_a_long_text(spark):
    """A text of more lines than the sample comes first in hash order, and labels without a document before that."""
    import hashlib

    rnd = random.Random(4)
    ids = sorted(range(200), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    good = lambda n: "\n".join(" ".join(f"{rnd.choice('abcdef')}word{rnd.randrange(99)}" for _ in range(12)) for _ in range(n))
    bad = lambda n: "\n".join("#### 77 %% 77" for _ in range(n))
    lost, long, rest = ids[:30], ids[30], ids[31:]
    rows = [(long, bad(900))] + [(i, good(5) if i % 2 else bad(5)) for i in rest]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 0) for i in [*lost, long]] + [(i, i % 2) for i in rest], "doc_id long, quality int")
    fitted = line_crf.train(docs, labels, F.lit(True), sample_docs=100, sample_lines=600)
    assert fitted is not None
    for i, t in rows:
        assert (line_crf.score(fitted, t.encode()) >= 0.7) == (i != long and i % 2 == 1)
    assert line_crf.train(docs, labels.where(F.col("doc_id") == long), F.lit(True), sample_lines=600) is not None
    assert line_crf.train(docs, labels, F.lit(True), sample_docs=30) is not None


def line_texts(rnd):
    """A model with strong links and texts of every shape: empty, no line end, only line ends, long and equal lines."""
    import numpy as np

    model = {"mean": rnd.normal(size=38), "std": rnd.uniform(0.5, 2, 38), "w": rnd.normal(size=38), "trans": rnd.normal(0, 3, (2, 2))}
    kinds = [b"", b" ", b"a a a b", b"The End, of it; all.", b"####  77 %%", "\u00fcber\tSTRASSE".encode(), b"x" * 150, b"to be or not to be " * 9]
    texts = [b"", b"\n", b"\n" * 300, b"a\n", b"\nb", b"one", *kinds]
    for n in (2, 3, 9, 40, 200):
        texts += [b"\n".join(kinds[i] for i in rnd.integers(0, len(kinds), n)) for _ in range(4)]
    return model, texts


@pytest.mark.parametrize("block,piece", [(1, 1), (7, 3), (64, 16), (1 << 15, 1 << 16)])
def test_quality_in_blocks_equals_plain_version(monkeypatch, block, piece):
    import numpy as np

    monkeypatch.setattr(line_crf, "BLOCK_BYTES", block)
    monkeypatch.setattr(line_crf, "PIECE_BYTES", piece)
    model, texts = line_texts(np.random.default_rng(block))
    for t in texts:
        assert line_crf.score(model, t) == pytest.approx(brute.op7_score(model, t), abs=1e-9), t[:80]
    sure = {**model, "w": model["w"] * 40}  # lines that are certain in double precision; the logs of the plain version lose digits
    for t in texts:
        assert line_crf.score(sure, t) == pytest.approx(brute.op7_score(sure, t), abs=1e-8), t[:80]


def test_quality_of_long_texts_in_bounded_memory():
    """Many short lines, many empty lines, one long line: memory beside the text stays that of a block or line."""
    import tracemalloc

    import numpy as np

    model, _ = line_texts(np.random.default_rng(3))
    for text, most in ((b"ab cd\n" * 60_000, 24 << 20), (b"\n" * 70_000, 32 << 20), (b"ab cd, " * 300_000, 16 << 20)):
        tracemalloc.start()
        got = line_crf.score(model, text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert 0 <= got <= 1 and peak < most, peak


def test_quality_fit_in_batches():
    import numpy as np

    rnd = np.random.default_rng(6)
    chains = [(np.hstack([rnd.normal(i % 2, 1, (n, 3)), np.ones((n, 1))]), i % 2) for i, n in enumerate((1, 9, 4, 30, 2, 9, 7))]
    whole = line_crf.fit(chains, steps=40)
    for lines in (1, 20, 64):
        part = line_crf.fit(chains, steps=40, batch_lines=lines)
        assert np.allclose(part["w"], whole["w"]) and np.allclose(part["trans"], whole["trans"])


def test_marginals_equal_enumeration():
    import itertools

    import numpy as np

    rnd = np.random.default_rng(1)
    scores, trans = rnd.normal(size=(1, 5)), rnd.normal(size=(2, 2))
    good, pairs, log_z = line_crf.marginals(scores, trans, np.array([5]))
    weight = {}
    for y in itertools.product((0, 1), repeat=5):
        weight[y] = np.exp(sum(scores[0, i] * y[i] for i in range(5)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
    z = sum(weight.values())
    assert log_z == pytest.approx(np.log(z))
    for i in range(5):
        assert good[0, i] == pytest.approx(sum(w for y, w in weight.items() if y[i]) / z)
    assert pairs.sum() == pytest.approx(4)


def test_vector_topk(spark):
    rnd = random.Random(11)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(8)]) for i in range(300)]
    rows += [(400 + i, rows[i][1]) for i in range(60)] + [(5, rows[5][1]), (5, [0.0] * 8), (800, None), (820, [1.0, None] * 4),
             (840, [float("nan")] * 8), (860, [float("inf")] + [0.0] * 7), (None, [0.1] * 8), (880, [0.5, 0.5]), (900, [])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, ids string, up double")
    is_query = F.expr("id % 20 = 0")
    same(vector_topk.top_k(df, is_query), brute.op3(rows))
    same(vector_topk.top_k(df.limit(0), is_query), [])
    real = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    same(vector_topk.top_k(real, is_query), brute.op3([(r.vec_id, r.embedding) for r in real.collect()]))


def test_vector_topk_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(vector_topk, "GROUP_ROWS", 64)
    monkeypatch.setattr(vector_topk, "QUERY_ROWS", 8)
    real = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    same(vector_topk.top_k(real, F.expr("id % 20 = 0")), brute.op3([(r.vec_id, r.embedding) for r in real.collect()]))


def test_vector_topk_visits_are_neither_broadcast_nor_exploded(spark):
    real = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    plan = vector_topk.top_k(real, F.expr("id % 20 = 0"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan


def test_warc(spark):
    big = "<html>" + "ä" * 300
    rows = [(5, "http://a/ b", big), (3, None, big), (9, "u", big), (3, None, big), (None, "n", big), (1, "x\r\ny", "short"),
            (2, "y", "short"), (4, "é", None), (6, "z", ""), (7, "q", "long " * 100_000), (8, "r", "\r\n\r\nWARC/1.1\r\n" * 20)]
    df = spark.createDataFrame([(*r, "k", "d") for r in rows], "page_id long, url string, html string, key string, digest string")
    same(warc.archive_pages(df), brute.op4(rows))
    same(warc.archive_pages(df.limit(0)), [])
    real = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    same(warc.archive_pages(real), brute.op4([tuple(r)[:3] for r in real.select("page_id", "url", "html").collect()]))


def test_warc_streams():
    import gzip
    import io

    recs = [warc.record(str(i), "u", b"p" * n, n, "d", None) for i, n in enumerate((0, 5, 300_000))]
    for raw in (gzip.compress(b"".join(recs)), b"".join(map(gzip.compress, recs))):
        assert list(warc.records(warc.inflate(io.BytesIO(raw), 1_000))) == recs
        with pytest.raises(ValueError):
            list(warc.records(warc.inflate(io.BytesIO(raw[:-30]), 1_000)))


def test_components_of_many_edges(spark, monkeypatch):
    """Above the bound no side of a round's joins is broadcast; the roots are the same."""
    from riskframe.llm import components

    rnd = random.Random(5)
    edges = spark.createDataFrame([(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(150)], "a long, b long")
    few = sorted(components.connected_components(edges).collect())
    plans = []
    monkeypatch.setattr(components, "store", lambda df, name, f=components.store: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or f(df, name))
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0)
    assert sorted(components.connected_components(edges).collect()) == few
    assert len(plans) > 1 and not any("Broadcast" in x for x in plans)


def test_components(spark):
    from riskframe.llm.components import connected_components

    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (300, 300)]
    edges += [(rnd.randint(400, 600), rnd.randint(400, 600)) for _ in range(150)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    same(connected_components(spark.createDataFrame(edges, "a long, b long")), [(x, find(x)) for x in nodes])
