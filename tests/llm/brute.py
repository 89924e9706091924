"""Plain Python versions of the text operators for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SF_SMALL = "/root/testdata/sf0.001"
SPACE = re.compile("[\x20\x09-\x0d]+")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def op1(docs):
    import public_tokenizers as P
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    out = []
    for d, t in docs:
        n = len(sp.encode(t or ""))
        out.append((d, len((t or "").encode()), n, n > 4096))
    return out


def fingerprint(text, width=4):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def op2(docs, bits=4):
    prints = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(docs[i][0], f"{prints[i]:016x}", least[find(i)]) for i in range(len(docs))]


def op3(vectors, k=20, step=20):
    import math

    rows = {}
    for i, v in vectors:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(64 * x) for x in v]
        rows[i] = min(rows.get(i, q), q)
    out = []
    for q in (i for i in rows if i % step == 0):
        best = sorted((-sum(a * b for a, b in zip(rows[q], v)), i) for i, v in rows.items() if i != q and len(v) == len(rows[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:k])]
    return out


def op4(pages):
    first = {}
    for i, _, h in pages:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[sha(b)] = min(first.get(sha(b), i), i)
    out = []
    for i, _, h in pages:
        b = (h or "").encode()
        head = first.get(sha(b)) if len(b) >= 100 else None
        again = head is not None and head != i
        out.append((i, len(b), sha(b), "revisit" if again else "response", head if again else None))
    return out


BENCH = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def bench_words(text):
    return BENCH.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def op5(docs, items, window=10):
    wins = defaultdict(set)
    for i, t in items:
        w = bench_words(t) if i is not None else []
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[j:j + n])].add(i)
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, met = bench_words(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[j:j + n]))):
                    hit.update(range(j, j + n))
                    met |= found
        out.append((d, len(w), len(hit), len(met), sha(",".join(sorted(map(str, met)))), bool(hit)))
    return out


def op6(docs, length=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(docs, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        runs = len([x for x in bytes(gone).split(b"\x00") if x])
        out.append((d, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def op8(docs, window=50):
    last = 1 << 63
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, last), last if d is None else d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (last if d is None else d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        rate = left / sum(weight[s] for s in free)
        over = [s for s in free if rate * weight[s] > limit * sizes[s]]
        if not over:
            goal |= {s: rate * weight[s] for s in free}
            break
        for s in over:
            goal[s] = limit * sizes[s]
            left -= goal[s]
            free.remove(s)
    return goal


def op10(docs, end=2):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out, start = [], 0
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def op11(docs, signatures, phrases, strength, name_tier, side=32):
    out = []
    for d, t in docs:
        w = bench_words(t)
        base = [(i, label) for i in range(len(w)) for p, label in phrases if tuple(w[i:i + len(p)]) == p]
        found = []
        for i, word in enumerate(w):
            win = " " + "".join(x + " " for x in w[max(0, i - side):i]) + "@" + " ".join(w[i:i + side + 1]) + " "
            for rank, tier, label, anchor, keyword, pattern in signatures:
                m = re.search(pattern, win) if word == anchor and keyword in win else None
                if m:
                    first = max(0, i - side) + win[:m.start()].count(" ")
                    found.append((first, first + m.group().count(" ") - 2, tier, rank, label))
        kept = []
        for e in found:
            inside = any(o != e and o[0] <= e[0] and o[1] >= e[1] and o[2] <= e[2]
                         and (o[:2] != e[:2] or o[2:4] < e[2:4]) for o in found)
            crossed = any(o[2] < e[2] and (o[0] <= e[0] <= o[1] or o[0] <= e[1] <= o[1]) for o in found)
            if not inside and not crossed:
                kept.append(e)
        join = lambda x: ",".join(sorted(set(x)))
        names, at = [b for _, b in base], [i for i, _ in base]
        score = max([strength[e[2]] for e in kept] + ([strength[name_tier]] if base else []), default=0.0)
        out.append((d, len(w), len(base), min(at, default=None), max(at, default=None), join(names),
                    join(names + [e[4] for e in kept]), score, len(kept)))
    return out


LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:]


def op12(docs):
    counts = Counter()
    for d, t in docs:
        for r in LETTERS.findall(t or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if d is None else d}:{r}".encode())
            counts[r[:h % len(r)] + r[h % len(r) + 1:] if h % 199 == 0 else r] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    drops = defaultdict(set)  # words by what is left without one code point, itself included
    for w in n:
        for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            drops[x].add(w)
    near = {w: {v for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for v in drops[x] if one_apart(w, v)} for w in n}
    form = {}
    for w, vs in near.items():
        best = min(((-n[v], v) for v in vs), default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def op13(docs, labels):
    """``docs``: (doc_id, text, lang); ``labels``: (doc_id, quality, toxic)."""
    from itertools import permutations

    last = 1 << 63
    key = lambda d: last if d is None else d
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    first = {}
    for d, t, _ in docs:
        first[t or ""] = min(first.get(t or "", last), key(d))
    parts = defaultdict(list)
    for d, t, lang in docs:
        t = t or ""
        w = words(t)
        fails = {c for c, f in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            re.search("[#$%&*|]", t), key(d) > first[t])) if f}
        parts[lang or ""].append((fails, d is not None and d in good, d is not None and d in toxic))
    out = []
    for part, rows in parts.items():
        worth, lines = Counter(), []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                worth[f] += len(gone)
                lines.append((part, "".join(order), step + 1, len(left), len(gone), sum(f in r[0] for r in rows) - len(gone),
                              sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(*x, worth[x[1][x[2] - 1]]) for x in lines]
    return out


def op7_score(model, text):
    """The score of a whole text in one piece, in log space, features and chain written out."""
    import math

    lines = text.split(b"\n")

    def own(line):
        n = len(line)
        if not n:
            return [1.0] + [0.0] * 11
        kinds = Counter("u" if 65 <= c <= 90 else "l" if 97 <= c <= 122 or c >= 128 else "d" if 48 <= c <= 57
                        else "s" if c in (9, 11, 12, 13, 32) else "p" if chr(c) in ".,;:'\"-?()" else "o" for c in line)
        found = line.split()
        k = max(1, len(found))
        again = sum(a == b for a, b in zip(found, found[1:]))
        return [0.0, *[kinds[c] / n for c in "uldspo"], len(set(found)) / k, again / k, min(n / k, 40.0) / 10.0,
                min(k, 200) / 50.0, 1.0 if k < 4 else 0.0]

    feats, none = [own(x) for x in lines], [0.0] * 12
    unary = []
    for i, x in enumerate(lines):
        same = 1.0 if x and i + 1 < len(lines) and x == lines[i + 1] else 0.0
        row = feats[i] + (feats[i - 1] if i else none) + (feats[i + 1] if i + 1 < len(lines) else none) + [same, 1.0]
        unary.append(sum((v - m) / s * w for v, m, s, w in zip(row, model["mean"], model["std"], model["w"])))
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
    t = model["trans"]
    alpha, beta = [(0.0, unary[0])], [(0.0, 0.0)]
    for u in unary[1:]:
        a = alpha[-1]
        alpha.append((add(a[0] + t[0][0], a[1] + t[1][0]), add(a[0] + t[0][1], a[1] + t[1][1]) + u))
    for u in reversed(unary[1:]):
        b = beta[-1]
        beta.append((add(t[0][0] + b[0], t[0][1] + u + b[1]), add(t[1][0] + b[0], t[1][1] + u + b[1])))
    beta.reverse()
    weight = [len(x) + 1 for x in lines]
    odds = [(a[0] + b[0]) - (a[1] + b[1]) for a, b in zip(alpha, beta)]  # of bad, in logs
    return sum(w / (1 + math.exp(min(o, 700.0))) for w, o in zip(weight, odds)) / sum(weight)
