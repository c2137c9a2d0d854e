"""Plain Python versions of the operators, as directly as their definitions read."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

FOLD = {i: i + 32 for i in range(65, 91)}


def low(text):
    return (text or "").translate(FOLD)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


# --- secrets

BASE = {
    "assign": (re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def secrets(text):
    """{kind: [(start, end)]} of the strong kinds."""
    return {k: [m.span() for m in p.finditer(text or "") if len(m[g]) >= least] for k, (p, g, least) in BASE.items()}


# --- decontamination


def contamination(docs, benchmark):
    windows = defaultdict(set)
    for item in benchmark:
        w = words(item["text"])
        size = min(13, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[s:s + size])].add(item["item_id"])
    sizes = {len(k) for k in windows}
    out = []
    for d in docs:
        w, hit, items = words(d["text"]), set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if found := windows.get(tuple(w[s:s + size])):
                    hit.update(range(s, s + size))
                    items |= found
        names = sorted(map(str, items))
        out.append((d["doc_id"], len(w), len(hit), len(names), sha(",".join(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


# --- mixing


def uniform(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) / 16 ** 13


def mix_counts(docs, seed, flatten):
    chars = Counter()
    for d in docs:
        chars[d["source"]] += len(d["text"] or "")
    weight = {s: n ** flatten for s, n in chars.items()}
    out = []
    for d in docs:
        s = d["source"]
        rate = weight[s] / sum(weight.values()) * sum(chars.values()) / chars[s] if chars[s] else 1.0
        own = str(d["doc_id"]) if d["doc_id"] is not None else "text " + (d["text"] or "")
        u, k, p = uniform(str(seed), own), 0, math.exp(-rate)
        total = p
        while total <= u and k < rate + 10 * math.sqrt(rate) + 21:
            k += 1
            p *= rate / k
            total += p
        out.append(k)
    return out


# --- licenses


def phrase_places(text, phrase):
    w, p = words(text), phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]


def notice_cover(text, notice, slack):
    """Largest share of a notice's word pairs on diagonals that are at most ``slack`` apart."""
    w, p = words(text), notice.split()
    pairs = [tuple(p[i:i + 2]) for i in range(len(p) - 1)]
    hits = defaultdict(set)
    for i in range(len(w) - 1):
        for at, pair in enumerate(pairs):
            if (w[i], w[i + 1]) == pair:
                hits[i - at].add(at)
    best, span, last = 0, set(), None
    for diagonal in sorted(hits):
        span = span if last is not None and diagonal - last <= slack else set()
        span, last = span | hits[diagonal], diagonal
        best = max(best, len(span))
    return best / len(pairs)


# --- quality


def quality_stats(text):
    t = tokens(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(t[i:i + 5]) for i in range(len(t) - 4))
    inside = {j for i in range(len(t) - 4) if grams[tuple(t[i:i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(t) < 10 or 100 * len(inside) > 20 * len(t)
    return (len(t), sum(map(len, t)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), failed)


def spark_hash(*values, seed=42):
    """Spark's xxhash64 of texts, whole numbers and nulls."""
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
            seed = xxhash.xxh64_intdigest(raw, seed % (1 << 64))
    return signed(seed % (1 << 64))


def buckets(text, n):
    h = [spark_hash(t) for t in tokens(text)]
    return [x % n for x in h] + [spark_hash(x, y) % n for x, y in zip(h, [*h[1:], None])]


def quality_scores(docs, trusted, n, prior):
    raw, target = Counter(), Counter()
    own = [buckets(d["text"], n) for d in docs]
    for d, b in zip(docs, own):
        raw.update(b)
        if d["doc_id"] in trusted:
            target.update(b)
    share = sum(target.values()) / max(1, sum(raw.values()))
    return [sum(math.log((target[x] + prior) / (raw[x] * share + prior)) for x in b) / len(b) if b else 0.0 for b in own]


# --- sharding


def virtual_slot(doc_id, text, n):
    own = str(doc_id) if doc_id is not None else "text:" + (text or "")
    return int(hashlib.md5(own.encode()).hexdigest()[:8], 16) % n


def shard_map(docs, shards, n):
    size = Counter({s: 0 for s in range(n)})
    for d in docs:
        size[virtual_slot(d["doc_id"], d["text"], n)] += len((d["text"] or "").encode()) + 8
    loads, out = [0] * shards, {}
    for slot, b in sorted(size.items(), key=lambda x: (-x[1], x[0])):
        k = loads.index(min(loads))
        loads[k] += b
        out[slot] = k
    return out


# --- near duplicates


def simhash(text):
    t = [x.encode() for x in tokens(low(text))]
    shingles = [b" ".join(t[i:i + 3]) for i in range(max(1, len(t) - 2))] if t else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids):
    """Smallest id reachable from every row; None counts as no id."""
    above = list(range(len(prints)))

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                above[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


# --- language model


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def base_scores(docs):
    counts = Counter()
    own = [[*tokens(low(d["text"])), ""] for d in docs]
    for d, t in zip(docs, own):
        if not held_out(d["doc_id"]):
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    return [(held_out(d["doc_id"]), len(t), sum(1 for x in t if counts[x]), n,
             sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)) for d, t in zip(docs, own)]


M32 = (1 << 32) - 1


def spread32(h):
    h ^= h >> 15
    h = h * 0x2C1B3C6D & M32
    h ^= h >> 13
    h = h * 0x297A2D39 & M32
    return h ^ h >> 16


def text_decisions(codes):
    """(place, bit, slots of three orders) of every token of a text of 10-bit codes; slots as keys."""
    out = []
    for i, code in enumerate(codes):
        one, two = (codes[i - 1] + 1 if i > 0 else 0), (codes[i - 2] + 1 if i > 1 else 0)
        h1 = spread32((one * 0x9E3779B1 + 1) & M32)
        h2 = spread32(h1 ^ (two * 0xC2B2AE35 + 0x27D4EB2F & M32))
        row = []
        for place in range(10):
            group, j = divmod(place, 5)
            begun = (code >> 5 * (2 - group)) + (0, 1)[group]
            node = 1 << j | (code >> 5 * (1 - group) & 31) >> (5 - j)
            line = [spread32(h + begun * 0x85EBCA6B & M32) >> 15 for h in (h1, h2)]
            row.append((place, code >> (9 - place) & 1, [("a", begun, node), ("b", line[0], node), ("c", line[1], node)]))
        out.append(row)
    return out


def mixed_scores(docs):
    """log10 probability of every document by the mixed model, one decision after the other."""
    counts = Counter()
    own = [[*tokens(low(d["text"])), ""] for d in docs]
    for d, t in zip(docs, own):
        if not held_out(d["doc_id"]):
            counts.update(t)
    number = {t: i for i, (t, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))) if i < 768}
    code = lambda t: number.get(t, 768 + zlib.crc32(t.encode()) % 256)
    mass = Counter()
    for t, n in counts.items():
        mass[code(t)] += n + 1
    laid = [text_decisions([code(x) for x in t]) for t in own]
    seen = defaultdict(lambda: [0, 0])
    for d, rows in zip(docs, laid):
        if not held_out(d["doc_id"]):
            for row in rows:
                for _, bit, slots in row:
                    for k in slots:
                        seen[k][bit] += 1
    for c in seen.values():
        most = max(c)
        if most > 255:
            c[:] = [max(x * 255 // most, int(x > 0)) for x in c]
    logit = lambda c: math.log((c[1] + 0.4) / (c[0] + 0.4))
    sure = lambda c: int(sum(c) > 0) + int(sum(c) >= 8)
    slope, bend = defaultdict(lambda: np.zeros(3)), defaultdict(lambda: np.eye(3))
    for d, rows in zip(docs, laid):
        for row in rows if not held_out(d["doc_id"]) else ():
            for place, bit, slots in row:
                left = [[seen[k][0] - (bit == 0), seen[k][1] - bit] for k in slots]
                x = np.array([logit(c) for c in left])
                p = 1 / (1 + math.exp(-0.4 * x.sum()))
                gate = place, sure(left[1]), sure(left[2])
                x[0] = 0  # the first weight is not learned
                slope[gate] += (bit - p) * x
                bend[gate] += p * (1 - p) * np.outer(x, x)
    start = {}
    for gate in slope:
        step = np.linalg.solve(bend[gate], slope[gate])
        start[gate] = 0.4 + step / max(1.0, np.abs(step).max())
    out = []
    for t, rows in zip(own, laid):
        weights, total = {}, 0.0
        for row in rows:
            for place, bit, slots in row:
                gate = place, sure(seen[slots[1]]), sure(seen[slots[2]])
                w = weights.setdefault(gate, start.get(gate, np.full(3, 0.4)).copy())
                x = np.array([logit(seen[k]) for k in slots])
                p = 1 / (1 + math.exp(-float(w @ x)))
                total += math.log10(p if bit else 1 - p)
                w += 0.02 * (bit - p) * x
        total += sum(math.log10((counts[x] + 1) / (mass[code(x)] + 1)) for x in t if x not in number)
        out.append(total)
    return out
