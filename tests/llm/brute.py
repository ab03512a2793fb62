"""Plain Python versions of the operators' definitions, for small inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import xxhash

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.translate(_LOWER) if lower else raw).split()


def grams(own, k):
    return [tuple(own[i:i + k]) for i in range(len(own) - k + 1)] if len(own) >= k else [tuple(own)] if own else []


def jaccard_components(rows, k=5, percent=80):
    """{(id, n, component)} of rows (id, text); ids are not null here."""
    sets = [(i, frozenset(grams(words(t, True), k))) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets:
        for b, t in sets:
            sizes = sorted((len(s), len(t)))
            if s and t and a < b and 100 * sizes[0] >= percent * sizes[1] and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def cut_repeats(rows, size):
    """(id, n_words, n_removed, sha256 of what is left) of rows (id, text), ids distinct."""
    first, out = {}, []
    for i, text in sorted(rows):
        own = words(text)
        gone = [False] * len(own)
        for at in range(len(own) - size + 1):
            if first.setdefault(tuple(own[at:at + size]), i) < i:
                gone[at:at + size] = [True] * size
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out.append((i, len(own), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def contaminated(docs, items, k=5, percent=80):
    """{(id, item): (common, total)} of the best windows, over all windows of item size."""
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    out = {}
    for i, text in docs:
        own = grams(split(text), k)
        for item, wanted in items:
            wanted = grams(split(wanted), k)
            if not set(own) & set(wanted):
                continue
            for at in range(max(1, len(own) - len(wanted) + 1)):
                window = own[at:at + len(wanted)]
                common = sum((Counter(window) & Counter(wanted)).values())
                total = len(window) + len(wanted) - common
                if 100 * common >= percent * total:
                    old = out.get((i, item), (0, 1))
                    if common * old[1] > old[0] * total:
                        out[i, item] = (common, total)
    return out


def prose(rng: random.Random, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, edits):
    own = text.split()
    for _ in range(edits):
        own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
    return " ".join(own)


def cluster_vectors(rows, k=40, rounds=5, dim=64, scale=256, seed=2):
    """[(id, cluster, distance)] and the final centroids of rows (id, vector); all distances are computed."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x) * scale < 1 << 24 for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    start = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in start[:k]]

    def assign():
        far = lambda v: [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centroids]
        return [min((d, j) for j, d in enumerate(far(v))) for _, v in kept]

    for _ in range(rounds if centroids else 0):
        own = assign()
        for j in range(len(centroids)):
            members = [v for (_, v), (_, at) in zip(kept, own) if at == j]
            if members:
                centroids[j] = [sum(x) // len(members) for x in zip(*members)]
    return ([(i, j, d) for (i, _), (d, j) in zip(kept, assign())] if centroids else []), centroids


def simhash(text, k=4):
    counts = [0] * 64
    own = [b" ".join(g) for g in grams(words(text, True), k)]
    for g in own:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(own))


def print_components(prints, radius=4):
    """[(id, component)] of [(id, fingerprint)], all pairs compared."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, p in prints:
        for b, q in prints:
            if a < b and (p ^ q).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, find(i)) for i, _ in prints)


def prefix_trie(rows, family=20, heads=4):
    """Sorted (conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of rows
    (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        built = own.get(c - int(math.fmod(c, family)), [])[:h] + turns[h:]
        for d in range(len(built) + 1):
            nodes.setdefault(tuple(built[:d]), []).append((c, d == len(built)))
    out = []
    for key, members in nodes.items():
        below = [n for n in nodes if n[:len(key)] == key]
        leaves = [n for n in below if not any(m[:len(n)] == n and len(m) == len(n) + 1 for m in below)]
        saved = sum((len(nodes[n]) - 1) * len(words(n[-1][1])) for n in below if n)
        ends = ",".join(map(str, sorted(c for c, ends in members if ends)))
        out.append((min(members)[0], len(key), min(nodes[key[:-1]])[0] if key else None, len(members),
                    sum(len(n) == len(key) + 1 for n in below), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)
