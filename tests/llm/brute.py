"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def words(text):
    return WORD.findall((text or "").encode())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def windows(docs, width=20):
    """{doc_id: (n_words, n_removed, kept)} of rows with distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        w = words(text)
        gone = set()
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            if key in seen:
                gone.update(range(i, i + width))
            seen.add(key)
        out[doc] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def shingle_set(text, width=5):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def near(docs, percent=85):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def suffixes(docs, width=50):
    """{doc_id: (n_bytes, spans, kept)} of rows with distinct ids."""
    seen, out = {}, {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if seen.setdefault(data[i:i + width], doc) < doc:
                gone[i:i + width] = b"\1" * width
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out[doc] = (len(data), spans, bytes(x for x, g in zip(data, gone) if not g))
    return out


def base_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    triples = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def mix(docs, max_epochs=3, seed=17):
    """[(doc_id, source, size, target, taken)] of (doc_id, text, source)."""
    sizes = [(d, s, len(words(t))) for d, t, s in docs]
    total = defaultdict(int)
    for _, s, n in sizes:
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, target = set(), {}
    while True:
        left = sum(total.values()) - sum(max_epochs * total[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and weight[s] * left > max_epochs * total[s] * share}
        if not more:
            break
        capped |= more
    for s in names:
        target[s] = float(max_epochs * total[s]) if s in capped else weight[s] * left / share if share else 0.0
    before, out = defaultdict(int), []
    order = lambda r: (hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), -1 if r[0] is None else r[0], r[2])
    for d, s, n in sorted(sizes, key=order):
        goal = math.floor(target[s] + 0.5)
        whole, part = divmod(goal, total[s]) if total[s] else (0, 0)
        out.append((d, s, n, target[s], whole * n + max(0, min(n, part - before[s]))))
        before[s] += n
    return out


def spelling(docs, min_length=7, min_count=2, factor=10):
    """{word: (form, root, n, n_near, form_n)} by plain edit distance over all pairs."""
    import zlib
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}

    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long_ = sorted((a, b), key=len)
        return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))

    near = defaultdict(list)
    words_ = sorted(vocab)
    for i, a in enumerate(words_):
        for b in words_[i + 1:]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda o: (-vocab[o], o), default=None)
        form[w] = best if best is not None and vocab[best] >= factor * n else None
    out = {}
    for w, n in vocab.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), vocab[form[w]] if form[w] else None)
    return out


def runs_of(ids):
    """(start, length, period) of every run, by trying every period on every place."""
    n, out = len(ids), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if ids[i] != ids[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and ids[j] == ids[j + q]:
                j += 1
            s, length = i, j - i + q
            smaller = any(q % p == 0 and all(ids[k] == ids[k + p] for k in range(s, s + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((s, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))
