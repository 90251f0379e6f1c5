"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

WHITE = re.compile(rb"[\x20\x09-\x0d]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return [w for w in WHITE.split((text or "").encode()) if w]


def without_repeats(texts, window=35):
    """Per text the number of words, of removed words, and the kept text."""
    all_words = [words(t) for t in texts]
    count = Counter(tuple(w[k:k + window]) for w in all_words for k in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def shingle_sets(texts):
    out = []
    for text in texts:
        w = [x.lower() for x in words(text)]
        out.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    return out


def groups(ids, texts):
    """Per id the size of its set and the smallest id that links reach."""
    sets, parent = shingle_sets(texts), {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, own in enumerate(sets):
        shared = Counter(j for x in own for j in holders[x])
        for x in own:
            holders[x].append(k)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                a, b = root(ids[k]), root(ids[j])
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in zip(ids, sets)}


def _passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def base_spans(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PII.items() for m in re.finditer(p, text or "") if _passes(k, m[0]))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def word_runs(w, shortest=24, times=3):
    """Every (start, length, period), period by period."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            begin = i
            while i < n and w[i] == w[i - q]:
                i += 1
            start, length = begin - q, i - begin + q
            if length >= max(shortest, times * q):
                least = next(p for p in range(1, q + 1) if all(w[k] == w[k - p] for k in range(start + p, i)))
                if least == q:
                    out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted_words(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collapsed(doc_id, text):
    """A row of the query on runs."""
    w = planted_words(doc_id, words(text))
    runs = word_runs(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def spelling_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    alike = defaultdict(set)
    for w in n:
        for k in range(len(w) + 1):
            alike[w[:k] + w[k + 1:]].add(w)
    near = defaultdict(set)
    for group in alike.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out)


def mix_targets(sizes, weights=(1, 2, 3), most=3):
    """Per source its target, from a dict of sizes in order of the sources."""
    total, weight = sum(sizes.values()), {s: weights[k % len(weights)] for k, s in enumerate(sizes)}
    capped = set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        share = sum(w for s, w in weight.items() if s not in capped)
        target = {s: Fraction(most * sizes[s]) if s in capped else Fraction(rest * weight[s], share) for s in sizes}
        over = {s for s in sizes if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over
