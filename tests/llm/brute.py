"""The contracts of the ten queries computed plainly, one row after the other."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def targets(sizes: dict) -> dict:
    """Targets per source by resharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1.0 + n % 3 for n, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in held]
        left = total - sum(3 * sizes[s] for s in held)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in held else share[s] for s in order}
        held |= over
        if len(held) == len(order):
            return {s: 3.0 * sizes[s] for s in order}


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs):
    """(doc_id, fingerprint, component_id) of rows (doc_id, text)."""
    found = [(i, fingerprint(t)) for i, t in docs]
    fps = sorted({f for _, f in found})
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    for n, a in enumerate(fps):
        for b in fps[:n]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for i, f in found:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [(i, f"{f:016x}", least.get(root(f))) for i, f in found]


def top_products(rows, every=100, k=10):
    vectors = set()
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.add((i, tuple(math.floor(1024 * x) for x in v)))
    out = []
    best = defaultdict(list)
    for q, a in vectors:
        if q % every == 0:
            best[q] += [(-sum(x * y for x, y in zip(a, b)), c) for c, b in vectors if c != q]
    for q, found in best.items():
        out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def without_repeats(docs, size=50):
    """(doc_id, n_words, n_removed, sha of the kept words) of rows (doc_id, text)."""
    first = {}
    for i, text in docs:
        w = words(text)
        for at in range(len(w) - size + 1):
            key = tuple(w[at : at + size])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for at in range(len(w) - size + 1):
            if i is not None and first[tuple(w[at : at + size])] < i:
                gone[at : at + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def base_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    gone = set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            gone.update(range(i, i + 5))
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(gone)
    )


def luhn(d):
    total = 0
    for n, c in enumerate(d[::-1]):
        x = int(c) * (2 if n % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def spans(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def prefix_trie(rows):
    """Nodes of rows (conv_id, turn, role, text), as the query returns them."""
    given = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            given[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in given.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in built.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
        ends[tuple(own)].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        adds = (len(own) - 1) * len(words(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += adds
    return [
        (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node], leaves[node], saved[node],
         sha(",".join(map(str, sorted(ends[node])))))
        for node, own in members.items()
    ]


def cosine_groups(rows, least):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, vector) with ids of their own."""
    sound = {
        i: v for i, v in rows if v and None not in v and all(map(math.isfinite, v)) and any(v)
    }
    parent, links = {i: i for i, _ in rows}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sound)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sound[a], sound[b]
            if len(x) == len(y) and math.sumprod(x, y) / math.sqrt(math.sumprod(x, x) * math.sumprod(y, y)) >= least:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [(i, links[i], root(i), root(i) == i) for i, _ in rows]


class KneserNey:
    """Interpolated modified Kneser-Ney over the characters of some texts, from dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter()
        for text in texts:
            text = "\n" * (order - 1) + text.replace("\0", "\1")
            top.update(text[i : i + order] for i in range(len(text) - order + 1))
        self.levels = [top]
        for _ in range(order - 1):
            self.levels.insert(0, Counter(g[1:] for g in self.levels[0]))
        self.cuts, self.contexts = [], []
        for level in self.levels:
            n = {i: 1 + sum(c == i for c in level.values()) for i in range(1, 5)}
            y = n[1] / (n[1] + 2 * n[2])
            cuts = [0.0] + [max(0.0, i - (i + 1) * y * n[i + 1] / n[i]) for i in (1, 2, 3)]
            contexts = defaultdict(lambda: [0, 0.0])
            for gram, c in level.items():
                contexts[gram[:-1]][0] += c
                contexts[gram[:-1]][1] += min(c, cuts[min(c, 3)])
            self.cuts.append(cuts)
            self.contexts.append(dict(contexts))

    def probability(self, gram):
        """Of the last character after those before it."""
        if not gram:
            return 1 / (len(self.levels[0]) + 1)
        level, cuts, contexts = (x[len(gram) - 1] for x in (self.levels, self.cuts, self.contexts))
        lower = self.probability(gram[1:])
        if gram[:-1] not in contexts:
            return lower
        total, left = contexts[gram[:-1]]
        c = level.get(gram, 0)
        return (c - min(c, cuts[min(c, 3)]) + left * lower) / total

    def surprise(self, text):
        text = "\n" * (self.order - 1) + text.replace("\0", "\1")
        return -sum(math.log(self.probability(text[i : i + self.order])) for i in range(len(text) - self.order + 1))


def disclosing(texts, module):
    """Per text the marked terms and whether they go: {term: gone}, from plain sets of documents."""
    held = []
    for text in texts:
        spans = module.base_spans(text or "")
        inside = {i for _, s, e in spans for i in range(s, e)}
        words = [m for m in WORD.finditer(text or "") if not inside & set(range(m.start(), m.end()))]
        entities = module._held(text or "", spans)[0]
        held.append((entities, {module.term_of(m[0]) for m in words} - {""}))
    with_entity, with_term, both = Counter(), Counter(), Counter()
    for n, text in enumerate(texts):
        entities, terms = held[n]
        with_entity.update(entities)
        with_term.update({module.term_of(w) for w in words_of(text)} - {""})
        both.update((e, t) for e in entities for t in terms)

    def bound(b, m):
        p, z = b / m, module.CONFIDENCE**2
        return round((p + z / (2 * m) - module.CONFIDENCE * math.sqrt(p * (1 - p) / m + z / (4 * m * m))) / (1 + z / m), 12)

    out = []
    for entities, terms in held:
        marked = {}
        for e in entities:
            n = with_entity[e]
            for t in terms:
                low = bound(both[e, t], with_term[t])
                if n < len(texts) and low >= module.CERTAIN and 1 - math.log(low) / math.log(n / len(texts)) >= module.GENERALISE:
                    marked[t] = marked.get(t, False) or low >= module.REMOVE
        out.append(marked)
    return out


def words_of(text):
    return WORD.findall(text or "")
