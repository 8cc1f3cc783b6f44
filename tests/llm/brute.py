"""Plain versions of the operators, for small tables."""

import collections
import re


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def top(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def link(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


def jaccard(rows, size, percent):
    sets = {}
    for key, text in rows:
        w = blank_words(lower(text))
        sets[key] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    groups, keys = Groups(sets), sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                groups.link(a, b)
    return {(k, len(sets[k]), groups.top(k)) for k in keys}


def contamination(docs, items, window=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = alnum_words(text)
        for j in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[j : j + window])].add(str(item))
    out = []
    for key, text in docs:
        w, hit, found = alnum_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for j in range(len(w) - size + 1):
                if (here := windows.get(tuple(w[j : j + size]))) is not None:
                    found |= here
                    hit.update(range(j, j + size))
        out.append((key, len(w), len(hit), sorted(found)))
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def simhash(word_hashes):
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in word_hashes) > len(word_hashes))


def line_dedup(rows, hash_of, distance_bits=3, similarity=0.9, min_words=5):
    """With ``distance_bits`` None lines are linked by edit similarity alone, however far apart their SimHashes are."""
    places = [(k, j, tuple(alnum_words(re.sub("[0-9]", "0", line)))) for k, t in rows if t is not None for j, line in enumerate(t.split("\n"))]
    places = [p for p in places if len(p[2]) >= min_words]
    forms = sorted({f for *_, f in places})
    hashes = [simhash([hash_of(w) for w in f]) for f in forms]
    groups, bags = Groups(range(len(forms))), [set(f) for f in forms]
    for i, a in enumerate(forms):
        for j in range(i + 1, len(forms)):
            if distance_bits is None or (hashes[i] ^ hashes[j]).bit_count() <= distance_bits:
                most = int((1 - similarity) * max(len(a), len(forms[j])) + 1e-9)
                # Words that only one of them has each cost an edit, so most pairs need no table.
                if abs(len(a) - len(forms[j])) <= most and len(bags[i] - bags[j]) <= most and distance(a, forms[j]) <= most:
                    groups.link(i, j)
    index, first, gone = {f: i for i, f in enumerate(forms)}, {}, set()
    for k, j, f in sorted(places):
        if first.setdefault(groups.top(index[f]), (k, j)) != (k, j):
            gone.add((k, j))
    return {k: None if t is None else "\n".join(line for j, line in enumerate(t.split("\n")) if (k, j) not in gone) for k, t in rows}


def quality(text):
    w = blank_words(text)
    seen, covered = collections.Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if blank_words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
