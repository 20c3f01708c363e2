"""Plain versions of the operators, over lists."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(low(text))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def line_dedup(rows, min_key=1, min_docs=10):
    """{k: (n_lines, n_dropped, kept)} of rows (id, text)."""
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for k, (i, t) in enumerate(rows):
        for line in (t or "").split("\n"):
            docs[key(line)].add(i if i is not None else ("null", t))
    drop = {x for x, s in docs.items() if len(s) >= min_docs and len(x) >= min_key}
    out = []
    for _, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in drop]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def jaccard_classes(rows, threshold=0.8):
    """(class_id, copy_id, n_copies, n_links) of rows (id, text)."""
    groups = defaultdict(list)
    for i, t in rows:
        if i is not None and words(t):
            groups[tuple(words(t))].append(i)
    reps = {min(ids): shingles(" ".join(w)) for w, ids in groups.items()}
    root, links = {k: k for k in reps}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    some = sorted(reps)
    for n, a in enumerate(some):
        for b in some[:n]:
            common = len(reps[a] & reps[b])
            if common and common >= threshold * (len(reps[a]) + len(reps[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    out = []
    for i, t in rows:
        ids = groups.get(tuple(words(t)), [i]) if i is not None and words(t) else [i]
        rep = ids[0] if ids == [i] else min(ids)
        out.append((find(rep) if rep in root else i, rep, len(ids), links[rep]))
    return out


def contained(rows, items, threshold=0.8):
    """Sorted (id, item, n, found)."""
    out = []
    wanted = [(m, shingles(s), min(5, max(1, len(words(s))))) for m, s in items]
    for i, t in rows:
        own = {size: shingles(t, size) for size in {size for *_, size in wanted}}
        for m, want, size in wanted:
            found = len(want & own[size])
            if want and found >= threshold * len(want) - 1e-9:
                out.append((i, m, len(want), found))
    return out


def base_rules(text):
    w = TOKEN.findall(text or "")
    lines = [x for x in (text or "").split("\n") if TOKEN.search(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed
