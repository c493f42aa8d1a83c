"""Plain Python versions of the operators' contracts."""

import hashlib

import xxhash


def words(text):
    return (text or "").encode().split()


def substring_dedup(rows):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text); a null id is larger than all."""
    rows = [(2**63 if i is None else i, i, words(t)) for i, t in rows]
    first = {}
    for order, _, w in rows:
        for p in range(len(w) - 12):
            k = tuple(w[p : p + 13])
            first[k] = min(first.get(k, 2**64), order)
    out = []
    for order, i, w in rows:
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < order:
                gone[p : p + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def fingerprint(text):
    w = words((text or "").encode().lower().decode())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(marks):
    """Smallest reachable id of each (id, fingerprint), by all pairs."""
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(marks)):
        for b in range(a):
            if (marks[a][1] ^ marks[b][1]).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(marks):
        groups.setdefault(find(k), []).append(i)
    return [min((i for i in groups[find(k)] if i is not None), default=None) for k in range(len(marks))]


def likeness(one, other, n=5):
    a, b = ({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in (words(one), words(other)))
    return len(a & b) / len(a | b)
