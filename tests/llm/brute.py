"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re


def removed(rows, window=200):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of (doc_id, text) rows."""
    data = [(t or "").encode() for _, t in rows]
    count = collections.Counter(d[s : s + window] for d in data for s in range(len(d) - window + 1))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for s in range(len(d) - window + 1):
            if count[d[s : s + window]] > 1:
                gone[s : s + window] = b"\1" * window
        spans = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, y in zip(d, gone, strict=True) if not y)
        out.append((doc, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n=5):
    words = [w for w in re.split("[\t\n\v\f\r ]+", (text or "").lower()) if w]
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else None


def near_groups(rows):
    """doc_id, group_id, class_id, copies, n_links of (doc_id, text) rows with ids."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    links = [0] * len(rows)
    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and y and 5 * len(x & y) >= 4 * len(x | y):
                links[a] += 1
                links[b] += 1
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = []
    for k, (doc, _) in enumerate(rows):
        mates = [rows[m][0] for m in range(len(rows)) if group[m] == group[k]]
        own = [rows[m][0] for m in range(len(rows)) if m == k or (sets[k] and sets[m] == sets[k])]
        out.append((doc, min(mates), min(own), len(own), links[k]))
    return out
