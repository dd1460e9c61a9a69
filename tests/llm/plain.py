"""Plain statements of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import string

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words7(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingles(text):
    w = words7(text)
    if len(w) >= 5:
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def smallest_reachable(nodes, links):
    """Union-find by smallest member."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def near_duplicates(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {d: (len(sets[d]), c) for d, c in smallest_reachable(ids, links).items()}


def words8(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def benchmark_hits(text, items):
    """(n_words, n_hit, n_items, sha256, contaminated) of one text."""
    w, hit, found = words8(text), set(), set()
    for item, body in items:
        ws = words8(body)
        n = min(13, len(ws))
        wins = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if ws else set()
        for i in range(len(w) - n + 1 if wins else 0):
            if tuple(w[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(item))
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)


def base_secrets(text):
    """(n_assign, n_access, n_hex, base_sha256) of one text."""
    text = text or ""
    kinds = [
        (r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|[sS][eE][cC][rR][eE][tT]|"
         r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
        (r"AKIA[A-Z0-9]+", 20, 0), (r"[0-9a-f]+", 24, 0)]
    spans = []
    for k, (p, n, g) in enumerate(kinds):
        spans += [(m.start(), k, m.end()) for m in re.finditer(p, text) if len(m.group(g)) >= n]
    spans.sort()
    s = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    return (*(sum(x[1] == k for x in spans) for k in range(3)), hashlib.sha256(s.encode()).hexdigest())
