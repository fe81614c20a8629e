"""Plain Python versions of the operators' results."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def lower_az(t: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sha(t: str) -> str:
    return hashlib.sha256(t.encode()).hexdigest()


def fingerprint(t: str | None) -> int:
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", lower_az(t))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64)) if h else 0


def components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    root = {f: f for _, f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(root)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[find(f)].append(i)
    return [(i, f"{f:016x}", min(least[find(f)], default=None)) for i, f in prints]


def hit_words(text: str | None, items: list[tuple]) -> tuple:
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(t))
    doc, hit, who = find(text), set(), set()
    known = defaultdict(set)
    for item, t in items:
        w = find(t)
        for i in range(max(1, len(w) - 9)) if w else ():
            known[tuple(w[i : i + 10])].add(item)
    for n in {len(k) for k in known}:
        for i in range(len(doc) - n + 1):
            if (k := tuple(doc[i : i + n])) in known:
                hit |= {*range(i, i + n)}
                who |= known[k]
    ids = sorted(str(x) for x in who if x is not None)
    return len(doc), len(hit), len(ids), sha(",".join(ids)), bool(hit)


def base_spans(text: str | None) -> list[tuple]:
    t, out = text or "", []
    assign = r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, t, re.ASCII) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def secrets(text: str | None) -> tuple:
    spans = base_spans(text)
    n = Counter(k for _, _, k, _ in spans)
    return n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans))


def exact(rows: list[tuple]) -> list[tuple]:
    by = defaultdict(list)
    for i, t in rows:
        by[lower_az(t)].append(i)
    out = []
    for t, ids in by.items():
        keep = max((i for i in ids if i is not None), default=None)
        at = ids.index(keep)
        out += [(i, keep, len(ids), k == at, sha(t)) for k, i in enumerate(ids)]
    return out


def targets(sizes: dict) -> dict:
    """Targets of sources by handing the excess on again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, goal, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), list(order)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if goal[s] + left * weight[s] / total > 2 * sizes[s]]
        for s in open_:
            goal[s] += left * weight[s] / total
        left = sum(goal[s] - 2 * sizes[s] for s in full)
        goal |= {s: 2.0 * sizes[s] for s in full}
        open_ = [s for s in open_ if s not in full]
    return goal


def split_url(url: str | None) -> tuple:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower_az(host), re.match(r"[^?#]*", rest[len(host) :])[0]


RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def rule(host: str, path: str) -> str | None:
    fits = []
    for r in RULES:
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(r)
    return max(fits, key=len, default=None)


def archive(rows: list[tuple]) -> list[tuple]:
    by = defaultdict(list)
    for i, html in rows:
        by[(html or "").encode()].append(i)
    out = []
    for body, ids in by.items():
        first = min((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(body) >= 100 and i != first
            out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return out


def unions(edges: list[tuple]) -> dict:
    root: dict = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}
