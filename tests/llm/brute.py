"""Plain Python statements of what the operators of this subpackage give."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeats(texts: dict, width: int = 400) -> dict:
    """doc -> (bytes, removed, spans, sha of what stays)."""
    data = {d: (t or "").encode() for d, t in texts.items()}
    seen = Counter(b[i : i + width] for b in data.values() for i in range(len(b) - width + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out[d] = len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))
    return out


def quality(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def rule(url: str | None, rules) -> tuple:
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fits = [
        (len(h + p), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    text = text or ""
    assign = re.compile(
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def shingle_set(text: str | None, size: int = 5) -> set:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def groups(texts: list[tuple], percent: int = 75) -> dict:
    """row number -> least id reachable."""
    sets = [shingle_set(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    done = set()
    for rows in index.values():
        for k, i in enumerate(rows):
            for j in rows[k + 1 :]:
                if (i, j) not in done:
                    done.add((i, j))
                    if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                        parent[root(i)] = root(j)
    least: dict = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return {i: (len(sets[i]), least.get(root(i), d)) for i, (d, _) in enumerate(texts)}


def leaks(text: str | None, items: list[tuple], size: int = 5, least: float = 0.75) -> list:
    """Items that some window of their own length resembles."""
    split = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").translate(LOWER))
    words, found = split(text), []

    def grams(w):
        return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()

    own = set(grams(words))
    for item, item_text in items:
        other = split(item_text)
        if not other:
            continue
        target = grams(other)
        if len(other) >= size and not own & set(target):
            continue
        for i in range(max(1, len(words) - len(other) + 1)):
            window = grams(words[i : i + len(other)])
            if sum((window & target).values()) >= least * sum((window | target).values()):
                found.append(item)
                break
    return sorted(found)


def manifest(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof hash, folded root, verified) of (doc_id, source, lang,
    n_chars, text) rows, some of them tampered with."""

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, more=0):
        doc_id, source, lang, n_chars, text = row
        n_chars = None if n_chars is None else n_chars + more
        return sha("".join(field(v) for v in (doc_id, source, lang, n_chars, text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def siblings(tree, i):
        for level in tree[:-1]:
            yield (i ^ 1) < i, "".join(level[i ^ 1 : (i ^ 1) + 1])
            i >>= 1

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = {
        lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for lang in langs
    }
    trees = {lang: levels([leaf(r) for r in members[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for i, row in enumerate(members[lang]):
            way = [*siblings(trees[lang], i), *siblings(top, place)]
            chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, int(chosen))
            for before, other in way:
                node = sha(other + node if before else node + other)
            proof = sha("".join(other for _, other in way))
            out.append((row[0], leaf(row), trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def passages(texts: list[tuple], width: int = 50) -> list[tuple]:
    """(doc_id, words, removed, sha of the kept words) of (doc_id, text) rows."""
    split = [(d, WORD.findall(t or "")) for d, t in texts]
    least: dict = {}
    for d, words in split:
        for i in range(len(words) - width + 1):
            if d is not None:
                passage = tuple(words[i : i + width])
                least[passage] = min(least.get(passage, d), d)
    out = []
    for d, words in split:
        gone = bytearray(len(words))
        for i in range(len(words) - width + 1):
            if d is not None and least[tuple(words[i : i + width])] < d:
                gone[i : i + width] = b"\1" * width
        out.append((d, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def divergences(rows: list[tuple], scale: int = 10**9) -> list[tuple]:
    """(lang, source, part, item, value, rank) of (lang, source, text) rows."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts: dict = {}
    documents: dict = {}
    for lang, source, text in rows:
        found = term.findall((text or "").translate(LOWER))
        counts.setdefault(lang or "", {}).setdefault(source or "", Counter()).update(found)
        documents.setdefault(lang or "", Counter()).update(set(found))
    out = []
    for lang, groups in counts.items():
        kept = [t for t, n in documents[lang].items() if n >= 3]

        def weights(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + scale * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {source: weights(count) for source, count in groups.items()}
        q = weights(sum(groups.values(), Counter()))
        for source, count in groups.items():
            pairs = [
                (-sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode())
                for o in groups if o != source
            ]
            more = [
                (-((p[source][t] - q[t]) ** 2 // q[t]), t.encode())
                for t in kept if count[t] and p[source][t] > q[t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(more)[:200])):
                out += [(lang, source, part, o.decode(), -v, i + 1) for i, (v, o) in enumerate(found)]
    return out
