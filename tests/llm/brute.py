"""The contracts in plain Python, on small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def removed(units: list, window: int, seen: set) -> list[bool]:
    """Marks the units covered by a window that is in ``seen``, to which the windows of this text are added."""
    out = [False] * len(units)
    for i in range(len(units) - window + 1):
        key = tuple(units[i:i + window])
        if key in seen:
            out[i:i + window] = [True] * window
        seen.add(key)
    return out


def suffix_dedup(texts: dict, length: int = 100) -> dict:
    seen: set = set()
    out = {}
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = removed(list(data), length, seen)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), sum(gone), runs, sha(bytes(b for b, g in zip(data, gone) if not g)))
    return out


def substring_dedup(texts: dict, window: int = 20) -> dict:
    seen: set = set()
    out = {}
    for doc in sorted(texts):
        words = WORD.findall(texts[doc] or "")
        gone = removed(words, window, seen)
        out[doc] = (len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g).encode()))
    return out


def near_duplicates(texts: dict, n: int = 5) -> dict:
    sets, classes = {}, {}
    for doc in sorted(texts):
        w = WORD.findall(texts[doc] or "")
        sets[doc] = frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
        classes.setdefault(sets[doc], doc)
    firsts = sorted(classes.values())
    links, root = Counter(), {d: d for d in firsts}
    for i, a in enumerate(firsts):
        for b in firsts[:i]:
            common = len(sets[a] & sets[b])
            if common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return {d: (classes[s], links[classes[s]], root[classes[s]]) for d, s in sets.items()}


def quality_rules(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1])) % 10 == 0


def personal_data(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""

    def spans(kind: str, pattern: str, good) -> list:
        return [(kind, *m.span()) for m in re.finditer(pattern, text) if good(m.group(), re.sub("[^0-9]", "", m.group()))]

    return [
        *spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True),
        *spans("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(p) <= 255 for p in s.split("."))),
        *spans("card", r"[0-9]([\x20-]?[0-9])+", lambda s, d: 16 <= len(d) <= 19 and luhn(d)),
        *spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 8 <= len(d) <= 15)]


def contamination(texts: dict, items: dict, window: int = 13) -> dict:
    windows = defaultdict(set)
    for item, text in items.items():
        w = BENCH_WORD.findall((text or "").translate(LOWER))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i:i + size])].add(str(item))
    out = {}
    for doc, text in texts.items():
        w = BENCH_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in range(1, window + 1):
            for i in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[i:i + size])):
                    hit.update(range(i, i + size))
                    found |= ids
        out[doc] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def kneser_ney(texts: dict) -> dict:
    tokens = {d: [*WORD.findall((t or "").translate(LOWER)), None] for d, t in texts.items()}
    single, pair = Counter(), Counter()
    for doc, words in tokens.items():
        if zlib.crc32(str(doc).encode()) % 5 != 1:
            single.update(words)
            pair.update(zip(["<start>", *words], words))
    total, distinct = sum(single.values()), len(single)

    def discount(counts) -> list[float]:
        n = Counter(counts)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [0, *(min(max(d, 0.05), k) for k, d in enumerate(raw, 1))]

    before = Counter(b for _, b in pair)
    d2, d1 = discount(pair.values()), discount(before.values())
    begins, kinds = Counter(), defaultdict(Counter)
    for (a, _), c in pair.items():
        begins[a] += c
        kinds[a][min(c, 3)] += 1
    spare = sum(d1[min(c, 3)] for c in before.values()) / len(pair)
    out = {}
    for doc, words in tokens.items():
        base = score = 0.0
        for a, b in zip(["<start>", *words], words):
            base += math.log10((single[b] + 0.5) / (total + 0.5 * (distinct + 1)))
            p = spare / (distinct + 1) + ((before[b] - d1[min(before[b], 3)]) / len(pair) if before[b] else 0)
            if begins[a]:
                c = pair[a, b]
                p = (c - d2[min(c, 3)]) / begins[a] + sum(d2[k] * kinds[a][k] for k in (1, 2, 3)) / begins[a] * p
            score += math.log10(p)
        out[doc] = (len(words), sum(single[w] > 0 for w in words), total, base, score)
    return out
