"""Plain versions of the operators, and tables of hard cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, score string, row int, n int"


def prose(seed: int, words: int, pool: int = 400) -> str:
    random = np.random.default_rng(seed)
    stems = ["an", "er", "th", "in", "on", "re", "st", "le", "ch", "ou", "ti", "ea"]
    some = ["".join(random.choice(stems, random.integers(1, 5))) for _ in range(pool)]
    return " ".join(random.choice(some, words))


def hard_rows() -> list[tuple]:
    """Nulls, empty and white texts, a very long one, copies, near copies, repeated rows, ties, scripts."""
    base, long = prose(1, 120), prose(2, 40_000, 3000)
    near = " ".join(w if k != 60 else "changed" for k, w in enumerate(base.split()))
    texts = [
        (1, None, None), (2, "", "a"), (3, " \t\n", "a"), (4, base, "a"), (5, base.replace(" ", "\n\t", 5), "b"),
        (6, near, None), (7, long, "a"), (8, long + " tail", "b"), (9, base, "a"), (9, base, "a"), (9, "other text here", ""),
        (None, base, "c"), (None, "quite alone", None), (10, "one", "c"), (11, "One", "c"), (12, "x" * 3000, "c"),
        (13, "12 34 -- ##", "c"), (14, "Это русский текст", "c"), (15, "a b c d e " * 50, "c"), (16, prose(3, 300), "a"),
        (17, prose(4, 60) + "\n" + prose(1, 70) + "\n" + prose(5, 40), "b"),
    ]
    lang = {14: "ru"}
    return [(i, t, lang.get(i, "en"), s, None, True, "big", "high", 1, 2) for i, t, s in texts]


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def normal(text: str | None) -> str:
    return re.sub(SPACE, " ", text or "")


def copies(rows: list[tuple]) -> dict[str, tuple]:
    """For each normalised text: the id that stays, how many there are, digest."""
    groups = defaultdict(list)
    for r in ordered(rows):
        groups[normal(r[1])].append(r[0])
    return {t: (ids[0], len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items()}


def counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    hit = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    fails = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), fails


def shingles(text: str | None) -> set:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def near_components(rows: list[tuple]) -> list[tuple]:
    """doc_id, size of the set, smallest id reachable, in the order of the rows."""
    sets, top = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(k: int) -> int:
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                top[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root(k)] = min(r[0], least.get(root(k), r[0]))
    return [(r[0], len(sets[k]), least.get(root(k))) for k, r in enumerate(rows)]


def without_repeats(texts: list[bytes], length: int) -> list[tuple]:
    """Bytes, removed bytes, runs and digest of what stays, of each text in order."""
    seen, out = set(), []
    for raw in texts:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(raw[k : k + length])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shares(sizes: dict, cap: float = 3.0) -> dict:
    """Targets of sources by sharing, cutting and sharing again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target
