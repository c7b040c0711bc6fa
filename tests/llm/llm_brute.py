"""Brute-force versions that several tests compare with."""

import hashlib
import re

_ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _ITEM_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def decontam_brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        k = min(window, len(w))
        for i in range(len(w) - k + 1):
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def line_weight(line):
    unspaced = sum("\u0e00" <= c <= "\u0eff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "\u3040" <= c <= "\u30ff" or "\u3400" <= c <= "\u9fff" or "\uf900" <= c <= "\ufaff" for c in line)
    return len(line.split()) + unspaced // 2


def line_brute(docs, min_words):
    """Texts after removal, by the longest run from each line that begins earlier, too."""
    keys = sorted({(d is None, d or 0, t) for d, t in docs if t is not None}, key=lambda k: k[:2])
    lines = [k[2].split("\n") for k in keys]
    starts = {}
    for a, own in enumerate(lines):
        for i, line in enumerate(own):
            starts.setdefault(line, []).append((a, i))
    out = {}
    for a, own in enumerate(lines):
        gone = [False] * len(own)
        for i in range(len(own)):
            best = 0
            for b, j in starts[own[i]]:
                if (b, j) >= (a, i):
                    break
                n = 0
                while i + n < len(own) and j + n < len(lines[b]) and own[i + n] == lines[b][j + n]:
                    n += 1
                best = max(best, n)
            if best and sum(line_weight(x) for x in own[i : i + best]) >= min_words:
                gone[i : i + best] = [True] * best
        out[keys[a]] = ("\n".join(x for x, g in zip(own, gone) if not g), sum(gone))
    return sorted(((d, *(out[(d is None, d or 0, t)] if t is not None else (None, 0))) for d, t in docs), key=repr)


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def minhash_brute(docs, percent):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for h in holders.values() for i in h for j in h if i < j}
    for i, j in pairs:
        (a, s), (b, t) = sets[i], sets[j]
        if a is not None and b is not None and 100 * len(s & t) >= percent * len(s | t):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return sorted(((d, len(s), root(d) if d is not None else None, d is None or root(d) == d) for d, s in sets), key=repr)
