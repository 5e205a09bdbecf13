"""Brute-force versions of the operators, and documents with every odd case."""

from __future__ import annotations

import random
import re

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def shingles(text, words):
    w = WORDS.findall((text or "").encode().translate(LOWER))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def jaccard_components(docs, words, percent):
    sets = {k: shingles(t, words) for k, t in docs.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {k: len(s) for k, s in sets.items()}, components(sets, links)


def repeated_bytes(docs, length=100):
    """Per document, whether each byte is in a string that starts earlier."""
    seen, out = set(), {}
    for k in sorted(docs):
        b = (docs[k] or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = [True] * length
            seen.add(s)
        out[k] = (b, gone)
    return out


def prose(rnd: random.Random, words: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


def odd_documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, score, kept) rows: copies, near
    copies, shared passages, null, empty and very long texts, a null source."""
    rnd = random.Random(seed)
    base = [prose(rnd, 120) for _ in range(6)]
    passage = prose(rnd, 60)
    texts = [None, "", " \n\t", "one two", "One  TWO", "x" * 350, "ab" * 400, "é漢" * 90, prose(rnd, 30_000, 90_000)]
    texts += base + base[:3]
    for b in base[:4]:
        for _ in range(4):
            w = b.split(" ")
            w[rnd.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    for _ in range(5):
        texts.append(f"{prose(rnd, 20)}\n{passage} {prose(rnd, 20)}")
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 3, t, "en", [None, "a", "b", "ü"][i % 4], len(t or ""), float(i), "extra"))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"
