"""Plain definitions that the operators are held against."""

import hashlib

import numpy as np
import xxhash


def components(nodes, links):
    """Node to the smallest node it reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def cosine_links(rows, threshold):
    """Index pairs of (vec_id, embedding, label) rows that link."""
    out = []
    good = []
    for _, vector, label in rows:
        ok = label is not None and bool(vector) and all(x is not None and np.isfinite(x) for x in vector)
        good.append(ok and any(x != 0 for x in vector))
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = rows[i], rows[j]
            if good[i] and good[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    out.append((i, j))
    return out


def simhash(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def fingerprint_links(prints, radius=2):
    values = np.array(prints, np.uint64)
    out = []
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= radius)
        out += [(i, i + 1 + int(j)) for j in near]
    return out


def line_words(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).encode().split()


def removed_lines(docs, threshold=0.8, least=1):
    """Places of lines like an earlier one; docs are (doc_id, text)."""
    lines = []
    for doc_id, text in docs:
        for number, line in enumerate((text or "").split("\n")):
            words = line_words(line)
            if len(words) >= least:
                lines.append(((doc_id, number), frozenset(words)))
    lines.sort(key=lambda x: x[0])
    gone = set()
    for i, (place, words) in enumerate(lines):
        for earlier, other in lines[:i]:
            if min(len(words), len(other)) < threshold * max(len(words), len(other)) - 1e-9 or earlier == place:
                continue
            shared = len(words & other)
            if shared >= threshold * (len(words) + len(other) - shared) - 1e-9:
                gone.add(place)
                break
    return gone


def chat_digest(turns):
    """Of (role, text) turns: count, digest of all, characters and digest of what is learnt."""
    whole = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    learnt = "".join(text or "" for role, text in turns if role == "assistant")
    return (
        len(turns),
        hashlib.sha256(whole.encode()).hexdigest(),
        len(learnt),
        hashlib.sha256(learnt.encode()).hexdigest(),
    )
