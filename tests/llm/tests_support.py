"""Brute-force helpers that several tests use."""

import re

import xxhash


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def union(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
