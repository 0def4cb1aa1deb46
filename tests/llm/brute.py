"""What the operators must return, computed the plain way."""

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def fold(word):
    """Lower case of the accented Latin capitals too."""
    return "".join(chr(ord(c) + 32) if "À" <= c <= "Þ" and c != "×" else c for c in word)


def shingles(text):
    w = tuple(map(fold, words(text)))
    return {w[n : n + 5] for n in range(max(len(w) - 4, 1))} if w else set()


def classes(rows, threshold=0.8):
    """(doc_id, class_id, n_links, n_copies) of rows (doc_id, text) with distinct ids."""
    by_words = defaultdict(list)
    for doc_id, text in rows:
        by_words[tuple(map(fold, words(text)))].append(doc_id)
    alone = by_words.pop((), [])
    nodes = list(by_words)
    sets = [shingles(" ".join(n)) for n in nodes]
    holders = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            holders[x].append(n)
    root, links = list(range(len(nodes))), [0] * len(nodes)

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for n, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for m in holders[x]:
                if m < n:
                    shared[m] += 1
        for m, k in shared.items():
            if k >= threshold * (len(s) + len(sets[m]) - k) - 1e-9:
                links[n] += 1
                links[m] += 1
                root[find(n)] = find(m)
    members = defaultdict(list)
    for n in range(len(nodes)):
        members[find(n)] += by_words[nodes[n]]
    out = [(i, i, 0, 1) for i in alone]
    for n, node in enumerate(nodes):
        out += [(i, min(members[find(n)]), links[n], len(by_words[node])) for i in by_words[node]]
    return sorted(out)
