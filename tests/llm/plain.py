"""The corpus operators once more, in plain Python over small lists."""

import re
from collections import defaultdict

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def order(number):
    return (number is None, number if number is not None else 0)


def line_dedup(rows):
    """``{(doc_id, text): (lines, removed, text)}`` of ``[(doc_id, text)]``. Texts with
    the same id must be equal."""
    seen, out = {}, {}
    windows = defaultdict(list)
    split = {}
    for number, text in rows:
        lines = (text or "").split("\n")
        places = [i for i, line in enumerate(lines) if WORDS.search(line)]
        split[number, text] = lines, places
    for number, text in sorted(split, key=lambda k: order(k[0])):
        lines, places = split[number, text]
        for j in range(len(places) - 2):
            windows[tuple(lines[p] for p in places[j : j + 3])].append((number, text, j))
    gone = defaultdict(set)
    for occurrences in windows.values():
        for number, text, j in occurrences[1:]:
            gone[number, text] |= {j, j + 1, j + 2}
    for key, (lines, places) in split.items():
        removed = {places[j] for j in gone[key]}
        left = "\n".join(line for i, line in enumerate(lines) if i not in removed)
        out[key] = len(lines), len(removed), left
    return out


def shingles(text, words):
    found = WORDS.findall((text or "").translate(AZ))
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(zip(*(found[k:] for k in range(words)), strict=False))


def near_duplicates(rows, words, percent):
    """``{(doc_id, text): (size, component_id)}``."""
    sets = {(i, t): shingles(t, words) for i, t in rows}
    by_set = defaultdict(list)
    for (i, _), s in sets.items():
        if s:
            by_set[s].append(i)
    kinds = list(by_set)
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(kinds)):
        for b in range(a):
            if len(kinds[a] & kinds[b]) * 100 >= percent * len(kinds[a] | kinds[b]):
                parent[find(a)] = find(b)
    smallest = {}
    for k, s in enumerate(kinds):
        known = [i for i in by_set[s] if i is not None] + [smallest.get(find(k))]
        smallest[find(k)] = min((i for i in known if i is not None), default=None)
    where = {s: smallest[find(k)] for k, s in enumerate(kinds)}
    return {k: (len(s), where[s] if s else k[0]) for k, s in sets.items()}


def contamination(rows, items, window=10):
    """``{(doc_id, text): (words, hit, sorted item ids as text)}``."""
    windows = defaultdict(set)
    for item, text in items:
        words = ITEM_WORDS.findall((text or "").translate(AZ))
        for k in range(max(len(words) - window + 1, 1)):
            if words:
                windows[tuple(words[k : k + window])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for number, text in rows:
        words = ITEM_WORDS.findall((text or "").translate(AZ))
        hit, found = set(), set()
        for size in lengths:
            for k in range(len(words) - size + 1):
                ids = windows.get(tuple(words[k : k + size]))
                if ids:
                    found |= ids
                    hit |= set(range(k, k + size))
        out[number, text] = len(words), len(hit), sorted(found)
    return out
