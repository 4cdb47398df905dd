"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_sets(rows, width):
    sets = {}
    for doc, text in rows:
        w = WORDS.findall((text or "").encode().lower())
        runs = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]
        sets[doc] = frozenset(runs or ([tuple(w)] if w else []))
    return sets


def near_components(rows, width, percent):
    """doc -> (size of its set, smallest doc it reaches)."""
    sets, holders, shared = shingle_sets(rows, width), defaultdict(list), Counter()
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)
    for docs in holders.values():
        shared.update(itertools.combinations(sorted(docs), 2))
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places, covered = defaultdict(list), set()
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    for at in places.values():
        if len(at) > 1:
            covered.update(j for i in at for j in range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)
