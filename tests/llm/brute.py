"""Plain Python versions of the operators, for small tables."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    w = words(lower(text or ""))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard_links(sets, percent):
    """Pairs of keys with 100 * intersection >= percent * union, by an inverted index."""
    index, links = defaultdict(list), []
    for key in sorted(sets):
        common = defaultdict(int)
        for item in sets[key]:
            for other in index[item]:
                common[other] += 1
            index[item].append(key)
        links += [(other, key) for other, n in common.items() if 100 * n >= percent * (len(sets[key]) + len(sets[other]) - n)]
    return links


def near_duplicates(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    component = union_find(list(sets), jaccard_links(sets, percent))
    return {i: (len(sets[i]), component[i]) for i in sets}


def line_key(line):
    return " ".join(words(lower(line)))


def dedup_lines(texts, families, percent):
    """Remaining text of each document; families as (shingle size, over, most characters)."""
    first, links = {}, set()
    for doc in sorted(d for d in texts if texts[d] is not None):
        for number, line in enumerate(texts[doc].split("\n")):
            if words(line):
                key = line_key(line)
                first.setdefault(key, (doc, number))
    for size, over, most in families:
        sets = {key: {key[i:i + size] for i in range(max(1, len(key) - size + 1))} for key in first if over < len(key) <= most}
        links |= set(jaccard_links(sets, percent))
    component = union_find(list(first), links)
    keeper = {}
    for key, at in first.items():
        keeper[component[key]] = min(at, keeper.get(component[key], at))
    out = {}
    for doc, text in texts.items():
        out[doc] = None if text is None else "\n".join(
            line for n, line in enumerate(text.split("\n")) if not words(line) or keeper[component[line_key(line)]] == (doc, n))
    return out


def targets(sizes, epochs=3):
    """Water filling by the words of the contract: cap, share the excess again, repeat."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: epochs * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in full and target[s] > epochs * sizes[s]}
        if not above:
            return target
        full |= above
