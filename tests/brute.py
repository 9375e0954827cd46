"""Plain Python versions of the operators, for small inputs."""

from collections import Counter

import regex

from tokenloom.functions.text import PRETOKEN_PATTERN


def split_specials(text, specials):
    if not specials:
        return [text] if text else []
    longest_first = sorted(specials, key=len, reverse=True)
    cut = regex.split("(" + "|".join(regex.escape(s) for s in longest_first) + ")", text)
    return [piece for piece in cut if piece]


def tokens(text, specials=()):
    out = []
    for piece in split_specials(text, list(specials)):
        out += [piece] if piece in specials else regex.findall(PRETOKEN_PATTERN, piece)
    return out


def merge_all(parts, left, right):
    out, i = [], 0
    while i < len(parts):
        if parts[i : i + 2] == [left, right]:
            out.append(left + right)
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def train(texts, n_merges, specials=()):
    counts = Counter(t for text in texts for t in tokens(text, specials) if t not in specials)
    words = [([bytes([b]) for b in w.encode()], n) for w, n in counts.items()]
    merges = []
    for _ in range(n_merges):
        pairs = Counter()
        for parts, n in words:
            for pair in zip(parts, parts[1:]):
                pairs[pair] += n
        if not pairs:
            break
        left, right = max(pairs, key=lambda p: (pairs[p], p))
        merges.append((left, right))
        words = [(merge_all(parts, left, right), n) for parts, n in words]
    return merges


def encode_word(word, merges):
    parts = [bytes([b]) for b in word]
    ranks = {pair: rank for rank, pair in enumerate(merges)}
    while True:
        ranked = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not ranked:
            return parts
        _, i = min(ranked)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def encode(text, ids, merges, specials=()):
    out = []
    for token in tokens(text, specials):
        data = token.encode()
        out += [ids[data]] if token in specials else [ids[p] for p in encode_word(data, merges)]
    return out


def boundaries(texts, n, delimiter):
    data = b"".join(t.encode() + delimiter.encode() for t in texts)
    step, cuts = len(data) // n, {0, len(data)}
    for i in range(1, n):
        at = data.find(delimiter.encode(), i * step)
        cuts.add(len(data) if at < 0 else at)
    return sorted(cuts)
