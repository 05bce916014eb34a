"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict
from difflib import SequenceMatcher

import numpy as np

from goldweave.llm import line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def near_components(rows, width=5, percent=75):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for doc_id, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets[doc_id] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    of = {d: d for d in sets}
    again = True
    while again:
        again = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]) and of[a] != of[b]:
                    low, high = sorted((of[a], of[b]))
                    of = {d: low if c == high else c for d, c in of.items()}
                    again = True
    return {d: (len(sets[d]), of[d]) for d in sets}


def repeated_bytes(rows, length=100):
    """doc_id -> (bytes, removed, spans, digest of the rest)."""
    first, out = {}, {}
    texts = {d: (t or "").encode() for d, t in rows}
    for d in sorted(texts):
        for s in range(len(texts[d]) - length + 1):
            first.setdefault(texts[d][s:s + length], (d, s))
    for d, b in texts.items():
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (d, s):
                gone[s:s + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def pieces(text, units):
    """(start, end, words) of each unit in code points, end where the next begins."""
    data = (text or "").encode()
    found = line_dedup.cut(np.frombuffer(data, np.uint8), units)
    starts = [len(data[:k].decode()) for k in found.start.tolist()]
    return list(zip(starts, [*starts[1:], len(text or "")], found.words.tolist()))


def repeated_runs(rows, units=line_dedup.Units()):
    """doc_id -> (text left, spans removed, units removed): units that an
    earlier place holds too, where enough of them follow each other."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        spans, n_units, run = [], 0, []
        for start, end, n in [*pieces(t, units), (None, None, 0)]:
            key = " ".join(WORD.findall(t[start:end].translate(LOWER))) if start is not None else None
            if key is not None and key in seen:
                run.append((start, end, n))
                continue
            seen.add(key)
            if sum(n for _, _, n in run) >= units.min_words:
                spans.append((run[0][0], run[-1][1]))
                n_units += len(run)
            run = []
        edges = [0, *(x for s in spans for x in s), len(t or "")]
        out[d] = ("".join((t or "")[a:b] for a, b in zip(edges[::2], edges[1::2])), spans, n_units)
    return out


def later_runs(rows, least):
    """doc_id -> the runs of `least` words that an earlier document or place holds."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        for line in (t or "").translate(LOWER).split("\n"):
            w = WORD.findall(line)
            for k in range(len(w) - least + 1):
                run = tuple(w[k:k + least])
                if run in seen:
                    out.setdefault(d, []).append(" ".join(run))
                seen.add(run)
    return out


def greedy_cover(text, item, least=5):
    """Tokens of the item that greedy tiles of the text cover."""
    tokens = [re.findall(r"[^\W_]+", x.lower()) for x in (text, item)]
    a, b = ([*t] for t in tokens)
    covered = 0
    while True:
        m = SequenceMatcher(None, a, b, autojunk=False).find_longest_match()
        if m.size < least:
            return covered, len(b)
        covered += m.size
        a[m.a:m.a + m.size] = [f"\0a{covered}_{k}" for k in range(m.size)]
        b[m.b:m.b + m.size] = [f"\0b{covered}_{k}" for k in range(m.size)]


def targets(sizes, weights=(3, 1, 2), percent=150, passes=2):
    """source -> target words; sizes maps sources to their words."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, out = sum(sizes.values()), {}
    open_ = set(names)
    while open_:
        left = total * percent / 100 - sum(out.values())
        share = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / share >= passes * sizes[s]}
        if not above:
            return out | {s: left * weight[s] / share for s in open_}
        out |= {s: float(passes * sizes[s]) for s in above}
        open_ -= above
    return out


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    places = defaultdict(list)
    for k in range(len(w) - 2):
        places[tuple(w[k:k + 3])].append(k)
    inside = {k + j for p in places.values() if len(p) > 1 for k in p for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))
