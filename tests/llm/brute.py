"""Plain versions of the operators, to hold them against."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import regex

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BLANK = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def runs(flags):
    out, start = [], None
    for i, f in enumerate([*flags, False]):
        if f and start is None:
            start = i
        elif not f and start is not None:
            out.append((start, i))
            start = None
    return out


def cut_bytes(docs, length=100):
    """docs: (doc_id, text).  (n_bytes, n_removed, n_spans, sha) by doc_id; rows of one id are the same text."""
    seen, out = {}, {}
    for d, t in sorted({(d, t or "") for d, t in docs if d is not None}):
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen.setdefault(b[s : s + length], (d, s)) < (d, s):
                gone[s : s + length] = b"\1" * length
        out[d] = (len(b), sum(gone), len(runs(gone)), sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def cut_words(docs, length=13):
    seen, out = {}, {}
    for d, t in sorted({(d, t or "") for d, t in docs if d is not None}):
        w = BLANK.findall(t.encode())
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if seen.setdefault(tuple(w[s : s + length]), d) < d:
                gone[s : s + length] = [True] * length
        out[d] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def shingles(text, n):
    w = BLANK.findall((text or "").encode().translate(LOWER))
    return frozenset(zip(*[w[i:] for i in range(n)])) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near(docs, n, percent=80):
    """component by doc_id, comparing all pairs."""
    sets = defaultdict(set)
    for d, t in docs:
        if d is not None:
            sets[d].add(shingles(t, n))
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def leaks(docs, items, n=10):
    """(n_words, n_hit, n_items, sha, contaminated) of each row."""
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").encode().translate(LOWER))
        for s in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[s : s + n])].add(str(i))
    lengths, out = {len(k) for k in windows}, []
    for _, t in docs:
        w = ALNUM.findall((t or "").encode().translate(LOWER))
        hit, found = set(), set()
        for m in lengths:
            for s in range(len(w) - m + 1):
                if tuple(w[s : s + m]) in windows:
                    hit.update(range(s, s + m))
                    found |= windows[tuple(w[s : s + m])]
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


KINDS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda v: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda v: 12 <= len(re.sub("[^0-9]", "", v)) <= 19 and luhn(re.sub("[^0-9]", "", v))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
]


def personal(text):
    """kind:start:end of the base spans, in order."""
    found = sorted((m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(KINDS) if k != "email" or "@" in (text or "") for m in p.finditer(text or "") if ok(m.group()))
    return [f"{k}:{a}:{b}" for a, _, b, k in found]


def entities(text):
    """(level, entity) of a text's base spans."""
    out = set()
    for a, n, b in sorted((m.start(), n, m.end()) for n, (k, p, ok) in enumerate(KINDS) if k != "email" or "@" in text for m in p.finditer(text) if ok(m.group())):
        v = text[a:b].lower()
        digits = re.sub("[^0-9]", "", v)
        value = v if n < 2 else digits
        group = (v.rpartition("@")[2], ".".join(v.split(".")[:3]), digits[:6], digits[:4])[n]
        out |= {(0, (n, value)), (1, (n, group)), (2, (n,))}
    return out


def clues(docs, support=2, threshold=0.9, prior=(0, 1, 1)):
    """{term: disclosure} by text, from (doc_id, text)."""
    terms, held = {}, {}
    for t in {t or "" for _, t in docs}:
        terms[t], held[t] = set(x.lower() for x in regex.findall(r"\p{L}{3,}", t)), entities(t)
    copies = Counter(t or "" for _, t in docs)
    n_term, n_entity, both, texts = Counter(), Counter(), Counter(), Counter()
    for t, c in copies.items():
        n_term.update({x: c for x in terms[t]})
        n_entity.update({e: c for e in held[t]})
        for e in held[t]:
            both.update({(e, x): c for x in terms[t]})
            texts.update((e, x) for x in terms[t])
    n, told = len(docs), defaultdict(dict)
    for (e, x), b in both.items():
        if texts[e, x] >= support and n_entity[e] < n:
            share = math.log(b * n / ((n_term[x] + prior[e[0]]) * n_entity[e])) / math.log(n / n_entity[e])
            if share >= threshold:
                told[e][x] = share
    return {t: {x: max(told[e][x] for e in held[t] if x in told[e]) for x in {x for e in held[t] for x in told[e]} & terms[t]} for t in copies}


def template_lines(docs, lead=3, similar=0.7, min_docs=3, min_chars=20):
    """(doc_id, nth) of the lines to drop."""
    at = []
    for d, t in docs:
        if d is not None and t is not None:
            for i, line in enumerate(t.split("\n")):
                tokens = ["<*>" if re.search("[0-9]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", line)]
                if len(line) >= min_chars and len(" ".join(tokens)) >= min_chars:
                    at.append((d, i, (len(tokens), *tokens[:lead]), tuple(tokens)))
    leaves = defaultdict(lambda: defaultdict(set))
    for d, _, leaf, line in at:
        leaves[leaf][line].add(d)
    template = {}
    for leaf, lines in leaves.items():
        seed = min(lines, key=lambda x: (-len(lines[x]), " ".join(x).encode()))
        for x in lines:
            template[leaf, x] = seed if sum(a == b for a, b in zip(x, seed)) / len(x) >= similar else x
    docs_of = defaultdict(set)
    for d, _, leaf, line in at:
        docs_of[leaf, template[leaf, line]].add(d)
    return {(d, i) for d, i, leaf, line in at if len(docs_of[leaf, template[leaf, line]]) >= min_docs and d != min(docs_of[leaf, template[leaf, line]])}


def cross_parse(text, sample):
    """Phrases of a greedy parse of one block of symbols; a symbol that the sample lacks ends one and is in none."""
    count, phrase = 1, ""
    for c in text:
        if phrase + c in sample:
            phrase += c
        else:
            count, phrase = count + 1, c if c in sample else ""
    return count
