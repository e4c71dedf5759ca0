"""Plain single-machine versions of the contracts, for comparison."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORDS = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def crc(data):
    return zlib.crc32(data) & 0xFFFFFFFF


def near(docs, k, num, den):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs that share a shingle."""
    sets = []
    for _, text in docs:
        w = WORDS.findall(lower(text))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        shared = Counter()
        for g in s:
            shared.update(holders.setdefault(g, []))
            holders[g].append(i)
        for j, n in shared.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    name = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        name[r] = min(name.get(r, d), d)
    return [(d, len(sets[i]), name[root(i)]) for i, (d, _) in enumerate(docs)]


def language(docs):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    tokens = {d: [*WORDS.findall(lower(t)), ""] for d, t in docs}
    held = {d: crc(str(d).encode()) % 7 == 2 for d in tokens}
    count = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    return {d: (held[d], len(ws), sum(count[w] > 0 for w in ws), n,
                sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)) for d, ws in tokens.items()}


def decontaminated(docs, items, window=13):
    wanted = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wanted.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    sizes = {len(x) for x in wanted}
    out = []
    for d, text in docs:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (g := tuple(w[i:i + size])) in wanted:
                    hit.update(range(i, i + size))
                    found |= wanted[g]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)"""
    spans, text = [], text or ""
    spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*[sum(k == i for _, k, _ in spans) for i in range(3)], hashlib.sha256(listed.encode()).hexdigest())


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeat = {j for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat),
            len(w) < 50 or 100 * len(repeat) > 50 * len(w))


def keeps(text, limits, lines):
    """The verdict of the repetition rules: shares of characters in n-grams
    that repeat an earlier one, and in lines that do."""
    text = text or ""
    w = WORDS.findall(text)
    if quality(text)[-1]:
        return False
    for n, limit in limits.items():
        seen, inside = set(), set()
        for i in range(len(w) - n + 1):
            if (g := tuple(w[i:i + n])) in seen:
                inside.update(range(i, i + n))
            seen.add(g)
        if sum(len(w[i]) for i in inside) > limit * sum(map(len, w)):
            return False
    seen, chars = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            chars += len(line) * (line in seen)
            seen.add(line)
    return chars <= lines * len(text)


def without(text, spans, mark="[secret]"):
    """``text`` with the spans [(start, end)] replaced, overlapping ones as one."""
    merged = []
    for a, b in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in reversed(merged):
        text = text[:a] + mark + text[b:]
    return text


def licence(text):
    """(n_words, n_base, first_word, last_word, base_labels)"""
    w = ALNUM.findall(lower(text))
    places, labels = [], set()
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
                          ("mit license", "mit")):
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def token_ids(docs, path, end=2):
    """doc_id -> ids with the end id, encoded text by text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return {d: [*t.encode(x or "", add_special_tokens=False).ids, end] for d, x in docs}


def ids_crc(ids):
    return crc(b"".join(i.to_bytes(4, "little") for i in ids))
