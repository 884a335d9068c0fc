"""Plain restatements of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import public_tokenizers

UP = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def lower(text: str) -> str:
    return text.translate(UP)


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard_components(docs: list[tuple]) -> dict:
    """doc_id -> (n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    for d, s in sets.items():
        for e in set().union(*[holders[x] for x in s]) if s else ():
            if e > d and 100 * len(s & sets[e]) >= 80 * len(s | sets[e]):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def contamination(docs: list[tuple], items: list[tuple]) -> dict:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t or ""))
        size = min(10, len(w))
        for k in range(len(w) - size + 1) if size else ():
            windows[tuple(w[k : k + size])].add(str(i))
    sizes = sorted({len(w) for w in windows})
    out = {}
    for d, t in docs:
        w = word.findall(lower(t or ""))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                ids = windows.get(tuple(w[k : k + size]))
                if ids:
                    found |= ids
                    hit.update(range(k, k + size))
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def lines(docs: list[tuple]) -> dict:
    strip = "\x20\x09\x0a\x0b\x0c\x0d"
    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            key = lower(line.strip(strip))
            if len(key) >= 20:
                holders[key].add(d)
    out = {}
    for d, t in docs:
        split = (t or "").split("\n")
        kept = []
        for line in split:
            at = holders.get(lower(line.strip(strip)), ())
            if len(at) < 3 or d == max(at):
                kept.append(line)
        out[d] = (len(split), len(split) - len(kept), sha("\n".join(kept)))
    return out


def secrets(docs: list[tuple]) -> dict:
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
    ]
    out = {}
    for d, t in docs:
        counts, spans = [], []
        for k, (name, pattern, group, least) in enumerate(kinds):
            hits = [m for m in pattern.finditer(t or "") if len(m[group]) >= least]
            counts.append(len(hits))
            spans += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in hits]
        out[d] = (*counts, sha(",".join(s for *_, s in sorted(spans))))
    return out


def piece_counts(docs: list[tuple]) -> dict:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return {d: (len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in docs}


def bpe(docs: list[tuple]) -> dict:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.no_truncation()
    tok.no_padding()
    out = {}
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out[d] = (len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))
    return out


def nearest(rows: list[tuple], k: int = 20) -> dict:
    """query -> [(vec_id, score)] by exact search."""
    import numpy as np

    usable = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    ids = np.array([i for i, _ in usable])
    x = np.array([v for _, v in usable])
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(s[j])) for j in order]
    return out
