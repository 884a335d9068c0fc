"""Vector codes, id files and periodic runs against plain restatements."""

from __future__ import annotations

import glob
import hashlib
import random
import zlib
from fractions import Fraction
from math import floor

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string"
CLASHES = "mark n part shard begin start label row runs code error entry spread length value content"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- Vector codes ------------------------------------------------------------------------


def brute_codes(rows: list[tuple], width: int):
    """vec_id, code, error, label_error and the digest, by the rounds as the contract words them."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[floor(1024 * Fraction(x)) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    deep = width // 4
    cut = [[tuple(v[p * deep : (p + 1) * deep]) for v in ints] for p in range(4)]
    books = [c[:256] for c in cut]

    def nearest(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(4):
        for p in range(4):
            own = [nearest(x, books[p])[0] for x in cut[p]]
            for e in range(len(books[p])):
                mine = [x for x, o in zip(cut[p], own) if o == e]
                if mine:
                    books[p][e] = tuple(sum(c) // len(mine) for c in zip(*mine))
    found = [[nearest(x, books[p]) for x in cut[p]] for p in range(4)]
    errors = [sum(found[p][i][1] for p in range(4)) for i in range(len(kept))]
    sums: dict = {}
    for (_, _, label), e in zip(kept, errors):
        sums[label] = sums.get(label, 0) + e
    digest = _sha(",".join(str(x) for b in books for e in b for x in e))
    return sorted(
        ((r[0], "".join(f"{found[p][i][0]:02x}" for p in range(4)), errors[i], sums[r[2]], digest) for i, r in enumerate(kept)), key=repr
    )


def _vectors(n: int, seed: int) -> list[tuple]:
    r = random.Random(seed)
    rows = [(i * 3, [float(np.float32(r.gauss(0, 0.3))) for _ in range(8)], r.choice([None, 0, 1, 1, 1])) for i in range(n)]
    rows += [(1, None, 1), (4, [0.5] * 7 + [None], 1), (7, [float("nan")] * 8, 2), (10, [float("inf")] + [0.0] * 7, 2)]
    rows += [(None, [0.25] * 8, 2), (3, [0.125] * 8, None), (3, [0.125] * 8, None), (3, [-0.125] * 8, 0)]
    rows += [(13, [0.5] * 3, 4), (16, [], 4), (19, [-0.0, -1e-9, 1e-9, 0.0, 1.0, -1.0, 0.999, 2.0], 4)]
    return rows


@pytest.mark.parametrize("n", [300, 12])
def test_vector_codes(spark, n):
    from docloom.llm.vectorcodes import compress

    rows = _vectors(n, 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    df = df.withColumns({c: F.lit(7) for c in CLASHES.split() if c != "label"})
    out = compress(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_codes(rows, 8)


def test_vector_codes_of_large_components(spark):
    """Beyond 32 and 64 bits the distances stay exact; what fits no long is the greatest long."""
    from docloom.llm.vectorcodes import LONG, compress

    rows = [(i, [float(10**k + i)] * 4, 0) for k in (4, 8, 11) for i in range(k * 100, k * 100 + 30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted((tuple(r) for r in compress(df).collect()), key=repr) == brute_codes(rows, 4)
    far = spark.createDataFrame([(i, [1e300 * (-1) ** i] * 4, 0) for i in range(300)] + [(300 + i, [0.0] * 4, 0) for i in range(20)], df.schema)
    assert {r["label_error"] for r in compress(far).collect()} <= {0, LONG}


def test_vector_codes_of_nothing(spark):
    from docloom.llm.vectorcodes import compress

    schema = "vec_id long, embedding array<float>, label int"
    assert compress(spark.createDataFrame([], schema)).count() == 0
    assert compress(spark.createDataFrame([(1, None, 1)], schema)).count() == 0
    only = compress(spark.createDataFrame([(1, [], 1), (2, [], None)], schema)).collect()
    assert {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in only} == {(1, "00000000", 0, 0), (2, "00000000", 0, 0)}


# --- Id files ----------------------------------------------------------------------------


@pytest.mark.parametrize("kind", range(5))
def test_words_round_trip(kind):
    from docloom.llm import idfiles

    r = np.random.default_rng(kind)
    for n in (0, 1, 59, 1023, 1024, 1025, 5000):
        ids = [r.integers(0, 49152, n), r.integers(0, 2, n), np.zeros(n), r.integers(0, 2**63, n), 2.0 ** r.integers(0, 64, n)][kind]
        ids = ids.astype(np.uint64)
        words, starts, odd = idfiles.pack(ids)
        assert (idfiles.unpack(words, starts, odd)[:n] == ids).all() if n else words.size == 0
        assert odd.size == (ids >= 1 << 60).sum()
    if kind == 0:
        assert words.nbytes < 3 * ids.size


def test_any_block_decodes_alone():
    from docloom.llm import idfiles

    ids = np.random.default_rng(1).integers(0, 49152, 700_000).astype(np.uint64)
    ids[::5000] = np.uint64(2**64 - 1)
    shard = idfiles.Shard(3, 4)
    for doc, low, high in [(5, 0, 3), (None, 3, 600_000), (7, 600_000, 600_000), (9, 600_000, 700_000)]:
        shard.add(doc, [ids[low:high]])
    view = idfiles.ShardView(shard.to_bytes() + b"\n")
    assert (view.part, view.number, view.docs) == (3, 4, [5, None, 7, 9])
    for first, last in [(0, 1), (17, 19), (683, 684), (0, 684), (5, 5)]:
        assert (view.blocks(first, last) == ids[first * 1024 : last * 1024]).all()
    for (doc, begin, pieces), want in zip(view.documents(), [ids[:3], ids[3:600_000], ids[:0], ids[600_000:]]):
        assert (np.concatenate([ids[:0], *pieces]) == want).all()
    with pytest.raises(ValueError):
        idfiles.ShardView(b"x" * 100)


def _texts() -> list[tuple]:
    r = random.Random(8)
    words = ["the", "Été", "naïve,", "x1y2", "don't", "“q”", "ß", "…", "\t", "äb", "<|endoftext|>", "ofthhantnd", "\U0001f600"]
    docs = [(r.randrange(10**6), r.choice([" ", "\n", "  "]).join(r.choice(words) for _ in range(r.randint(0, 300)))) for _ in range(150)]
    docs += [(-5, None), (0, ""), (2, " \n\t "), (None, "no id"), (None, None), (77, "twice"), (77, "twice"), (77, "again")]
    return docs + [(10**12, "word " * 250_000), (10**12 + 1, "q" * 20_000), (10**12 + 2, "é1," * 30_000)]


def _library_ids(text: str | None) -> list[int]:
    global _TOKENIZER
    if "_TOKENIZER" not in globals():
        from tokenizers import Tokenizer

        _TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return _TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_token_files(spark, tmp_path, monkeypatch):
    from docloom.llm import idfiles

    docs = _texts()
    df = spark.createDataFrame(docs, DOCS).repartition(3).withColumns({c: F.lit(7) for c in CLASHES.split()})
    path = str(tmp_path / "ids")
    out = [tuple(r) for r in idfiles.token_files(df, path).collect()]
    lists = [(d, _library_ids(t) + [2]) for d, t in docs]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((d, n, c) for d, _, n, c in out if d is not None) == sorted((d, len(i), crc(i)) for d, i in lists if d is not None)
    assert sorted((n, c) for d, _, n, c in out if d is None) == sorted((len(i), crc(i)) for d, i in lists if d is None)
    # In the order of their ids the documents lie behind each other.
    ordered = sorted(out, key=lambda r: r[1])
    at = 0
    for _, start, n, _ in ordered:
        assert start == at
        at += n
    keys = [(d is not None, d or 0) for d, *_ in ordered]
    assert keys == sorted(keys)
    # The files themselves hold the ids, in the order of parts and shards.
    shards = [idfiles.ShardView(open(f, "rb").read()) for f in glob.glob(f"{path}/part-*")]
    shards.sort(key=lambda s: (s.part, s.number))
    whole = np.concatenate([s.blocks(0, s.starts.size) for s in shards])
    assert whole.size == at
    for d, start, n, c in out:
        assert crc(whole[start : start + n]) == c
    ids = {(r["doc_id"], tuple(r["ids"])) for r in idfiles.read_ids(spark, path, ids=True).collect()}
    assert ids == {(d, tuple(i)) for d, i in lists}


def test_token_files_close_shards(spark, tmp_path):
    """Many shards in one part: starts follow their order."""
    from docloom.llm import idfiles

    coder = idfiles.ChunkIds(public_tokenizers.path("word_bpe_49k.json"))
    plain = np.concatenate(list(coder.ids("one two  three\n'll")))
    assert plain.tolist() == _library_ids("one two  three\n'll")
    rows = spark.createDataFrame([(0, s, 10 * (s + 1)) for s in range(12)] + [(2, 0, 5), (1, 0, 7)], "part long, shard long, n_tokens long")
    before = {(r["_part"], r["_shard"]): r["before"] for r in idfiles.shard_starts(rows).collect()}
    assert before[0, 0] == 0 and before[0, 11] == sum(10 * (s + 1) for s in range(11))
    assert before[1, 0] == 780 and before[2, 0] == 787


def test_token_files_of_nothing(spark, tmp_path):
    from docloom.llm.idfiles import token_files

    assert token_files(spark.createDataFrame([], DOCS), str(tmp_path / "none")).count() == 0


# --- Periodic runs -----------------------------------------------------------------------


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size, s = j - i + q, words[i : j + q]
            if size >= max(6, 4 * q) and not any(s[: size - p] == s[p:] for p in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda x: (x[0], x[2]))


def _row(doc, text, plant=True):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc).encode())
    if plant and doc is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + size for s, size, q in runs)]
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc, len(runs), *tail, _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), _sha(" ".join(kept))


def test_runs_of_random_words():
    from docloom.llm.runs import find_runs

    r = random.Random(3)
    for _ in range(400):
        docs = []
        for _ in range(r.randint(1, 6)):
            n, letters = r.choice([0, 1, 5, 6, 20, 60, 200, r.randint(0, 400)]), r.choice([1, 2, 3, 50])
            w = [r.randrange(letters) for _ in range(n)]
            for _ in range(r.choice([0, 0, 1, 4]) if n > 10 else 0):
                p, s = r.randint(1, max(1, n // 5)), r.randrange(n)
                root = [r.randrange(letters + 1) for _ in range(p)]
                root = root[: max(1, p // 3)] * 3 if r.random() < 0.3 else root
                size = min(r.randint(p, 8 * p), n - s)
                w[s : s + size] = [root[i % len(root)] for i in range(size)]
            docs.append(w)
        assert find_runs([np.array(w, np.int64) for w in docs]) == [brute_runs(w) for w in docs]


def test_runs_of_long_texts():
    from docloom.llm.runs import find_runs

    n = 300_000
    words = np.random.default_rng(1).integers(0, 5000, n)
    words[1000:201_000] = words[1000 + np.arange(200_000) % 43_210]
    words[250_000:250_600] = words[250_000 + np.arange(600) % 17]
    runs = find_runs([np.zeros(n, np.int64), words, np.arange(n)])
    assert runs[0] == [(0, n, 1)] and runs[2] == []
    assert [(q, n // q) for _, n, q in runs[1]] == [(43_210, 4), (17, 35)]


def test_periodic_runs(spark):
    from docloom.llm.runs import periodic_runs

    r = random.Random(6)
    docs = [(i, " ".join(r.choice("a b c dd".split()) for _ in range(r.randint(0, 150)))) for i in range(120)]
    docs += [(1000, None), (1001, ""), (1002, " \t\n "), (None, "a b " * 9), (None, None), (1003, "x " * 6), (1003, "x " * 6)]
    docs += [(1004, "a\x0bb\x0ca\rb a b a b"), (1005, "é é é é é é É"), (1006, "  " * 7 + "  " * 5), (1007, "a a a a a a b b b b b b")]
    df = spark.createDataFrame(docs, DOCS).repartition(3).withColumns({c: F.lit(7) for c in CLASHES.split()})
    out = periodic_runs(df, plant=True, outputs=False)
    assert out.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert sorted((tuple(x) for x in out.collect()), key=repr) == sorted((_row(*d) for d in docs), key=repr)
    full = periodic_runs(df).filter("doc_id = 1007").first()
    assert [tuple(x) for x in full["runs"]] == [(0, 6, 1), (6, 6, 1)] and full["collapsed"] == "a b" and full["start"] == 0
    assert periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
