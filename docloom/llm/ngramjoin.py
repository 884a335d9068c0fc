"""N-gram Jaccard join over signature trees.

Sets meet in blocks: two sets of the wanted similarity share one of the first tokens of
each, in an order common to all.  Within a block a signature tree holds OR-combined token
bitmaps and size ranges; a dual traversal drops node pairs whose largest possible overlap
is too small, and what is left is compared exactly.

Every link between different sets is found and counted once, in the block of the smallest
token the two have in common.  Only counts per set leave a block, so a group of near copies
costs rows by its sets, not by its links.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import (
    in_sieve,
    mix64,
    sieve,
    space_words,
    staged,
    sweep,
    text_mark,
    text_or_empty,
    unstage,
    without,
    word_hashes,
)
from docloom.llm.components import components
from docloom.session import settings

WORDS = 5
# Links have 100 * intersection >= 80 * union: the overlap is at least 4 (n + m) / 9.
HOT_SHARE = 2000
HOT_TOKENS = 200_000
FANOUT = 16
PAGE = 1024
TOKEN_BITS = 1.5
MAX_BITS = 1 << 13
PAGE_BYTES = 16 << 20
OWNED_PARTS = 4
MAP_WORDS = 1 << 23
_ODD = np.random.default_rng(21).integers(1, 1 << 63, WORDS + 3, dtype=np.uint64) | np.uint64(1)


# --- Sets -------------------------------------------------------------------------------


def shingle_set(data: bytes, member: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; fewer words are one, none are none."""
    w = word_hashes(data, member)
    n = w.size
    if not n:
        return w
    if n < WORDS:
        return mix64((w * _ODD[:n]).sum(keepdims=True) + _ODD[WORDS] * np.array([n], np.uint64))
    total = np.zeros(n - WORDS + 1, np.uint64)
    for i in range(WORDS):
        total += w[i : n - WORDS + 1 + i] * _ODD[i]
    return np.unique(mix64(total))


def digest(s: np.ndarray) -> tuple[int, bytes]:
    """The set's 64-bit key and its 128-bit name, which starts with the key."""
    one = int(mix64(s ^ _ODD[6]).sum(dtype=np.uint64))
    two = int(mix64(s ^ _ODD[7]).sum(dtype=np.uint64))
    return one - (1 << 64) * (one >> 63), one.to_bytes(8, "big") + two.to_bytes(8, "big")


def signature(s: np.ndarray) -> bytes:
    """Bitmap of the tokens' low bits, a power of two wide: ``TOKEN_BITS`` to twice as many per token.

    Two sets without common tokens share under half of their bits at that; more width would
    rule out few pairs more, and the bitmaps are most of what the groups move.
    """
    width = 64
    while width < TOKEN_BITS * s.size and width < MAX_BITS:
        width *= 2
    bits = np.zeros(width, bool)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def prefix(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The first tokens, frequent ones last: a partner of the wanted similarity has one too."""
    n = s.size
    size = n - (4 * n + 4) // 5 + 1
    if hot.size:
        at = np.minimum(np.searchsorted(hot, s), hot.size - 1)
        frequent = hot[at] == s
        if frequent.any():
            s = np.concatenate([s[~frequent], s[frequent]])
    return s[:size]


def _sets(batch_texts, member):
    for value in batch_texts:
        yield shingle_set(value.as_py().encode("utf-8", "surrogatepass"), member)


def profiles(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n, key, node, sig`` per row; and tokens frequent within the batch, once each."""

    def run(batches):
        member = space_words()
        for b in batches:
            n, key, node, sig, every = [], [], [], [], []
            for s in _sets(b.column(1), member):
                k, name = digest(s)
                n.append(s.size)
                key.append(k)
                node.append(name)
                sig.append(signature(s) if s.size else b"")
                every.append(s)
            tokens, times = np.unique(np.concatenate(every), return_counts=True) if every else ([], [])
            keep = np.flatnonzero(np.asarray(times) >= max(4, len(n) // 400))
            some = [None] * len(n)
            often = [None] * len(n)
            if keep.size and n:
                some[0], often[0] = tokens[keep].view(np.int64), times[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(2),
                    pa.array(n, pa.int32()),
                    pa.array(key, pa.int64()),
                    pa.array(node, pa.binary()),
                    pa.array(sig, pa.binary()),
                    pa.array(some, pa.list_(pa.int64())),
                    pa.array(often, pa.list_(pa.int64())),
                ],
                ["doc_id", "mark", "n", "key", "node", "sig", "some", "often"],
            )

    return docs.select("doc_id", text_or_empty().alias("text"), text_mark().alias("mark")).mapInArrow(
        run, "doc_id long, mark long, n int, key long, node binary, sig binary, some array<long>, often array<long>"
    )


def hot_tokens(profile: DataFrame) -> np.ndarray:
    """Tokens of about one set in ``HOT_SHARE`` or more, ``HOT_TOKENS`` of them at most.

    They only decide the order of tokens, so approximate counts do: a batch reports what is
    frequent in it.
    """
    rows = profile.filter("n > 0").count()
    found = (
        profile.filter("some is not null")
        .select(F.explode(F.arrays_zip("some", "often")).alias("t"))
        .groupBy(F.col("t.some").alias("token"))
        .agg(F.sum("t.often").alias("times"))
        .filter(F.col("times") >= max(8, rows // HOT_SHARE))
        .orderBy(F.desc("times"), "token")
        .limit(HOT_TOKENS)
    )
    return np.sort(np.array([r.token for r in found.collect()], np.int64).view(np.uint64))


def prefix_tokens(docs: DataFrame, hot) -> DataFrame:
    """``token, key`` of every set's first tokens, equal sets of one task once."""

    def run(batches):
        member, seen = space_words(), set()
        for b in batches:
            tokens, keys, sizes = [], [], []
            for s in _sets(b.column(0), member):
                if not s.size:
                    continue
                k, _ = digest(s)
                if k in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(k)
                p = prefix(s, hot.value)
                tokens.append(p)
                keys.append(k)
                sizes.append(p.size)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.repeat(np.array(keys, np.int64), sizes)),
                    ],
                    ["token", "key"],
                )

    return docs.select(text_or_empty().alias("text")).mapInArrow(run, "token long, key long")


def shared_tokens(tokens: DataFrame) -> DataFrame:
    """``token, key`` once each, of tokens that several sets have: one shuffle by token.

    In rows sorted by token and key, those of one token lie together; while only one key of
    it has come, a single row waits.
    """

    def run(batches):
        last = np.zeros((2, 0), np.int64)  # the newest row, and whether it is out already
        out = True
        for b in batches:
            token, key = (np.concatenate([last[i], b.column(i).to_numpy()]) for i in (0, 1))
            fresh = np.ones(token.size, bool)
            fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
            waited = bool(last.size)
            at = np.flatnonzero(fresh)
            token, key = token[at], key[at]
            same = token[1:] == token[:-1]
            keep = np.zeros(token.size, bool)
            keep[1:] |= same
            keep[:-1] |= same
            told = bool(keep[-1]) if token.size else False
            if waited and token.size == 1:
                told = out
            if waited and out:
                keep[0] = False  # handed out with its batch
                told = told or token.size == 1
            last, out = np.array([token[-1:], key[-1:]]), told
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(key[keep])], ["token", "key"])

    dealt = tokens.repartition("token").sortWithinPartitions("token", "key")
    return dealt.mapInArrow(run, "token long, key long")


# --- Exact comparison -------------------------------------------------------------------


def linked_sets(a: np.ndarray, b: np.ndarray) -> bool:
    if 5 * min(a.size, b.size) < 4 * max(a.size, b.size):
        return False
    small, large = (a, b) if a.size <= b.size else (b, a)
    at = np.minimum(np.searchsorted(large, small), large.size - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= 80 * (a.size + b.size - both)


def sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, hot=None) -> DataFrame:
    """``node, tokens`` for ``nodes (node)``; with ``hot`` the first tokens only.

    The sets are made again from the texts of the classes' first documents; a sieve of
    their ids keeps most other rows out of the shuffle.
    """
    needed = staged(nodes.distinct().join(classes.select("node", "rep"), "node"), "jaccard-needed")
    held = docs.sparkSession.sparkContext.broadcast(sieve(F.xxhash64("rep"), needed))

    def run(batches):
        member = space_words()
        for b in batches:
            keep = in_sieve(held.value, b.column(1).to_numpy(zero_copy_only=False))
            names, sets = [], []
            for s in _sets(b.column(0).filter(pa.array(keep)), member):
                if s.size:
                    names.append(digest(s)[1])
                    sets.append((s if hot is None else prefix(s, hot.value)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(sets, pa.binary())], ["node", "tokens"]
            )

    made = docs.select(text_or_empty().alias("text"), F.xxhash64("doc_id").alias("h")).mapInArrow(
        run, "node binary, tokens binary"
    )
    return made.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"])


def shared_bits(sets: list[np.ndarray]) -> np.ndarray | None:
    """A row of bits per set, one for each token that several have; None if that is too large."""
    tokens, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    words = max(1, -(-int((times > 1).sum()) // 64))
    if words * len(sets) > MAP_WORDS:
        return None
    column = np.cumsum(times > 1) - 1
    keep = times[where] > 1
    rows = np.repeat(np.arange(len(sets)), [s.size for s in sets])[keep]
    cols = column[where[keep]]
    maps = np.zeros((len(sets), words), np.uint64)
    np.bitwise_or.at(maps, (rows, cols >> 6), np.uint64(1) << (cols & 63).astype(np.uint64))
    return maps


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The number of common tokens of each pair."""
    if not i.size:
        return np.zeros(0, np.int64)
    maps = shared_bits(sets)
    if maps is None:
        return np.array([np.intersect1d(sets[x], sets[y], True).size for x, y in zip(i.tolist(), j.tolist())])
    out = np.zeros(i.size, np.int64)
    step = max(1, (1 << 20) // maps.shape[1])
    for s in range(0, i.size, step):
        out[s : s + step] = np.bitwise_count(maps[i[s : s + step]] & maps[j[s : s + step]]).sum(axis=1)
    return out


def owned(token: int, first: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the pairs of a block have no common first token before the block's."""
    return overlaps([p[p.view(np.int64) < token] for p in first], i, j) == 0


def most_common(first: list[np.ndarray], n: np.ndarray, hot: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The largest possible overlap of pairs by their first tokens.

    Up to where the shorter reach of the two ends, in the common order, both sides are known;
    beyond it the one that ends there has only the rest of its tokens.
    """
    last = np.array([p[-1] for p in first], np.uint64)
    at = np.minimum(np.searchsorted(hot, last), max(hot.size - 1, 0))
    frequent = hot[at] == last if hot.size else np.zeros(last.size, bool)
    reach = np.empty(last.size, np.int64)
    reach[np.lexsort((last, frequent))] = np.arange(last.size)
    # Equal ends have equal reach.
    same = np.unique(last, return_inverse=True)[1]
    reach = np.minimum.reduceat(reach[np.argsort(same, kind="stable")], np.searchsorted(np.sort(same), np.arange(same.max() + 1)))[same]
    rest = n - np.array([p.size for p in first], np.int64)
    beyond = np.where(
        reach[i] == reach[j], np.minimum(rest[i], rest[j]), np.where(reach[i] < reach[j], rest[i], rest[j])
    )
    return overlaps(first, i, j) + beyond


def owned_links(token: int, sets: list[np.ndarray], hot: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Those of the pairs of a block that link and that the block owns."""
    own = owned(token, [prefix(s, hot) for s in sets], i, j)
    i, j = i[own], j[own]
    n = np.array([s.size for s in sets], np.int64)
    both = overlaps(sets, i, j)
    links = 100 * both >= 80 * (n[i] + n[j] - both)
    return i[links], j[links]


def least_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index each of ``n`` is connected with by the pairs."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


# --- Signature trees --------------------------------------------------------------------


def fold(sig: bytes, width: int) -> np.ndarray:
    """A bitmap at a smaller width: the low bits of its tokens."""
    return np.bitwise_or.reduce(np.frombuffer(sig, np.uint8).reshape(-1, width // 8), axis=0)


class SignatureTree:
    """Levels of nodes over sets in order of size; level 0 are the sets themselves."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray):
        counts = np.bitwise_count(bitmaps).sum(axis=1)
        self.levels = [(bitmaps, sizes, sizes, counts)]
        while len(self.levels[-1][1]) > FANOUT:
            maps, low, high, least = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, cuts, axis=0),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.minimum.reduceat(least, cuts),
                )
            )

    def pairs(self):
        """Pairs of sets ``i < j`` whose largest possible overlap suffices, with that overlap."""
        top = len(self.levels[-1][1])
        i, j = np.triu_indices(top)
        for depth in range(len(self.levels) - 1, -1, -1):
            keep, best = self._possible(depth, i, j)
            i, j, best = i[keep], j[keep], best[keep]
            if depth == 0:
                apart = i < j
                return i[apart], j[apart], best[apart]
            i, j = self._children(depth - 1, i, j)
        raise AssertionError

    def _possible(self, depth: int, i: np.ndarray, j: np.ndarray):
        maps, low, high, least = self.levels[depth]
        keep, best = np.zeros(len(i), bool), np.zeros(len(i))
        sized = np.flatnonzero((5 * high[i] >= 4 * low[j]) & (5 * high[j] >= 4 * low[i]))
        step = max(1, (1 << 22) // maps.shape[1])
        for s in range(0, len(sized), step):
            at = sized[s : s + step]
            a, b = i[at], j[at]
            shared = np.bitwise_count(maps[a] & maps[b]).sum(axis=1).astype(np.int64)
            # Bits of a set that the other side lacks stand for at least one token each.
            most = np.minimum(
                high[a] - np.maximum(0, least[a].astype(np.int64) - shared),
                high[b] - np.maximum(0, least[b].astype(np.int64) - shared),
            )
            keep[at] = 9 * most >= 4 * (low[a] + low[b])
            best[at] = most
        return keep, best

    def _children(self, depth: int, i: np.ndarray, j: np.ndarray):
        n = len(self.levels[depth][1])
        step = np.arange(FANOUT)
        a = (i[:, None, None] * FANOUT + step[None, :, None]).repeat(FANOUT, axis=2).ravel()
        b = (j[:, None, None] * FANOUT + step[None, None, :]).repeat(FANOUT, axis=1).ravel()
        keep = (a < n) & (b < n) & (a <= b)
        return a[keep], b[keep]


def likely_pairs(sizes, sigs, home):
    """Likely pairs of one block, at least one set at home, with their largest overlap."""
    order = np.argsort(sizes, kind="stable")
    width = 8 * min(len(s) for s in sigs)
    maps = np.array([fold(sigs[k], width) for k in order])
    maps = np.ascontiguousarray(maps).view(np.uint64)
    i, j, best = SignatureTree(sizes[order], maps).pairs()
    i, j = order[i], order[j]
    keep = home[i] | home[j]
    return i[keep], j[keep], best[keep]


def block_cuts(members: DataFrame) -> DataFrame:
    """``token, slot, node, n, home``: blocks ``token, node, n`` cut by size bands.

    Each set also visits the band below its own, where it meets smaller partners.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(1.25))).cast("int")
    placed = members.withColumn("_band", band).withColumn(
        "slot", F.explode(F.array(F.col("_band"), F.col("_band") - 1))
    )
    return placed.select("token", "slot", "node", "n", (F.col("_band") == F.col("slot")).alias("home"))


def open_cuts(placed: DataFrame) -> DataFrame:
    """Rows of the cuts that hold several sets.

    Of cuts with the same members (the tokens of one passage) one is kept.
    """
    member = F.xxhash64("node")
    cuts = (
        placed.groupBy("token", "slot")
        .agg(
            F.count("*").alias("rows"),
            F.count_if("home").alias("at_home"),
            F.min(member).alias("low"),
            F.max(member).alias("high"),
            F.bit_xor(F.xxhash64("node", "home", "n")).alias("one"),
            F.bit_xor(F.xxhash64(F.lit(9), "node", "home", "n")).alias("two"),
        )
        .filter("rows > 1 and at_home > 0 and low != high")
        .groupBy("slot", "rows", "one", "two")
        .agg(F.min("token").alias("token"))
        .select("token", "slot", "rows")
    )
    return placed.join(cuts, ["token", "slot"])


def _dealt(cuts: DataFrame, sigs: DataFrame) -> DataFrame:
    """The rows of ``open_cuts`` with bitmaps, a large cut in pages and each pair of pages a group.

    Only now the bitmaps of ``sigs`` come in.  No task holds more than two pages.
    """
    most = F.col("rows") * F.pow(F.lit(1.25), F.col("slot") + 2) * 8 / PAGE_BYTES
    pages = F.ceil(F.greatest(F.col("rows") / PAGE, most)).cast("int")
    placed = cuts.withColumn("pages", F.least(pages, F.col("rows").cast("int"))).join(sigs.select("node", "sig"), "node")
    page = F.pmod(F.xxhash64("node"), F.col("pages")).cast("int")
    placed = placed.withColumn("page", page).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    placed = placed.select(
        "token",
        "slot",
        F.least("page", "other").alias("one"),
        F.greatest("page", "other").alias("two"),
        "page",
        "node",
        "n",
        "sig",
        "home",
    )
    return placed.repartition(*GROUP).sortWithinPartitions(*GROUP)


GROUP = ["token", "slot", "one", "two"]


def _across(pages: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Pairs inside a page belong to its own group, others to the group of their two pages."""
    return (pages[i] != pages[j]) if (pages != pages[0]).any() else np.ones(i.size, bool)


def paired_sets(cuts: DataFrame, sigs: DataFrame) -> DataFrame:
    """``token, slot, one, two, page, node, home``: the sets with a likely partner in their group."""

    def run(batches):
        for rows in _groups(batches, len(GROUP)):
            pages = rows.column("page").to_numpy()
            i, j, _ = likely_pairs(
                rows.column("n").to_numpy().astype(np.int64),
                rows.column("sig").to_pylist(),
                rows.column("home").to_numpy(zero_copy_only=False),
            )
            keep = _across(pages, i, j)
            at = np.unique(np.concatenate([i[keep], j[keep]]))
            if at.size:
                out = rows.select([*GROUP, "page", "node", "home"]).take(pa.array(at)).combine_chunks()
                yield from out.to_batches()

    form = "token long, slot int, one int, two int, page int, node binary, home boolean"
    return _dealt(cuts, sigs).mapInArrow(run, form)


def owned_sets(paired: DataFrame, classes: DataFrame, firsts: DataFrame, hot) -> DataFrame:
    """The rows of ``paired`` whose group owns a likely pair of theirs.

    First tokens, a fifth of a set, decide that: near copies meet in many groups, one of which
    owns the pair, and only there the whole sets are needed.  They also bound the overlap.
    """
    firsts = firsts.select("node", F.col("tokens").alias("first"))
    placed = paired.join(classes.select("node", "n", "sig"), "node").join(firsts, "node")

    def run(batches):
        for rows in _groups(batches, len(GROUP)):
            pages = rows.column("page").to_numpy()
            first = [np.frombuffer(t, np.uint64) for t in rows.column("first").to_pylist()]
            n = rows.column("n").to_numpy().astype(np.int64)
            home = rows.column("home").to_numpy(zero_copy_only=False)
            i, j, _ = likely_pairs(n, rows.column("sig").to_pylist(), home)
            keep = _across(pages, i, j)
            i, j = i[keep], j[keep]
            keep = 9 * most_common(first, n, hot.value, i, j) >= 4 * (n[i] + n[j])
            i, j = i[keep], j[keep]
            keep = owned(rows.column("token")[0].as_py(), first, i, j)
            at = np.unique(np.concatenate([i[keep], j[keep]]))
            if at.size:
                out = rows.select([*GROUP, "page", "node", "home"]).take(pa.array(at)).combine_chunks()
                yield from out.to_batches()

    dealt = placed.select(*GROUP, "page", "node", "n", "sig", "first", "home").repartition(*GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInArrow(run, "token long, slot int, one int, two int, page int, node binary, home boolean")


def count_in_groups(paired: DataFrame, sets: DataFrame, hot) -> DataFrame:
    """``node, root, links``: a set's links that its group owns, and the least set they lead to there."""
    placed = paired.join(sets, "node").select(*GROUP, "page", "home", "node", "tokens")

    def run(batches):
        for rows in _groups(batches, len(GROUP)):
            node = rows.column("node").to_pylist()
            pages = rows.column("page").to_numpy()
            home = rows.column("home").to_numpy(zero_copy_only=False)
            tokens = [np.frombuffer(t, np.uint64) for t in rows.column("tokens").to_pylist()]
            n = np.array([t.size for t in tokens], np.int64)
            i, j, _ = likely_pairs(n, [signature(t) for t in tokens], home)
            keep = _across(pages, i, j)
            i, j = owned_links(rows.column("token")[0].as_py(), tokens, hot.value, i[keep], j[keep])
            if i.size:
                links = np.bincount(np.concatenate([i, j]), minlength=len(node))
                root = least_reached(len(node), i, j)
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node[k] for k in at], pa.binary()),
                        pa.array([node[k] for k in root[at]], pa.binary()),
                        pa.array(links[at], pa.int64()),
                    ],
                    ["node", "root", "links"],
                )

    dealt = placed.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInArrow(run, "node binary, root binary, links long")


def _groups(batches, n_keys: int):
    """Tables of the rows that share the first columns, from batches sorted by them."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t]).combine_chunks()
        if not t.num_rows:
            continue
        keys = np.stack([t.column(i).to_numpy().astype(np.int64) for i in range(n_keys)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        start = 0
        for cut in cuts.tolist():
            yield t.slice(start, cut - start)
            start = cut
        held = t.slice(start)
    if held is not None and held.num_rows:
        yield held


# --- The join ---------------------------------------------------------------------------


def _labelled(classes: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """The classes with the root of their component; a class without links is its own."""
    roots = components(links, label)
    return classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def jaccard_join(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, class_links, mark`` for every row of ``docs``.

    Rows with equal sets form a class, named by its smallest id; ``class_links`` counts the
    other classes that the class links with, all of them.  A text
    without words, or null, has the empty set and links with nothing, not even its like:
    its component is its own id.  Repeated rows of an id each keep their row, in the
    component of their text; a null id has a row, and names no component unless no other
    id is there.  Further columns are ignored.
    """
    profile = staged(profiles(docs), "jaccard-profiles")
    classes = staged(
        profile.filter("n > 0")
        .groupBy("key", "node")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "jaccard-classes",
    )
    links = find_links(docs, profile, classes)
    edges = links.select(F.col("root").alias("a"), F.col("node").alias("b"))
    labelled = staged(_labelled(classes, edges, "jaccard-roots").select("node", "root", "rep"), "jaccard-labels")
    names = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    degree = links.groupBy("node").agg(F.sum("links").alias("class_links"))
    per = labelled.join(names, "root").join(degree, "node", "left").select(
        "node", "component_id", F.col("rep").alias("class_id"), F.coalesce("class_links", F.lit(0)).alias("class_links")
    )
    rows = profile.select("doc_id", "mark", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    return rows.join(per, "node", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("class_links", F.lit(0)).alias("class_links"),
        "mark",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest id of every component only, all columns and empty texts kept.

    Rows of one id are one document, and stay or go together if their texts are equal.
    """
    found = jaccard_join(docs.select("doc_id", "text"))
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "mark")
    return without(docs, gone)


def find_links(docs: DataFrame, profile: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, root, links``: for each class, the numbers of its links add up to all it has.

    ``root`` is a class of the same component; together they connect every component.
    """
    hot = docs.sparkSession.sparkContext.broadcast(hot_tokens(profile))
    sweep(docs.sparkSession)
    blocks = staged(shared_tokens(prefix_tokens(docs, hot)), "jaccard-blocks")
    sweep(docs.sparkSession)
    members = blocks.join(classes.select("key", "node", "n"), "key").select("token", "node", "n")
    # Members move by token once; their two bands are made, counted and met with the counts there.
    with settings(docs.sparkSession, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        cuts = staged(open_cuts(block_cuts(members.repartition("token"))), "jaccard-cuts")
    unstage(blocks)
    paired = staged(paired_sets(cuts, classes), "jaccard-paired")
    unstage(cuts)
    firsts = staged(sets_of(docs, classes, paired.select("node"), hot), "jaccard-firsts")
    part = F.pmod(F.xxhash64(*GROUP), F.lit(OWNED_PARTS))
    owns = []
    for k in range(OWNED_PARTS):  # whole groups, a part's first tokens on disk at a time
        owns.append(staged(owned_sets(paired.where(part == k), classes, firsts, hot), "jaccard-owned"))
        sweep(docs.sparkSession)
    own = functools.reduce(DataFrame.unionAll, owns)
    unstage(paired, firsts)
    sets = staged(sets_of(docs, classes, own.select("node")), "jaccard-sets")
    links = staged(count_in_groups(own, sets, hot), "jaccard-links")
    unstage(*owns, sets)
    return links
