"""SimHash near-duplicates through an LSH forest.

A document's SimHash has 64 bits a word of ``WORDS``: each is the majority, over its distinct tokens, of that bit of their
hashes. Documents with equal sets of tokens are one node. The forest holds several tries, each over its own random permutation of
the bits: within a trie, nodes are sorted by permuted SimHash, so that a prefix is a run. The prefix depth adapts to the density, to
leave about ``bucket`` nodes a run; the number of tries follows from it, so that nodes ``design`` bits apart meet at
that depth with the target recall. Where a run holds far more nodes (``CROWD`` times ``bucket``), it is climbed from long prefixes:
nodes within ``TIGHT`` bits of another are represented by it at the shorter ones. What is still too crowded at the depth
gets a forest of its own, deeper and with the more tries that this depth asks for; so the depth follows the local density.

All nodes of a run are compared. Of the pairs within ``radius`` bits, which may be quadratic in a group of near copies, a
sparse part is handed on: each node with the first of the group it falls to, with its nearest ones there, and with the
nearest one of every other group that it touches. So a link that fails the verification isn't the only one that a node has.
Candidates are verified by the Jaccard similarity of their whole token sets. Nodes with pairs that weren't handed on, or that another
one represented, are walked again in the same tries: all their pairs within ``radius`` whose nodes the verified links don't join yet
are handed on then. So the classes are those of all pairs that meet, while pairs within a class needn't all be compared.
Connected documents form a class.

``radius`` and ``design`` are bits of 64. Sets with a Jaccard of 0.7 lie 12.3 of 64 bits apart on average, with a deviation
of 2.2 in two words; both stand beyond that, so that such pairs, not only closer ones, are found at any size. Sets are
kept as 32-bit hashes of tokens, so a Jaccard can be off by a share of about the number of tokens in 2**32.

Texts aren't shuffled. Their sets are written once to the shared folder; those of candidates are read from there by place.

Documents are ordered by id, null ids last, then a hash of the text, then their place; the first of a class is kept. Defined
results: null and empty texts, and those of blanks, have no tokens, so are in no class and kept. Every row is a document of
its own: of repeated rows, and of copies without ids, one stays. An empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import AT, FILE, LAST, ROW, attach, finder, lean, located, materialise, unpacked
from paperloom.llm.components import components

#: Words of 64 bits in a SimHash; with one, a radius that holds the pairs of a Jaccard of 0.7 would hold many others.
WORDS = 2
RADIUS = 16
DESIGN = 14
RECALL = 0.9
BUCKET = 2048
JACCARD = 0.7
SEED = 9
#: Nodes of a crowded run, in buckets; bits of 64 within which a node represents another there.
CROWD = 16
TIGHT = 4
#: A node's nearest of its own group that are verified, too.
NEAREST = 3
#: Tries of one pass, whose shuffle is on disk at once.
PASS = 32
#: The longest prefix of a forest; runs that share it are compared however crowded they are.
DEEPEST = 60
#: Text handled at once, in bytes; pairs compared at once.
SLICE = 1 << 20
CELLS = 1 << 18
#: Stands for another node with one that has pairs beside its links.
REST = -1
FP = [f"fp{w}" for w in range(WORDS)]
TURN = np.uint64(1 << 63)


def _lanes() -> np.ndarray:
    """For each byte, eight lanes of eight bits that hold its bits."""
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).reshape(256, 8).copy().view(np.uint64).reshape(256)


BLANK = np.arange(256, dtype=np.uint8)
BLANK[[9, 10, 13]] = 32


def _blanks(texts: pa.Array) -> pa.Array:
    """Large strings with tabs and line ends as blanks."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(BLANK[data]))


def simhashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First word of the SimHash and number of distinct tokens of each text (0 for null)."""
    fps, counts, *_ = signatures(texts, 1)
    return fps[:, 0].view(np.int64), counts


def signatures(texts: pa.Array, words_each: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """SimHash, of so many words, and number of distinct tokens of each text (0 for null); a hash of its set of tokens; and the
    32-bit hashes of the tokens of all texts, one text behind the other."""
    n = len(texts)
    lists = pc.split_pattern(_blanks(pc.fill_null(texts, "").cast(pa.large_string())), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values[offsets[0] : offsets[-1]].cast(pa.large_binary()).dictionary_encode()
    words = flat.dictionary.to_pylist()
    codes = flat.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    keep = np.array([w != b"" for w in words], dtype=bool)
    both = np.unique((doc << 32 | codes)[keep[codes]] if len(codes) else np.zeros(0, np.int64))
    doc, codes = both >> 32, both & 0xFFFFFFFF
    counts = np.bincount(doc, minlength=n)
    fps, sets = np.zeros((n, words_each), np.uint64), np.zeros(n, np.uint64)
    if not len(both):
        return fps, counts, sets, np.zeros(0, np.int32)
    # a lane holds up to 255: sum short stretches in lanes, then these in full
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    cuts = np.unique(np.concatenate([starts[counts > 0], *[np.arange(s, s + c, 255) for s, c in zip(starts[counts > 255], counts[counts > 255], strict=True)]]).astype(np.int64))
    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words]), ">u8").astype(np.uint64).reshape(-1, WORDS)
    for k in range(words_each):
        hashes = np.ascontiguousarray(digests[:, k])
        if k == 0:
            tokens = hashes.astype(np.uint32).view(np.int32)[codes]
            # a set's hash is a sum: its order doesn't count
            mixed = (hashes ^ hashes >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
            sets[counts > 0] = np.add.reduceat((mixed ^ mixed >> np.uint64(29))[codes], starts[counts > 0])
        lanes = _lanes()[hashes.view(np.uint8).reshape(-1, 8)][codes]
        sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(-1, 64).astype(np.int64)
        ones = np.zeros((n, 64), np.int64)
        np.add.at(ones, doc[cuts], sums)
        bits = (ones * 2 > counts[:, None]).astype(np.uint8)
        fps[:, k] = np.ascontiguousarray(np.packbits(bits, axis=1)).view(">u8").astype(np.uint64).reshape(n)
    return fps, counts, sets, tokens


def _columns(fps: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(fps[:, k]).view(np.int64)) for k in range(fps.shape[1])]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = ["id", "h", FILE, AT]
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            # from SLICE bytes on, at least one row
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE)))
            part = batch.slice(at, to - at)
            fps, n, sets, tokens = signatures(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(tokens))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *_columns(fps), pa.array(sets.view(np.int64)), pa.array(n.astype(np.int32)), lists], [*own, *FP, "s", "n", "tokens"])
            at = to


def _sign_known(find):
    """Signs, of documents in their earlier state, those that have a place now, under what they are now (h, __file, __at). One step
    looks them up and signs them: two would be two Python processes a task."""

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            now = find(batch.column(FILE), batch.column(AT))
            some = pc.is_valid(now)
            now, batch = now.filter(some), batch.filter(some)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pc.struct_field(now, c) for c in ("h", FILE, AT)), batch.column("text")], ["id", "h", FILE, AT, "text"])

    return lambda batches: _sign(known(batches))


SIGNED = f"id bigint, h bigint, {FILE} bigint, {AT} bigint, {', '.join(f'{c} bigint' for c in FP)}, s bigint, n int, tokens array<int>"


def _texts(docs: DataFrame) -> DataFrame:
    """(id, h, __file, __at, text) of every row."""
    text = F.col(f"{ROW}.text")
    return located(docs).select(F.coalesce(F.col(f"{ROW}.doc_id").cast("bigint"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("h"), FILE, AT, text.alias("text"))


def _signed_before(docs: DataFrame, before: DataFrame) -> DataFrame:
    """The rows of docs, signed; and where an id stands once in both and has another text in ``before``, once more with that."""
    here, there = _texts(docs), _texts(before)
    once = lambda df, s: df.where(F.col("id") != LAST).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h", FILE, AT)).alias(s)).where("n = 1").select("id", s)
    both = materialise(once(here, "a").join(once(there, "b"), "id").where("a.h != b.h").select("a", "b"), "texts-before")
    find = finder(both.select(F.col(f"b.{FILE}").alias("file"), F.col(f"b.{AT}").alias("at"), F.col("a").alias("value")))
    return here.mapInArrow(lean(_sign), SIGNED).unionByName(there.mapInArrow(lean(_sign_known(find)), SIGNED))


def signed(docs: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(id, h, __file, __at, fp0, ..., s, n, tokens) of documents that have tokens, written to the shared folder; with
    ``before``, of either state of a document."""
    rows = _texts(docs).mapInArrow(lean(_sign), SIGNED) if before is None else _signed_before(docs, before)
    return materialise(rows.where("n > 0"), "simhash")


def meet(depth: int, apart: int, bits: int = 64) -> float:
    """Chance that two nodes so many bits apart share a prefix of that depth of a random permutation."""
    return math.prod((bits - apart - i) / (bits - i) for i in range(depth)) if depth <= bits - apart else 0.0


def tries(depth: int, design: int = DESIGN, recall: float = RECALL, words: int = 1) -> int:
    """The number of tries that brings the target recall at the depth."""
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - meet(depth, design * words, 64 * words))))


def forest(nodes: int, bucket: int = BUCKET, design: int = DESIGN, recall: float = RECALL, words: int = 1) -> tuple[int, int]:
    """The prefix depth at which a run has about ``bucket`` nodes, and the number of tries."""
    depth = max(4, math.ceil(math.log2(max(nodes, 1) / bucket)) if nodes > bucket else 4)
    return depth, tries(depth, design, recall, words)


def permuted(fps: np.ndarray, tree: int, seed: int = SEED) -> np.ndarray:
    """SimHashes, of one word or of several in rows, with their bits in a trie's order."""
    order = np.random.default_rng([seed, tree]).permutation(64 * (fps.shape[1] if fps.ndim > 1 else 1))
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, len(order) // 8), axis=1)[:, order]
    return np.ascontiguousarray(np.packbits(bits, axis=1)).view(">u8").astype(np.uint64).reshape(fps.shape)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits by which each of a differs from each of b."""
    out = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0])
    for w in range(1, a.shape[1]):
        out += np.bitwise_count(a[:, None, w] ^ b[None, :, w])
    return out


def with_neighbours(keys: np.ndarray, radius: int) -> np.ndarray:
    """The positions of keys that another one lies within the radius of."""
    m = len(keys)
    near = np.zeros(m, dtype=bool)
    step = max(1, CELLS // max(m, 1))
    for s in range(0, m - 1, step):
        hit = distances(keys[s : min(s + step, m)], keys[s + 1 :]) <= radius
        for r in range(1, len(hit)):  # itself, and what was compared before
            hit[r, :r] = False
        if hit.any():
            near[s : s + len(hit)] |= hit.any(axis=1)
            near[s + 1 :] |= hit.any(axis=0)
    return np.flatnonzero(near)


def leaders(keys: np.ndarray, radius: int) -> np.ndarray:
    """For each key the first one within the radius that isn't itself led by another."""
    led = np.full(len(keys), -1)
    for x in range(len(keys)):
        if led[x] < 0:
            led[(distances(keys[x : x + 1], keys)[0] <= radius) & (led < 0)] = x
    return led


def compare(keys: np.ndarray, radius: int, rest: list[np.ndarray] | None = None) -> np.ndarray:
    """Links (i, j), i < j, between keys within the radius: with a group's leader, the nearest of the group, and the nearest of each other group.
    ``rest`` gets the positions of keys that have other pairs within the radius, too."""
    sub = with_neighbours(keys, radius)
    if not len(sub):
        return np.zeros((0, 2), np.int64)
    k = keys[sub]
    led = leaders(k, radius)
    found, pairs = [np.stack([led, np.arange(len(k))], axis=1)], np.zeros(len(k), np.int64)
    step = max(1, CELLS // len(k))
    for s in range(0, len(k), step):
        d = distances(k[s : s + step], k)
        d[np.arange(len(d)), s + np.arange(len(d))] = 255
        x, y = np.nonzero(d <= radius)
        if not len(x):
            continue
        pairs += np.bincount(s + x, minlength=len(k))
        group, d = led[y], d[x, y]
        order = np.lexsort((y, d, group, x))
        x, y, group = x[order], y[order], group[order]
        fresh = np.ones(len(x), dtype=bool)
        fresh[1:] = (x[1:] != x[:-1]) | (group[1:] != group[:-1])
        at = np.arange(len(x))
        rank = at - np.maximum.accumulate(np.where(fresh, at, 0))
        use = rank < np.where(group == led[s + x], NEAREST, 1)
        found.append(np.stack([s + x[use], y[use]], axis=1))
    links = np.sort(np.concatenate(found), axis=1)
    links = np.unique(links[links[:, 0] != links[:, 1]], axis=0)
    if rest is not None:
        rest.append(sub[pairs > np.bincount(links.ravel(), minlength=len(k))])
    return sub[links]


def across(keys: np.ndarray, groups: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """All links (i, j) between keys of different groups within the radius, a part at a time."""
    order = np.argsort(groups, kind="stable")
    k, ends = keys[order], np.searchsorted(groups[order], groups[order], side="right")
    s = 0
    while s < len(k) and (first := int(ends[s])) < len(k):
        step = max(1, CELLS // (len(k) - first))
        x, y = np.nonzero(distances(k[s : s + step], k[first:]) <= radius)
        x, y = x + s, y + first
        use = y >= ends[x]
        if use.any():
            yield order[np.stack([x[use], y[use]], axis=1)]
        s += step


def _runs(keys: np.ndarray, of: np.ndarray, depth: int) -> list[np.ndarray]:
    """Positions of sorted keys, split where the prefix of the depth changes."""
    return np.split(of, np.flatnonzero(np.diff(keys[of, 0] >> np.uint64(64 - depth))) + 1)


def climb(keys: np.ndarray, depth: int, radius: int, crowd: int, tight: int, rest: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of one trie between sorted keys that share a prefix of the depth, and the positions of those that are too crowded there.
    ``rest`` gets the positions of keys of which not all pairs within the radius are among the links."""
    links, crowded = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
    for run in _runs(keys, np.arange(len(keys)), depth):
        if len(run) > crowd and depth < DEEPEST:
            alive = run
            for at in range(DEEPEST, depth, -4):
                left = []
                for part in _runs(keys, alive, at):
                    parts = np.array_split(part, -(-len(part) // crowd)) if at == DEEPEST else [part]
                    for p in parts:
                        if 1 < len(p) <= crowd:
                            led = leaders(keys[p], tight)
                            links.append(np.stack([p[led], p], axis=1)[led != np.arange(len(p))])
                            p = p[np.unique(led)]
                        left.append(p)
                alive = np.concatenate(left)
            if len(alive) > crowd:  # all go on, those that are represented here, too
                crowded.append(run)
                continue
            if rest is not None and len(alive) < len(run):
                rest.append(run)
            run = alive
        if len(run) > 1:
            left: list[np.ndarray] = []
            links.append(run[compare(keys[run], radius, left)])
            if rest is not None:
                rest += [run[x] for x in left]
    return np.concatenate(links), np.concatenate(crowded)


def _spread(trees: range, own: tuple[str, ...] = ("node",)):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in FP], axis=1)
            for t in trees:
                # the order of signed numbers is that of unsigned ones with the first bit turned
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), t, np.int32)), *_columns(permuted(fps, t) ^ TURN), *(batch.column(c) for c in own)], ["tree", *FP, *own])

    return spread


def _links(a: np.ndarray, b: np.ndarray, crowded: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, crowded])), pa.concat_arrays([pa.array(b), pa.nulls(len(crowded), pa.int64())])], ["a", "b"])


def _first(depth: int, radius: int, crowd: int, tight: int):
    """Links of a trie; with null, nodes that are too crowded; with ``REST``, nodes that have other pairs, too."""

    def out(keys: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []
        links, crowded = climb(keys, depth, radius, crowd, tight, rest)
        left = np.unique(np.concatenate([np.zeros(0, np.int64), *rest]))
        nodes = own[:, 0]
        yield _links(nodes[np.concatenate([links[:, 0], left])], np.concatenate([nodes[links[:, 1]], np.full(len(left), REST)]), nodes[crowded])

    return out


def _second(depth: int, radius: int):
    """Links of a trie between nodes with different roots."""

    def out(keys: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        for run in _runs(keys, np.arange(len(keys)), depth):
            for links in across(keys[run], own[run, 1], radius):
                yield _links(own[run[links[:, 0]], 0], own[run[links[:, 1]], 0], run[:0])

    return out


def _walk(depth: int, out, own: tuple[str, ...] = ("node",), hold: int = 1 << 18):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, nodes = -1, np.zeros((0, WORDS), np.uint64), np.zeros((0, len(own)), np.int64)
        for batch in batches:
            trees, ids = batch.column("tree").to_numpy(), np.stack([batch.column(c).to_numpy() for c in own], axis=1)
            now = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in FP], axis=1) ^ TURN
            cuts = [0, *(np.nonzero(np.diff(trees))[0] + 1).tolist(), len(trees)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if trees[s] != tree and len(keys):
                    yield from out(keys, nodes)
                    keys, nodes = keys[:0], nodes[:0]
                tree = int(trees[s])
                keys, nodes = np.concatenate([keys, now[s:e]]), np.concatenate([nodes, ids[s:e]])
                if len(keys) > hold:  # all but the last run, which may go on
                    last = int(np.searchsorted(keys[:, 0] >> np.uint64(64 - depth), keys[-1, 0] >> np.uint64(64 - depth)))
                    if last:
                        yield from out(keys[:last], nodes[:last])
                        keys, nodes = keys[last:], nodes[last:]
        if len(keys):
            yield from out(keys, nodes)

    return walk


def _passes(rows: DataFrame, tries: range, depth: int, out, own: tuple[str, ...] = ("node",)) -> list[DataFrame]:
    """What the tries give, with so many at once that their shuffle is bounded."""
    passes = []
    columns = ", ".join(f"{c} bigint" for c in (*FP, *own))
    for first in range(tries.start, tries.stop, PASS):
        some = range(first, min(first + PASS, tries.stop))
        spread = rows.mapInArrow(lean(_spread(some, own)), f"tree int, {columns}")
        spread = spread.repartition("tree", F.shiftright(FP[0], 64 - depth)).sortWithinPartitions("tree", *FP)
        passes.append(materialise(spread.mapInArrow(lean(_walk(depth, out, own)), "a bigint, b bigint").distinct(), "simhash-links"))
    return passes


def _all(frames: list[DataFrame]) -> DataFrame:
    found = frames[0]
    for f in frames[1:]:
        found = found.unionByName(f)
    return found


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("b >= 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def candidates(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, design: int = DESIGN, recall: float = RECALL) -> tuple[DataFrame, list[tuple[range, int, DataFrame]]]:
    """(a, b), a < b: links between nodes (node, fp0, ...) within the radius, found by the forest; and for each depth of it, its tries, itself,
    and the nodes (node) that have other pairs there."""
    rows = nodes.select("node", *FP)
    depth, trees = forest(rows.count(), bucket, design, recall, WORDS)
    begun, found, rest = 0, [], []
    while True:
        passes = _passes(rows, range(begun, begun + trees), depth, _first(depth, radius * WORDS, CROWD * bucket, TIGHT * WORDS))
        found += passes
        rest.append((range(begun, begun + trees), depth, _all(passes).where(F.col("b") == REST).select(F.col("a").alias("node")).distinct()))
        again = _all(passes).where("b IS NULL").select("a")
        if depth >= DEEPEST or again.isEmpty():
            break
        begun, depth = begun + trees, min(DEEPEST, depth + 4)
        trees = tries(depth, design, recall, WORDS)
        rows = materialise(nodes.join(again.distinct().withColumnRenamed("a", "node"), "node", "left_semi").select("node", *FP), "simhash-crowded")
    return _ordered(_all(found)), rest


def candidate_links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, design: int = DESIGN, recall: float = RECALL) -> DataFrame:
    """The links of ``candidates``."""
    return candidates(nodes, radius, bucket, design, recall)[0]


def rest_links(nodes: DataFrame, roots: DataFrame, rest: list[tuple[range, int, DataFrame]], radius: int = RADIUS) -> DataFrame | None:
    """(a, b), a < b: of the pairs within the radius that met and aren't links of ``candidates``, all whose nodes have different
    roots (node, root; a node without is its own). None if there are none."""
    own, found = ("node", "root"), []
    for trees, depth, left in rest:
        rows = nodes.join(left, "node", "left_semi").join(roots, "node", "left").select("node", *FP, F.coalesce("root", "node").alias("root"))
        rows = materialise(rows, "simhash-rest")
        if not rows.isEmpty():
            found += _passes(rows, trees, depth, _second(depth, radius * WORDS), own)
    found = [p for p in found if not p.isEmpty()]
    return _ordered(_all(found)) if found else None


def verify(links: DataFrame, nodes: DataFrame, prints: DataFrame, jaccard: float) -> DataFrame:
    """The links (a, b) between nodes whose sets are alike. Sets are read by place."""
    place = prints.metadataColumn("_metadata")
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("set").alias(f"set_{s}"))
    # sets whose sizes differ too much can't be alike
    fit = F.least("n_a", "n_b") >= F.lit(jaccard) * F.greatest("n_a", "n_b")
    pairs = materialise(links.join(side("a"), "a").join(side("b"), "b").where(fit), "simhash-pairs")
    wanted = pairs.select(F.explode(F.array(F.struct(F.col("set_a").alias("set"), F.col("a").alias("value")), F.struct(F.col("set_b").alias("set"), F.col("b").alias("value")))).alias("w")).select("w.set.file", "w.set.at", "w.value").distinct()
    sets = attach(prints.select("tokens", F.xxhash64(place["file_path"]).alias(FILE), place["row_index"].alias(AT)), wanted, "node").where("node IS NOT NULL")
    sets = materialise(sets.select("node", "tokens"), "simhash-sets")
    with_sets = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
    common = F.size(F.array_intersect("ta", "tb"))
    alike = with_sets.where(common >= F.lit(jaccard) * (F.size("ta") + F.size("tb") - common)).select("a", "b")
    return materialise(alike, "simhash-verified")


def classes(docs: DataFrame, radius: int = RADIUS, jaccard: float = JACCARD, bucket: int = BUCKET, design: int = DESIGN, recall: float = RECALL, before: DataFrame | None = None) -> DataFrame:
    """(id, h, __file, __at, keep_id, keep_h, keep_file, keep_at, links): every document of a class of two or more, the one that
    stays, and the number of verified links to other sets of tokens (of pairs within a class, not all are compared). ``before``: documents in an earlier state, whose texts count,
    beside those of now, where they have an id that stands once in both: documents alike in either state are linked."""
    prints = signed(docs, before)
    place = prints.metadataColumn("_metadata")
    key, own = ["s", *FP], ["id", "h", FILE, AT]
    nodes = prints.select(*key, "n", F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("at")).alias("set"))
    # the id of a node is written, so it stays
    nodes = materialise(nodes.groupBy(*key).agg(F.min("set").alias("set"), F.first("n").alias("n")).withColumn("node", F.monotonically_increasing_id()), "simhash-nodes")
    links, rest = candidates(nodes, radius, bucket, design, recall)
    verified = verify(links, nodes, prints, jaccard)
    states = prints.select(*own, *key).join(nodes.select(*key, "node"), key).select(*own, "node")
    states = materialise(states if before is None else states.distinct(), "simhash-states")
    joined = verified
    if before is not None:  # the two states of a document are of one class
        pairs = states.groupBy(*own).agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("a", "b")
        pairs = materialise(pairs, "simhash-same")
        joined = verified.unionByName(pairs)
    roots = components(joined)
    if (more := rest_links(nodes, roots, rest, radius)) is not None:
        more = verify(more.join(links, ["a", "b"], "left_anti"), nodes, prints, jaccard)
        if not more.isEmpty():
            verified = verified.unionByName(more)
            roots = components(joined.unionByName(more))
    degree = verified.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    each = states.join(roots, "node", "left").join(degree, "node", "left").select(*own, F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
    if before is not None:
        each = each.groupBy(*own).agg(F.min("root").alias("root"), F.sum("links").alias("links"))
    each = materialise(each, "simhash-classes")
    whole = each.groupBy("root").agg(F.min(F.struct(*own)).alias("keep"), F.count(F.lit(1)).alias("size")).where("size > 1")
    out = each.join(whole, "root")
    return out.select(*own, F.col("keep.id").alias("keep_id"), F.col("keep.h").alias("keep_h"), F.col(f"keep.{FILE}").alias("keep_file"), F.col(f"keep.{AT}").alias("keep_at"), "links")


def duplicates(docs: DataFrame, **options) -> DataFrame:
    """Of ``classes``, the documents that go."""
    return classes(docs, **options).where((F.col("keep_file") != F.col(FILE)) | (F.col("keep_at") != F.col(AT)))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """Documents but for those that ``duplicates`` names, with their columns as they came."""
    from paperloom.llm.common import _is_scan

    docs = docs if _is_scan(docs) else materialise(docs, "rows")
    gone = duplicates(docs, **options).select(F.col(FILE).alias("file"), F.col(AT).alias("at"), F.lit(True).alias("value"))
    return unpacked(attach(located(docs), gone, "__gone").where("__gone IS NULL"), docs.columns)
