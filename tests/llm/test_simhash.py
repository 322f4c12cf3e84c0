import itertools
import math
import random

import numpy as np
import pyarrow as pa
import xxhash

from paperloom.llm import components, simhash
from tests.llm.util import DOCS, docs, odd


def _naive(text):
    ones = np.zeros(64)
    words = set((text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")) - {""}
    for w in words:
        h = int.from_bytes(xxhash.xxh3_128_digest(w.encode())[:8])
        ones += [h >> (8 * (k // 8)) >> (7 - k % 8) & 1 for k in range(64)]
    return sum(int(o * 2 > len(words)) << (63 - k) for k, o in enumerate(ones)), len(words)


def test_simhash_against_a_naive_one():
    r = random.Random(2)
    texts = [None, "", " \n", "one", *(" ".join(r.choices("abcdefghijklmnop", k=r.randint(1, 30))) for _ in range(40)), " ".join(f"w{i}" for i in range(3000))]
    fp, n = simhash.simhashes(pa.array(texts))
    for i, t in enumerate(texts):
        want, words = _naive(t)
        assert n[i] == words and (words == 0 or int(fp[i]) & (2**64 - 1) == want)


def _corpus(seed, originals=150, words=120):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefghilmnorstu", k=r.randint(3, 9))) for _ in range(4000)]
    table, group = [], {}
    for i in range(originals):
        ws = r.choices(vocabulary, k=r.randint(words // 3, words * 2))
        for _ in range(1 + (r.randint(1, 4) if i % 3 == 0 else 0)):
            near = [r.choice(vocabulary) if r.random() < 0.04 else w for w in ws]
            group[len(table)] = i
            table.append((len(table), " ".join(near), "en", "a"))
    order = list(range(len(table)))
    r.shuffle(order)
    return [(order[i], t, lang, s) for i, t, lang, s in table], {order[i]: g for i, g in group.items()}


def brute(table):
    """Pairs within the radius whose token sets are alike."""
    fp = simhash.simhashes(pa.array([t[1] for t in table]))[0].view(np.uint64)
    sets = [set(t[1].split()) for t in table]
    return {
        tuple(sorted((table[i][0], table[j][0])))
        for i, j in itertools.combinations(range(len(table)), 2)
        if (int(fp[i]) ^ int(fp[j])).bit_count() <= simhash.RADIUS and len(sets[i] & sets[j]) >= simhash.JACCARD * len(sets[i] | sets[j])
    }


def _groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_sets_and_their_hashes():
    texts = ["a b c", None, "c\tb\n\na a", "", "a b d"]
    _, n, sets, tokens = simhash.signatures(pa.array(texts))
    assert n.tolist() == [3, 0, 3, 0, 3] and sets[0] == sets[2] != sets[4]
    assert set(tokens[:3].tolist()) == set(tokens[3:6].tolist()) and len(set(tokens[:3].tolist()) & set(tokens[6:].tolist())) == 2


def test_recall_and_precision_against_brute_force(spark):
    table, truth = _corpus(7)
    pairs = brute(table)
    ids = [t[0] for t in table]
    want = _groups(pairs, ids)
    for options in ({}, {"bucket": 4}):
        got = {r["id"]: r["keep_id"] for r in simhash.duplicates(docs(spark, table), **options).collect()}
        group = {i: got.get(i, i) for i in ids}
        together = sum(group[a] == group[b] for a, b in pairs)
        assert len(pairs) > 100 and together >= (0.95 if options else 1) * len(pairs)
        # two words of SimHash find some pairs more than one
        assert all(truth[i] == truth[k] for i, k in got.items()) and sum(want[i] != want[k] for i, k in got.items()) <= 0.05 * len(got)


def _meeting(fps, trees, *climbing):
    """The pairs of SimHashes that the tries link, and those left as too crowded."""
    met, left = set(), set()
    for t in range(trees):
        keys = simhash.permuted(fps, t)
        order = np.lexsort(keys.T[::-1])
        links, crowded = simhash.climb(keys[order], *climbing)
        met |= {frozenset(p) for p in order[links].tolist()}
        left |= set(order[crowded].tolist())
    return met, left


def test_forest_recall_at_several_depths():
    r = np.random.default_rng(4)
    base = r.integers(0, 2**63, (3000, 2)).astype(np.uint64)
    other = []
    for i in range(600):
        flip = np.zeros(128, np.uint8)
        flip[r.choice(128, 2 * simhash.DESIGN, replace=False)] = 1
        other.append(base[i] ^ np.packbits(flip).view(">u8").astype(np.uint64))
    fps = np.concatenate([base, other])
    for nodes in (3600, 100_000, 10**7):
        depth, trees = simhash.forest(nodes, words=2)
        met, left = _meeting(fps, trees, depth, 2 * simhash.RADIUS, 10**6, 2 * simhash.TIGHT)
        found = sum(frozenset((i, 3000 + i)) in met for i in range(600))
        assert found >= 0.87 * 600 and not left, (nodes, depth, trees, found)


def test_a_link_that_may_fail_is_not_the_only_one():
    keys = np.array([[0], [2**6 - 1], [2**12 - 1]], np.uint64)
    assert simhash.climb(keys, 16, 8, 100, 2)[0].tolist() == [[0, 1], [1, 2]]


def _bits(r, center, n, width, flips):
    return np.unique([center ^ np.uint64(sum(1 << int(b) for b in r.choice(width, flips))) for _ in range(n)])[:, None]


def test_links_join_what_all_pairs_join():
    r = np.random.default_rng(6)
    keys = np.concatenate([_bits(r, np.uint64(c), 60, 40, 9) for c in r.integers(0, 2**24, 6)])
    keys = keys[np.argsort(keys[:, 0])]
    pairs = {(i, j) for i, j in itertools.combinations(range(len(keys)), 2) if int(keys[i, 0] ^ keys[j, 0]).bit_count() <= 9}
    links = set(map(tuple, simhash.compare(keys, 9).tolist()))
    assert links <= pairs and _groups(links, range(len(keys))) == _groups(pairs, range(len(keys)))
    # and so they do where a third of them fails
    sound = {p for p in pairs if hash(p) % 3}
    assert len(set(_groups(links & sound, range(len(keys))).values())) <= len(set(_groups(sound, range(len(keys))).values())) * 1.1 + 1


def test_a_dense_run_is_joined_without_all_pairs():
    r = np.random.default_rng(1)
    near = _bits(r, np.uint64(r.integers(0, 2**63)), 4000, 30, 3)
    for crowd in (10**6, 500):  # whole, and climbed
        links, crowded = simhash.climb(near, 16, simhash.RADIUS, crowd, simhash.TIGHT)
        assert len(links) < 8 * len(near) and not len(crowded)
        assert len(set(_groups(links.tolist(), range(len(near))).values())) == 1


def test_crowds_get_a_deeper_forest(spark, monkeypatch):
    """Unlike nodes with a long prefix in common; pairs among them are found as elsewhere."""
    monkeypatch.setattr(simhash, "CROWD", 2)
    r = np.random.default_rng(5)
    fps = r.integers(0, 2**63, (1200, 2)).astype(np.uint64)
    fps[:, 0] &= np.uint64(0xFFFF)  # 48 bits alike
    fps[600:] = fps[:600] ^ np.array([0b111, 0b1110000], np.uint64)
    nodes = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(fps.tolist())], "node bigint, fp0 bigint, fp1 bigint")
    links = {(x["a"], x["b"]) for x in simhash.candidate_links(nodes, radius=8, design=6, bucket=32).collect()}
    assert sum((i, 600 + i) in links for i in range(600)) >= 0.9 * 600


def test_thousands_of_copies_and_one_stays(spark):
    text = " ".join(f"word{k}" for k in range(80))
    table = [(i, text if i % 2 else text + f" copy{i}", "en", "a") for i in range(3000)] + [(5000, "something that is quite different from all the others here", "en", "a")]
    assert sorted(r["doc_id"] for r in simhash.near_dedup(docs(spark, table)).collect()) == [0, 5000]


def test_one_of_repeated_rows_and_of_copies_without_ids_stays(spark):
    text = "a text of some words that stands here again and again"
    table = [(None, text, "en", "a"), (None, text, "en", "a"), (7, "something else of several other words", "en", "a"), (7, "something else of several other words", "en", "a"), (None, "and a text that is on its own in this table", "en", "a"), (None, None, "en", "a"), (None, None, "en", "a")]
    out = sorted(str((r["doc_id"], r["text"])) for r in simhash.near_dedup(docs(spark, table)).collect())
    assert out == sorted(str(table[i][:2]) for i in (0, 2, 4, 5, 6))


def test_texts_of_an_earlier_state(spark):
    """Fragments are held by the texts that they had; ids that stand twice, or nowhere, by their own."""
    long = " ".join(f"word{k}" for k in range(60))
    before = [(1, long, "en", "a"), (2, long + " more", "en", "a"), (3, long + " three", "en", "a"), (3, "twice", "en", "a")]
    now = [(1, long, "en", "a"), (2, "more", "en", "a"), (3, "a fragment of three", "en", "a"), (4, "only here", "en", "a"), (None, "only here", "en", "a")]
    assert sorted(r["doc_id"] for r in simhash.near_dedup(docs(spark, now), before=docs(spark, before)).collect()) == [1, 3, 4]


def test_odd_rows_and_empty_table(spark):
    table = odd(spark)
    out = simhash.near_dedup(table)
    assert out.columns == table.columns
    want = list(map(str, table.collect()))
    want.remove(next(r for r in want if "the same row twice" in r))
    assert sorted(map(str, out.collect())) == sorted(want)
    assert simhash.near_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(400, 460)]
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = _groups(edges, {n for e in edges for n in e})
    assert got == {n: k for n, k in want.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_recall_of_pairs_by_jaccard_alone(spark):
    """Pairs of a Jaccard of 0.7 to 0.75, which lie about 12 of 64 bits apart: pairs are found whatever their distance."""
    r = random.Random(11)
    table, truth = [], set()
    for k in range(400):
        own = [f"t{k}x{i}" for i in range(117)]
        drop = r.randint(13, 17)  # of 100 each: 100 - drop in common
        table += [(2 * k, " ".join(own[:100]), "en", "a"), (2 * k + 1, " ".join(own[drop : 100] + [f"u{k}x{i}" for i in range(drop)]), "en", "a")]
        assert (100 - drop) / (100 + drop) >= simhash.JACCARD
        truth.add(2 * k + 1)
    # few to a run, as the last depth is then that of a large corpus
    got = {x["id"]: x["keep_id"] for x in simhash.duplicates(docs(spark, table), bucket=1).collect()}
    assert all(k == i - 1 for i, k in got.items()) and len(truth & set(got)) >= 0.9 * len(truth)


def test_expected_recall_at_the_threshold_at_every_size():
    """Of pairs with a Jaccard of just 0.7: chance to lie within the radius and to meet in one of the tries."""
    bits = 64 * simhash.WORDS
    apart = math.acos(2 * 0.7 / 1.7) / math.pi
    for nodes in (3000, 240_000, 10**7, 10**9):
        depth, trees = simhash.forest(nodes, words=simhash.WORDS)
        chance = lambda k: math.comb(bits, k) * apart**k * (1 - apart) ** (bits - k)
        assert sum(chance(k) * (1 - (1 - simhash.meet(depth, k, bits)) ** trees) for k in range(simhash.RADIUS * simhash.WORDS + 1)) >= 0.9, nodes


def test_pairs_left_out_are_made_up_for(spark):
    """Where links fail, the other pairs that met are handed on: classes are those of all pairs."""
    r = np.random.default_rng(8)
    center = r.integers(0, 2**63, 2).astype(np.uint64)
    flips = np.zeros((300, 128), np.uint8)
    for row in flips:
        row[r.choice(128, 12, replace=False)] = 1
    fps = np.packbits(flips, axis=1).view(">u8").astype(np.uint64) ^ center
    near = simhash.distances(fps, fps) <= 2 * simhash.RADIUS
    rest = []
    links = simhash.compare(fps, 2 * simhash.RADIUS, rest)
    left = np.concatenate(rest)
    made_up = {tuple(sorted(left[p])) for part in simhash.across(fps[left], left, 2 * simhash.RADIUS) for p in part}
    assert set(map(tuple, links.tolist())) | made_up == set(zip(*np.nonzero(np.triu(near, 1)), strict=True)) != set(map(tuple, links.tolist()))
    depth, trees = simhash.forest(300, words=2)
    met = set()
    for t in range(trees):
        prefix = simhash.permuted(fps, t)[:, 0] >> np.uint64(64 - depth)
        met |= set(zip(*(x.tolist() for x in np.nonzero(np.triu(near & (prefix[:, None] == prefix[None, :]), 1))), strict=True))
    alike = {p for p in met if hash(p) % 25 == 0}
    nodes = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(fps.view(np.int64).tolist())], "node bigint, fp0 bigint, fp1 bigint")
    found, rest = simhash.candidates(nodes)
    first = {(x["a"], x["b"]) for x in found.collect()}
    roots = _groups(first & alike, range(300))
    more = {(x["a"], x["b"]) for x in simhash.rest_links(nodes, spark.createDataFrame(list(roots.items()), "node bigint, root bigint"), rest).collect()}
    assert first <= met and more <= met and not any(roots[a] == roots[b] for a, b in more)
    assert _groups((first | more) & alike, range(300)) == _groups(alike, range(300)) != roots
