"""HTML extraction by wrapper induction: union-free regular expressions inferred from the pages of a host.

A page is a stream of tokens: tags (name, class and id), texts between them, and scripts, styles and comments, which
are passed over. Equal elements, one behind the other, become repeated groups; so do short blocks of tokens that are closed in themselves, as
lines with breaks or items that no tag closes. A single element that repeats
in another page of the host becomes one, too. Folding takes time in proportion to the page: elements are compared by hashes that
their parts add up to. The token streams of a host are then aligned one by one with the wrapper
so far: where tags differ, the tokens that one side lacks become an optional group; where texts differ, a text slot
stands. What is left outside groups and slots is the host's template. Extraction aligns a page with its host's wrapper
and takes the texts in slots; ``text`` leaves out those in navigation, headers, footers, asides, forms and titles.

Streams that differ in texts alone have one shape, and are merged in parallel before anything is aligned, so that each shape is seen
once, however many pages it has. A host's shapes are shared out, about the square root of their number to a share; each share is
aligned in a task of its own, and then the wrappers of the shares are. Shapes are taken by falling number of pages, so a wrapper
doesn't depend on how pages are spread over tasks. Alignment is exact, in memory that grows with the longer stream alone.

Defined results: a null or empty page, or one without texts, has no fields and the text ''. Null URLs and those without a
host form the host ''. A text is fixed where enough different pages have it: copies of a page say nothing of the template, so a host with a
single page, or copies of one, has none, and all its texts are slots. Repeated rows each have a result. Pages of any length are handled whole.
An empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from collections import Counter, OrderedDict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import join_sized, materialise

TOKENS = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>|<\?[^>]*>", re.S | re.I)
NAMES = re.compile(r"\b(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")
#: Texts within these aren't part of ``text``.
OUTSIDE = {"nav", "header", "footer", "aside", "form", "title", "button", "select"}
#: A text is fixed where at least so many different pages have it, or all pages of a host that has fewer (two, at least).
SUPPORT = 3
VOID = {"br", "hr", "img", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr"}
TEXT = "#"
OPEN, CLOSE = "\x02", "\x03"


def tokens(page: str) -> tuple[list[str], list[str | None]]:
    """Keys of the tokens, and their texts (None for tags)."""
    keys: list[str] = []
    texts: list[str | None] = []
    at = 0
    for m in TOKENS.finditer(page):
        if m.start() > at:
            _text(page[at : m.start()], keys, texts)
        at = m.end()
        if name := m.group(3):
            names = "".join(f" {k.lower()}={SPACE.sub(' ', a or b or c)}" for k, a, b, c in NAMES.findall(m.group(4))) if m.group(4) and not m.group(2) else ""
            keys.append(f"{m.group(2)}{name.lower()}{names}")
            texts.append(None)
    if at < len(page):
        _text(page[at:], keys, texts)
    return keys, texts


def _text(raw: str, keys: list[str], texts: list[str | None]) -> None:
    if raw.isspace():
        return
    text = SPACE.sub(" ", htmllib.unescape(raw) if "&" in raw else raw).strip()
    if not text:
        return
    if keys and keys[-1] == TEXT:  # a comment stood between
        texts[-1] += " " + text
    else:
        keys.append(TEXT)
        texts.append(text)


MODULUS, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)
#: Nodes of a block without an element of its own, at most.
PERIOD = 8
Hash = tuple[int, int]


def _join(a: Hash, b: Hash) -> Hash:
    """(hash, length) of one sequence behind another."""
    return (a[0] * pow(BASE, b[1], MODULUS) + b[0]) % MODULUS, a[1] + b[1]


@lru_cache(1 << 16)
def _symbol(key: str) -> Hash:
    if key[:1] == OPEN:
        inner: list[Hash] = [(0, 0)]
        for part in re.split(f"([{OPEN}{CLOSE}\t])", key):
            if part == OPEN:
                inner.append((0, 0))
            elif part == CLOSE:
                whole = inner.pop()
                inner[-1] = _join(inner[-1], _repeated(whole))
            elif part and part != "\t":
                inner[-1] = _join(inner[-1], _symbol(part))
        return inner[0]
    return xxhash.xxh64_intdigest(key) % MODULUS, 1


def _repeated(block: Hash) -> Hash:
    """A group as a symbol of its own."""
    return xxhash.xxh64_intdigest(b"%d,%d" % block) % MODULUS, 1


def group(keys: tuple[str, ...]) -> str:
    """The key of a repeated group."""
    return OPEN + "\t".join(keys) + CLOSE


def _partners(keys: tuple[str, ...]) -> list[int]:
    """For each tag the one that closes or opens it; -1 for none."""
    partner, stack, opened = [-1] * len(keys), [], Counter()
    for i, key in enumerate(keys):
        if key[0] == "/":
            name = key[1:]
            while opened[name]:
                j, other = stack.pop()
                opened[other] -= 1
                if other == name:
                    partner[i], partner[j] = j, i
                    break
        elif key != TEXT and key[0] != OPEN and (name := key.split(" ", 1)[0]) not in VOID:
            stack.append((i, name))
            opened[name] += 1
    return partner


class _Element:
    """A closed element, or a group of equal ones."""

    __slots__ = ("hash", "start", "end", "parts", "grouped")

    def __init__(self, hash_: Hash, start: int, end: int, parts: list, grouped: bool):
        self.hash, self.start, self.end, self.parts, self.grouped = hash_, start, end, parts, grouped


def fold(keys: tuple[str, ...], known: frozenset[int] = frozenset()) -> list[tuple[str, int, int]]:
    """(key, from token, to token) of a page's nodes: tokens and repeated groups, which may hold such groups. Elements whose
    hashes are ``known`` are groups even where they stand once."""
    partner = _partners(keys)
    frames: list[list] = [[]]
    for i, key in enumerate(keys):
        if key != TEXT and partner[i] > i:
            frames.append([i])
            continue
        frames[-1].append(i)
        if partner[i] < 0 or key == TEXT:
            continue
        parts = frames.pop()
        whole = (0, 0)
        for x in parts:
            whole = _join(whole, _symbol(keys[x]) if isinstance(x, int) else _repeated(x.hash) if x.grouped else x.hash)
        last = frames[-1][-1] if frames[-1] else None
        if isinstance(last, _Element) and last.hash == whole:
            last.end, last.grouped = i + 1, True
        else:
            frames[-1].append(_Element(whole, parts[0], i + 1, parts, whole[0] in known))
    nodes: list[tuple[str, int, int]] = []

    def walk(parts: list, out: list) -> None:
        todo = [iter(parts)]
        while todo:  # not by recursion: pages may be nested deeply
            for x in todo[-1]:
                if isinstance(x, int):
                    out.append((keys[x], x, x + 1))
                elif x.grouped:
                    inner: list = []
                    walk(x.parts, inner)
                    out.append((group(tuple(n[0] for n in inner)), x.start, x.end))
                else:
                    todo.append(iter(x.parts))
                    break
            else:
                todo.pop()

    walk(frames[0], nodes)
    return _merged(_periods(_merged(nodes), partner))


def _merged(nodes: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Equal groups, one behind the other, as one."""
    out: list[tuple[str, int, int]] = []
    for n in nodes:
        if out and n[0][0] == OPEN and out[-1][0] == n[0]:
            out[-1] = (n[0], out[-1][1], n[2])
        else:
            out.append(n)
    return out


def _periods(nodes: list[tuple[str, int, int]], partner: list[int]) -> list[tuple[str, int, int]]:
    """Blocks of up to PERIOD nodes that stand twice or more in a row, have a tag, and no tag whose partner is outside, as groups;
    of overlapping ones the shortest, then the first."""
    n = len(nodes)
    ids = {k: i for i, k in enumerate(dict.fromkeys(k for k, _, _ in nodes))}
    if len(ids) == n:
        return nodes
    seq = np.array([ids[k] for k, _, _ in nodes])
    taken = np.zeros(n, dtype=bool)
    spans = []
    for b in range(1, min(PERIOD, n // 2) + 1):
        same = np.concatenate([[0], (seq[:-b] == seq[b:]).view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(same))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            for start in range(s, min(s + b, e - b + 1)):  # the block may be turned
                block = nodes[start : start + b]
                low, high = block[0][1], block[-1][2]
                if any(k != TEXT and k[0] != OPEN for k, _, _ in block) and all(partner[f] < 0 or low <= partner[f] < high for _, f, _ in block):
                    times = (e - start) // b + 1
                    if not taken[start : start + b * times].any():
                        taken[start : start + b * times] = True
                        spans.append((start, b, times))
                    break
    out, at = [], 0
    for s, b, times in sorted(spans):
        out += nodes[at:s]
        out.append((group(tuple(x[0] for x in nodes[s : s + b])), nodes[s][1], nodes[s + b * times - 1][2]))
        at = s + b * times
    return out + nodes[at:]


def _weight(key: str) -> int:
    return 1 if key == TEXT else 2 + key.count("\t")


def _weights(x: np.ndarray, w: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The weight of the heaviest common subsequence of x with each beginning of y."""
    best = np.zeros(len(y) + 1, np.int64)
    for key, gain in zip(x.tolist(), w.tolist(), strict=True):
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + np.where(y == key, gain, 0)))
    return best


def _table(x: list[int], w: list[int], y: list[int]) -> list[tuple[int, int]]:
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for p in range(len(x) - 1, -1, -1):
        row, below, key, gain = best[p], best[p + 1], x[p], w[p]
        for q in range(len(y) - 1, -1, -1):
            v = below[q] if below[q] >= row[q + 1] else row[q + 1]
            if key == y[q] and below[q + 1] + gain > v:
                v = below[q + 1] + gain
            row[q] = v
    out, p, q = [], 0, 0
    while p < len(x) and q < len(y):
        if x[p] == y[q] and best[p][q] == best[p + 1][q + 1] + w[p]:
            out.append((p, q))
            p, q = p + 1, q + 1
        elif best[p][q] == best[p + 1][q]:
            p += 1
        else:
            q += 1
    return out


def align(a: list[str], b: list[str], table: int = 1 << 12) -> list[tuple[int, int]]:
    """The heaviest common subsequence of keys, as positions (i, j). Beyond ``table`` pairs of keys the problem is halved where its halves'
    weights add up to the most, so that memory grows with the longer side alone."""
    ids = {k: i for i, k in enumerate(dict.fromkeys([*a, *b]))}
    x, y = np.array([ids[k] for k in a], np.int64), np.array([ids[k] for k in b], np.int64)
    w = np.array([_weight(k) for k in a], np.int64)
    found, todo = [], [(0, len(x), 0, len(y))]
    while todo:
        i, i2, j, j2 = todo.pop()
        n = min(i2 - i, j2 - j)
        differ = np.flatnonzero(x[i : i + n] != y[j : j + n])
        head = int(differ[0]) if len(differ) else n
        found += [(i + k, j + k) for k in range(head)]
        i, j, n = i + head, j + head, n - head
        differ = np.flatnonzero(x[i2 - n : i2][::-1] != y[j2 - n : j2][::-1])
        tail = int(differ[0]) if len(differ) else n
        found += [(i2 - 1 - k, j2 - 1 - k) for k in range(tail)]
        i2, j2 = i2 - tail, j2 - tail
        if i == i2 or j == j2:
            continue
        if (i2 - i) * (j2 - j) <= table:
            found += [(i + p, j + q) for p, q in _table(x[i:i2].tolist(), w[i:i2].tolist(), y[j:j2].tolist())]
        elif i2 - i == 1:
            hit = np.flatnonzero(y[j:j2] == x[i])
            found += [(i, j + int(hit[0]))] if len(hit) else []
        else:
            mid = (i + i2) // 2
            cut = j + int((_weights(x[i:mid], w[i:mid], y[j:j2]) + _weights(x[mid:i2][::-1], w[mid:i2][::-1], y[j:j2][::-1])[::-1]).argmax())
            todo += [(i, mid, j, cut), (mid, i2, cut, j2)]
    return sorted(found)


def blocks(shapes: Iterable[Iterable[str]]) -> frozenset[int]:
    """The hashes of the blocks of all repeated groups in the shapes."""
    found: set[int] = set()
    for key in {key for keys in shapes for key in keys if key[0] == OPEN}:
        inner: list[Hash] = [(0, 0)]
        for part in re.split(f"([{OPEN}{CLOSE}\t])", key):
            if part == OPEN:
                inner.append((0, 0))
            elif part == CLOSE:
                whole = inner.pop()
                found.add(whole[0])
                inner[-1] = _join(inner[-1], _repeated(whole))
            elif part and part != "\t":
                inner[-1] = _join(inner[-1], _symbol(part))
    return frozenset(found)


#: A node of a wrapper: key, fixed text or None, number of its optional group or 0, and how many different pages have it.
Node = list


def refolded(wrapper: list[Node], known: frozenset[int]) -> list[Node]:
    """A wrapper with the groups that others of its host have."""
    out = []
    for key, s, e in fold(tuple(n[0] for n in wrapper), known):
        own = wrapper[s:e]
        out.append(own[0] if e - s == 1 else [key, None, own[0][2] if len({n[2] for n in own}) == 1 else 0, max(n[3] for n in own)])
    return out


def merge(a: list[Node], b: list[Node], groups: int) -> tuple[list[Node], int]:
    """Two wrappers as one, and the last number of an optional group. What one of them lacks becomes optional; of a group that is there
    in part, the part that isn't leaves it."""
    out: list[Node] = []
    i, j = 0, 0
    of_b: dict[int, int] = {}

    def lone(run: list[Node]) -> None:
        nonlocal groups
        last = None
        for n in run:
            if last is None or last != n[2]:
                last = n[2]
                groups += 1
            out.append([n[0], n[1], groups, n[3]])

    for x, y in [*align([n[0] for n in a], [n[0] for n in b]), (len(a), len(b))]:
        lone(a[i:x])
        lone(b[j:y])
        if x < len(a):
            m, n = a[x], b[y]
            number = m[2]
            if n[2] and not number:
                if n[2] not in of_b:
                    groups += 1
                    of_b[n[2]] = groups
                number = of_b[n[2]]
            out.append([m[0], m[1] if m[1] == n[1] else None, number, m[3] + n[3]])
        i, j = x + 1, y + 1
    return out, groups


def induce(parts: list[list[Node]]) -> list[Node]:
    """The wrapper of a host from those of its shapes or shares, in the order in which they are taken."""
    known = blocks([[n[0] for n in p] for p in parts])
    wrapper: list[Node] | None = None
    groups = max([0, *(n[2] for p in parts for n in p)])
    for p in parts:
        p = refolded(p, known)
        wrapper, groups = (p, groups) if wrapper is None else merge(wrapper, p, groups)
    return wrapper or []


def expression(wrapper: list[list]) -> str:
    """A wrapper as a regular expression: ``#`` for slots, (...)+ for repeated and (...)? for optional groups."""
    out, open_group = [], 0
    for key, text, group, _ in wrapper:
        if group != open_group:
            out.append((")?" if open_group else "") + ("(" if group else ""))
            open_group = group
        out.append(text if text is not None else "".join({OPEN: "(", CLOSE: ")+", "\t": "", TEXT: TEXT, "": ""}.get(k, f"<{k}>") for k in re.split(f"([{OPEN}{CLOSE}\t])", key)))
    return "".join(out) + (")?" if open_group else "")


def _merge(old: list | None, texts: list[str | None], n: int, seen: list[int]) -> list:
    """State of a shape: its texts, None where they differ, its pages, and hashes of up to SUPPORT different ones."""
    if old is None:
        return [list(texts), n, list(seen)]
    for i, t in enumerate(texts):
        if old[0][i] is not None and old[0][i] != t:
            old[0][i] = None
    old[1] += n
    old[2] = sorted({*old[2], *seen})[:SUPPORT]
    return old


PART = "host string, keys string, texts string, seen string, n bigint"


def _partial(limit: int = 4 << 20):
    def out(held: dict) -> pa.RecordBatch:
        rows = [(host, json.dumps(keys), json.dumps(v[0]), json.dumps(v[2]), v[1]) for (host, keys), v in held.items()]
        cols = list(zip(*rows, strict=True)) or [[], [], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], ["host", "keys", "texts", "seen", "n"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                keys, texts = tokens(page)
                if TEXT not in keys:
                    continue
                nodes = fold(tuple(keys))
                at = (host, tuple(n[0] for n in nodes))
                old = held.get(at)
                own = xxhash.xxh64_intdigest("\0".join(t for t in texts if t is not None)) >> 1
                held[at] = _merge(old, [texts[start] for key, start, _ in nodes if key == TEXT], 1, [own])
                size += 0 if old else sum(len(t) for t in texts if t) + 20 * len(keys)
                if size > limit:  # as a combiner does, hand on what is held
                    yield out(held)
                    held, size = {}, 0
        if held:
            yield out(held)

    return partial


def _shape(table: pa.Table) -> pa.Table:
    held = None
    for texts, n, seen in zip(*(table.column(c).to_pylist() for c in ("texts", "n", "seen")), strict=True):
        held = _merge(held, json.loads(texts), n, json.loads(seen))
    return pa.table({"host": table.column("host")[:1], "keys": table.column("keys")[:1], "texts": pa.array([json.dumps(held[0])]), "seen": pa.array([json.dumps(held[2])]), "n": pa.array([held[1]], pa.int64())})


def _ordered(table: pa.Table) -> tuple[list[list[Node]], int, int]:
    """Wrappers of a host's shares, by falling number of pages; all pages, and different ones."""
    rows = [(n, seen, w) for n, seen, w in zip(*(table.column(c).to_pylist() for c in ("pages", "different", "wrapper")), strict=True)]
    return [json.loads(w) for _, _, w in sorted(rows, key=lambda r: (-r[0], r[2]))], sum(r[0] for r in rows), sum(r[1] for r in rows)


def _share(table: pa.Table) -> pa.Table:
    shapes = []
    for keys, texts, seen, n in zip(*(table.column(c).to_pylist() for c in ("keys", "texts", "seen", "n")), strict=True):
        keys, own, seen = tuple(json.loads(keys)), iter(json.loads(texts)), len(json.loads(seen))
        shapes.append((n, keys, [[k, next(own) if k == TEXT else None, 0, seen] for k in keys], seen))
    shapes.sort(key=lambda x: (-x[0], x[1]))
    return pa.table({"host": table.column("host")[:1], "pages": pa.array([sum(x[0] for x in shapes)], pa.int64()), "different": pa.array([sum(x[3] for x in shapes)], pa.int64()), "wrapper": pa.array([json.dumps(induce([x[2] for x in shapes]))])})


def _induce(table: pa.Table) -> pa.Table:
    parts, pages, different = _ordered(table)
    wrapper = induce(parts)
    # a text that few different pages have says nothing of the template
    least = max(2, min(SUPPORT, different))
    wrapper = [[k, t if n >= least else None, g, n] for k, t, g, n in wrapper]
    known = sorted(blocks([[n[0] for n in p] for p in parts]))
    return pa.table({"host": table.column("host")[:1], "pages": pa.array([pages], pa.int64()), "regex": pa.array([expression(wrapper)]), "wrapper": pa.array([json.dumps([known, wrapper])])})


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, pages, regex, wrapper): a wrapper for each host."""
    rows = pages.where("length(html) > 0").select(host_of(F.col("url")).alias("host"), "html")
    partial = rows.mapInArrow(_partial(), PART)
    # parts of a shape that very many tasks have are merged in two steps
    some = partial.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("host", "keys", "salt").applyInArrow(_shape, PART)
    shapes = materialise(some.groupBy("host", "keys").applyInArrow(_shape, PART), "shapes")
    counts = materialise(shapes.groupBy("host").agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("int").alias("shares")), "shares")
    shared = join_sized(shapes, counts, ["host"]).withColumn("share", F.pmod(F.xxhash64("keys"), F.col("shares")))
    parts = shared.drop("shares").groupBy("host", "share").applyInArrow(_share, "host string, pages bigint, different bigint, wrapper string")
    return parts.groupBy("host").applyInArrow(_induce, "host string, pages bigint, regex string, wrapper string")


class Extractor:
    """A host's wrapper, and what it makes of each shape that it has met."""

    def __init__(self, wrapper: str):
        known, self.wrapper = json.loads(wrapper)
        self.known = frozenset(known)
        self.keys = [n[0] for n in self.wrapper]
        self.met: OrderedDict = OrderedDict()

    def template(self, shape: tuple[str, ...]) -> set[int]:
        """The nodes of the shape whose texts are fixed in the wrapper."""
        if shape not in self.met:
            self.met[shape] = {j for i, j in align(self.keys, list(shape)) if self.keys[i] == TEXT and self.wrapper[i][1] is not None}
            if len(self.met) > 1000:  # a cache; what leaves it is worked out again
                self.met.popitem(last=False)
        return self.met[shape]

    def slots(self, keys: tuple[str, ...]) -> list[tuple[int, str, bool]]:
        """(token, path, inside the body) of the texts in slots."""
        nodes = fold(keys, self.known)
        shape = tuple(n[0] for n in nodes)
        fixed = {nodes[j][1] for j in self.template(shape)}
        out, stack = [], []
        for i, key in enumerate(keys):
            if key == TEXT:
                if i not in fixed:
                    out.append((i, "/".join(stack), not any(s in OUTSIDE for s in stack)))
            elif key[0] == "/":
                if key[1:] in stack:
                    while stack.pop() != key[1:]:
                        pass
            elif (name := key.split(" ", 1)[0]) not in VOID:
                stack.append(name)
        return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: OrderedDict[str, Extractor] = OrderedDict()
    field = pa.list_(pa.struct([("path", pa.string()), ("value", pa.string())]))
    for batch in batches:
        out: list[tuple] = []
        for page_id, url, host, page, wrapper in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "html", "wrapper")), strict=True):
            fields, body = [], []
            if page and wrapper:
                if wrapper not in known:
                    known[wrapper] = Extractor(wrapper)
                    if len(known) > 256:
                        known.popitem(last=False)
                keys, texts = tokens(page)
                for i, path, inside in known[wrapper].slots(tuple(keys)):
                    fields.append({"path": path, "value": texts[i]})
                    if inside:
                        body.append(texts[i])
            out.append((page_id, url, host, "\n".join(body), fields))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.string(), field), strict=True)], ["page_id", "url", "host", "text", "fields"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, text, fields): every page's texts in slots, each with the tags above it, and its main text."""
    found = materialise(wrappers(pages).select("host", "wrapper"), "wrappers")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    rows = join_sized(rows, found, ["host"], "left")
    return rows.select("page_id", "url", "host", "html", "wrapper").mapInArrow(_extract, "page_id bigint, url string, host string, text string, fields array<struct<path:string,value:string>>")
