"""Line dedup by pairwise alignment.

Lines are hashed; a hash found in two or more documents is shared. Stretches of shared lines, one behind the other, give
candidate pairs: from each line on, and up to each line, the shortest that holds ``min_words`` tokens. Any line of a block
that two documents share is in such a stretch that both have. The n-th time that a document has a stretch counts as a
stretch of its own. Each stretch pairs every document that has it with the first that has it (so often), so that the pairs grow
with the occurrences, however many documents share a line, and no line is left out. Each pair is aligned with patience diff on
its shared lines, and runs of aligned lines that stand together in both and hold ``min_words`` tokens are deleted from the
later document. What they leave is aligned again, as blocks may stand in another order; stretches that patience doesn't align,
as their lines stand several times in both, are matched as they come. The first document with a line keeps it always.

Of scripts written without blanks each character is a token. Documents are ordered by id, null ids last, then a hash of the text,
then their place. Defined results: every row is a document of its own, so a repeated row, or a copy without an id, loses all its
lines to the first. Null and empty texts pass unchanged; so do blank lines outside deleted
blocks. A document that loses all its lines that aren't blank is left out with ``drop_emptied`` (its text stands
elsewhere in full), or else stays with an empty text. A column ``n_chars`` is brought up to date. An empty table gives
an empty one. Other columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import AT, FILE, LAST, ROW, TOKEN, _is_scan, attach, lean, located, materialise

#: Thai, Lao, Burmese, Khmer, Japanese and Chinese, written without blanks: each of their characters counts as a token. As ranges, as
#: looking up each character's script takes longer than all else.
UNBROKEN = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0002fa1f"
WORD = f"[{UNBROKEN}]|[^ \\t\\r{UNBROKEN}]+"
MIN_WORDS = 5


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: matched positions (i, j), rising in both. Common ends match; lines found once in each, in the
    longest order that both have, split the rest, which is treated likewise."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            found.append((i2, j2))
        if i == i2 or j == j2:
            continue
        na, nb = Counter(a[i:i2]), Counter(b[j:j2])
        at = {x: k for k, x in enumerate(b[j:j2], j) if nb[x] == 1}
        pairs = [(k, at[x]) for k, x in enumerate(a[i:i2], i) if na[x] == 1 and x in at]
        if not pairs:
            continue
        tails: list[int] = []
        last: list[int] = []
        back: list[int] = []
        for n, (_, y) in enumerate(pairs):
            p = bisect_left(tails, y)
            back.append(last[p - 1] if p else -1)
            if p == len(tails):
                tails.append(y)
                last.append(n)
            else:
                tails[p], last[p] = y, n
        chain, n = [], last[-1]
        while n >= 0:
            chain.append(pairs[n])
            n = back[n]
        for x, y in reversed(chain):
            todo.append((i, x, j, y))
            found.append((x, y))
            i, j = x + 1, y + 1
        todo.append((i, i2, j, j2))
    return sorted(found)


def _blocks(early: list[tuple[int, int]], late: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int]]:
    """Positions (early, late) in the aligned runs of one alignment that hold enough tokens."""
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []
    words, before = 0, (-2, -2)
    for x, y in patience([h for _, h in early], [h for _, h, _ in late]):
        here = (early[x][0], late[y][0])
        if here != (before[0] + 1, before[1] + 1):
            out += run if words >= min_words else []
            run, words = [], 0
        run.append(here)
        words += late[y][2]
        before = here
    return out + (run if words >= min_words else [])


def _leftover(early: list[tuple[int, int]], late: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int]]:
    """Positions (early, late) of stretches that both have and no alignment has found, each with the lines that go on with it."""
    index: dict[tuple, list[int]] = {}
    for k in range(1, min_words + 1):
        for x in range(len(early) - k, -1, -1):
            if early[x + k - 1][0] - early[x][0] == k - 1:
                index.setdefault(tuple(h for _, h in early[x : x + k]), []).append(x)
    used: set[int] = set()
    found: list[tuple[int, int]] = []
    y = 0
    while y < len(late):
        k, words = 0, 0
        while y + k < len(late) and words < min_words and late[y + k][0] == late[y][0] + k:
            words += late[y + k][2]
            k += 1
        x = -1
        free = index.get(tuple(h for _, h, _ in late[y : y + k]), []) if words >= min_words else []
        while free and x < 0:
            x = free.pop()
            x = -1 if any(i in used for i in range(x, x + k)) else x
        if x < 0:
            y += 1
            continue
        while y + k < len(late) and x + k < len(early) and x + k not in used and early[x + k][1] == late[y + k][1] and early[x + k][0] == early[x][0] + k and late[y + k][0] == late[y][0] + k:
            k += 1
        used |= set(range(x, x + k))
        found += [(early[x + i][0], late[y + i][0]) for i in range(k)]
        y += k
    return found


def aligned_blocks(early: list[tuple[int, int]], late: list[tuple[int, int, int]], min_words: int) -> list[int]:
    """Positions of the later document in aligned blocks. early: (position, hash); late: (position, hash, tokens)."""
    out: list[int] = []
    while found := _blocks(early, late, min_words) or _leftover(early, late, min_words):
        used, gone = {x for x, _ in found}, {y for _, y in found}
        out += gone
        early, late = [e for e in early if e[0] not in used], [e for e in late if e[0] not in gone]
    return out


def _align(min_words: int):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, gone = [], []
            c = {n: batch.column(n) for n in batch.schema.names}
            # numbers become objects for a pair at a time: a batch of long documents would fill the memory
            lists = {n: (c[n].offsets.to_numpy(), c[n].values.to_numpy()) for n in ("early_pos", "early_hash", "late_pos", "late_hash", "late_words")}
            one = lambda n, i: lists[n][1][lists[n][0][i] : lists[n][0][i + 1]].tolist()
            for i in range(batch.num_rows):
                lost = aligned_blocks(list(zip(one("early_pos", i), one("early_hash", i), strict=True)), list(zip(one("late_pos", i), one("late_hash", i), one("late_words", i), strict=True)), min_words)
                if lost:
                    at.append(i)
                    gone.append(lost)
            yield pa.RecordBatch.from_arrays([c["doc"].take(pa.array(at, pa.int64())), pa.array(gone, pa.list_(pa.int32()))], ["doc", "gone"])

    return aligned


def stretches(doc: np.ndarray, pos: np.ndarray, hashes: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, anchor): the shortest stretches of lines that hold enough tokens, from each line on and up to each line. The
    lines come by document and position; an anchor is a hash of the lines and of how often they stood before."""
    n = len(doc)
    found = []
    upto = np.concatenate([[0], np.cumsum(words)])
    for k in range(min(min_words, n)):
        i = np.arange(n - k)
        j = i + k
        whole = (doc[i] == doc[j]) & (pos[j] - pos[i] == k) & (upto[j + 1] - upto[i] >= min_words)
        # without its last, or its first line, it is too short
        i = i[whole & ((upto[j] - upto[i] < min_words) | (upto[j + 1] - upto[i + 1] < min_words))]
        mixed = np.full(len(i), k, np.uint64)
        for at in range(k + 1):
            mixed = (mixed ^ hashes[i + at].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        found.append((doc[i], mixed))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, mixed = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((mixed, doc))
    doc, mixed = doc[order], mixed[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (mixed[1:] != mixed[:-1])
    times = np.arange(len(doc)) - np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))
    mixed = (mixed + times.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return doc, (mixed ^ mixed >> np.uint64(32)).view(np.int64)


def _anchors(min_words: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {n: batch.column(n) for n in ("pos", "hash", "words")}
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists["pos"].offsets.to_numpy()))
            doc, anchor = stretches(doc, *(x.flatten().to_numpy().astype(np.int64) for x in lists.values()), min_words)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(doc)), pa.array(anchor)], ["doc", "anchor"])

    return anchors


DOC = f"struct<id:bigint,h:bigint,{FILE}:bigint,{AT}:bigint>"


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, h, __file, __at, gone): the positions, from 0, of the lines that each document loses."""
    text = F.col(f"{ROW}.text")
    doc = F.struct(F.coalesce(F.col(f"{ROW}.doc_id").cast("bigint"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("h"), FILE, AT)
    stripped = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    lines = located(docs).where(F.length(text) > 0).select(doc.alias("doc"), F.posexplode(stripped).alias("pos", "line")).where("line != ''")
    # more than min_words tokens count as one more: that is enough to tell, and needn't read on
    some = F.size(F.split("line", "[ \\t\\r]+", min_words + 1))
    unbroken = (F.octet_length("line") > F.length("line") + 1) & F.rlike("line", F.lit(f"[{UNBROKEN}]"))
    lines = lines.select("doc", "pos", F.xxhash64("line").alias("hash"), F.when(unbroken, F.regexp_count("line", F.lit(WORD))).otherwise(some).alias("words"))
    lines = materialise(lines, "lines")
    stats = lines.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where(F.col("first") != F.col("last"))
    seqs = lines.join(stats.select("hash"), "hash").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", "hash", "words"))).alias("s"))
    seqs = materialise(seqs.select("doc", F.col("s.pos").alias("pos"), F.col("s.hash").alias("hash"), F.col("s.words").alias("words")), "lines-of-documents")
    anchors = materialise(seqs.mapInArrow(lean(_anchors(min_words)), f"doc {DOC}, anchor bigint"), "lines-anchors")
    firsts = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("early")).where("n > 1").select("anchor", "early")
    pairs = anchors.join(firsts, "anchor").where(F.col("doc") != F.col("early")).select("early", "doc").distinct()
    both = pairs.join(seqs.select("doc", F.col("pos").alias("late_pos"), F.col("hash").alias("late_hash"), F.col("words").alias("late_words")), "doc")
    both = both.join(seqs.select(F.col("doc").alias("early"), F.col("pos").alias("early_pos"), F.col("hash").alias("early_hash")), "early")
    lost = both.select("doc", "early_pos", "early_hash", "late_pos", "late_hash", "late_words").mapInArrow(lean(_align(min_words)), f"doc {DOC}, gone array<int>")
    return lost.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias("gone")).select("doc.*", "gone")


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = True) -> DataFrame:
    """Documents without the lines that an earlier one has in an aligned block."""
    docs = docs if _is_scan(docs) else materialise(docs, "rows")
    gone = deletions(docs, min_words).select(F.col(FILE).alias("file"), F.col(AT).alias("at"), F.col("gone").alias("value"))
    text = F.col(f"{ROW}.text")
    rows = attach(located(docs), gone, "gone")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    rows = rows.select(ROW, F.when(F.col("gone").isNull(), text).otherwise(kept).alias("__text"), F.col("gone").isNotNull().alias("__cut"))
    blank = F.regexp_count("__text", F.lit(TOKEN)) == 0
    if drop_emptied:
        rows = rows.where(~(F.col("__cut") & blank))
    fresh = {"text": F.when(F.col("__cut") & blank, F.lit("")).otherwise(F.col("__text")), "n_chars": F.when(F.col("__cut"), F.length("__text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(f"{ROW}.n_chars")) if "n_chars" in docs.columns else None}
    return rows.select(*[fresh.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns])
