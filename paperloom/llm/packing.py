"""Best-fit packing of documents into sequences by a configuration linear program.

Texts longer than a sequence are cut into full pieces and a rest; nothing is lost. Pieces are counted by length, in
units of ``quantum`` tokens rounded up, so that the problem solved on the driver has as many rows as a sequence has
units, however large the corpus. A configuration is a multiset of lengths that fits. The program (cover every length's
count with the fewest configurations) is solved by multiplicative weights: the weights of lengths not yet covered price
a knapsack, whose dynamic programme gives the next configuration. The solution is rounded down, what is left is packed
best-fit, longest first, and pieces are then given to the places of their length by rank, in parallel. Two tables are
broadcast for that: the offsets of shares of a length (at most 2 ``SHARES`` rows and one a unit), and the places of the configurations
(as many rows as the program has configurations times their lengths, which depends on ``capacity / quantum`` alone).

Defined results: null and empty texts, and those of blanks, have no tokens and no pieces. Repeated rows are packed as
often as they stand there. Null ids are allowed. An empty table gives an empty result. Of the input's columns only id and text
are used.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from paperloom.llm.common import materialise, token_count

CAPACITY = 2048
QUANTUM = 4
#: Least share of its count by which a step covers a length.
STEP = 0.25
ETA = 12.0
#: Share of the pieces, at any size, that rounds of the program needn't reach.
REST = 0.25
#: Pieces that a rank is counted over at once, at least; shares of all lengths, at most (twice as many, and one a length), which
#: bounds the table of their offsets, whatever the corpus; and the finest shares that are counted.
SHARE = 1 << 8
SHARES = 1 << 17
FINE = 1 << 18

WS = " \\t\\n\\r"


def knapsack(values: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths (index + 1) of the largest value that fits: unbounded knapsack by dynamic programming."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    m = len(values)
    for c in range(1, capacity + 1):
        w = min(c, m)
        sums = values[:w] + best[c - w : c][::-1]
        k = int(sums.argmax())
        best[c], choice[c] = sums[k], k + 1
    found: dict[int, int] = {}
    c = capacity
    while c > 0:
        length = int(choice[c])
        if values[length - 1] > 0:
            found[length] = found.get(length, 0) + 1
        c -= length
    return found


def solve(counts: dict[int, int], capacity: int, step: float = STEP, eta: float = ETA) -> tuple[dict[tuple, float], float]:
    """Fractional configurations that cover the counts, and the best lower bound that a price vector proved."""
    demand = np.zeros(capacity)
    for length, n in counts.items():
        demand[length - 1] = n
    has = demand > 0
    cover = np.zeros(capacity)
    x: dict[tuple, float] = {}
    bound = math.ceil(sum(k * n for k, n in counts.items()) / capacity)
    while has.any() and cover[has].min() < 1:
        # lengths that are covered have no price: what they would add is of no use
        prices = np.where(has & (cover < 1), np.exp(-eta * np.minimum(cover, 1)), 0)
        prices[has] /= demand[has]
        config = knapsack(prices, capacity)
        worth = sum(prices[k - 1] * a for k, a in config.items())
        bound = max(bound, float((prices * demand).sum() / worth))
        amount = step * min(demand[k - 1] / a for k, a in config.items())
        for k, a in config.items():
            cover[k - 1] += amount * a / demand[k - 1]
        key = tuple(sorted(config.items(), reverse=True))
        x[key] = x.get(key, 0.0) + amount
    return x, bound


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Best-fit decreasing: configurations and how many bins have each. Bins that hold the same are filled together, so the time
    depends on how many kinds there are, not on the number of pieces."""
    kinds: dict[int, dict[tuple, int]] = {}
    room: list[int] = []

    def add(config: tuple, left: int, n: int) -> None:
        if left not in kinds:
            insort(room, left)
            kinds[left] = {}
        kinds[left][config] = kinds[left].get(config, 0) + n

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            at = bisect_left(room, length)
            if at < len(room):
                left = room[at]
                config, bins = next(iter(kinds[left].items()))
            else:
                left, config, bins = capacity, (), n
            # the bin that a piece goes to stays the best one for the next, while there is room
            each = min(left // length, n)
            take = min(bins, n // each)
            if config:
                kinds[left][config] -= take
                if not kinds[left][config]:
                    del kinds[left][config]
                if not kinds[left]:
                    del kinds[left]
                    room.pop(at)
            add((*config, (length, each)), left - each * length, take)
            n -= each * take
    return [(tuple(sorted(c, reverse=True)), n) for left in kinds for c, n in kinds[left].items()]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Configurations and how often each is used; together they hold the counts exactly.

    A rounded solution can cover too much, and is then cut back, which leaves a share of the pieces. The program is solved for
    these again, at first with configurations alone that leave no unit empty, then with any, as long as a round places a tenth of
    what there is, and until a share of ``REST`` is left to best-fit."""
    left = {k: n for k, n in counts.items() if n > 0}
    rest = REST * sum(left.values())
    used: dict[tuple, int] = {}
    if full := left.pop(capacity, 0):
        used[((capacity, 1),)] = full
    strict = True
    while sum(left.values()) > rest:
        x, _ = solve(left, capacity)
        before = sum(left.values())
        for config, amount in sorted(x.items(), key=lambda c: (sum(k * a for k, a in c[0]) - capacity) * -1):
            if strict and sum(k * a for k, a in config) < capacity:
                break
            n = min(int(amount), *(left.get(k, 0) // a for k, a in config))
            if n > 0:
                used[config] = used.get(config, 0) + n
                for k, a in config:
                    left[k] -= a * n
        left = {k: n for k, n in left.items() if n > 0}
        if before - sum(left.values()) < 0.1 * before:
            if not strict:
                break
            strict = False
    for config, n in best_fit(left, capacity):
        used[config] = used.get(config, 0) + n
    return sorted(used.items(), reverse=True)


def places(used: list[tuple[tuple, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(units, from rank, to rank, first bin, pieces a bin, first unit in the bin) of each length in each configuration."""
    rows, ranks, b = [], {}, 0
    for config, n in used:
        at = 0
        for k, a in config:
            r = ranks.get(k, 0)
            rows.append((k, r, r + a * n, b, a, at))
            ranks[k] = r + a * n
            at += a * k
        b += n
    return rows


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, n_tokens, text): whole texts, or cut at every ``capacity`` tokens; blanks stay with the token before."""
    rows = docs.select("doc_id", "text", token_count(F.col("text")).alias("__n")).where("__n > 0")
    short = F.array(F.struct(F.lit(0).alias("piece"), F.col("__n").cast("int").alias("n_tokens"), F.col("text").alias("text")))
    tokens = F.regexp_extract_all("text", F.lit(f"(?:^[{WS}]+)?[^{WS}]+[{WS}]*"), 0)
    many = F.transform(F.sequence(F.lit(0), F.call_function("div", F.col("__n") - 1, F.lit(capacity).cast("bigint")).cast("int")), lambda i: F.struct(i.alias("piece"), F.least(F.col("__n") - i * capacity, F.lit(capacity)).cast("int").alias("n_tokens"), F.array_join(F.slice("__tokens", i * capacity + 1, F.lit(capacity)), "").alias("text")))
    small = rows.where(F.col("__n") <= capacity).select("doc_id", F.explode(short).alias("p"))
    large = rows.where(F.col("__n") > capacity).select("doc_id", "__n", tokens.alias("__tokens")).select("doc_id", F.explode(many).alias("p"))
    return small.unionByName(large).select("doc_id", "p.piece", "p.n_tokens", "p.text")


def pack(docs: DataFrame, capacity: int = CAPACITY, quantum: int = QUANTUM) -> DataFrame:
    """(bin, start, doc_id, piece, n_tokens, text): each piece's sequence, and the token in it where its place starts."""
    room = capacity // quantum
    units = F.call_function("div", F.col("n_tokens") + quantum - 1, F.lit(quantum)).cast("int")
    # a piece's length needs no cut text: the counts read only what they count
    n = token_count(F.col("text"))
    lengths = docs.select("doc_id", n.alias("n")).where("n > 0").select("doc_id", "n", F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("n") - 1, F.lit(capacity).cast("bigint")))).alias("piece", "i"))
    lengths = lengths.select("doc_id", "piece", F.least(F.col("n") - F.col("i") * capacity, F.lit(capacity)).cast("int").alias("n_tokens"))
    # ranks are counted within salted shares of a length, as one length may hold most of the corpus; counts by fine salts
    # tell how many salts each length gets, of which the fine ones are parts
    hashed = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(FINE)).cast("int")
    fine = materialise(lengths.groupBy(units.alias("units"), hashed.alias("salt")).agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["units"]: r["n"] for r in fine.groupBy("units").agg(F.sum("n").alias("n")).collect()}
    share = max(SHARE, sum(histogram.values()) / SHARES)
    salts = [min(FINE, 1 << max(0, math.ceil(math.log2(max(1, histogram.get(u, 0)) / share)))) for u in range(room + 2)]
    salt = lambda of, length: F.pmod(of, F.get(F.array(*[F.lit(x) for x in salts]), length))
    counted = fine.groupBy("units", salt(F.col("salt"), F.col("units")).alias("salt")).agg(F.sum("n").alias("n"))
    rows = places(plan(histogram, room), room)
    before = Window.partitionBy("units").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(counted.select(F.col("units").alias("__units"), F.col("salt").alias("__salt"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")), "pack-offsets")
    cut = pieces(docs, capacity).select("doc_id", "piece", "n_tokens", "text", units.alias("__units"), salt(hashed, units).alias("__salt"))
    order = Window.partitionBy("__units", "__salt").orderBy("doc_id", "piece", F.xxhash64("text"))
    ranked = cut.withColumn("__rank", F.row_number().over(order).cast("bigint") - 1)
    ranked = ranked.join(F.broadcast(offsets), ["__units", "__salt"]).withColumn("__rank", F.col("__rank") + F.col("__before"))
    schema = T.StructType([T.StructField(k, T.LongType() if k != "__units" else T.IntegerType(), False) for k in ("__units", "__from", "__to", "__bin", "__each", "__at")])
    # by Arrow: from a list, Spark would start Python processes of another kind on the executors, and keep them
    kinds = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    slots = docs.sparkSession.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds), schema)
    r = F.col("__rank") - F.col("__from")
    out = ranked.join(F.broadcast(slots), "__units").where((F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    return out.select((F.col("__bin") + F.call_function("div", r, F.col("__each"))).alias("bin"), ((F.col("__at") + r % F.col("__each") * F.col("__units")) * quantum).alias("start"), "doc_id", "piece", "n_tokens", "text")
