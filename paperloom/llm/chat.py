"""Chat formatting with collapse of cumulative snapshots.

A conversation is logged again as it grows, so a log may be the beginning of a longer one. Each turn's digest enters a
rolling hash of the turns up to it; a conversation whose last hash is an inner hash of another one is a prefix of it.
Anti-joins on these hashes, each taken once, leave the maximal conversations, which are rendered; only then does text move.

Defined results: turns with a null conversation are dropped. Rows equal in conversation, turn, role and text are one
turn, logged twice. Turns with the same number stand in the order of role, then text; null numbers come first. Null
roles read 'unknown', null texts ''. Of conversations with equal turns, the smallest id stays. ``<|`` in a text or role
is broken up so that it can't end a turn. An empty table gives an empty one. Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import AT, FILE, ROW, _is_scan, attach, located, materialise


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, __file, __at)"""
    rows = located(conversations).where(F.col(f"{ROW}.conv_id").isNotNull())
    return rows.select(F.col(f"{ROW}.conv_id").alias("conv_id"), F.col(f"{ROW}.turn").alias("turn"), F.coalesce(f"{ROW}.role", F.lit("unknown")).alias("role"), F.coalesce(f"{ROW}.text", F.lit("")).alias("text"), FILE, AT)


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, h1, h2, n): the 128-bit hash of the first k turns, by summing a digest of (position, turn); n turns in all."""
    digest = lambda salt: F.xxhash64(F.lit(salt), "role", "text")
    turns = _turns(conversations)
    short = materialise(turns.groupBy("conv_id", "turn", "role", digest(1).alias("a"), digest(2).alias("b")).agg(F.min(F.struct(FILE, AT)).alias("p")), "chat-turns")
    # texts break ties between turns of one number and role, of which there are few: only theirs move
    tied = short.groupBy("conv_id", "turn", "role").agg(F.count(F.lit(1)).alias("n"), F.collect_list("p").alias("ps")).where("n > 1").select(F.explode("ps").alias("p"))
    texts = attach(turns, tied.select(F.col(f"p.{FILE}").alias("file"), F.col(f"p.{AT}").alias("at"), F.lit(True).alias("value")), "__tied").where("__tied").select(F.struct(FILE, AT).alias("p"), "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "a", "b")
    k = short.join(texts, "p", "left").withColumn("k", F.row_number().over(order))
    k = k.select("conv_id", "k", F.xxhash64("k", "a", "b").cast("decimal(38,0)").alias("a"), F.xxhash64("k", "b", "a", F.lit(7)).cast("decimal(38,0)").alias("b"))
    upto = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id")
    return k.select("conv_id", "k", F.sum("a").over(upto).alias("h1"), F.sum("b").over(upto).alias("h2"), F.count(F.lit(1)).over(whole).alias("n"))


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id): the conversations that are no proper prefix of another, one of each set of equal ones."""
    hashes = materialise(prefix_hashes(conversations), "chat-prefixes")
    full = hashes.where("k = n").groupBy("k", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    # a beginning that very many have, as a system prompt, is one row after the partial aggregation
    inner = hashes.where("k < n").select("k", "h1", "h2").distinct()
    return full.join(inner, ["k", "h1", "h2"], "left_anti").select("conv_id")


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, chat): the maximal conversations in a markup of turns."""
    conversations = conversations if _is_scan(conversations) else materialise(conversations, "rows")
    turns = _turns(conversations).select("conv_id", "turn", "role", "text").distinct().join(maximal(conversations), "conv_id", "left_semi")
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text"))).alias("ts"))
    render = F.array_join(F.transform("ts", lambda t: F.concat(F.lit("<|im_start|>"), F.replace(t["role"], F.lit("<|"), F.lit("< |")), F.lit("\n"), F.replace(t["text"], F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>\n"))), "")
    return chats.select("conv_id", F.size("ts").cast("bigint").alias("n_turns"), render.alias("chat"))


def sql() -> str:
    """In DuckDB SQL, on the turns themselves."""
    return """WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS ts FROM t GROUP BY conv_id),
    p AS (SELECT DISTINCT list_slice(ts, 1, k) AS pre FROM (SELECT ts, unnest(range(1, len(ts))) AS k FROM c)),
    m AS (SELECT ts, min(conv_id) AS conv_id FROM c GROUP BY ts),
    k AS (SELECT m.* FROM m WHERE ts NOT IN (SELECT pre FROM p))
    SELECT conv_id, len(ts)::BIGINT AS n_turns, list_aggregate(list_transform(ts, lambda x: '<|im_start|>' || replace(x.role, '<|', '< |') || chr(10) || replace(x.text, '<|', '< |') || '<|im_end|>' || chr(10)), 'string_agg', '') AS chat FROM k"""
