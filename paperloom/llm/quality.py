"""Quality rules whose cutoffs come from mergeable quantile sketches per language and source.

Every document gives five integer metrics, worked out in one pass and written to the shared folder. A sketch is a histogram over
buckets that are exact up to 1023 and have a
relative width of 1/512 above; sketches merge by adding counts, so partial ones combine on the map side, and those of
sources add up to that of a language and of the corpus. A group's cutoffs lie ``RULES`` times its own spread from its median: the
spread is the way from the median to the first of the tail quantiles (80, 90, 99, 99.9 %) that differs from it. A metric
without any spread cuts nothing. A group of fewer than ``min_docs`` documents takes the cutoffs of its language, or else of the corpus.

A ratio over few tokens scatters more, so for texts below ``REF`` tokens (or characters) cutoffs widen with the square root
of the lack; no text is exempt. Texts below ``MIN_CHARS`` characters are judged but don't enter the sketches.

Defined results: a null or empty text, or one of blanks, holds no token and is rejected. Null languages and sources form the
group ''. Equal rows are judged alike and all kept or all rejected. An empty table gives an empty one. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import AT, FILE, ROW, _is_scan, attach, join_sized, located, materialise, unpacked

#: metric -> (spreads below the median, above it; None: no cutoff on that side). Set on half of the labels of sf0.1.
RULES = {
    "symbols": (None, 6.5),
    "uppers": (None, 9.0),
    "word_len": (7.0, 8.0),
    "uniq": (4.0, None),
    "repeated_lines": (None, 1.0),
}
#: What a metric is a ratio over, and so much of it as a text must have for cutoffs not to be widened.
REF = {"symbols": ("chars", 1200.0), "uppers": ("chars", 1200.0), "word_len": ("words", 200.0), "uniq": ("words", 200.0), "repeated_lines": ("words", 200.0)}
#: Tails, per mille, that a spread may reach to.
TAILS = (800, 900, 990, 999)
MIN_CHARS = 100
MIN_DOCS = 100


def bucket(v: Column) -> Column:
    return v - v % F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.length(F.bin(v)) - 10, F.lit(0)))


def measured(docs: DataFrame) -> DataFrame:
    """(__file, __at, lang, source, words, chars, and a column for each metric) of every row, written to the shared folder. Shares are in
    1/1024, the mean token length in 1/16 character; all in buckets."""
    text = F.col(f"{ROW}.text")
    lang, source = (F.coalesce(F.col(f"{ROW}.{c}").cast("string"), F.lit("")) for c in ("lang", "source"))
    tokens = F.array_remove(F.split(text, "[ \\t\\n\\r]+"), "")
    # a generator keeps what metrics share from being worked out for each of them
    once = F.explode(F.array(F.struct(tokens.alias("ts"), F.length(text).cast("bigint").alias("chars"), F.split(text, "\n").alias("lines"))))
    rows = located(docs).select(FILE, AT, lang.alias("lang"), source.alias("source"), text.alias("text"), once.alias("o"))
    share = lambda a, b: F.call_function("div", a.cast("bigint") * 1024, F.greatest(b.cast("bigint"), F.lit(1).cast("bigint")))
    words, chars = F.coalesce(F.size("o.ts"), F.lit(0)).cast("bigint"), F.coalesce("o.chars", F.lit(0)).cast("bigint")
    metrics = {
        "symbols": share(F.length(F.regexp_replace("text", "[\\p{L}\\p{N} \\t\\n\\r]+", "")), chars),
        "uppers": share(F.regexp_count("text", F.lit("\\p{Lu}")), chars),
        "word_len": F.call_function("div", F.length(F.array_join("o.ts", "")).cast("bigint") * 16, F.greatest(words, F.lit(1).cast("bigint"))),
        "uniq": share(F.size(F.array_distinct("o.ts")), words),
        "repeated_lines": F.lit(1024).cast("bigint") - share(F.size(F.array_distinct("o.lines")), F.size("o.lines")),
    }
    counted = rows.select(FILE, AT, "lang", "source", F.greatest(words, F.lit(0).cast("bigint")).alias("words"), chars.alias("chars"), *[c.alias(k) for k, c in metrics.items()])
    return materialise(counted.select(FILE, AT, "lang", "source", "words", "chars", *[bucket(F.col(k)).alias(k) for k in metrics]), "quality-metrics")


def sketches(metrics: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(lang, source, metric, bucket, n): one mergeable sketch per language, source and metric."""
    rows = metrics.where((F.col("words") > 0) & (F.col("chars") >= min_chars))
    rows = rows.select("lang", "source", F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("bucket")) for k in RULES])).alias("m"))
    return rows.groupBy("lang", "source", "m.metric", "m.bucket").agg(F.count(F.lit(1)).alias("n"))


def thresholds(metrics: DataFrame, sketch: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, cut): each group's median and spreads of each metric, from its own sketch or a merged one."""
    merged = sketch.groupingSets([["lang", "source", "metric", "bucket"], ["lang", "metric", "bucket"], ["metric", "bucket"]], "lang", "source", "metric", "bucket").agg(F.sum("n").alias("n"), F.grouping_id("lang", "source", "metric", "bucket").alias("gid"))
    merged = merged.select(F.when(F.col("gid") >= 8, 2).when(F.col("gid") >= 4, 1).otherwise(0).alias("level"), "lang", "source", "metric", "bucket", "n")
    whole = Window.partitionBy("level", "lang", "source", "metric")
    sums = merged.withColumn("upto", F.sum("n").over(whole.orderBy("bucket"))).withColumn("all", F.sum("n").over(whole))
    at = lambda share: F.min(F.when(F.col("upto") * 1000 >= F.col("all") * share, F.col("bucket")))
    q = sums.groupBy("level", "lang", "source", "metric").agg(F.max("all").alias("n"), at(500).alias("mid"), *[at(t).alias(f"q{t}") for t in TAILS], *[at(1000 - t).alias(f"q{1000 - t}") for t in TAILS])
    over = F.coalesce(*[F.when(F.col(f"q{t}") > F.col("mid"), F.col(f"q{t}") - F.col("mid")) for t in TAILS])
    under = F.coalesce(*[F.when(F.col(f"q{1000 - t}") < F.col("mid"), F.col("mid") - F.col(f"q{1000 - t}")) for t in TAILS])
    q = q.select("level", "lang", "source", "metric", "n", F.struct("mid", over.alias("over"), under.alias("under")).alias("s"))
    wide = materialise(q.groupBy("level", "lang", "source").agg(F.max("n").alias("n"), *[F.max(F.when(F.col("metric") == k, F.col("s"))).alias(k) for k in RULES]), "quality-levels")
    cut = lambda level: wide.where(F.col("level") == level).select(*(["lang", "source"], ["lang"], [])[level], F.struct("n", *RULES).alias(f"l{level}"))
    groups = metrics.select("lang", "source").distinct()
    every = groups.join(cut(0), ["lang", "source"], "left").join(cut(1), "lang", "left").join(F.broadcast(cut(2)), F.lit(True), "left")
    pick = F.when(F.col("l0.n") >= min_docs, F.col("l0")).when(F.col("l1.n") >= min_docs, F.col("l1")).otherwise(F.col("l2"))
    return materialise(every.select("lang", "source", pick.alias("cut")), "quality-cuts")


def _breaks(k: str) -> Column:
    """Whether a metric lies too far from its group's median."""
    name, ref = REF[k]
    n = F.col(name).cast("double")
    far = (F.col(k) - F.col(f"cut.{k}.mid")).cast("double")
    out = F.lit(False)
    for times, spread, way in ((RULES[k][0], "under", -1), (RULES[k][1], "over", 1)):
        if times is not None:
            width = F.lit(times) * F.col(f"cut.{k}.{spread}").cast("double")
            out = out | F.coalesce((far * way > 0) & (far * far * n > width * width * F.greatest(n, F.lit(ref))), F.lit(False))
    return out


def rejected(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(__file, __at) of the rows that hold no token or break a cutoff."""
    metrics = measured(docs)
    joined = join_sized(metrics, thresholds(metrics, sketches(metrics), min_docs), ["lang", "source"], "left")
    bad = F.col("words") == 0
    for k in RULES:
        bad = bad | _breaks(k)
    return joined.where(bad).select(FILE, AT)


def quality_filter(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents that break none of their group's cutoffs, with their columns as they came."""
    docs = docs if _is_scan(docs) else materialise(docs, "rows")
    gone = rejected(docs, min_docs).select(F.col(FILE).alias("file"), F.col(AT).alias("at"), F.lit(True).alias("value"))
    return unpacked(attach(located(docs), gone, "__gone").where("__gone IS NULL"), docs.columns)


_M = {
    "symbols": "length(regexp_replace(text, '[\\p{L}\\p{N} \\t\\n\\r]+', '', 'g'))::BIGINT * 1024 // greatest(length(text), 1)",
    "uppers": "length(regexp_replace(text, '[^\\p{Lu}]+', '', 'g'))::BIGINT * 1024 // greatest(length(text), 1)",
    "word_len": "length(regexp_replace(text, '[ \\t\\n\\r]+', '', 'g'))::BIGINT * 16 // greatest(words, 1)",
    "uniq": "len(list_distinct(regexp_extract_all(text, '[^ \\t\\n\\r]+')))::BIGINT * 1024 // greatest(words, 1)",
    "repeated_lines": "1024 - len(list_distinct(string_split(text, chr(10))))::BIGINT * 1024 // len(string_split(text, chr(10)))",
}


def sql(min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> str:
    """The same in DuckDB SQL, over the view ``documents``."""
    hdr = lambda e: f"({e}) - ({e}) % (1::BIGINT << greatest(length(bin({e})) - 10, 0))"
    ms = ", ".join(f"{hdr(e)} AS {k}" for k, e in _M.items())
    longs = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS metric, {k} AS b FROM m WHERE chars >= {min_chars}" for k in RULES)
    at = lambda share: f"min(b) FILTER (cum * 1000 >= tot * {share})"
    over = ", ".join(f"CASE WHEN q{t} > mid THEN q{t} - mid END" for t in TAILS)
    under = ", ".join(f"CASE WHEN q{1000 - t} < mid THEN mid - q{1000 - t} END" for t in TAILS)
    levels = ", ".join(
        f"""c{i} AS (SELECT {keys} metric, n, {{'mid': mid, 'over': coalesce({over}), 'under': coalesce({under})}} AS s FROM (SELECT {keys} metric, max(tot) AS n, {at(500)} AS mid, {", ".join(f"{at(t)} AS q{t}" for x in TAILS for t in (x, 1000 - x))} FROM (
        SELECT {keys} metric, b, sum(n) OVER (PARTITION BY {keys} metric ORDER BY b) AS cum, sum(n) OVER (PARTITION BY {keys} metric) AS tot FROM (
        SELECT {keys} metric, b, count(*) AS n FROM l GROUP BY ALL)) GROUP BY ALL))"""
        for i, keys in enumerate(("lang, source,", "lang,", ""))
    )
    tests = []
    for k, (low, high) in RULES.items():
        n, ref = REF[k]
        for times, spread, sign in ((low, "under", "<"), (high, "over", ">")):
            if times is not None:
                tests.append(f"(metric = '{k}' AND {k} {sign} s.mid AND ({k} - s.mid)::DOUBLE * ({k} - s.mid)::DOUBLE * {n}::DOUBLE > ({times}::DOUBLE * s.{spread}::DOUBLE) * ({times}::DOUBLE * s.{spread}::DOUBLE) * greatest({n}::DOUBLE, {ref}::DOUBLE))")
    return f"""WITH d AS (SELECT *, row_number() OVER () AS rid, len(regexp_extract_all(text, '[^ \\t\\n\\r]+')) AS words FROM documents),
    m AS (SELECT rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, words, length(text) AS chars, {ms} FROM d WHERE words > 0),
    l AS ({longs}), {levels},
    g AS (SELECT DISTINCT lang, source, metric FROM m, (SELECT unnest([{", ".join(f"'{k}'" for k in RULES)}]) AS metric)),
    f AS (SELECT g.*, CASE WHEN c0.n >= {min_docs} THEN c0.s WHEN c1.n >= {min_docs} THEN c1.s ELSE c2.s END AS s
        FROM g LEFT JOIN c0 ON c0.lang = g.lang AND c0.source = g.source AND c0.metric = g.metric LEFT JOIN c1 ON c1.lang = g.lang AND c1.metric = g.metric LEFT JOIN c2 ON c2.metric = g.metric),
    bad AS (SELECT DISTINCT rid FROM m JOIN f ON m.lang = f.lang AND m.source = f.source WHERE {" OR ".join(tests)})
    SELECT doc_id, text, lang, source, n_chars FROM d WHERE words > 0 AND rid NOT IN (SELECT rid FROM bad)"""
