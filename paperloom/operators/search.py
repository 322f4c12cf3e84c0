"""Search over records: filter expressions, facets, BM25, vectors, fusion, captions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.figures import cosine

K1, B = 1.2, 0.75
WORD = "[a-z0-9äöüßéèêàçôûùîïñáíóúœ]+"

# -- filter expressions --

_LEX = re.compile(r"\s*(?:(?P<str>'(?:[^']|'')*')|(?P<num>-?\d+(?:\.\d+)?(?![\w:-]))|(?P<time>\d{4}-\d\d-\d\d(?:T[\d:.]+Z?)?)|(?P<name>[A-Za-z_][\w./]*)|(?P<sign>[(),:]))")
_COMPARE = {"eq": "__eq__", "ne": "__ne__", "lt": "__lt__", "le": "__le__", "gt": "__gt__", "ge": "__ge__"}


class _Parser:
    """or < and < not < comparison | contains(f, 'x') | field/any(v: ...) | (...)"""

    def __init__(self, text: str, columns: list[str] | None = None):
        self.toks: list[tuple[str, str]] = []
        at = 0
        while at < len(text.rstrip()):
            m = _LEX.match(text, at)
            if not m:
                raise ValueError(f"can't read {text[at:]!r}")
            self.toks.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.i, self.columns = 0, columns
        self.bound: dict[str, Column] = {}

    def peek(self, n: int = 0) -> tuple[str, str]:
        return self.toks[self.i + n] if self.i + n < len(self.toks) else ("end", "")

    def take(self, value: str | None = None) -> tuple[str, str]:
        t = self.peek()
        if value is not None and t[1] != value:
            raise ValueError(f"{value!r} should stand where {t[1]!r} does")
        self.i += 1
        return t

    def parse(self) -> Column:
        c = self.either()
        if self.peek()[0] != "end":
            raise ValueError(f"{self.peek()[1]!r} is left over")
        return c

    def either(self) -> Column:
        c = self.both()
        while self.peek() == ("name", "or"):
            self.take()
            c = c | self.both()
        return c

    def both(self) -> Column:
        c = self.single()
        while self.peek() == ("name", "and"):
            self.take()
            c = c & self.single()
        return c

    def single(self) -> Column:
        kind, value = self.peek()
        if (kind, value) == ("name", "not"):
            self.take()
            return ~self.single()
        if value == "(":
            self.take()
            c = self.either()
            self.take(")")
            return c
        if (kind, value) == ("name", "contains") and self.peek(1)[1] == "(":
            self.take()
            self.take("(")
            a = self.operand()
            self.take(",")
            b = self.operand()
            self.take(")")
            return F.contains(a, b)
        if kind == "name" and value.endswith(("/any", "/all")) and self.peek(1)[1] == "(":
            self.take()
            self.take("(")
            name, how = value.rsplit("/", 1)
            of = self.field(name)
            if self.peek()[1] == ")":
                self.take()
                return F.size(of) > 0
            var = self.take()[1]
            self.take(":")
            start = self.i

            def test(x: Column) -> Column:
                self.i = start
                self.bound[var] = x
                c = self.either()
                del self.bound[var]
                return c

            out = (F.exists if how == "any" else F.forall)(of, test)
            self.take(")")
            return out
        left = self.operand()
        op = self.peek()
        if op[0] != "name" or op[1] not in _COMPARE:
            return left  # a boolean field alone
        self.take()
        if self.peek() == ("name", "null"):
            self.take()
            return {"eq": left.isNull(), "ne": left.isNotNull()}[op[1]]
        return getattr(left, _COMPARE[op[1]])(self.operand())

    def field(self, name: str) -> Column:
        if self.columns is not None and name.split("/")[0] not in self.columns:
            raise ValueError(f"there is no field {name}")
        return F.col(name.replace("/", "."))

    def operand(self) -> Column:
        kind, value = self.take()
        if kind == "str":
            return F.lit(value[1:-1].replace("''", "'"))
        if kind == "num":
            return F.lit(float(value) if "." in value else int(value))
        if kind == "time":
            return F.lit(value).cast("timestamp")
        if kind == "name" and value in ("true", "false"):
            return F.lit(value == "true")
        if kind == "name":
            return self.bound[value] if value in self.bound else self.field(value)
        raise ValueError(f"{value!r} is no operand")


def parse_filter(text: str, columns: list[str] | None = None) -> Column:
    """A filter expression as a column: eq ne lt le gt ge, and or not, contains, any, all, null, true, false."""
    return _Parser(text, columns).parse()


def escape_literal(value: str) -> str:
    return value.replace("'", "''")


def safe_token(value: str) -> str:
    """The value, if it can stand in a filter as it is; else ''."""
    return value if re.fullmatch(r"[\w-]+", value or "", re.ASCII) else ""


# -- facets --


def facet(df: DataFrame, name: str, top: int | None = 10) -> DataFrame:
    """(value, count), the most frequent first, equals by value; a list counts each of its values once a row."""
    is_list = df.schema[name].dataType.typeName() == "array"
    values = df.select(F.explode(F.array_distinct(name)).alias("value")) if is_list else df.select(F.col(name).alias("value"))
    counts = values.where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value")
    return counts.limit(top) if top else counts


# -- scoring --


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _count(list_: str, term: str) -> Column:
    return F.size(F.filter(list_, lambda t: t == term))


def bm25(docs: DataFrame, query: str, key: str, text: str = "text", weights: dict[str, float] | None = None) -> DataFrame:
    """(key, score) of documents with a term of the query. One pass counts the query's terms in each document and the
    lengths, without exploding texts; document frequencies and the mean length are then one row."""
    wanted = sorted(set(re.findall(WORD, query.lower())))
    fields = weights or {text: 1.0}
    out: DataFrame | None = None
    for name, weight in fields.items():
        counted = docs.select(key, terms(F.coalesce(F.col(name), F.lit(""))).alias("ts")).select(key, F.size("ts").alias("n"), *[_count("ts", w).alias(f"tf{i}") for i, w in enumerate(wanted)])
        stats = counted.agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(wanted))])
        parts = []
        for i in range(len(wanted)):
            tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
            idf = F.log(1 + (F.col("docs") - df + 0.5) / (df + 0.5))
            parts.append(idf * (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * F.col("n") / F.col("mean"))))
        hit = F.greatest(*[F.col(f"tf{i}") for i in range(len(wanted))], F.lit(0), F.lit(0)) > 0
        scored = counted.where(hit).crossJoin(F.broadcast(stats)).select(key, (sum(parts, F.lit(0.0)) * weight).alias("score"))
        out = scored if out is None else out.unionByName(scored)
    return out.groupBy(key).agg(F.sum("score").alias("score")) if len(fields) > 1 else out


def top(scored: DataFrame, key: str, k: int, score: str = "score") -> DataFrame:
    return scored.orderBy(F.desc(score), key).limit(k)


def vector_scores(df: DataFrame, query: list[float], key: str, vector: str = "embedding") -> DataFrame:
    """(key, score): the cosine of every vector with the query's."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return df.where(F.size(vector) == len(query)).select(key, cosine(F.col(vector), q).alias("score"))


def fuse(rankings: list[DataFrame], key: str, k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of short rankings (key, score): the sum of 1 / (k + rank)."""
    out = None
    for r in rankings:
        ranked = r.select(key, F.row_number().over(Window.orderBy(F.desc("score"), key)).alias("rank"))
        out = ranked if out is None else out.unionByName(ranked)
    return out.groupBy(key).agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"))


def rerank(hits: DataFrame, query: str, fields: dict[str, float], window: int = 50, key: str = "id") -> DataFrame:
    """The first ``window`` hits by the share of the query's terms in each field, weighted; then by the score they had."""
    wanted = F.array(*[F.lit(w) for w in sorted(set(re.findall(WORD, query.lower())))])
    share = sum((F.size(F.array_intersect(terms(F.coalesce(F.col(f), F.lit(""))), wanted)) / F.size(wanted) * w for f, w in fields.items()), F.lit(0.0))
    return top(hits, key, window).withColumn("rerank", share).orderBy(F.desc("rerank"), F.desc("score"), key)


def caption(text: Column, query: str) -> Column:
    """The sentence with most of the query's terms, the first of equals."""
    wanted = F.array(*[F.lit(w) for w in sorted(set(re.findall(WORD, query.lower())))])
    sentences = F.filter(F.transform(F.split(text, "(?<=[.!?])\\s+|\\n"), F.trim), lambda s: s != "")
    scored = F.transform(sentences, lambda s, i: F.struct((-F.size(F.array_intersect(terms(s), wanted))).alias("n"), i.alias("i"), s.alias("s")))
    return F.array_min(scored)["s"]


@dataclass
class SearchRequest:
    """A search: words, a vector, a filter, facets, fields to return, and how many."""

    search: str = ""
    vector: list[float] | None = None
    filter: str = ""
    facets: list[str] = field(default_factory=list)
    select: list[str] = field(default_factory=list)
    top: int = 10
    window: int = 50


def matching(records: DataFrame, filter_: str = "") -> DataFrame:
    """The records that a filter lets through; all of them without one."""
    return records.where(parse_filter(filter_, records.columns)) if filter_ else records


def count(found: DataFrame) -> DataFrame:
    """(count): the number of all that is found, beside the hits and facets."""
    return found.agg(F.count(F.lit(1)).alias("count"))


def search(records: DataFrame, request: SearchRequest, key: str = "id", text: str = "chunk", vector: str = "embedding") -> tuple[DataFrame, dict[str, DataFrame]]:
    """The hits, best first, with ``score``, of equal ones those with the better chunk_quality_score; and the facets over all that the
    filter lets through."""
    rows = matching(records, request.filter)
    rankings = []
    if request.search:
        rankings.append(top(bm25(rows, request.search, key, text), key, request.window))
    if request.vector is not None:
        rankings.append(top(vector_scores(rows, request.vector, key, vector), key, request.window))
    if not rankings:
        hits = rows.orderBy(key).limit(request.top).withColumn("score", F.lit(1.0))
    else:
        scored = fuse(rankings, key) if len(rankings) > 1 else rankings[0]
        best = top(scored, key, request.top)
        quality = [F.desc("chunk_quality_score")] if "chunk_quality_score" in rows.columns else []
        hits = rows.join(F.broadcast(best), key).orderBy(F.desc("score"), *quality, key)
    fields = request.select or records.columns
    return hits.select(*fields, "score"), {f: facet(rows, f) for f in request.facets}
