"""Tables of a layout: continuations, grids with spans, headers, Markdown, row texts, bounded splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import let

MAX_ROWS, MAX_COLS = 5000, 200
CHUNK = 3000
ROW_RECORDS = (5, 5000)


def clusters(tables: DataFrame) -> DataFrame:
    """Adds ``cluster``, from 0 per document: a table goes on with the one before it if it starts on the page after its
    last, has as many columns and no caption. Tables are in the order of first page, then position."""
    order = Window.partitionBy("doc").orderBy("first_page", "pos")
    before = lambda c: F.lag(c).over(order)
    goes_on = (before("last_page") + 1 == F.col("first_page")) & (before("cols") == F.col("cols")) & (F.coalesce(F.trim("caption"), F.lit("")) == "")
    starts = tables.withColumn("__starts", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    return starts.withColumn("cluster", F.sum("__starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1).drop("__starts")


def escape(text: Column) -> Column:
    return F.trim(F.replace(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\r\\n]+", " "), F.lit("|"), F.lit("\\|")))


def grid_cells(cells: DataFrame) -> DataFrame:
    """(table_id, row, col, text) of cells (table_id, pos, r, c, rs, cs, text) of tables of ``rows`` by ``cols``: spans repeat
    their text, the later cell wins, what lies outside falls away; too large tables give nothing."""
    upto = lambda at, span: F.sequence(F.col(at), F.col(at) + F.greatest(F.coalesce(F.col(span), F.lit(1)), F.lit(1)) - 1)
    fit = cells.where((F.col("rows") <= MAX_ROWS) & (F.col("cols") <= MAX_COLS))
    each = fit.select("table_id", "pos", "rows", "cols", "text", F.explode(upto("r", "rs")).alias("row"), "c", "cs").select("*", F.explode(upto("c", "cs")).alias("col"))
    inside = each.where("row BETWEEN 0 AND rows - 1 AND col BETWEEN 0 AND cols - 1")
    return inside.groupBy("table_id", "row", "col").agg(escape(F.max_by("text", F.struct("pos", "text"))).alias("text"))


def grids(cells: DataFrame) -> DataFrame:
    """(table_id, grid): the full grid of each table, '' where no cell is. Cells are shuffled once, as they come; the places that spans fill
    are spread and settled within their table, in one sort."""
    first = lambda at: F.greatest(F.col(at), F.lit(0))
    last = lambda at, span, n: F.least(F.col(at) + F.greatest(F.coalesce(F.col(span), F.lit(1)), F.lit(1)) - 1, F.col(n) - 1)
    box = F.struct(first("r").alias("r0"), last("r", "rs", "rows").alias("r1"), first("c").alias("c0"), last("c", "cs", "cols").alias("c1"), "pos", "text")
    fit = (F.col("rows") <= MAX_ROWS) & (F.col("cols") <= MAX_COLS) & F.col("r").isNotNull() & F.col("c").isNotNull() & (box["r0"] <= box["r1"]) & (box["c0"] <= box["c1"])
    each = cells.where("table_id IS NOT NULL").groupBy("table_id").agg(F.max("rows").alias("rows"), F.max("cols").alias("cols"), F.collect_list(F.when(fit, box)).alias("cells")).where(F.size("cells") > 0)
    place = lambda k, cell, pos, text: F.struct(k.cast("bigint").alias("k"), F.lit(cell).alias("cell"), pos.cast(cells.schema["pos"].dataType).alias("pos"), text.cast("string").alias("text"))
    line = lambda x, r: F.transform(F.sequence(x["c0"], x["c1"]), lambda c: place(r * F.col("cols") + c, 1, x["pos"], x["text"]))
    filled = F.flatten(F.transform("cells", lambda x: F.flatten(F.transform(F.sequence(x["r0"], x["r1"]), lambda r: line(x, r)))))
    blank = F.transform(F.sequence(F.lit(0), F.col("rows") * F.col("cols") - 1), lambda k: place(k, 0, F.lit(None), F.lit(None)))
    # the last of a place wins, so any cell before the blank
    won = let(F.sort_array(F.concat(blank, filled)), lambda ps: F.filter(ps, lambda x, i: F.coalesce(F.get(ps, i + 1)["k"] != x["k"], F.lit(True))))
    texts = F.transform(won, lambda x: F.when(x["cell"] == 0, "").otherwise(escape(x["text"])))
    return each.select("table_id", let(texts, lambda ts: F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: F.slice(ts, r * F.col("cols") + 1, F.col("cols")))).alias("grid"))


def header_rows(cells: DataFrame) -> DataFrame:
    """(table_id, header_rows): how many leading rows have at least half of their cells marked as column headers; 1 if none."""
    share = cells.groupBy("table_id", "r").agg((F.count_if(F.col("kind") == "columnHeader") * 2 >= F.count(F.lit(1))).alias("is_header"))
    first_other = share.groupBy("table_id").agg(F.min(F.when(~F.col("is_header"), F.col("r"))).alias("other"), (F.max("r") + 1).alias("all"))
    return first_other.select("table_id", F.greatest(F.coalesce("other", "all"), F.lit(1)).alias("header_rows"))


def fold_headers(grid: Column, header_rows: Column) -> Column:
    """A header for each column: the header rows' texts from the top, without blanks and immediate repeats."""
    heads = F.slice(grid, F.lit(1), header_rows)

    def one(c: Column) -> Column:
        texts = F.filter(F.transform(heads, lambda row: F.get(row, c)), lambda x: F.coalesce(x, F.lit("")) != "")
        return F.array_join(F.aggregate(texts, F.array().cast("array<string>"), lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1) == x), acc).otherwise(F.concat(acc, F.array(x)))), " — ")

    return F.transform(F.sequence(F.lit(0), F.size(grid[0]) - 1), one)


def markdown(grid: Column, heads: Column, header_rows: Column) -> Column:
    line = lambda row: F.concat(F.lit("| "), F.array_join(row, " | "), F.lit(" |"))
    rule = line(F.transform(heads, lambda _: F.lit("---")))
    body = F.slice(grid, header_rows + 1, F.greatest(F.size(grid) - header_rows, F.lit(0)))
    return F.array_join(F.concat(F.array(line(heads), rule), F.transform(body, line)), "\n")


def row_text(heads: Column, values: Column) -> Column:
    """'Header: value; ...' without empty values; a value without a header stands alone."""
    parts = F.zip_with(heads, values, lambda h, v: F.when(F.coalesce(v, F.lit("")) == "", F.lit(None)).when(F.coalesce(h, F.lit("")) == "", v).otherwise(F.concat(h, F.lit(": "), v)))
    return F.array_join(F.array_compact(parts), "; ")


def split_rows(rows: Column, head_length: Column, limit: int = CHUNK) -> Column:
    """Rows in parts that stay, with their head, within the limit; a row too long for it is a part alone."""
    acc = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast("array<string>").alias("now"), head_length.cast("int").alias("size"))

    def add(a: Column, row: Column) -> Column:
        n = F.length(row) + 1
        full = (a["size"] + n > limit) & (F.size(a["now"]) > 0)
        return F.struct(
            F.when(full, F.concat(a["done"], F.array(a["now"]))).otherwise(a["done"]).alias("done"),
            F.when(full, F.array(row)).otherwise(F.concat(a["now"], F.array(row))).alias("now"),
            (F.when(full, head_length.cast("int")).otherwise(a["size"]) + n).alias("size"),
        )

    return F.aggregate(rows, acc, add, lambda a: F.when(F.size(a["now"]) > 0, F.concat(a["done"], F.array(a["now"]))).otherwise(a["done"]))


def merge_continuations(tables: DataFrame) -> DataFrame:
    """(doc, cluster, header_rows, heads, body, page_start, page_end) of tables (doc, pos, first_page, last_page, cols, caption, grid,
    header_rows): the parts of a cluster in order; a part's header block that equals the first one's falls away. Each
    body row carries the page of its part: struct<page, values>."""
    first = Window.partitionBy("doc", "cluster").orderBy("first_page", "pos")
    t = clusters(tables).withColumn("__head", F.first("grid").over(first)).withColumn("__n", F.first("header_rows").over(first)).withColumn("__at", F.row_number().over(first))
    again = (F.col("__at") == 1) | (F.slice("grid", F.lit(1), F.col("__n")) == F.slice("__head", F.lit(1), F.col("__n")))
    body = F.when(again, F.slice("grid", F.col("__n") + 1, F.greatest(F.size("grid") - F.col("__n"), F.lit(0)))).otherwise(F.col("grid"))
    part = F.struct("first_page", "pos", F.transform(body, lambda row: F.struct(F.col("first_page").alias("page"), row.alias("values"))).alias("rows"))
    merged = t.groupBy("doc", "cluster").agg(F.first("__head").alias("head"), F.first("__n").alias("header_rows"), F.array_sort(F.collect_list(part)).alias("parts"), F.max_by("caption", F.struct(-F.col("__at"))).alias("caption"), F.min("first_page").alias("page_start"), F.max_by("last_page", "__at").alias("page_end"))
    return merged.select("doc", "cluster", "caption", "header_rows", fold_headers(F.col("head"), F.col("header_rows")).alias("heads"), F.flatten(F.transform("parts", lambda p: p["rows"])).alias("body"), "page_start", "page_end")


def table_records(merged: DataFrame) -> DataFrame:
    """A row for each split of a merged table: table_index '<cluster>_<split>', markdown, row_count, col_count."""
    line = lambda row: F.concat(F.lit("| "), F.array_join(row, " | "), F.lit(" |"))
    head = F.concat(line(F.col("heads")), F.lit("\n"), line(F.transform("heads", lambda _: F.lit("---"))))
    t = merged.withColumn("__head", head).withColumn("__lines", F.transform("body", lambda b: line(b["values"])))
    parts = t.select("*", F.posexplode(split_rows(F.col("__lines"), F.length("__head") + 1, CHUNK)).alias("split", "__part"))
    return parts.select("doc", "cluster", "split", F.concat_ws("_", F.col("cluster").cast("string"), F.col("split").cast("string")).alias("table_index"), "caption", "page_start", "page_end", F.concat_ws("\n", "__head", F.array_join("__part", "\n")).alias("markdown"), F.size("__part").alias("row_count"), F.size("heads").alias("col_count"))


def row_records(merged: DataFrame) -> DataFrame:
    """A row for each body row of tables of 5 to 5000 of them; they belong to the table's first split."""
    some = merged.where(F.size("body").between(*ROW_RECORDS))
    rows = some.select("doc", "cluster", "heads", F.posexplode("body").alias("row_index", "b"))
    return rows.select("doc", F.concat_ws("_", F.col("cluster").cast("string"), F.lit("0")).alias("table_index"), "row_index", F.col("b.page").alias("page"), row_text(F.col("heads"), F.col("b.values")).alias("row_text"))
