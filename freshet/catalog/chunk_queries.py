"""Documents to chunks, by type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.catalog.event_queries import ROUTE_SQL
from freshet.catalog.inputs import (
    CONFIG, DOCS, MARKDOWN, PLAIN, WS_CLASS, WS_SQL, exploded_sql, object_uri_sql, plain_chunks_sql, strip_sql, table,
    windows_sql,
)
from freshet.catalog.registry import Query
from freshet.functions import text as tx
from freshet.functions.arrays import elements
from freshet.operators import extras
from freshet.operators.chunking import (
    Chunkers, chunk_by_type, chunk_documents, chunk_lines, chunk_pages, csv_pieces, finish, markdown_pieces,
    plain_pieces, text_pieces,
)
from freshet.operators.routing import identify
from freshet.operators.tabular import chunk_rows

def _identified(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "doc_id": tx.document_id(F.col("source_uri")),
            "doc_content_hash": tx.content_hash(F.col("body")),
        }
    )


def plain_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged chunks of the documents as plain text; knows no JSON, so nothing leaves the JVM."""
    docs = _identified(PLAIN.spark(spark, sf_dir))
    pieces = plain_pieces(F.col("body"), F.lit(None), CONFIG)
    return finish(docs.withColumn("pieces", pieces), extractor=F.lit("text"))


CHUNK_COLUMNS = ("doc_id", "chunk_id", "ordinal", "text", "content_hash", "doc_content_hash", "source_uri")


def chunk_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_chunks(spark, sf_dir).select(*CHUNK_COLUMNS)


PLAIN_CHUNKS_SQL = plain_chunks_sql(f"({PLAIN.sql})")


def chunk_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = MARKDOWN.spark(spark, sf_dir)
    pieces = markdown_pieces(F.col("text"), F.lit(None), CONFIG)
    return docs.select("doc_id", elements(pieces).alias("ordinal", "p")).select(
        "doc_id", "ordinal", F.col("p.heading").alias("heading"), F.col("p.text").alias("text")
    )


# Sections of a markdown text: the part before the first heading, then each heading with its body.
_HEAD = f"(?m)^(#{{1,6}}){WS_CLASS}+(.*)$"


def markdown_sql(source: str, key: str, text: str = "text") -> str:
    """(key, heading, text, ordinal): windows of all sections in order."""
    return f"""
    with s0 as (select {key}, {text} as t from {source}),
    s1 as (select {key}, regexp_extract_all(t, '{_HEAD}', 0) as m, regexp_extract_all(t, '{_HEAD}', 2) as h,
           string_split_regex(t, '{_HEAD}') as p from s0),
    s2 as (select {key}, 0 as sec, null as heading, p[1] as body from s1 where p[1] <> ''
           union all select {key}, unnest(range(1, len(m)+1)) as sec,
           unnest(list_transform(h, lambda x: nullif({strip_sql('x')}, ''))) as heading,
           unnest(list_transform(range(1, len(m)+1), lambda i: m[i]||p[i+1])) as body from s1),
    s3 as (select {key}, sec, heading, {strip_sql('body')} as t from s2),
    s4 as (select {key}, sec, heading, {windows_sql('t')} as w from s3),
    s5 as (select {key}, sec, heading, unnest(w) as text, generate_subscripts(w, 1) as i from s4)
    select {key}, heading, text, cast(row_number() over (partition by {key} order by sec, i) - 1 as int) as ordinal
    from s5
    """


PAGE_CHARS = 3000


def _page_texts(text) -> F.Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE_CHARS}}}+"), F.lit(0))


def chunk_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select("doc_id", elements(_page_texts(F.col("text"))).alias("i", "text"))
    return chunk_pages(pages.select("doc_id", (F.col("i") + 1).alias("page_no"), "text"), CONFIG)


def paged_sql(source: str, key: str, text: str = "text") -> str:
    return f"""
    with p0 as (select {key}, list_transform(range(0, length({text}), {PAGE_CHARS}),
                lambda s: substring({text}, s+1, {PAGE_CHARS})) as pg from {source}),
    p1 as (select {key}, unnest(pg) as body, cast(generate_subscripts(pg, 1) as int) as page from p0),
    p2 as (select {key}, page, {strip_sql('body')} as t from p1),
    p3 as (select {key}, page, {windows_sql('t')} as w from p2),
    p4 as (select {key}, page, unnest(w) as text, generate_subscripts(w, 1) as i from p3)
    select {key}, page, text, cast(row_number() over (partition by {key} order by page, i) - 1 as int) as ordinal from p4
    """


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def rows_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per order status: a group may hold a third of all rows."""
    return chunk_rows(table(spark, sf_dir, "orders"), ORDER_COLUMNS, "o_orderkey", ["o_orderstatus"], CONFIG).select(
        "o_orderstatus", "ordinal", "rows", "text"
    )


def rows_sql(columns: list[str], source: str, by: str, position: str, per: int) -> str:
    line = "||'; '||".join(f"'{c}: '||coalesce(cast({c} as varchar), '')" for c in columns)
    return (
        f"with n as (select {by}, {line} as line, row_number() over (partition by {by} order by {position}) as rn "
        f"from {source}) select {by}, cast((rn-1)//{per} as int) as ordinal, "
        "cast(min(rn) as varchar)||'-'||cast(max(rn) as varchar) as rows, "
        "string_agg(line, chr(10) order by rn) as text from n group by all"
    )


# CSV files of 120 orders each, with a quoted field that holds commas and quotes.
_FILE_ROWS = 120


def chunk_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    line = F.concat_ws(
        ",", F.col("o_orderkey").cast("string"), "o_orderstatus",
        F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', ""c'), F.col("o_custkey").cast("string"), F.lit('"""')),
    )
    numbered = F.floor(F.col("o_orderkey") / _FILE_ROWS).alias("file_no")
    lines = F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("l"))))
    header = F.lit("key,status,note\r\n")
    files = orders.groupBy(numbered).agg(
        F.concat(header, F.array_join(F.transform(lines, lambda s: s["l"]), "\r\n")).alias("body")
    )
    pieces = csv_pieces(F.col("body"), F.lit(None), CONFIG)
    return files.select("file_no", elements(pieces).alias("ordinal", "p")).select(
        "file_no", "ordinal", F.col("p.rows").alias("rows"), F.array_join("p.columns", "|").alias("columns"),
        F.col("p.text").alias("text"),
    )


_CSV_SQL = f"""
with n as (select o_orderkey//{_FILE_ROWS} as file_no, 'key: '||cast(o_orderkey as varchar)||'; status: '||o_orderstatus||
 '; note: '||o_orderpriority||', "c'||cast(o_custkey as varchar)||'"' as line,
 row_number() over (partition by o_orderkey//{_FILE_ROWS} order by o_orderkey) as rn from orders)
select file_no, cast((rn-1)//50 as int) as ordinal, cast(min(rn) as varchar)||'-'||cast(max(rn) as varchar) as rows,
 'key|status|note' as columns, string_agg(line, chr(10) order by rn) as text from n group by all
"""


def chunk_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = text_pieces(F.col("props"), F.lit(None), CONFIG)
    return table(spark, sf_dir, "events").select("event_id", elements(pieces).alias("ordinal", "p")).select(
        "event_id", "ordinal", F.col("p.text").alias("text")
    )


def all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of all types in one pass; paged ones carry their page texts."""
    docs = Chunkers(CONFIG).route(identify(DOCS.spark(spark, sf_dir)))
    pages = F.when(F.col("extractor") == "pdf", _page_texts(F.col("body")))
    return chunk_documents(docs.withColumn("pages", pages), Chunkers(CONFIG))


def chunk_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("metadata")
    return all_types(spark, sf_dir).select(
        "doc_id", "chunk_id", "ordinal", "n_chunks", "content_hash", "doc_content_hash", "source_uri", "extractor",
        m["heading"].alias("heading"), m["page"].alias("page"),
    )


def _all_types_sql() -> str:
    docs = f"(select *, substr(sha1(source_uri),1,16) as doc_id, {ROUTE_SQL} as extractor from {object_uri_sql(DOCS.sql)})"
    md = markdown_sql("(select * from d where extractor='markdown')", "doc_id", "body")
    pdf = paged_sql("(select * from d where extractor='pdf')", "doc_id", "body")
    plain = exploded_sql(
        f"(select doc_id, {windows_sql('t')} as w from (select doc_id, {strip_sql('body')} as t from d where extractor='text'))",
        "doc_id", "w",
    )
    return f"""
    with d as {docs},
    c as (select doc_id, ordinal, text, heading, null::int as page from ({md})
          union all select doc_id, ordinal, text, null, page from ({pdf})
          union all select doc_id, ordinal, text, null, null from ({plain}))
    select c.doc_id, c.doc_id||':'||cast(ordinal as varchar) as chunk_id, ordinal,
           cast(count(*) over (partition by c.doc_id) as int) as n_chunks, sha256(text) as content_hash,
           sha256(body) as doc_content_hash, source_uri, extractor, heading, page
    from c join d using (doc_id)
    """


def json_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = extras.json_object_pieces(depth=2)(F.col("doc"), F.lit(None), CONFIG)
    doc = F.expr(_JSON_DOC)
    return table(spark, sf_dir, "events").select("event_id", doc.alias("doc")).select(
        "event_id", elements(pieces).alias("ordinal", "p")
    ).select("event_id", "ordinal", F.col("p.heading").alias("member"), F.col("p.text").alias("text"))


_JSON_DOC = (
    "'{\"props\":'||props||',\"who\":{\"id\":'||cast(user_id as string)||',\"did\":{\"type\":\"'||event_type||'\"}},"
    "\"list\":[1,2]}'"
)
_JSON_SQL = """
select event_id, 0 as ordinal, 'props' as member, 'props.k: '||(props->>'$.k') as text from events
union all select event_id, 1, 'who', 'who.id: '||cast(user_id as varchar)||chr(10)||'who.did.type: '||event_type from events
union all select event_id, 2, 'list', 'list: [1,2]' from events
"""


def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = extras.html_pieces(F.col("html"), F.lit(None), CONFIG)
    return table(spark, sf_dir, "pages").select("page_id", elements(pieces).alias("ordinal", "p")).select(
        "page_id", "ordinal", F.col("p.text").alias("text")
    )


def _html_sql() -> str:
    text = "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
    for name in extras.HTML_DROPPED:
        text = f"regexp_replace({text}, '(?is)<{name}\\b.*?</{name}\\s*>', '', 'g')"
    text = f"regexp_replace({text}, '(?i)</?({'|'.join(extras.HTML_BLOCKS)})\\b[^>]*>', chr(30), 'g')"
    text = f"regexp_replace({text}, '<[^>]+>', '', 'g')"
    for entity, char in extras.HTML_ENTITIES:
        text = f"replace({text}, '{entity}', chr({ord(char)}))"
    block = strip_sql("regexp_replace(b, '[ \\t\\r\\n]+', ' ', 'g')")
    return f"""
    with h as (select page_id, string_split({text}, chr(30)) as bs from pages),
    b as (select page_id, generate_subscripts(bs, 1) as bi, unnest(bs) as b from h),
    c as (select page_id, bi, {block} as t from b),
    w as (select page_id, bi, {windows_sql('t')} as w from c where t <> ''),
    x as (select page_id, bi, unnest(w) as text, generate_subscripts(w, 1) as i from w)
    select page_id, cast(row_number() over (partition by page_id order by bi, i) - 1 as int) as ordinal, text from x
    """


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query result as rows: sales per part, chunked in part order within a return flag."""
    result = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_partkey")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    )
    return chunk_rows(
        result, ["l_partkey", "items", "quantity"], "l_partkey", ["l_returnflag"], CONFIG
    ).select("l_returnflag", "ordinal", "rows", "text")


_RESULT_SOURCE = (
    "(select l_returnflag, l_partkey, count(*) as items, cast(sum(l_quantity) as bigint) as quantity from lineitem group by all)"
)


def transcript_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("line", F.concat("role", F.lit(": "), "text"))
    return chunk_lines(turns, ["conv_id"], "turn", "line", CONFIG)


_TRANSCRIPT_SQL = f"""
with l as (select conv_id, turn, {strip_sql("role||': '||text")} as line from conversations),
j as (select conv_id, string_agg(line, chr(10) order by turn) as t from l group by 1),
x as (select conv_id, list_transform(range(0, length(t), 1050), lambda s: substring(t, s+1, 1200)) as w from j),
e as (select conv_id, unnest(w) as text, generate_subscripts(w, 1) - 1 as "window" from x)
select * from e where ltrim(text, {WS_SQL}) <> ''
"""

# Window sizes and overlaps advised per kind of text.
TYPE_SIZES = (("en", 1200, 150), ("de", 512, 64), ("fr", 800, 200), ("es", 400, 0))


def chunk_by_type_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The advised sizes, assigned to the documents' languages for want of other types."""
    sizes = spark.createDataFrame(TYPE_SIZES, "doc_type STRING, chunk_size INT, chunk_overlap INT")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("doc_type"), "text")
    return chunk_by_type(docs, sizes)


_TYPE_SQL = f"""
with s(doc_type, size, step) as (values {', '.join(f"('{t}', {s}, {s - o})" for t, s, o in TYPE_SIZES)}),
d as (select doc_id, doc_type, size, step, {strip_sql('text')} as t from documents join s on doc_type = lang),
w as (select doc_id, doc_type, {windows_sql('t', 'size', 'step')} as w from d)
{exploded_sql('w', 'doc_id, doc_type', 'w')}
"""


QUERIES = {
    "chunk_window": Query(chunk_window, PLAIN_CHUNKS_SQL),
    "chunk_markdown": Query(chunk_markdown, markdown_sql(f"({MARKDOWN.sql})", "doc_id")),
    "chunk_paged": Query(chunk_paged, paged_sql("documents", "doc_id")),
    "chunk_rows": Query(rows_of_orders, rows_sql(ORDER_COLUMNS, "orders", "o_orderstatus", "o_orderkey", 50)),
    "chunk_csv_files": Query(chunk_csv_files, _CSV_SQL),
    "chunk_json_text": Query(
        chunk_json_text,
        "select event_id, 0 as ordinal, replace(replace(props, '{', '{'||chr(10)||'  '), '}', chr(10)||'}') as text "
        "from events",
    ),
    "chunk_all_types": Query(chunk_all_types, _all_types_sql()),
    "json_objects": Query(json_objects, _JSON_SQL),
    "html_blocks": Query(html_blocks, _html_sql()),
    "result_rows": Query(
        result_rows, rows_sql(["l_partkey", "items", "quantity"], _RESULT_SOURCE, "l_returnflag", "l_partkey", 50)
    ),
    "transcript_chunks": Query(transcript_chunks, _TRANSCRIPT_SQL),
    "chunk_by_type_config": Query(chunk_by_type_config, _TYPE_SQL),
}
