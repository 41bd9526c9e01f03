"""Further kinds of documents: inline records, table rows, sensor batches, JSON objects, HTML, tenants, model trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.config import JobConfig
from freshet.functions import text as tx
from freshet.functions.arrays import let
from freshet.functions.numbering import slab_of
from freshet.functions.windows import windows
from freshet.operators.chunking import Chunker, piece
from freshet.schemas import REF_DDL


# ---- inline records -------------------------------------------------------------------------------------------------

def inline_records(rows: DataFrame, source: str, key: Column, payload: Column, **metadata: str) -> DataFrame:
    """Rows of a database, a topic or a webhook as raw records that carry their own text."""
    pairs = [F.lit(x) for item in metadata.items() for x in item]
    uri = F.concat(F.lit(f"{source}://"), key)
    return rows.select(
        F.lit(source).alias("source"),
        tx.document_id(uri).alias("doc_id"),
        uri.alias("source_uri"),
        F.lit(None).cast(REF_DDL).alias("ref"),
        payload.alias("payload"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("metadata"),
    )


def reference_records(refs: DataFrame) -> DataFrame:
    """Object references as raw records of the same shape."""
    ref = F.struct("bucket", "key", "s3_uri", "etag", "size", "content_type").cast(REF_DDL)
    return refs.select(
        F.lit("s3").alias("source"),
        tx.document_id(F.col("s3_uri")).alias("doc_id"),
        F.col("s3_uri").alias("source_uri"),
        ref.alias("ref"),
        F.lit(None).cast("string").alias("payload"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )


def raw_documents(raw: DataFrame, objects: DataFrame) -> DataFrame:
    """Raw records of both kinds as (source, doc_id, source_uri, body): the payload, or the text of the object."""
    bodies = objects.select(F.col("bucket").alias("_b"), F.col("key").alias("_k"), F.col("body").alias("_body"))
    by_ref = raw.where(F.col("payload").isNull()).join(
        bodies, (F.col("ref.bucket") == F.col("_b")) & (F.col("ref.key") == F.col("_k"))
    )
    inline = raw.where(F.col("payload").isNotNull()).withColumn("_body", F.col("payload"))
    kept = ["source", "doc_id", "source_uri", F.col("_body").alias("body")]
    return by_ref.select(*kept).unionByName(inline.select(*kept))


def inline_documents(raw: DataFrame) -> DataFrame:
    """Inline records as documents: the payload is the body, read as JSON text, and its hash is the version."""
    return raw.select(
        "source",
        "doc_id",
        "source_uri",
        F.col("payload").alias("body"),
        tx.content_hash(F.col("payload")).alias("doc_content_hash"),
        F.lit("text").alias("extractor"),
    )


def row_documents(rows: DataFrame, table: str, key: str, columns: list[str]) -> DataFrame:
    """Database rows as documents whose version is the hash of the row's compact JSON, for row-level sync."""
    return inline_documents(inline_records(rows, table, F.col(key).cast("string"), tx.compact_json(*columns)))


# ---- sensor batches -------------------------------------------------------------------------------------------------

def batch_readings(
    readings: DataFrame, duration: str, by: list[str], reading_no: str, line: Column, span: int = 1000
) -> DataFrame:
    """Readings of a tumbling window as one record, at most `span` readings each.

    The window is further cut by `span` consecutive reading numbers. A device that sends a third of all readings thus
    gives many bounded records and never one unbounded one. Works on a stream with a watermark as on a table.
    """
    grouped = readings.groupBy(
        *by, F.window("ts", duration).alias("_w"), slab_of(F.col(reading_no), span).alias("part")
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col(reading_no).alias("no"), line.alias("line"))))
    return grouped.agg(
        F.count(F.lit(1)).alias("readings"),
        F.array_join(F.transform(ordered, lambda s: s["line"]), "\n").alias("payload"),
    ).select(*by, F.col("_w.start").alias("window_start"), "part", "readings", "payload")


def count_readings(readings: DataFrame, duration: str, by: list[str]) -> DataFrame:
    """Readings per tumbling window; counts are combined map-side."""
    return (
        readings.groupBy(*by, F.window("ts", duration).alias("_w"))
        .agg(F.count(F.lit(1)).alias("readings"))
        .select(*by, F.col("_w.start").alias("window_start"), "readings")
    )


# ---- JSON objects ---------------------------------------------------------------------------------------------------

def _flat_lines(path: Column, value: Column, depth: int) -> Column:
    leaf = F.array(F.concat(path, F.lit(": "), F.coalesce(value, F.lit("null"))))
    if depth == 0:
        return leaf
    members = F.map_entries(F.from_json(value, "map<string,string>"))
    nested = F.flatten(
        F.transform(members, lambda e: _flat_lines(F.concat(path, F.lit("."), e["key"]), e["value"], depth - 1))
    )
    return F.when(value.startswith("{"), F.coalesce(nested, leaf)).otherwise(leaf)


def _is_json(text: Column) -> Column:
    """Whether the text is one JSON value. Parsers stop after the first value; as the only element of an array it must
    be followed by nothing."""
    alone = F.concat(F.lit("["), text, F.lit("]"))
    return F.try_parse_json(alone).isNotNull() & (F.size(F.from_json(alone, "array<string>")) == 1)


def json_object_pieces(depth: int = 2) -> Chunker:
    """One piece per member of the top-level object, or per element of the top-level array, flattened to `path: value`
    lines down to `depth` levels. Each piece is windowed. Of JSON lines each line is such an object, its number standing
    before the member's name. What is none of these, or holds nothing, is windowed as plain text."""

    def pieces(text: Column, pages: Column, config: JobConfig) -> Column:
        whole = F.when(_is_json(text), text)
        members = F.map_entries(F.from_json(F.when(tx.strip(whole).startswith("{"), whole), "map<string,string>"))
        elements = F.transform(
            F.from_json(F.when(tx.strip(whole).startswith("["), whole), "array<string>"),
            lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value")),
        )

        def numbered(line: Column, i: Column) -> Column:
            found = F.map_entries(F.from_json(line, "map<string,string>"))
            return F.transform(
                found, lambda e: F.struct(F.concat_ws(".", (i + 1).cast("string"), e["key"]).alias("key"), e["value"].alias("value"))
            )

        def of_lines(lines: Column) -> Column:
            good = F.forall(lines, lambda v: tx.strip(v).startswith("{") & _is_json(v))
            return F.flatten(F.transform(F.when(good, lines), numbered))

        lines = let(F.filter(F.split(F.when(whole.isNull(), text), "\n"), lambda v: ~tx.is_blank(v)), of_lines)

        def cut(e: Column) -> Column:
            lines = F.array_join(_flat_lines(e["key"], e["value"], depth), "\n")
            return F.transform(
                windows(lines, config.chunk_size, config.chunk_overlap), lambda w: piece(w, heading=e["key"])
            )

        plain = F.transform(windows(text, config.chunk_size, config.chunk_overlap), lambda w: piece(w))
        return let(
            F.flatten(F.transform(F.coalesce(members, elements, lines), cut)),
            lambda found: F.when(F.size(found) > 0, found).otherwise(plain),
        )

    return pieces


# ---- HTML -----------------------------------------------------------------------------------------------------------

# Elements whose content is not text, elements that begin or end a block, and common entities.
HTML_DROPPED = ("script", "style")
HTML_BLOCKS = (
    "article", "section", "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th",
    "blockquote", "pre", "header", "footer", "nav", "main", "aside", "title", "head", "body", "br",
)
HTML_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
_BLOCK_MARK = "\x1e"


def html_blocks(html: Column) -> Column:
    """Array of the texts of an HTML page's blocks, tags stripped and white space collapsed, blank ones left out."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for name in HTML_DROPPED:
        text = F.regexp_replace(text, rf"(?is)<{name}\b.*?</{name}\s*>", "")
    text = F.regexp_replace(text, rf"(?i)</?({'|'.join(HTML_BLOCKS)})\b[^>]*>", _BLOCK_MARK)
    text = F.regexp_replace(text, r"<[^>]+>", "")
    for entity, char in HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    blocks = F.transform(
        F.split(text, _BLOCK_MARK), lambda b: tx.strip(F.regexp_replace(b, r"[ \t\r\n]+", " "))
    )
    return F.filter(blocks, lambda b: b != "")


def html_pieces(text: Column, pages: Column, config: JobConfig) -> Column:
    def cut(block: Column) -> Column:
        return F.transform(windows(block, config.chunk_size, config.chunk_overlap), lambda w: piece(w))

    return F.flatten(F.transform(html_blocks(text), cut))


# ---- tenants and model trials ---------------------------------------------------------------------------------------

def tenant_target(tenant: Column, base: str = "knowledge") -> Column:
    """Name of the table that holds a tenant's chunks."""
    safe = F.regexp_replace(F.lower(tenant), "[^a-z0-9]+", "_")
    return F.concat(safe, F.lit(f"_{base}"))


def overlap_at_k(a: DataFrame, b: DataFrame, k: int, id_column: str = "chunk_id") -> DataFrame:
    """Share of the first k hits that two retrievals have in common, per question of either one."""
    left = a.select("query_id", id_column, F.lit(1).alias("_a"))
    right = b.select("query_id", id_column, F.lit(1).alias("_b"))
    both = F.count(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1))
    return (
        left.join(right, ["query_id", id_column], "full_outer")
        .groupBy("query_id")
        .agg(both.cast("int").alias("common"), (both / k).alias("overlap"))
    )
