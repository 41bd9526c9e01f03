"""Documents to chunks.

A chunker maps a document's text to an array of pieces, as one column expression. All types are therefore chunked in
a single pass over the documents, without a shuffle: pick the chunker per row, drop blank pieces, then `posexplode`.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from freshet.config import JobConfig
from freshet.functions import text as tx
from freshet.functions.arrays import elements, let, tail
from freshet.functions.numbering import running_offset
from freshet.functions.windows import windows, windows_by_column
from freshet.operators.routing import extractor_name

PIECE_DDL = "struct<text:string,heading:string,page:int,rows:string,columns:array<string>>"
PIECES_DDL = f"array<{PIECE_DDL}>"


def piece(text: Column, heading: Column | None = None, page: Column | None = None) -> Column:
    """One piece; metadata that a chunker does not know is NULL."""
    null = F.lit(None)
    return F.struct(
        text.alias("text"),
        (null if heading is None else heading).cast("string").alias("heading"),
        (null if page is None else page).cast("int").alias("page"),
        null.cast("string").alias("rows"),
        null.cast("array<string>").alias("columns"),
    )


# Text and extracted pages of a document to ARRAY<piece>.
Chunker = Callable[[Column, Column, JobConfig], Column]


def text_pieces(text: Column, pages: Column, config: JobConfig) -> Column:
    """Plain text in windows; JSON text is indented first."""
    return F.transform(windows(tx.pretty_json(text), config.chunk_size, config.chunk_overlap), lambda w: piece(w))


def plain_pieces(text: Column, pages: Column, config: JobConfig) -> Column:
    """Plain text in windows, known not to be JSON: nothing goes through Python."""
    return F.transform(windows(text, config.chunk_size, config.chunk_overlap), lambda w: piece(w))


# Fixed value: a heading line. 1 to 6 #, white space (which may run over line ends), the title. Only \n ends a line.
_HEADING = r"(?dmU)^(#{1,6})[\s\x{1c}-\x{1f}]+(.*)$"


def markdown_sections(text: Column) -> Column:
    """Array of (heading, text): the part before the first heading, then each heading with what follows it.

    The text is cut at the heading matches themselves, since a heading match may consume the next line's `#`.
    """
    heads = F.regexp_extract_all(text, F.lit(_HEADING), F.lit(0))
    titles = F.regexp_extract_all(text, F.lit(_HEADING), F.lit(2))

    def section(title: Column, body: Column) -> Column:
        return F.struct(F.nullif(tx.strip(title), F.lit("")).alias("heading"), body.alias("text"))

    def assemble(parts: Column) -> Column:
        preamble = F.array(section(F.lit(""), parts[0]))
        rest = F.zip_with(titles, F.zip_with(heads, tail(parts), lambda m, b: F.concat(m, b)), section)
        return F.concat(F.filter(preamble, lambda s: s["text"] != ""), rest)

    return let(F.split(text, _HEADING, -1), assemble)


def markdown_pieces(text: Column, pages: Column, config: JobConfig) -> Column:
    def cut(s: Column) -> Column:
        return F.transform(
            windows(s["text"], config.chunk_size, config.chunk_overlap), lambda w: piece(w, heading=s["heading"])
        )

    return F.flatten(F.transform(markdown_sections(text), cut))


def paged_pieces(text: Column, pages: Column, config: JobConfig) -> Column:
    """Windows per page; pages are numbered from 1."""

    def cut(page_text: Column, i: Column) -> Column:
        cut_page = windows(page_text, config.chunk_size, config.chunk_overlap)
        return F.transform(cut_page, lambda w: piece(w, page=i + 1))

    return F.coalesce(F.flatten(F.transform(pages, cut)), F.array().cast(PIECES_DDL))


def python_pieces(split: Callable[[str], Iterable[dict]]) -> Callable[[Column], Column]:
    """Adapter for chunkers that need Python: `split(text)` yields dicts with the fields of a piece."""
    fields = ("text", "heading", "page", "rows", "columns")

    @F.pandas_udf(PIECES_DDL)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(
                [None if t is None else [{f: p.get(f) for f in fields} for p in split(t)] for t in texts], dtype=object
            )

    return run


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def csv_records(texts: pd.Series) -> pd.Series:
    """The records of CSV texts, as arrays of their fields. A field may hold quotes, commas and line ends."""
    csv.field_size_limit(sys.maxsize)
    return pd.Series([None if t is None else list(csv.reader(io.StringIO(t, newline=""))) for t in texts], dtype=object)


def csv_pieces(text: Column, pages: Column, config: JobConfig) -> Column:
    """Records below a header as `name: value; ...` lines, a fixed number of records per piece.

    Fields beyond the header are named by their place. A header without records is one piece that lists its names.
    """
    per = config.rows_per_chunk

    def piece_of(text: Column, rows: Column, columns: Column) -> Column:
        null = F.lit(None)
        return F.struct(
            text.alias("text"), null.cast("string").alias("heading"), null.cast("int").alias("page"),
            rows.alias("rows"), columns.alias("columns"),
        )

    def assemble(records: Column) -> Column:
        header = records[0]

        def line(record: Column) -> Column:
            names = F.transform(record, lambda _, i: F.coalesce(F.get(header, i), F.concat(F.lit("col"), i.cast("string"))))
            return F.array_join(F.zip_with(names, record, lambda n, v: F.concat(n, F.lit(": "), v)), "; ")

        def groups(lines: Column) -> Column:
            count = F.size(lines)
            starts = F.sequence(F.lit(1), count, F.lit(per))
            return F.transform(
                starts,
                lambda first: piece_of(
                    F.array_join(F.slice(lines, first, F.lit(per)), "\n"),
                    F.concat_ws("-", first.cast("string"), F.least(first + (per - 1), count).cast("string")),
                    header,
                ),
            )

        alone = F.array(piece_of(F.array_join(header, ", "), F.lit("header"), F.lit(None).cast("array<string>")))
        none = F.array().cast(PIECES_DDL)
        return F.when(F.size(records) == 0, none).when(F.size(records) == 1, alone).otherwise(
            let(F.transform(tail(records), line), groups)
        )

    return let(csv_records(text), assemble)


@dataclass(frozen=True)
class Chunkers:
    """Registry of chunkers by extractor name. Immutable: `register` returns an extended one."""

    config: JobConfig = JobConfig()
    by_name: dict[str, Chunker] = field(
        default_factory=lambda: {
            "markdown": markdown_pieces,
            "pdf": paged_pieces,
            "csv": csv_pieces,
            "text": text_pieces,
        }
    )

    def register(
        self, name: str, chunker: Chunker, extensions: Iterable[str] = (), mimes: Iterable[str] = ()
    ) -> Chunkers:
        config = replace(
            self.config,
            by_extension={**self.config.by_extension, **{e: name for e in extensions}},
            by_mime={**self.config.by_mime, **{m: name for m in mimes}},
        )
        return Chunkers(config, {**self.by_name, name: chunker})

    def route(self, objects: DataFrame) -> DataFrame:
        return objects.withColumn("extractor", extractor_name(F.col("key"), F.col("content_type"), self.config))

    def pieces(self, text: Column, pages: Column, extractor: Column) -> Column:
        """Pieces of a row by the chunker of its type; each chunker sees NULL on rows of another type."""
        chosen = None
        for name, chunker in self.by_name.items():
            mine = extractor == name
            result = chunker(F.when(mine, text), F.when(mine, pages), self.config)
            chosen = F.when(mine, result) if chosen is None else chosen.when(mine, result)
        return chosen


def finish(
    docs: DataFrame, pieces: str = "pieces", extractor: Column | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """Pieces to staged chunk rows: drop blank pieces, number the rest, add ids and hashes.

    Needs doc_id, source_uri, doc_content_hash and the piece array. `n_chunks` comes from the array size, so counting
    chunks per document takes no aggregation later on. Columns `carried` along come last.
    """
    extractor = F.col("extractor") if extractor is None else extractor
    kept = F.filter(F.col(pieces), lambda p: p["text"].isNotNull() & ~tx.is_blank(p["text"]))
    of_document = ["doc_id", "source_uri", "doc_content_hash", "extractor", *carried]
    # The size becomes a column before the explode; computed after it, the whole array would travel with every piece.
    exploded = (
        docs.withColumn("extractor", extractor)
        .select(*of_document, kept.alias("_kept"))
        .select(*of_document, F.size("_kept").alias("n_chunks"), "_kept")
        .select(*of_document, "n_chunks", elements(F.col("_kept")).alias("ordinal", "_p"))
    )
    p = F.col("_p")
    return exploded.select(
        "doc_id",
        tx.chunk_id(F.col("doc_id"), F.col("ordinal")).alias("chunk_id"),
        "ordinal",
        p["text"].alias("text"),
        tx.content_hash(p["text"]).alias("content_hash"),
        "doc_content_hash",
        "source_uri",
        F.struct(
            F.col("extractor"), p["heading"].alias("heading"), p["page"].alias("page"),
            p["rows"].alias("rows"), p["columns"].alias("columns"),
        ).alias("metadata"),
        "extractor",
        "n_chunks",
        F.lit("pending").alias("status"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.lit(None).cast("string").alias("model"),
        F.lit(None).cast("int").alias("dim"),
        *carried,
    )


def chunk_documents(docs: DataFrame, chunkers: Chunkers = Chunkers(), carried: Sequence[str] = ()) -> DataFrame:
    """Chunks of documents of any type, with the columns `carried` along. Needs doc_id, source_uri, doc_content_hash,
    extractor and body (text or bytes); paged documents carry their extracted pages in `pages ARRAY<STRING>`."""
    text = F.col("body") if dict(docs.dtypes)["body"] == "string" else tx.decode_utf8(F.col("body"))
    pages = F.col("pages") if "pages" in docs.columns else F.lit(None).cast("array<string>")
    return finish(docs.withColumn("pieces", chunkers.pieces(text, pages, F.col("extractor"))), carried=carried)


def chunk_pages(pages: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Chunks of extracted pages (doc_id, page_no, text), one row per page; page_no counts from 1 per document.

    The ordinal of a window is its place inside the page plus the windows of earlier pages. That running total sees
    one number per page and is cut into slabs, so a document holding much of the corpus does not land in one task.
    """
    cut = pages.withColumn("_w", windows(F.col("text"), config.chunk_size, config.chunk_overlap))
    counts = cut.select("doc_id", "page_no", F.size("_w").alias("_n"))
    before = running_offset(counts, "page_no", ["doc_id"], F.col("_n"), "_before", slim=True).drop("_n")
    return (
        cut.join(before, ["doc_id", "page_no"])
        .select("doc_id", "page_no", "_before", elements(F.col("_w")).alias("_i", "text"))
        .select(
            "doc_id",
            (F.col("_before") + F.col("_i")).cast("int").alias("ordinal"),
            F.col("page_no").alias("page"),
            "text",
        )
    )


def chunk_lines(
    lines: DataFrame, by: list[str], position: str, text: str, config: JobConfig = JobConfig()
) -> DataFrame:
    """Windows over a text stored as many rows, as if the stripped lines of each `by` group were joined by newlines.

    Only line lengths are added up to find where each line starts. A line then sends its slices to the windows it
    touches, and a window collects at most as many slices as it has characters. No group is ever joined as a whole.
    """
    size, step = config.chunk_size, max(1, config.chunk_size - config.chunk_overlap)
    if size <= 0:
        raise ValueError("a text stored as many rows needs a positive window size")
    clean = lines.select(*by, position, tx.strip(F.col(text)).alias("_t")).where(F.col("_t") != "")
    lengths = clean.select(*by, position, F.length("_t").alias("_len"))
    starts = running_offset(lengths, position, by, F.col("_len") + 1, "_start", slim=True).drop("_len")
    # Each line brings the newline in front of it; the one before the first line has place -1 and is never taken.
    a = F.col("_start") - 1
    b = a + 1 + F.length("_t")
    first = F.greatest(F.lit(0), F.ceil((a - size + 1) / step)).cast("bigint")
    last = F.floor((b - 1) / step).cast("bigint")
    w = F.col("_w")
    from_ = F.greatest(a, w * step, F.lit(0))
    until = F.least(b, w * step + size)
    piece_text = F.substring(F.concat(F.lit("\n"), F.col("_t")), (from_ - a + 1).cast("int"), (until - from_).cast("int"))
    slices = (
        clean.join(starts, [*by, position])
        .withColumn("_w", F.explode(F.sequence(first, last)))
        .select(*by, "_w", F.struct(F.col("_start"), piece_text.alias("t")).alias("_s"))
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["t"]), "")
    return (
        slices.groupBy(*by, "_w")
        .agg(joined.alias("text"))
        .where(~tx.is_blank(F.col("text")))
        .withColumnRenamed("_w", "window")
    )


def chunk_by_type(docs: DataFrame, sizes: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Windows whose size and overlap depend on the document's type.

    `sizes` is (doc_type, chunk_size, chunk_overlap), one row per type; types without a row get the sizes of `config`.
    Nothing forces a broadcast of it; Spark's own size check decides.
    """
    size = F.coalesce("chunk_size", F.lit(config.chunk_size))
    overlap = F.coalesce("chunk_overlap", F.lit(config.chunk_overlap))
    return (
        docs.join(sizes, "doc_type", "left")
        .withColumn("_w", windows_by_column(F.col("text"), size, overlap))
        .select(*[c for c in docs.columns if c != "text"], elements(F.col("_w")).alias("ordinal", "text"))
    )
