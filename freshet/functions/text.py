"""Scalar text functions as Spark column expressions.

They stay in the JVM, inside code generation, and none of them takes more than linear time in the text.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code points that count as white space when a text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True when nothing but white space is left. Looks no further than the first other character."""
    return F.ltrim(text, F.lit(WHITESPACE)) == ""


def decode_utf8(body: Column) -> Column:
    """Bytes to text; malformed bytes become U+FFFD instead of failing the row."""
    return F.make_valid_utf8(body.cast("string"))


def s3_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def document_id(uri: Column) -> Column:
    return F.substring(F.sha1(uri), 1, 16)


def content_hash(value: Column) -> Column:
    return F.sha2(value, 256)


def chunk_id(doc_id: Column, ordinal: Column) -> Column:
    return F.concat(doc_id, F.lit(":"), ordinal.cast("string"))


def unquote_plus(text: Column) -> Column:
    """Percent-decoding that leaves stray percent signs alone and reads `+` as a space."""
    return F.url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def etag(raw: Column) -> Column:
    return F.coalesce(F.btrim(raw, F.lit('"')), F.lit(""))


def lenient_size(raw: Column) -> Column:
    return F.coalesce(raw.try_cast("bigint"), F.lit(0).cast("bigint"))


def extension(key: Column) -> Column:
    """Lower-cased part after the last dot, empty without a dot."""
    return F.when(F.instr(key, ".") > 0, F.lower(F.substring_index(key, ".", -1))).otherwise("")


def bare_mime(content_type: Column) -> Column:
    return strip(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1)))


# MIME types guessed from a file extension.
MIME_BY_EXTENSION = {
    "md": "text/markdown",
    "markdown": "text/markdown",
    "txt": "text/plain",
    "csv": "text/csv",
    "json": "application/json",
    "pdf": "application/pdf",
    "html": "text/html",
    "htm": "text/html",
    "xml": "text/xml",
}


def guess_mime(key: Column, default: str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MIME_BY_EXTENSION.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension(key)), F.lit(default))


def basename(uri: Column) -> Column:
    last = F.substring_index(uri, "/", -1)
    return F.when(last == "", uri).otherwise(last)


# How a citation, a link and the punctuation after a link look in an answer or a source.
CITATION = r"\[([0-9]+)\]"
HTTP_URL = r"(?i)https?://[^\s\])>]+"
AFTER_URL = r"[.,;:)]+$"


def citation_numbers(answer: Column) -> Column:
    """Numbers cited as [n], first-seen order, each once, zero left out."""
    numbers = F.regexp_extract_all(answer, F.lit(CITATION), F.lit(1))
    ints = F.filter(F.transform(numbers, lambda s: s.try_cast("int")), lambda n: n > 0)
    return F.coalesce(F.array_distinct(ints), F.array().cast("array<int>"))


def first_http_url(text: Column) -> Column:
    """First http(s) URL without trailing punctuation, NULL when there is none."""
    url = F.regexp_extract(text, HTTP_URL, 0)
    return F.nullif(F.regexp_replace(url, AFTER_URL, ""), F.lit(""))


def round4(x: Column) -> Column:
    """Round to 4 places. Values that are exact binary ties (multiples of 1/32) go to the even digit."""
    exact_tie = (x * 32) == F.floor(x * 32)
    return F.when(exact_tie, F.bround(x, 4)).otherwise(F.round(x, 4))


def compact_json(*columns: str) -> Column:
    """A whole row as compact JSON text; absent values are kept as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def looks_like_json(text: Column) -> Column:
    return F.substring(F.ltrim(text, F.lit(WHITESPACE)), 1, 1).isin("{", "[")


@F.pandas_udf(T.StringType())
def _pretty(texts: pd.Series) -> pd.Series:
    def one(text):
        if text is None:
            return None
        try:
            pretty = json.dumps(json.loads(text), indent=2, ensure_ascii=False)
        except (ValueError, RecursionError):
            return text
        return pretty.encode("utf-16", "surrogatepass").decode("utf-16", "replace")

    return texts.map(one)


def pretty_json(text: Column) -> Column:
    """JSON texts indented by two, everything else unchanged.

    Spark's own JSON printer needs a schema, quotes NaN and lays the text out differently, so this is an Arrow
    UDF. Only texts that start like JSON travel to Python; for all other rows a NULL is sent.
    """
    return F.coalesce(_pretty(F.when(looks_like_json(text), text)), text)
