"""Inputs of the named queries, derived from the test tables.

Each is a list of select expressions that both engines read, so the SQL side starts from the very same rows. All of
them keep every row of their table; the variants (file types, broken events, later versions) are chosen by CASE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.config import JobConfig
from freshet.functions.sizes import spread
from freshet.functions.text import WHITESPACE

# A small vector size for the stand-in embedder keeps the SQL side of the comparisons affordable.
DIM = 64
CONFIG = JobConfig(dim=DIM)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


class Derived:
    """A table with select expressions on top, for Spark and as SQL text."""

    def __init__(self, source: str | Derived, *exprs: str, where: str | None = None):
        self.source, self.exprs, self.where = source, exprs, where

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        s = self.source
        df = s.spark(spark, sf_dir) if isinstance(s, Derived) else table(spark, sf_dir, s)
        if self.where:
            df = df.where(self.where)
        return df.selectExpr(*self.exprs)

    @property
    def sql(self) -> str:
        inner = f"({self.source.sql})" if isinstance(self.source, Derived) else self.source
        where = f" where {self.where}" if self.where else ""
        return f"select {', '.join(self.exprs)} from {inner} as _t{where}"


_KEY = (
    "lang||'/'||cast(doc_id as string)||case doc_id%5 when 0 then '.md' when 1 then '.txt' when 2 then '.MD' "
    "when 3 then '.mdx' else '' end as key"
)
_TYPE = "case doc_id%5 when 3 then 'text/markdown; charset=utf-8' when 4 then 'application/pdf' else '' end as content_type"
_OBJECT = ("doc_id as n", "lang", "source as bucket", _KEY, _TYPE)

# Objects as first uploaded: Spanish ones are longer than in their later version.
DOCS = Derived("documents", *_OBJECT, "case when lang='es' then text||chr(10)||text else text end as body")

# The later upload: German ones are not sent again, French ones come empty, Spanish ones shorter, one source changed.
DOCS_LATER = Derived(
    "documents",
    *_OBJECT,
    "case when lang='fr' then '' when source='src7' then text||chr(10)||source else text end as body",
    where="lang<>'de'",
)

# A repository tree with a few paths that are not wanted.
TREE = Derived(
    "documents",
    "case when doc_id%13=0 then '.git/' else '' end||lang||'/'||cast(doc_id as string)||case doc_id%5 when 0 then "
    "'.md' when 1 then '.txt' when 2 then '.MD' when 3 then '.mdx' else '' end as path",
)

# Notifications: not JSON, test events, wrapped ones, removals, empty buckets, broken percent signs, repeated keys.
_ITEM = "cast(cast(floor(doc_id/3) as bigint) as string)"
_RAW_EVENTS = Derived(
    "documents",
    "doc_id as off",
    "replace('{\"Key\":\"src/'||" + _ITEM + "||'\",\"Records\":[{\"eventName\":\"'||"
    "case when doc_id%10=9 then 's3:ObjectRemoved:Delete' when doc_id%10=8 then 'ObjectCreated:Copy' "
    "else 's3:ObjectCreated:Put' end||'\",\"s3\":{\"bucket\":{\"name\":\"'||"
    "case when doc_id%50=3 then '' else source end||'\"},\"object\":{\"key\":\"'||lang||'%2Fa+'||" + _ITEM + "||"
    "case when doc_id%20=4 then '%25' when doc_id%20=5 then '%zz' else '' end||'.md\",\"size\":'||"
    "cast(n_chars as string)||',\"eTag\":\"~'||md5(text)||'~\"}}}]}','~',chr(92)||chr(34)) as j",
)
EVENTS = Derived(
    _RAW_EVENTS,
    "off",
    "case when off%50=0 then 'not json' when off%50=1 then '{\"Event\":\"s3:TestEvent\"}' when off%50=2 then "
    "'{\"Message\":\"'||replace(replace(j,chr(92),chr(92)||chr(92)),chr(34),chr(92)||chr(34))||'\"}' else j end as value",
)

# Answers that cite sources by number, some of them unknown, repeated or zero.
ANSWERS = Derived(
    "documents",
    "doc_id as qid",
    "lang",
    "source",
    "text",
    "case when doc_id%9=0 then null else 'See ['||cast(doc_id%4 as string)||'], ['||cast(doc_id%7 as string)||"
    "'] and ['||cast(doc_id%4 as string)||'].' end as answer",
)

# Markdown made from plain text: every line break becomes a new heading.
MARKDOWN = Derived(
    "documents", "doc_id", "'# '||replace(text,chr(10),chr(10)||chr(10)||'## ') as text"
)


def key_of_plain_document() -> str:
    return "'s3://'||source||'/'||lang||'/'||cast(doc_id as string)||'.txt'"


# Documents as plain text objects.
PLAIN = Derived("documents", "doc_id as n", "lang", "source", f"{key_of_plain_document()} as source_uri", "text as body")


# ---- SQL building blocks for the comparison engine ------------------------------------------------------------------

WS_SQL = "||".join(f"chr({ord(c)})" for c in WHITESPACE)
WS_CLASS = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def strip_sql(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


def windows_sql(stripped: str, size: int | str = 1200, step: int | str = 1050) -> str:
    """List of windows of an already stripped text column."""
    cut = f"list_transform(range(0, length({stripped}), {step}), lambda s: substring({stripped}, s+1, {size}))"
    return f"list_filter({cut}, lambda w: ltrim(w, {WS_SQL}) <> '')"


def exploded_sql(source: str, columns: str, array: str, value: str = "text") -> str:
    """One row per list element with its `ordinal` from 0."""
    return (
        f"select {columns}, unnest({array}) as {value}, cast(generate_subscripts({array}, 1) - 1 as int) as ordinal "
        f"from {source}"
    )


def plain_chunks_sql(source: str, keep: str = "") -> str:
    """Chunks of plain text objects (source_uri, body), as the staging step makes them."""
    return (
        f"select substr(sha1(source_uri),1,16) as doc_id, substr(sha1(source_uri),1,16)||':'||cast(ordinal as varchar) "
        f"as chunk_id, ordinal, text, sha256(text) as content_hash, sha256(body) as doc_content_hash, source_uri{keep} "
        f"from ({exploded_sql(f'(select *, {windows_sql('_t')} as _w from (select *, {strip_sql('body')} as _t from {source}))', '*', '_w')})"
    )


def object_uri_sql(docs: str) -> str:
    return f"(select *, 's3://'||bucket||'/'||key as source_uri from ({docs}))"


def embedding_sql(chunks: str, key: str, model: str, dim: int = DIM) -> str:
    """Non-zero entries (key, b, v) of the stand-in embedding of `text`; v as stored, in single precision."""
    return (
        f"with _w as (select {key}, lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) as word from {chunks}), "
        f"_c as (select {key}, word, count(*) as c from _w group by all), "
        f"_d as (select word, md5('{model}:'||word) as h from (select distinct word from _c)), "
        f"_p as (select word, cast(('0x'||substr(h,1,8))::bigint % {dim} as int) as b, "
        f"case when substr(h,9,1) < '8' then 1 else -1 end as sg from _d), "
        f"_s as (select {key}, b, sum(sg*c) as s from _c join _p using (word) group by all having sum(sg*c) <> 0) "
        f"select {key}, b, cast(s / sqrt(sum(s*s) over (partition by {key})) as float) as v from _s"
    )
