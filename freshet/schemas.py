"""Table schemas as DDL texts. Everything is read with an explicit schema; nothing is inferred."""

from __future__ import annotations

METADATA_DDL = "STRUCT<extractor:STRING,heading:STRING,page:INT,rows:STRING,columns:ARRAY<STRING>>"
REF_DDL = "STRUCT<bucket:STRING,key:STRING,s3_uri:STRING,etag:STRING,size:BIGINT,content_type:STRING>"

OBJECT_REFS = "bucket STRING, key STRING, s3_uri STRING, etag STRING, size BIGINT, content_type STRING"
RAW_RECORDS = f"source STRING, doc_id STRING, ref {REF_DDL}, payload STRING, metadata MAP<STRING,STRING>"

# One object-created notification. `size` stays a string: some producers quote it.
RECORDS_DDL = (
    "ARRAY<STRUCT<eventName:STRING,s3:STRUCT<bucket:STRUCT<name:STRING>,"
    "object:STRUCT<key:STRING,size:STRING,eTag:STRING>>>>"
)
EVENT_DDL = f"Key STRING, Event STRING, Message STRING, Records {RECORDS_DDL}"

KNOWLEDGE = (
    "doc_id STRING, chunk_id STRING, ordinal INT, text STRING, content_hash STRING, doc_content_hash STRING, "
    f"embedding ARRAY<FLOAT>, model STRING, dim INT, source_uri STRING, metadata {METADATA_DDL}"
)
STAGING = (
    "doc_id STRING, chunk_id STRING, ordinal INT, text STRING, content_hash STRING, doc_content_hash STRING, "
    f"source_uri STRING, metadata {METADATA_DDL}, extractor STRING, n_chunks INT, status STRING, "
    "embedding ARRAY<FLOAT>, model STRING, dim INT"
)
ACTIVE_POINTER = "active_collection STRING, active_index STRING, model STRING, dim INT"
AGENT_MEMORY = "query STRING, answer STRING, sources ARRAY<STRING>, model STRING, ts TIMESTAMP"
SOURCE_DDL = "STRUCT<n:INT,s3_uri:STRING,chunk_id:STRING,score:DOUBLE,vector_score:DOUBLE,text:STRING>"
ANSWERS = (
    "query_id STRING, query STRING, answer STRING, answer_available BOOLEAN, active_collection STRING, "
    f"model STRING, sources ARRAY<{SOURCE_DDL}>"
)
INGEST_REPORT = "doc_id STRING, status STRING, indexed INT, collection STRING, extractor STRING"
