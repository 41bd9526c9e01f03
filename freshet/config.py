"""Settings of a job. Plain values, passed explicitly to the operators that need them."""

from __future__ import annotations

from dataclasses import dataclass, field

# The two tables that take turns being the searched one.
BLUE, GREEN = "knowledge", "knowledge_v2"

# Names of the other tables.
STAGING, POINTER, MEMORY = "chunks_staging", "active_pointer", "agent_memory"
REPORT = "ingest_report"


@dataclass(frozen=True)
class JobConfig:
    """Fixed values, as defaults: chunk size and overlap in characters, CSV rows per chunk, vector size, result counts,
    and the file types known by extension or MIME type."""

    chunk_size: int = 1200
    chunk_overlap: int = 150
    rows_per_chunk: int = 50
    model: str = "hashed-bow-1"
    dim: int = 1024
    index_name: str = "chunk_vectors"
    answer_model: str = "none"
    search_k: int = 10
    top_k: int = 5
    # anything unknown is "text"
    by_extension: dict[str, str] = field(
        default_factory=lambda: {"md": "markdown", "markdown": "markdown", "pdf": "pdf", "csv": "csv"}
    )
    by_mime: dict[str, str] = field(
        default_factory=lambda: {
            "text/markdown": "markdown",
            "application/pdf": "pdf",
            "text/csv": "csv",
            "application/csv": "csv",
        }
    )
