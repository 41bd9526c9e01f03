"""Answer a table of questions from the active chunk table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from freshet import schemas
from freshet.config import MEMORY, JobConfig
from freshet.operators import answers as an
from freshet.operators.cells import build, fit, is_built, knn_cells
from freshet.operators.embedding import Embedder, embed_questions
from freshet.operators.rerank import Scorer, rerank, word_overlap
from freshet.operators.search import knn_exact, with_payload
from freshet.sources.pointer import get_active
from freshet.sources.shared import shared_dir
from freshet.sources.tables import TableStore


def retrieve(corpus: DataFrame, questions: DataFrame, embedder: Embedder, k: int, index: str | None = None) -> DataFrame:
    """Hits of (query_id, query) in a chunk table, with what an answer shows of them.

    Questions are embedded once and written. With `index`, the folder of an inverted file over the same rows, only the
    cells near a question are searched; otherwise the search is exact.
    """
    spark = questions.sparkSession
    embedded = embed_questions(questions, embedder).select("query_id", "embedding")
    path = shared_dir(spark, "questions")
    embedded.write.parquet(path)
    asked = spark.read.schema(embedded.schema).parquet(path)
    hits = knn_cells(spark, index, asked, k) if index else knn_exact(corpus, asked, k, dim=embedder.dim)
    return with_payload(hits, corpus, ["source_uri", "ordinal", "text"])


def index_folder(store: TableStore, name: str) -> str:
    """Where the inverted file of the table's present version is kept. A later version has another folder, so an index
    is never searched for a table that it does not describe."""
    return f"{store.root}/_cells/{name}-v{store.state(name).batch}"


def build_index(store: TableStore, name: str, dim: int, **how) -> str:
    """Fit cells to the vectors of a chunk table and write its inverted file; searches use it from then on."""
    path, rows = index_folder(store, name), store.read(name)
    build(rows, fit(rows, dim, **how), path)
    return path


@dataclass
class Asking:
    """`embedders` gives the embedder of a model name, so that questions are embedded like the active table."""

    store: TableStore
    embedders: Callable[[str, int], Embedder]
    scorer: Scorer | None = word_overlap
    answerer: an.Answerer | None = None
    config: JobConfig = JobConfig()

    def ask(
        self, questions: DataFrame, k: int | None = None, top_k: int | None = None, log: bool = True
    ) -> DataFrame:
        """Answers to (query_id, query), written once, logged (unless `log` is off) and returned from what was written."""
        active = get_active(self.store, self.config)
        embedder = self.embedders(active["model"], active["dim"])
        corpus = self.store.read(active["active_collection"])
        index = index_folder(self.store, active["active_collection"])
        index = index if is_built(self.store.spark, index) else None
        hits = retrieve(corpus, questions, embedder, k or self.config.search_k, index)
        ranked = rerank(hits.join(questions, "query_id"), self.scorer, top_k or self.config.top_k)
        rows = an.answer_rows(questions, ranked, active["active_collection"], active["model"], self.answerer)
        path = shared_dir(questions.sparkSession, "answers")
        rows.write.parquet(path)
        answers = questions.sparkSession.read.schema(rows.schema).parquet(path)
        if log:
            self.remember(answers)
        return answers

    def remember(self, answers: DataFrame) -> bool:
        """Append to the memory table; a failure is reported, never raised."""
        try:
            self.store.ensure(MEMORY, schemas.AGENT_MEMORY)
            self.store.append(MEMORY, an.memory_rows(answers, self.config.answer_model))
            self.store.maintain(MEMORY)
            return True
        except Exception as problem:  # an answer is worth more than its log
            print(f"memory not written: {problem}")
            return False
