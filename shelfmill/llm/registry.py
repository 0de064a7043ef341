"""Names of the registered queries of this package."""

from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
from corpus_pipeline import run
from shelfmill.llm.oracle import ORACLE_SQL
from shelfmill.llm.queries import QUERIES

LLM_QUERIES = {**QUERIES, "pipeline": run}
LLM_SQL = {**ORACLE_SQL, **({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})}
