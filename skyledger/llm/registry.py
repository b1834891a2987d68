"""All queries of the subpackage and of the pipeline, and their SQL."""

import corpus_pipeline
from skyledger.llm import oracle, queries


def all_queries():
    return queries.all_queries() | {"pipeline": corpus_pipeline.run}


def all_sql():
    return oracle.all_sql() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
