"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trainyard.llm import (alignment, decontamination, html_text, lexical,
                           licenses, minhash, mixing, neighbours, quality,
                           scoring, sharding, simhash, token_files)
from trainyard.llm.common import prepare, table


def _on(query: Callable[..., DataFrame], *names: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(*[table(spark, sf_dir, n) for n in names])
    return run


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    prepare(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": _on(html_text.op1_query, "pages"),
    "op2_decontamination": _on(decontamination.op2_query, "documents",
                               "benchmark"),
    "op3_quality": _on(quality.op3_query, "documents", "labels"),
    "op4_token_files": _on(token_files.op4_query, "documents"),
    "op5_mixing": _on(mixing.op5_query, "documents"),
    "op6_licenses": _on(licenses.op6_query, "documents"),
    "op7_neighbours": _on(neighbours.op7_query, "embeddings"),
    "op8_sharding": _on(sharding.op8_query, "documents"),
    "op9_scoring": _on(scoring.op9_query, "documents"),
    "op10_simhash": _on(simhash.op10_query, "documents"),
    "op11_alignment": _on(alignment.op11_query, "documents"),
    "op12_minhash": _on(minhash.op12_query, "documents"),
    "op13_lexical": _on(lexical.op13_query, "documents", "benchmark"),
    "pipeline": _pipeline,
}

# The other operators' results cannot be written in SQL; the tests hold each
# query against a brute-force version (see tests/llm).
ORACLE_SQL: dict[str, str] = {"op12_minhash": minhash.ORACLE,
                              "op13_lexical": lexical.ORACLE}
