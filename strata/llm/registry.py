"""Queries of the corpus operators, by name, with their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import functools

from strata.llm import (ann, conversation_repair, exact_dedup, html_extract, license_scan, ngram_join, packing, periodic_runs, piece_codec,
                        quality_lm, secret_scan, suffix_dedup, url_filter)
from strata.llm.common import ship_package



def pipeline(spark, sf_dir):
    # the module imports this subpackage, so it is imported when the query is called
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _shipped(query):
    @functools.wraps(query)
    def call(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return call


QUERIES = {"pipeline": _shipped(pipeline)}
ORACLE = {}
for _m in (url_filter, packing, quality_lm, license_scan, ann, ngram_join, html_extract, suffix_dedup, exact_dedup, piece_codec,
           conversation_repair, periodic_runs, secret_scan):
    QUERIES.update({name: _shipped(query) for name, query in _m.QUERIES.items()})
    ORACLE.update(_m.ORACLE)
