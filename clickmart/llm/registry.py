"""The registered queries of this sub-package and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame

from clickmart.llm import bwt_dedup, decontaminate, harmonic_pack, kk_shards, lexical_search, mph_dedup, nbsvm, ngram_join, pii, simhash_dedup, token_counts, url_rules, whitening
from clickmart.llm.common import find_package



def _found(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @wraps(query)
    def run(spark, sf_dir: str) -> DataFrame:
        find_package(spark)
        return query(spark, sf_dir)

    return run


_QUERIES = {
    "op1_mph_dedup": mph_dedup.query,
    "op2_nbsvm": nbsvm.query,
    "op3_kk_shards": kk_shards.query,
    "op4_url_rules": url_rules.query,
    "op5_harmonic_pack": harmonic_pack.query,
    "op6_token_counts": token_counts.query,
    "op7_decontaminate": decontaminate.query,
    "op8_pii": pii.query,
    "op9_bwt_dedup": bwt_dedup.query,
    "op10_ngram_join": ngram_join.query,
    "op11_lexical_search": lexical_search.query,
    "op12_whitening": whitening.query,
    "op13_simhash_dedup": simhash_dedup.query,
}

QUERIES = {name: _found(query) for name, query in _QUERIES.items()}

SQL = {
    "op1_mph_dedup": mph_dedup.SQL,
    "op4_url_rules": url_rules.SQL,
    "op10_ngram_join": ngram_join.SQL,
    "op11_lexical_search": lexical_search.SQL,
}
