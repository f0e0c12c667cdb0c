"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourgrid.llm import oracle
from hourgrid.llm.bpe import op3_bpe_transducer
from hourgrid.llm.cover_tree import op8_cover_tree
from hourgrid.llm.licenses import op5_signature_rules
from hourgrid.llm.mixing import op9_mix_by_threshold
from hourgrid.llm.periodic_runs import op12_recompressed_runs
from hourgrid.llm.pii import op1_pii_checksums
from hourgrid.llm.quality import op6_decision_list
from hourgrid.llm.secret_battery import op11_secret_battery
from hourgrid.llm.sharding import op4_hash_tree_shards
from hourgrid.llm.simhash import op2_simhash_trie
from hourgrid.llm.token_alignment import op13_end_slices
from hourgrid.llm.url_filter import op7_url_reputation
from hourgrid.llm.warc import op10_zip_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_checksums": op1_pii_checksums,
    "op2_simhash_trie": op2_simhash_trie,
    "op3_bpe_transducer": op3_bpe_transducer,
    "op4_hash_tree_shards": op4_hash_tree_shards,
    "op5_signature_rules": op5_signature_rules,
    "op6_decision_list": op6_decision_list,
    "op7_url_reputation": op7_url_reputation,
    "op8_cover_tree": op8_cover_tree,
    "op9_mix_by_threshold": op9_mix_by_threshold,
    "op10_zip_archives": op10_zip_archives,
    "op11_secret_battery": op11_secret_battery,
    "op12_recompressed_runs": op12_recompressed_runs,
    "op13_end_slices": op13_end_slices,
}

#: The others are beyond SQL (XXH64, CRC-32, BPE, checksums, learned rules): tested against brute force.
SQL: dict[str, str] = {
    "op7_url_reputation": oracle.URLS,
    "op8_cover_tree": oracle.VECTORS,
    "op9_mix_by_threshold": oracle.MIX,
    "op10_zip_archives": oracle.PACKAGES,
}
