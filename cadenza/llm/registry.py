"""The queries of this subpackage and the SQL that DuckDB can hold against them."""

from __future__ import annotations

from cadenza.llm import bpe, embeddings, language, licenses, mixing, packing, passages, quality, repair, simhash, toxicity, trie, urls

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_quality": quality.op2_quality,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_licenses": licenses.op4_licenses,
    "op5_embeddings": embeddings.op5_embeddings,
    "op6_urls": urls.op6_urls,
    "op7_bpe": bpe.op7_bpe,
    "op8_simhash": simhash.op8_simhash,
    "op9_passages": passages.op9_passages,
    "op10_language": language.op10_language,
    "op11_mixing": mixing.op11_mixing,
    "op12_trie": trie.op12_trie,
    "op13_repair": repair.op13_repair,
}

SQL: dict[str, str] = {
    "op5_embeddings": embeddings.OP5_SQL,
    "op6_urls": urls.OP6_SQL,
    "op12_trie": trie.OP12_SQL,
    "op13_repair": repair.OP13_SQL,
}
