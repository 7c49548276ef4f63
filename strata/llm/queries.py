"""The registered queries of this package and the DuckDB statements that give the same rows."""

from strata.llm.dialogue import OP11_SQL, op11_cyk_repair
from strata.llm.embeddings import OP2_SQL, op2_pivot_permutations
from strata.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from strata.llm.langid import op12_zstd_language
from strata.llm.licenses import OP6_SQL, op6_diagonal_voting
from strata.llm.line_dedup import OP5_SQL, op5_template_tree
from strata.llm.minhash import OP10_SQL, op10_minhash
from strata.llm.mixing import OP7_SQL, op7_source_mix
from strata.llm.packing import op9_cost_packing
from strata.llm.quality import op1_kneser_ney
from strata.llm.sharding import op4_external_shuffle
from strata.llm.spelling import OP13_SQL, op13_frequency_trie
from strata.llm.substrings import op8_collinear_chains

LLM_QUERIES = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_pivot_permutations": op2_pivot_permutations,
    "op3_digest_index": op3_exact_dedup,
    "op4_external_shuffle": op4_external_shuffle,
    "op5_template_tree": op5_template_tree,
    "op6_diagonal_voting": op6_diagonal_voting,
    "op7_source_mix": op7_source_mix,
    "op8_collinear_chains": op8_collinear_chains,
    "op9_cost_packing": op9_cost_packing,
    "op10_minhash": op10_minhash,
    "op11_cyk_repair": op11_cyk_repair,
    "op12_zstd_language": op12_zstd_language,
    "op13_frequency_trie": op13_frequency_trie,
}

LLM_ORACLE = {
    "op2_pivot_permutations": OP2_SQL,
    "op3_digest_index": OP3_SQL,
    "op5_template_tree": OP5_SQL,
    "op6_diagonal_voting": OP6_SQL,
    "op7_source_mix": OP7_SQL,
    "op10_minhash": OP10_SQL,
    "op11_cyk_repair": OP11_SQL,
    "op13_frequency_trie": OP13_SQL,
}
