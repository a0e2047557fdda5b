"""The registered text queries and the SQL of those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

from tickwise.llm.chunk_bpe import op13_chunk_bpe
from tickwise.llm.fingerprints import op9_fingerprints
from tickwise.llm.importance import ORACLE as IMPORTANCE_SQL
from tickwise.llm.importance import op12_importance
from tickwise.llm.licenses import op10_licenses
from tickwise.llm.mixing import op8_mixing
from tickwise.llm.packing import op5_packing
from tickwise.llm.pii import op6_pii
from tickwise.llm.prefix_trie import ORACLE as TRIE_SQL
from tickwise.llm.prefix_trie import op11_prefix_trie
from tickwise.llm.quality_rules import ORACLE as QUALITY_SQL
from tickwise.llm.quality_rules import op3_quality_rules
from tickwise.llm.secrets import op1_secrets
from tickwise.llm.simhash import op7_simhash
from tickwise.llm.url_filter import op2_url_filter
from tickwise.llm.weak_quality import op4_quality_classifier

QUERIES: dict[str, Callable] = {
    f.__name__: f for f in (
        op1_secrets, op2_url_filter, op3_quality_rules, op4_quality_classifier, op5_packing,
        op6_pii, op7_simhash, op8_mixing, op9_fingerprints, op10_licenses, op11_prefix_trie, op12_importance, op13_chunk_bpe,
    )
}

ORACLES: dict[str, str] = {"op3_quality_rules": QUALITY_SQL, "op11_prefix_trie": TRIE_SQL, "op12_importance": IMPORTANCE_SQL}
