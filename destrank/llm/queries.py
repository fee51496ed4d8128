"""The registered queries of this subpackage and their DuckDB SQL.

Queries without SQL (tokenizers, learned models, keyed surrogates, rolling
hashes of several lengths, periodic runs) are tested against plain versions instead.
"""

from __future__ import annotations

from .byte_bpe import op10_byte_bpe
from .kneser_ney import op4_kneser_ney_quality
from .language_mixture import op1_language_mixture
from .license_digest import OP2_SQL, op2_license_digest
from .packing import op3_best_fit_packing
from .partenum_join import OP9_SQL, op9_partenum_join
from .periodic_runs import op11_periodic_runs
from .pii_surrogates import op5_pii_surrogates
from .pivot_search import OP6_SQL, op6_pivot_search
from .prefix_trie import OP13_SQL, op13_prefix_trie
from .repetition import op7_repetition_coverage
from .reply_trees import OP8_SQL, op8_reply_trees
from .token_counts import op12_token_counts

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_mixture, op2_license_digest, op3_best_fit_packing, op4_kneser_ney_quality, op5_pii_surrogates,
        op6_pivot_search, op7_repetition_coverage, op8_reply_trees, op9_partenum_join, op10_byte_bpe,
        op11_periodic_runs, op12_token_counts, op13_prefix_trie,
    )
}

ORACLE = {
    "op2_license_digest": OP2_SQL,
    "op6_pivot_search": OP6_SQL,
    "op8_reply_trees": OP8_SQL,
    "op9_partenum_join": OP9_SQL,
    "op13_prefix_trie": OP13_SQL,
}
