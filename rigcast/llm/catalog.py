"""The registered queries of this subpackage and their DuckDB SQL.

Chat formatting, revisit resolution and the filter audit have an SQL counterpart
that is quick on whole tables; the others are held against brute force, round trips or held-out labels in
``tests/llm``.
"""

from __future__ import annotations

from rigcast.llm import (bpe, chat_repair, crosspoly, filter_audit, html_text, jaccard, langid, nbsvm, packing, quality_rules, reply_trees, revisits,
                         simhash)

QUERIES = {
    "op1_cross_polytope": crosspoly.op1_cross_polytope,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_nb_svm": nbsvm.op3_nb_svm,
    "op4_reply_trees": reply_trees.op4_reply_trees,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_warc_revisits": revisits.op6_warc_revisits,
    "op7_html_extraction": html_text.op7_html_extraction,
    "op8_language_id": langid.op8_language_id,
    "op9_bpe": bpe.op9_bpe,
    "op10_packing": packing.op10_packing,
    "op11_chat_repair": chat_repair.op11_chat_repair,
    "op12_simhash": simhash.op12_simhash,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLE = {"op4_reply_trees": reply_trees.OP4_SQL, "op6_warc_revisits": revisits.OP6_SQL,
          "op13_filter_audit": filter_audit.OP13_SQL}
