"""Queries of the training-data operators and the SQL that checks those it can express."""

from __future__ import annotations

from treille.llm import canonical_map, consistency, cooccur, language_mix, mixing, packing, scan_repair, sentences, set_join, unicode_forms

QUERIES = {
    "p1_found": unicode_forms.found,
    "p2_found": scan_repair.found,
    "p2_repaired": scan_repair.repaired_fields,
    "p3_found": set_join.found,
    "p3_between": set_join.between,
    "p4_found": language_mix.found,
    "p5_found": cooccur.found,
    "p6_found": canonical_map.found,
    "p6_unmatched": canonical_map.unmatched,
    "p7_packed": packing.packed,
    "p7_unused": packing.unused,
    "p7_loss_packed": packing.packed_by_loss,
    "p7_loss_unused": packing.unused_by_loss,
    "p8_mixture": mixing.chosen,
    "p8_shares": mixing.shares,
    "p9_found": sentences.found,
    "p1_invisible": consistency.invisible,
    "p4_greek": consistency.greek,
    "p6_exact": consistency.exact,
    "p7_limits": consistency.packing_limits,
    "p8_limits": consistency.mixture_limits,
    "p9_last": consistency.last_ends,
}

ORACLE = {
    "p3_found": set_join.FOUND_SQL,
    "p3_between": set_join.BETWEEN_SQL,
    "p5_found": cooccur.FOUND_SQL,
    "p1_invisible": consistency.INVISIBLE_SQL,
    "p4_greek": consistency.GREEK_SQL,
    "p6_exact": consistency.EXACT_SQL,
    "p7_limits": consistency.LIMITS_SQL,
    "p8_limits": consistency.MIXTURE_SQL,
    "p9_last": consistency.LAST_SQL,
}
