"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL, run
from rtdw.llm.chat import OP9_SQL, op9_preferences
from rtdw.llm.decontamination import op5_decontamination
from rtdw.llm.jaccard import op4_jaccard
from rtdw.llm.language_id import op3_language_id
from rtdw.llm.packing import op7_packing
from rtdw.llm.periodic import op13_periodic
from rtdw.llm.quality import op2_quality
from rtdw.llm.repeats import op8_repeats
from rtdw.llm.sharding import op12_sharding
from rtdw.llm.simhash import op1_fingerprints
from rtdw.llm.toxicity import op10_toxicity
from rtdw.llm.warc import op6_warc
from rtdw.llm.whitening import op11_whitening

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality": op2_quality,
    "op3_language_id": op3_language_id,
    "op4_jaccard": op4_jaccard,
    "op5_decontamination": op5_decontamination,
    "op6_warc": op6_warc,
    "op7_packing": op7_packing,
    "op8_repeats": op8_repeats,
    "op9_preferences": op9_preferences,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_sharding": op12_sharding,
    "op13_periodic": op13_periodic,
    "pipeline": run,
}

CHECKS: dict[str, str] = {"op9_preferences": OP9_SQL}
if ORACLE_SQL:
    CHECKS["pipeline"] = ORACLE_SQL
