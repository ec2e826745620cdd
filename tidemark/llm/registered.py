"""The registered queries of this package and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm.decontamination import OP5_SQL, op5_decontamination
from tidemark.llm.mixing import op11_mixing
from tidemark.llm.near_dedup import op7_near_dedup
from tidemark.llm.packing import op3_packing
from tidemark.llm.periodic_runs import op13_periodic_runs
from tidemark.llm.pii import op10_pii
from tidemark.llm.quality import OP8_SQL, op8_quality
from tidemark.llm.secret_scan import op9_secret_scan
from tidemark.llm.sharding import op2_sharding
from tidemark.llm.suffix_dedup import op1_suffix_dedup
from tidemark.llm.token_files import op4_token_files
from tidemark.llm.toxicity import op6_toxicity
from tidemark.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_sharding,
        op3_packing,
        op4_token_files,
        op5_decontamination,
        op6_toxicity,
        op7_near_dedup,
        op8_quality,
        op9_secret_scan,
        op10_pii,
        op11_mixing,
        op12_vector_codes,
        op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {"op5_decontamination": OP5_SQL, "op8_quality": OP8_SQL, "op12_vector_codes": OP12_SQL}
