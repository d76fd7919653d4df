"""The registered queries of this subpackage."""

from loomchain.llm.decontamination import OP7_SQL, op7_benchmark_hits
from loomchain.llm.licenses import op8_license_scan
from loomchain.llm.line_dedup import OP10_SQL, op10_line_dedup
from loomchain.llm.packing import op5_hilbert_packing
from loomchain.llm.piece_codec import op11_piece_codec
from loomchain.llm.quality_classifier import op6_quality_classifier
from loomchain.llm.quality_rules import OP4_SQL, op4_quality_rules
from loomchain.llm.secret_scan import op9_secret_scan
from loomchain.llm.simhash import op3_simhash
from loomchain.llm.suffix_dedup import OP1_SQL, op1_suffix_dedup
from loomchain.llm.token_counts import op2_token_counts
from loomchain.llm.vector_codes import OP13_SQL, op13_vector_codes
from loomchain.llm.whitening import op12_embedding_whitening

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_simhash": op3_simhash,
    "op4_quality_rules": op4_quality_rules,
    "op5_hilbert_packing": op5_hilbert_packing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_benchmark_hits": op7_benchmark_hits,
    "op8_license_scan": op8_license_scan,
    "op9_secret_scan": op9_secret_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_piece_codec": op11_piece_codec,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": OP1_SQL,
    "op4_quality_rules": OP4_SQL,
    "op7_benchmark_hits": OP7_SQL,
    "op10_line_dedup": OP10_SQL,
    "op13_vector_codes": OP13_SQL,
}
