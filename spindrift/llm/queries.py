"""The queries of this subpackage and their SQL, as ``__spark_entry__`` registers them."""

from spindrift.llm.chat import OP2_SQL, op2_chat_format
from spindrift.llm.codes import OP11_SQL, op11_vector_codes
from spindrift.llm.collocations import OP12_SQL, op12_collocations
from spindrift.llm.decontaminate import OP5_SQL, op5_decontaminate
from spindrift.llm.embeddings import op7_embedding_dedup
from spindrift.llm.language import op8_language_id
from spindrift.llm.licenses import op10_license_scan
from spindrift.llm.lines import OP6_SQL, op6_line_dedup
from spindrift.llm.mixing import op9_source_mix
from spindrift.llm.packing import op13_packing
from spindrift.llm.simhash import op1_simhash
from spindrift.llm.substrings import OP3_SQL, op3_substring_dedup
from spindrift.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_chat_format": op2_chat_format,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_warc": op4_warc,
    "op5_decontaminate": op5_decontaminate,
    "op6_line_dedup": op6_line_dedup,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_language_id": op8_language_id,
    "op9_source_mix": op9_source_mix,
    "op10_license_scan": op10_license_scan,
    "op11_vector_codes": op11_vector_codes,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op2_chat_format": OP2_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op5_decontaminate": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_collocations": OP12_SQL,
}
