"""The queries of this subpackage, and their SQL where SQL can express them."""

from attesta.llm.op1_langid import op1_langid
from attesta.llm.op2_warc import op2_warc
from attesta.llm.op3_bpe import op3_bpe
from attesta.llm.op4_packing import op4_packing
from attesta.llm.op5_topk import OP5_SQL, op5_topk
from attesta.llm.op6_suffix_dedup import op6_suffix_dedup
from attesta.llm.op7_mixing import op7_mixing
from attesta.llm.op8_ngram_join import op8_ngram_join
from attesta.llm.op9_quality import op9_quality
from attesta.llm.op10_lsm_dedup import op10_lsm_dedup

QUERIES = {f.__name__: f for f in (op1_langid, op2_warc, op3_bpe, op4_packing, op5_topk, op6_suffix_dedup, op7_mixing, op8_ngram_join, op9_quality, op10_lsm_dedup)}
ORACLES = {"op5_topk": OP5_SQL}
