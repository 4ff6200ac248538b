"""The registered queries of the training-data operators."""

import corpus_pipeline
from sedimenta.llm import embedding_dedup, exact_dedup, html_extract, licenses, packing, sentencepiece_bpe, simhash, substring_dedup, toxicity, warc

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_sentencepiece": sentencepiece_bpe.op3_sentencepiece,
    "op4_warc": warc.op4_warc,
    "op5_packing": packing.op5_packing,
    "op6_html_extract": html_extract.op6_html_extract,
    "op7_simhash": simhash.op7_simhash,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
    "pipeline": corpus_pipeline.run,
}
SQL = {"op1_exact_dedup": exact_dedup.SQL, "op4_warc": warc.SQL, "op8_substring_dedup": substring_dedup.SQL}
