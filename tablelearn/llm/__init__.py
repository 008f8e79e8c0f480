"""Training-data operators: PII, LM scoring, decontamination, quality, WARC, mixing,
line dedup, similarity join, HTML extraction and toxicity. Nothing else in the library
imports this subpackage."""
