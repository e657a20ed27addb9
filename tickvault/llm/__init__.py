"""Training-data operators: mixing, deduplication, decontamination, quality,
language, licence, HTML and toxicity.  Nothing outside this folder, its tests
and ``corpus_pipeline.py`` imports it."""
