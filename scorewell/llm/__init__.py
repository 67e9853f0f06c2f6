"""Training-data operators over text corpora.

One module per operator; ``queries`` registers them over the driver tables.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
