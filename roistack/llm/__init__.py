"""Training-data operators: cleaning, de-duplication, scoring, tokenising and search over text corpora.

Nothing else in the package imports this subpackage.  Every operator takes and
returns DataFrames; the thin ``opN_*`` queries live in :mod:`roistack.llm.queries`.
"""
