"""Training-data operators: near-duplicates, tokens, packing, language models, toxicity, pages.

Nothing outside this package imports it.
"""
