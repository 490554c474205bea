"""Training-data operators over text, page and vector tables.

Ten distributed operators (top-k search, page extraction, token counts, language ID, secret
scans, near duplicates, toxicity, nearest neighbours, packing, n-best segmentation). Each
module has a general DataFrame interface; ``queries`` registers one query per operator over
the whole input table. Python code runs inside tasks over Arrow batches; Spark partitions,
joins and shuffles the work. Nothing else in the library imports this package.
"""
