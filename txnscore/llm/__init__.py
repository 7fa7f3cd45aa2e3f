"""Training-data operators: URL filters, language id, mixing, quality rules, line and document
near-dedup, toxicity, quality scores, HTML extraction and benchmark decontamination.

Nothing else in the library imports this subpackage; the driver entry adds its queries when it can
be imported.
"""
