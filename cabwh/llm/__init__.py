"""Training-data operators: de-duplication, extraction, filtering, scrubbing, packing and archives.

Nothing outside this subpackage imports it; ``queries.py`` registers one query per operator.
"""
