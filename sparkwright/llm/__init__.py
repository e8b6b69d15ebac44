"""Training-data operators: scoring, scanning, counting, de-duplication, sharding, mixing, fingerprints.

One module per operator; ``queries`` registers them. Nothing outside this subpackage imports it.
"""
