"""Training-data operators: tokenising, sharding, extraction, dedup, mixing, search, archives, language.

Nothing outside this subpackage imports it. Each module holds one operator with its own general
interface; ``queries`` registers one query per operator.
"""
