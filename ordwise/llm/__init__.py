"""Training-data operators: extraction, scanning, packing, deduplication, mixing, search.

Nothing else in the library imports this subpackage; ``queries`` registers its
production queries and their oracle SQL.
"""
