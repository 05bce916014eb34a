"""goldweave: consolidate conflicting records about people into one profile each.

Sources become a long table of tagged facts, the facts are merged under fixed,
order-independent rules, and the result is written as profile, provenance,
quarantine and validation tables.
"""

__version__ = "0.1.0"
