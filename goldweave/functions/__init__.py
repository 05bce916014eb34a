from .confidence import as_ratio, checked_priors, mean_milli, prior, prior_of, priority_of
from .contact import email_address, phone_e164
from .dates import year_month
from .lookup import literal_map, sql_literal
from .rules import FIXED, Rules, rules_from
from .skills import skill_name
from .text import clean_text, collapse, nfkc, present, strip, title_case

__all__ = [
    "FIXED", "Rules", "as_ratio", "checked_priors", "clean_text", "collapse", "email_address", "literal_map",
    "mean_milli", "nfkc", "phone_e164", "present", "prior", "prior_of", "priority_of",
    "rules_from",
    "skill_name", "sql_literal", "strip", "title_case", "year_month",
]
