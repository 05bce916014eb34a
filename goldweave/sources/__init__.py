from . import ats, code_host, recruiter, untyped
from .unpivot import Reading, facts_of, without_markers

__all__ = ["Reading", "ats", "code_host", "facts_of", "recruiter", "untyped", "without_markers"]
