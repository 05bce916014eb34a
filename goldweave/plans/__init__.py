from .consolidate import Gathered, Result, Sources, consolidated, gather, run, shaped
from .job import run_to_folder

__all__ = ["Gathered", "Result", "Sources", "consolidated", "gather", "run", "run_to_folder", "shaped"]
