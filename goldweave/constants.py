"""Fixed values of the consolidation rules.

Everything here is data, not logic: the result of a merge is only comparable
with other implementations of the same rules when these values are equal.
Confidences are whole thousandths (850 means 0.85), so that sums do not depend
on the order in which partitions arrive.
"""

# --- fixed values: source tags, in order of priority (first wins a tie) -----
RECRUITER = "recruiter_csv"
ATS = "ats_json"
LINKEDIN = "linkedin"
RESUME = "resume"
CODE_HOST = "github"
NOTES = "recruiter_notes"
SOURCE_PRIORITY = [RECRUITER, ATS, LINKEDIN, RESUME, CODE_HOST, NOTES]
UNKNOWN_PRIORITY = 6

# --- fixed values: reliability of a source for a field, in thousandths ------
PRIOR_MILLI = {
    "full_name": {RECRUITER: 850, ATS: 850, LINKEDIN: 900, RESUME: 800, CODE_HOST: 600},
    "emails": {RECRUITER: 900, ATS: 850, RESUME: 700, CODE_HOST: 400, LINKEDIN: 300},
    "phones": {RECRUITER: 900, ATS: 800, RESUME: 600},
    "location": {LINKEDIN: 850, RESUME: 700, RECRUITER: 500, ATS: 500, CODE_HOST: 400},
    "headline": {LINKEDIN: 900, CODE_HOST: 600, RESUME: 500},
    "years_experience": {RESUME: 750, LINKEDIN: 700, ATS: 500},
    "skills": {CODE_HOST: 850, RESUME: 700, LINKEDIN: 600, NOTES: 400},
    "experience": {LINKEDIN: 850, RESUME: 800, ATS: 600},
    "education": {RESUME: 850, LINKEDIN: 800},
    "links": {RECRUITER: 700, LINKEDIN: 900, CODE_HOST: 900},
}
DEFAULT_PRIOR_MILLI = 500

# --- fixed values: discounts of an indirect reading, in thousandths ---------
RECRUITER_EXPERIENCE_DISCOUNT = 100
INFERRED_SKILL_DISCOUNT = 150

# --- fixed values: skill aliases (lower case) and their display names -------
SKILL_ALIASES = {
    "js": "JavaScript", "javascript": "JavaScript",
    "ts": "TypeScript", "typescript": "TypeScript",
    "py": "Python", "python": "Python", "python3": "Python",
    "reactjs": "React", "react.js": "React", "react": "React",
    "nodejs": "Node.js", "node.js": "Node.js", "node": "Node.js",
    "golang": "Go", "go": "Go",
    "postgres": "PostgreSQL", "postgresql": "PostgreSQL",
    "mongo": "MongoDB", "mongodb": "MongoDB",
    "ml": "Machine Learning", "machine learning": "Machine Learning",
    "k8s": "Kubernetes", "kubernetes": "Kubernetes",
    "aws": "AWS", "amazon web services": "AWS",
    "django": "Django", "flask": "Flask",
    "c++": "C++", "cpp": "C++",
    "sql": "SQL",
}

# --- fixed values: months, phone prefix, link hosts --------------------------
MONTHS = {
    "jan": "01", "feb": "02", "mar": "03", "apr": "04", "may": "05", "jun": "06",
    "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12",
}
COUNTRY_PREFIX = "91"
CODE_HOST_DOMAIN = "github.com"
NETWORK_DOMAIN = "linkedin.com"
CODE_HOST_URL = "https://github.com/"

# --- fixed values: sections of the provenance ledger, in output order --------
SECTIONS = ["full_name", "headline", "emails", "phones", "skills", "experience", "links"]
SINGLE_SECTIONS = ["full_name", "headline"]
SECTION_NO = {name: i for i, name in enumerate(SECTIONS)}

# --- fixed values: alternative names of one attribute, first usable one wins -
ATS_ALIASES = {
    "name": ["candidateName", "full_name", "name"],
    "email": ["contactEmail", "email"],
    "company": ["employer", "current_company"],
    "title": ["currentTitle", "title"],
}
RECRUITER_COLUMNS = ["name", "email", "phone", "current_company", "title"]

# --- fixed values: paths of a config, and its messages --------------------------
SUB_VALUES_PATH = r"^([a-zA-Z_]+)\[\]\.(.+)$"
ELEMENT_PATH = r"^([a-zA-Z_]+)\[(\d+)\]$"
MSG_MISSING = "Required field '{}' is missing (source: '{}')"
MSG_FAILED = "Projection validation failed: "

# --- types of the tables ------------------------------------------------------
EXPERIENCE_TYPE = "struct<company:string,title:string,start:string,end:string,summary:string>"
FACT_COLUMNS = [
    "candidate_id", "field", "value", "exp", "source", "method",
    "confidence_milli", "source_ord", "record_ord", "emit_ord",
]
FACT_SCHEMA = (
    "candidate_id string, field string, value string, exp " + EXPERIENCE_TYPE + ", "
    "source string, method string, confidence_milli int, "
    "source_ord int, record_ord bigint, emit_ord int"
)
