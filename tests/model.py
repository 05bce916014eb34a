"""The merge rules once more, plainly, for small fixtures.

Facts are tuples (candidate, field, value or job, source, method, milli) in
order of arrival; a job is a dict of the five attributes.
"""

from itertools import groupby

SECTIONS = ["full_name", "headline", "emails", "phones", "skills", "experience", "links"]
PRIORITY = ["recruiter_csv", "ats_json", "linkedin", "resume", "github", "recruiter_notes"]


def _place(source):
    return PRIORITY.index(source) if source in PRIORITY else len(PRIORITY)


def _job_key(job):
    return ((job["company"] or "").lower(), (job["title"] or "").lower())


def expected(candidate, facts):
    """Profile of one candidate as nested plain values."""
    ledger = []
    out = {"full_name": None, "headline": None, "emails": [], "phones": [], "skills": [], "experience": [],
           "github": None, "linkedin": None, "other": []}
    for section in SECTIONS:
        mine = [f for f in facts if f[1] == section]
        trusted = sorted(mine, key=lambda f: -f[5])
        if section in ("full_name", "headline") and mine:
            best = min(range(len(mine)), key=lambda i: (-mine[i][5], _place(mine[i][3]), i))
            out[section] = mine[best][2]
            ledger.append((section, mine[best][3], mine[best][4], mine[best][5]))
            ledger += [(section, f[3], "discarded:" + f[4], f[5]) for i, f in enumerate(mine) if i != best]
        elif section in ("emails", "phones"):
            # a value stands where its most trusted fact stands
            values = [f[2] for f in trusted]
            first = sorted({values.index(v) for v in values})
            out[section] = [values[i] for i in first]
            ledger += [(section, *trusted[i][3:]) for i in first]
        elif section == "skills":
            names = list(dict.fromkeys(f[2] for f in trusted))
            for name in names:
                same = [f for f in trusted if f[2] == name]
                out["skills"].append((name, max(f[5] for f in same), [f[3] for f in same]))
            ledger += [(section, f[3], f[4], f[5]) for f in trusted]
        elif section == "experience":
            order = list(dict.fromkeys(_job_key(f[2]) for f in trusted))
            by_key = {k: list(g) for k, g in groupby(sorted(trusted, key=lambda f: order.index(_job_key(f[2]))),
                                                     key=lambda f: _job_key(f[2]))}
            for key in order:
                # max keeps the first of equally rich entries
                out["experience"].append(max((f[2] for f in by_key[key]), key=lambda j: sum(1 for v in j.values() if v)))
            seen = set()
            for f in trusted:
                again = _job_key(f[2]) in seen
                seen.add(_job_key(f[2]))
                ledger.append((section, f[3], ("merged-duplicate:" if again else "") + f[4], f[5]))
        elif section == "links":
            # one rank has the code host, one other rank the network, all the
            # rest are a set in order of first appearance
            urls = [f[2] for f in trusted]
            host = [i for i, u in enumerate(urls) if "github.com" in u][:1]
            network = [i for i, u in enumerate(urls) if "linkedin.com" in u and i not in host][:1]
            rest = [u for i, u in enumerate(urls) if i not in host + network]
            out["github"], out["linkedin"] = (urls[i[0]] if i else None for i in (host, network))
            out["other"] = sorted(set(rest), key=rest.index)
            ledger += [(section, *f[3:]) for f in trusted]
    won = [x[3] for x in ledger if not x[2].startswith(("discarded", "merged-duplicate"))]
    out["provenance"] = ledger
    out["overall"] = (2 * sum(won) + len(won)) // (2 * len(won)) if won else 0
    out["candidate_id"] = candidate
    return out


def found(row):
    """The same shape from a row of the profile table."""
    return {
        "candidate_id": row["candidate_id"],
        "full_name": row["full_name"],
        "headline": row["headline"],
        "emails": row["emails"],
        "phones": row["phones"],
        "skills": [(s["name"], round(s["confidence"] * 1000), s["sources"]) for s in row["skills"]],
        "experience": [e.asDict() for e in row["experience"]],
        "github": row["links"]["github"],
        "linkedin": row["links"]["linkedin"],
        "other": row["links"]["other"],
        "provenance": [(p["field"], p["source"], p["method"], round(p["confidence"] * 1000))
                       for p in row["provenance"]],
        "overall": round(row["overall_confidence"] * 1000),
    }
