"""Canonical column names.

Every operator works on these names; the adapters in ``hitroll.sources.tables`` map the given
tables onto them.
"""

STRUCTURE = "structure"   # one structure file (the unit of work)
DATASET = "dataset"       # the named collection a structure belongs to
SCORE = "score"           # per-hit score (field 3 of a hit row)
CODE = "code"             # classification code (key ``cath`` of the hit's JSON cell)
BAD = "bad"               # the hit row would make the parser raise
REASON = "reason"         # why a hit row is bad

# Outcomes of one structure (R1). "rejected" is the no-output case caused by a bad hit row.
HITS, ZERO_HITS, NO_OUTPUT, REJECTED = "hits", "zero_hits", "no_output", "rejected"
SCORED_OUTCOMES = (HITS, ZERO_HITS)
