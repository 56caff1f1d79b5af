"""These must equal the reference's for identical inputs and outputs.

They are formats and names, stated here once and imported everywhere else.
"""

# Fixed values ------------------------------------------------------------------------------

# Hit files: name suffix, number of fields, position of the score and of the JSON metadata cell,
# and the key of that JSON object that holds the classification code.
HIT_FILE_SUFFIX = "_search.tsv"
HIT_FIELDS = 16
SCORE_FIELD = 3
META_FIELD = 15
CODE_KEY = "cath"

# Parsed-summary text: first line "#<file> Results. mean plddt: <mean>" ("0" without hits),
# second line "cath_id,count", then one "<code>,<count>" line per code.
MEAN_MARKER = "mean plddt:"
SUMMARY_SECOND_LINE = "cath_id,count"

# Structure files and the two known datasets: name, folder, input split count (18 by default).
# (Packed files are read without unpacking them; other compressed forms are not structures.)
PLAIN_GLOB, PACKED_GLOB = "*.pdb", "*.pdb.gz"
DEFAULT_MIN_PARTITIONS = 18
DATASETS = (
    ("ecoli", "/UP000000625_83333_ECOLI_v4/", 9),
    ("human", "/UP000005640_9606_HUMAN_v4/", 72),
)

# Outputs: the statistics file and its columns; the per-dataset code summary and its columns.
STATISTICS_FILE = "plDDT_means"
STATISTICS_COLUMNS = ("organism", "mean plddt", "plddt std")
CODE_SUMMARY_SUFFIX = "_cath_summary"
CODE_SUMMARY_COLUMNS = ("cath_code", "count")

# Sampling fraction of the prototype's structure sample.
SAMPLE_FRACTION = 0.005
