"""Write PLANS.md: the physical plan of each headline query in its large-data shape.

Broadcast joins are disabled and AQE is off, so the plan shows the exchanges a large input
would get (AQE can only remove or shrink them at run time). For every scan, the columns read
and the filters pushed to the source are listed under the tree.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitroll import queries as Q  # noqa: E402
from hitroll.operators import search as SE  # noqa: E402
from hitroll.session import build_session  # noqa: E402
from hitroll.sources import tables as T  # noqa: E402

NAMES = ["dataset_summary", "code_summary", "structure_scores", "json_code_summary",
         "structure_code_counts", "map_explode_sum", "summary_combine_pair",
         "empty_dataset_defaults", "generated_rows", "label_top_k", "external_command_stage"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", shuffle_partitions=8,
                          extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.enabled": "false",
                                 "spark.sql.maxMetadataStringLength": "10000"})
    out = ["# Physical plans (large-data shape)", "",
           "Generated by `scripts/plans.py`: broadcast joins off, AQE off. `*` marks operators",
           "inside whole-stage code generation; `Exchange` is a shuffle.", ""]
    runs = [(name, lambda name=name: Q.REGISTRY[name].run(spark, sf)) for name in NAMES]
    # The search in a library of many blocks.
    emb = T.table(spark, sf, "embeddings")
    runs.append(("label_top_k (many blocks)",
                 lambda: SE.top_k(emb, emb, k=3, exclude_self=True, block_bytes=1 << 16)))
    for name, build in runs:
        text = build()._jdf.queryExecution().executedPlan().treeString()
        tree = [ln for ln in text.splitlines() if ln.strip()]
        scans = []
        for ln in tree:
            if "FileScan" in ln or "Scan parquet" in ln:
                rs = re.search(r"ReadSchema: (struct<.*>)", ln)
                pf = re.search(r"PushedFilters: (\[[^\]]*\])", ln)
                tbl = re.search(r"\[file:[^\]]*/([a-z_]+)\.parquet\]", ln)
                scans.append(f"- `{tbl.group(1) if tbl else '?'}`: reads `{rs.group(1) if rs else '?'}`"
                             f", pushed filters `{pf.group(1) if pf else '[]'}`")
        short = [re.sub(r"\s*\[[^\]]*\].*$", "", ln) if ("Scan" in ln) else re.sub(r"#\d+L?", "", ln)
                 for ln in tree]
        short = [ln if len(ln) < 140 else ln[:137] + "..." for ln in short]
        n_ex = sum("Exchange" in ln for ln in tree)
        out += [f"## `{name}`", "", f"Shuffles: {n_ex}", "", "```", *short, "```", "", *scans, ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
