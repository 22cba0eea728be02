import os
import tempfile

from vigil.plans.catalog import QUERIES
from vigil.streaming import merge_site_files, site_table_from_merged


def test_incremental_site_merge(spark):
    d = "/root/testdata/sf0.001"
    m = QUERIES["metrics_table"](spark, d).select("site", "metric", "value", "ci_lower", "ci_upper").toPandas()
    root = tempfile.mkdtemp(prefix="vigil-stream-")
    inbox, merged = os.path.join(root, "inbox"), os.path.join(root, "merged")
    os.makedirs(inbox)
    sites = sorted(m.site.unique())
    m[m.site == sites[0]].to_csv(os.path.join(inbox, f"metrics_{sites[0]}.csv"), index=False)
    merge_site_files(spark, inbox, merged, name="t1")
    assert spark.read.parquet(merged).count() == 5
    for s in sites[1:]:
        m[m.site == s].to_csv(os.path.join(inbox, f"metrics_{s}.csv"), index=False)
    merge_site_files(spark, inbox, merged, name="t1")          # only the new files are read
    assert spark.read.parquet(merged).count() == 5 * len(sites)
    t = site_table_from_merged(spark, merged).collect()
    assert len(t) == len(sites) and sorted(r["auc_rank"] for r in t) == list(range(1, len(sites) + 1))
