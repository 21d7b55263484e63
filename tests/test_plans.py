"""Plan hygiene of every registered query: no cartesian / nested-loop joins, no Python in the
plan, and column pruning down to the Parquet scans (no query reads a column it never uses)."""
import pytest

from adherence.plans import catalog

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas", "Scan ExistingRDD"]
NEVER_READ = {"l_discount", "l_tax", "o_totalprice", "o_orderstatus", "c_name", "c_acctbal", "c_nationkey",
              "s_nationkey", "p_name"}


def scans(spark_plan):
    """(table file, required columns) of every file scan leaf of a physical plan."""
    out = []
    leaves = spark_plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "FileSourceScanExec":
            out.append((leaf.relation().location().rootPaths().head().getName(),
                        list(leaf.requiredSchema().fieldNames())))
    return out


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_hygiene(spark, sf_dir, name):
    qe = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution()
    plan = qe.sparkPlan()
    text = plan.toString() + qe.executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in text, f"{name}: {bad} in plan"
    found = scans(plan)
    assert found, f"{name}: no parquet scan found"
    for table, cols in found:
        assert not set(cols) & NEVER_READ, f"{name} reads unused {set(cols) & NEVER_READ} from {table}"
        assert len(cols) < 10, f"{name}: {table} scan is not pruned: {cols}"
