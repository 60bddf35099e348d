import pytest
from pyspark.sql import functions as F

from faunatally.catalog.binding import PHYLUM, tables
from faunatally.catalog.queries import REPORT_NAMES as NAMES
from faunatally.operators.effort import deploy_meta
from faunatally.plans.report import metric_rows, report
from faunatally.session import CHECKPOINT_DIR, materialise, use_checkpoint_dir
from faunatally.sources import write_results
from tests.rows import as_set, tuples


@pytest.fixture(scope="module")
def bound(spark, folder):
    return tables(spark, folder)


@pytest.fixture(scope="module")
def results(bound):
    return report(materialise(bound.clean), bound.keys, NAMES, share=materialise)


def test_report_writes_every_table(spark, results, tmp_path):
    write_results(results, str(tmp_path))
    for name, df in results.items():
        assert spark.read.parquet(str(tmp_path / name)).columns == df.columns


def test_metrics(bound, results):
    metrics = dict(tuples(results["metrics"]))
    assert len(metrics) == 18
    assert metrics["total_taxa"] == metrics["phylum_taxa"] + metrics["other_taxa"]
    assert metrics["total_deployments"] == deploy_meta(bound.clean).count()
    assert metrics["taxa_beyond"] == results["taxa_beyond"].count()
    assert metrics["phylum_families"] == bound.clean.where(
        (F.col("phylum") == PHYLUM) & (F.col("family") != "")
    ).select("family").distinct().count()
    assert metrics["n_phyla"] == bound.clean.select("phylum").distinct().count()


def test_metric_rows(spark):
    assert as_set(metric_rows(spark.sql("SELECT 1 AS a, 2.5D AS b, CAST(NULL AS INT) AS c"))) == {
        ("a", 1.0),
        ("b", 2.5),
        ("c", None),
    }


def test_report_on_shared_tables_equals_report_on_rows(bound, results):
    plain = report(bound.clean, bound.keys, NAMES, sets=True)
    assert set(plain) == set(results)
    for name in ("inventory", "zone_taxa_invertebrates", "shared_taxa", "redundancy_audit"):
        assert sorted(map(repr, tuples(results[name]))) == sorted(map(repr, tuples(plain[name])))


class Context:
    """Stands in for a context: records the folder it is given."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = {CHECKPOINT_DIR: named}


def test_checkpoints_go_to_the_named_folder():
    for session, want in (
        (Session("yarn", "hdfs://shared"), "hdfs://shared"),
        (Session("local[2]", "/shared"), "/shared"),
        (Session("yarn", "hdfs://shared", "hdfs://set"), "hdfs://set"),
    ):
        use_checkpoint_dir(session)
        assert session.sparkContext.folder == want


def test_only_a_local_session_may_pick_a_folder():
    local = Session("local[2]")
    use_checkpoint_dir(local)
    assert local.sparkContext.folder
    with pytest.raises(ValueError, match="not set"):
        use_checkpoint_dir(Session("yarn"))


def test_materialise(spark):
    shared = materialise(spark.range(5).withColumn("twice", F.col("id") * 2))
    assert as_set(shared) == {(i, 2 * i) for i in range(5)}
    pruned = shared.select("twice")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint>" in pruned and "Range" not in pruned
