import pytest
from pyspark.errors import AnalysisException

from faunatally.jobs import main
from faunatally.plans.preparation import prepare
from faunatally.schema import ANNOTATIONS, CLEAN, FIELD_LOG, FREQ_EXCLUSIONS, MANUAL_EXCLUSIONS
from faunatally.sources import (
    optional,
    read_annotations,
    read_banner_csv,
    read_clean,
    read_csv,
    read_field_log,
    read_freq_exclusions,
    read_manual_exclusions,
    write_clean,
    write_results,
)
from tests.rows import as_set, clean, tuples


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


FIELD_LOG_LINES = (
    ",,Group A,,",
    "Notes,Deployment,Depth (m),Location,Substrate (Hard/Soft)",
    "ok, d1 ,1200.5,Reef,Hard",
    'late,d2,NA,"North, outer",',
    ",d3,not measured,NA,Hard/Soft",
)


def test_field_log_with_banner(spark, tmp_path):
    log = read_field_log(spark, write(tmp_path / "log.csv", *FIELD_LOG_LINES))
    assert log.schema == FIELD_LOG
    assert as_set(log) == {
        ("d1", 1200.5, "Reef", "Hard"),
        ("d2", None, "North, outer", None),
        ("d3", None, None, "Hard/Soft"),
    }


def test_field_logs_of_a_folder_each_lose_banner_and_header(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"log{i}.csv", *FIELD_LOG_LINES[:2], f",d{i},10,L,Hard")
    log = read_field_log(spark, str(tmp_path))
    assert as_set(log, "deployment", "depth_m") == {("d0", 10.0), ("d1", 10.0), ("d2", 10.0)}


def test_banner_reader_names_a_missing_column(spark, tmp_path):
    path = write(tmp_path / "log.csv", "banner", "Deployment,Location", "d1,x")
    with pytest.raises(ValueError, match="no such column: depth_m, substrate_type"):
        read_field_log(spark, path)
    with pytest.raises(ValueError, match="no such column"):
        read_banner_csv(spark, path, FIELD_LOG)


def test_exclusion_lists(spark, tmp_path):
    manual = write(
        tmp_path / "manual.csv", "note,scientificName,deployment", "x, Aus bus ,d1", "y,NA,d2", 'z,"",d3', "w,N,"
    )
    listed = read_manual_exclusions(spark, manual)
    assert listed.schema == MANUAL_EXCLUSIONS
    assert as_set(listed) == {("d1", "Aus bus"), ("d2", None), ("d3", None), (None, "N")}
    freq = read_freq_exclusions(spark, write(tmp_path / "freq.csv", "deployment", "d1", "d2"))
    assert freq.schema == FREQ_EXCLUSIONS
    assert as_set(freq) == {("d1",), ("d2",)}


def test_missing_list_is_none(spark, tmp_path):
    assert read_manual_exclusions(spark, str(tmp_path / "none.csv")) is None
    assert read_freq_exclusions(spark, str(tmp_path / "none.csv")) is None


def test_other_read_errors_are_raised(spark, tmp_path):
    path = write(tmp_path / "manual.csv", "deployment", "d1")
    with pytest.raises(ValueError, match="no such column: scientificName"):
        optional(lambda: read_csv(spark, path, MANUAL_EXCLUSIONS))
    with pytest.raises(AnalysisException):
        optional(lambda: spark.sql("SELECT nothing"))


ANNOTATION_LINES = (
    "deployment,depth(m),phylum,class,order,family,scientificName,taxonRank,tentativeId,attracted,individualCount",
    "d1,5,Chordata,NA,,Fam,Aus bus,Species,Aus cus,Attracted,3",
    "d1,5,Chordata,NA,,Fam,Aus bus,Species,Aus aus,Attracted,4",
    "d2,6,Mollusca,,,,Bus,Genus,,,NA",
    "d3,7,,,,,,,,,",
)


def test_annotations_from_csv(spark, tmp_path):
    rows = read_annotations(spark, write(tmp_path / "a.csv", *ANNOTATION_LINES), "csv")
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in ANNOTATIONS]
    ordered = tuples(rows.orderBy("row_key"), "deployment", "class", "tax_order", "tentativeId", "individualCount")
    assert ordered == [
        ("d1", None, None, "Aus cus", 3),
        ("d1", None, None, "Aus aus", 4),
        ("d2", None, None, None, None),
        ("d3", None, None, None, None),
    ]


@pytest.mark.parametrize("file_format", ["parquet", "orc"])
def test_annotations_from_columnar_files(spark, tmp_path, file_format):
    source = read_annotations(spark, write(tmp_path / "a.csv", *ANNOTATION_LINES), "csv")
    path = str(tmp_path / "a")
    source.withColumnRenamed("tax_order", "order").write.format(file_format).save(path)
    assert as_set(read_annotations(spark, path, file_format)) == as_set(source)


def test_clean_table_round_trip_replaces_earlier_output(spark, tmp_path):
    path = str(tmp_path / "deep" / "er" / "clean")
    write_clean(clean(spark, {"deployment": "old"}), path)
    rows = clean(spark, {"deployment": "d1", "depth_m": 5.5}, {"deployment": None, "valid_for_freq": False})
    write_clean(rows, path)
    back = read_clean(spark, path)
    assert back.columns == CLEAN.names
    assert as_set(back) == as_set(rows)


def test_prepare_from_files(spark, tmp_path):
    paths = {
        "annotations_path": write(tmp_path / "a.csv", *ANNOTATION_LINES),
        "field_log_path": write(tmp_path / "log.csv", *FIELD_LOG_LINES),
        "clean_path": str(tmp_path / "clean"),
        "manual_exclusions_path": write(tmp_path / "m.csv", "deployment,scientificName", "d2,Bus"),
        "freq_exclusions_path": write(tmp_path / "f.csv", "deployment", "d1"),
    }
    audit = prepare(spark, annotations_format="csv", **paths)
    assert tuples(audit["exclusions"]) == [(4, 3, 1)]
    assert tuples(audit["effort"]) == [(1,)]
    assert tuples(audit["log_repeats"]) == []
    columns = ("deployment", "tentativeId", "depth_m", "substrate_type", "valid_for_freq")
    assert as_set(read_clean(spark, paths["clean_path"]), *columns) == {
        ("d1", "Aus cus", 1200.5, "Hard", False),
        ("d1", "Aus aus", 1200.5, "Hard", False),
        ("d3", None, None, "Hard/Soft", True),
    }

    paths["manual_exclusions_path"] = str(tmp_path / "none.csv")
    del paths["freq_exclusions_path"]
    audit = prepare(spark, annotations_format="csv", **paths)
    assert tuples(audit["exclusions"]) == [(4, 4, 0)]
    assert tuples(audit["effort"]) == [(0,)]
    assert read_clean(spark, paths["clean_path"]).where("valid_for_freq").count() == 4


def test_prepare_with_a_deployment_logged_twice(spark, tmp_path):
    paths = {
        "annotations_path": write(tmp_path / "a.csv", *ANNOTATION_LINES, "d1,8,,,,,Cus,,,,2.5"),
        "field_log_path": write(tmp_path / "log.csv", *FIELD_LOG_LINES, ",d1,1300,Reef,Hard"),
        "clean_path": str(tmp_path / "clean"),
        "manual_exclusions_path": write(tmp_path / "m.csv", "deployment,scientificName", "d1,Cus", "d1,Cus"),
        "annotations_format": "csv",
    }
    with pytest.raises(Exception, match="field log: 2 rows for deployment = d1"):
        prepare(spark, repeats="raise", **paths)
    with pytest.raises(FileNotFoundError):
        read_clean(spark, paths["clean_path"])
    with pytest.warns(UserWarning, match=r"annotations will be repeated: d1 \(2 times\)"):
        audit = prepare(spark, **paths)
    # one annotation of a deployment logged twice is two records, and both go
    assert tuples(audit["exclusions"]) == [(8, 6, 2)]
    assert as_set(audit["rejected_cells"], "table", "place", "column", "raw") == {
        ("annotations", 4, "individualCount", "2.5"),
        ("field_log", 2, "depth_m", "not measured"),
    }
    assert read_clean(spark, paths["clean_path"]).count() == 6


def test_jobs_from_the_command_line(spark, tmp_path):
    clean_path, audit_path, out = (str(tmp_path / d) for d in ("clean", "audit", "out"))
    main(
        [
            "prepare",
            "--annotations",
            write(tmp_path / "a.csv", *ANNOTATION_LINES),
            "--annotations-format",
            "csv",
            "--field-log",
            write(tmp_path / "log.csv", *FIELD_LOG_LINES),
            "--clean",
            clean_path,
            "--audit",
            audit_path,
        ]
    )
    assert tuples(spark.read.parquet(f"{audit_path}/exclusions")) == [(4, 4, 0)]
    main(["report", "--clean", clean_path, "--out", out])
    metrics = dict(tuples(spark.read.parquet(f"{out}/metrics")))
    assert (metrics["total_taxa"], metrics["phylum_taxa"], metrics["n_phyla"]) == (3, 1, 3)
    assert as_set(spark.read.parquet(f"{out}/inventory"), "taxon", "scientificName", "max_n") == {
        ("Aus bus", "*Aus bus*<br>(Tentative: *Aus cus*, *Aus aus*)", "4"),
        ("Bus", "Bus", ""),
        ("", "", ""),
    }


def test_write_results(spark, tmp_path):
    write_results({"one": spark.range(2), "two": spark.range(3)}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "two")).count() == 3
