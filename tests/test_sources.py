import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from retrocohort import staging
from retrocohort.plans import extracts as EX
from retrocohort.plans.report import format_pvalues, preview
from retrocohort.sources.delimited import (
    clean_names,
    cohort_source,
    find_separator,
    load_results,
    read_checked,
    read_cohort_covariates,
    read_delimited,
)
from retrocohort.sources.schemas import SOURCES
from retrocohort.sources.sinks import save_extract
from retrocohort.sources.tables import CdmTables
from tests.conftest import rows


def test_names_are_repaired(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], ["Person ID", "person.id", "2nd", "P-Value (%)", "!!", "startDate"])
    assert clean_names(df).columns == ["person_id", "person_id_2", "x2nd", "p_value_percent", "x", "start_date"]
    assert clean_names(spark.createDataFrame([(1, 2, 3)], ["p #", "p %", "Âge"])).columns == ["p_number", "p_percent", "age"]


def test_binding_accepts_names_paths_frames_and_factories(spark, frame, tmp_path):
    codes = frame([(1, "I10", "ICD10CM", 5)], "concept_id long, concept_code string, vocabulary_id string, extra int")
    codes.write.parquet(str(tmp_path / "codes"))
    codes.createOrReplaceTempView("my_codes")
    for binding in (codes, str(tmp_path / "codes"), "my_codes", lambda: codes):
        cdm = CdmTables(spark, {"comorbidity_codes": binding})
        assert rows(cdm.get("comorbidity_codes")) == [(1, "I10", "ICD10CM")]
    with pytest.raises(ValueError, match="no table"):
        cdm.get("person")
    with pytest.raises(ValueError, match="unknown"):
        CdmTables(spark, {"persons": codes})
    with pytest.raises(ValueError, match="person_id"):
        CdmTables(spark, {"person": codes}).get("person")


def test_covariates_file_from_its_configuration_row(spark, frame, tmp_path):
    text = (
        "Person ID,Gender,Race,DOB,Start Date,End Date,Treat Start,Treat End,Other\n"
        "1,F,W,1950-01-01,2000-01-01,2002-01-01,2001-01-01,2001-03-01,z\n"
        "2,,B,bad,2000-01-01,2002-01-01,2001-01-01,2001-03-01,z\n"
        "3,NA,NA,NA,2000-01-01,2002-01-01,2001-01-01,2001-03-01,NA\n"
    )
    (tmp_path / "drug_a_20210123_cohort1.csv").write_text(text)
    template = str(tmp_path) + "/{drug_name}_{exptid}_{cohort_type}.csv"
    config = frame([("drug_b", "nowhere", 1), ("drug_a", template, 20210123)], "drug_name string, covariates_file string, expt_id long")
    got = read_cohort_covariates(spark, config, "drug_a", SOURCES["covariates_file"])
    assert rows(got) == [
        (1, "F", "W", "1950-01-01", "2000-01-01", "2002-01-01", "2001-01-01", "2001-03-01"),
        (2, None, "B", None, "2000-01-01", "2002-01-01", "2001-01-01", "2001-03-01"),
        (3, None, None, None, "2000-01-01", "2002-01-01", "2001-01-01", "2001-03-01"),
    ]
    assert cohort_source(config, "drug_a")[1:] == ("drug_a", "20210123")
    with pytest.raises(ValueError, match="drug_c"):
        cohort_source(config, "drug_c")
    assert cohort_source(config.unionByName(config), "drug_a")[2] == "20210123"
    with pytest.raises(ValueError, match="several configuration rows"):
        cohort_source(config.unionByName(config.withColumn("expt_id", config.expt_id + 1)), "drug_a")


def test_results_from_a_file_or_a_frame(spark, frame, tmp_path):
    (tmp_path / "results.csv").write_text("Test,P Val\na,1.234e-5\nb,\nc,NA\n")
    got = format_pvalues(load_results(spark, str(tmp_path / "results.csv")), "p_val")
    assert rows(got) == [("a", "1.23E-05"), ("b", None), ("c", None)]
    df = frame([("a", 0.05)], "test string, pval double")
    assert load_results(spark, df) is df
    assert rows(format_pvalues(df)) == [("a", "5.00E-02")]


def test_saving_refuses_to_overwrite(spark, frame, tmp_path):
    df = frame([(1,)], "person_id long")
    target = str(tmp_path / "saved")
    assert rows(save_extract(df, target)) == [(1,)]
    with pytest.raises(Exception, match="(?i)already.exists"):
        save_extract(df, target)
    assert rows(save_extract(df, target, mode="append")) == [(1,), (1,)]


def test_saving_as_a_table(spark, frame, tmp_path):
    df = frame([(1,)], "person_id long")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS saved_db LOCATION '{tmp_path}/db'")
    assert rows(save_extract(df, "saved_db.extract")) == [(1,)]
    with pytest.raises(Exception, match="(?i)already.exists"):
        save_extract(df, "saved_db.extract")
    spark.sql("DROP DATABASE saved_db CASCADE")


def test_preview_is_ordered_and_limited(frame):
    df = frame([(i, i % 3) for i in range(20)], "id int, g int")
    got = preview(df, [F.desc("g"), "id"], 4, ["id > 5"])
    assert [tuple(r) for r in got.collect()] == [(8, 2), (11, 2), (14, 2), (17, 2)]
    assert preview(df, ["id"]).count() == 20
    with pytest.raises(ValueError, match="order"):
        preview(df, [])


def test_normalizing_gives_lower_case_names_and_dates(frame):
    covariates = frame(
        [(1, "1950-05-05 10:00:00", "2020-01-01", "bad")],
        "PERSON_ID long, DOB timestamp, FIRST_DRUG_EXPOSURE string, LAST_DRUG_EXPOSURE string",
    )
    drugs = frame([("2020-01-01", None, "2020-01-02")], "START_DATE string, END_DATE string, DRUG_EXPOSURE_START_DATE string")
    markers = frame([("2020-01-01", "2020-01-03", "2020-01-02")], "START_DATE string, END_DATE string, MEASUREMENT_DATE date")
    bundle = EX.normalize_extracts(covariates, drugs, markers)
    assert list(bundle) == ["r_c", "r_d", "r_b"]
    row = bundle["r_c"].first()
    assert row.asDict() == {
        "person_id": 1,
        "dob": datetime.date(1950, 5, 5),
        "first_drug_exposure": datetime.date(2020, 1, 1),
        "last_drug_exposure": None,
    }
    assert rows(bundle["r_d"]) == [("2020-01-01", None, "2020-01-02")]
    with pytest.raises(ValueError, match="case"):
        EX.normalize_extracts(covariates.withColumn("x", F.lit(1)).toDF("a", "A", "b", "c", "d"), drugs, markers)


def test_unknown_extract_type(spark):
    with pytest.raises(ValueError, match="'labs'"):
        EX.extract("labs", CdmTables(spark, {}), EX.CohortParams(1, 2, 250))


def test_size_bound_decides_about_the_broadcast(frame):
    df = frame([(i, "x" * 100) for i in range(10)], "id int, name string")
    exact = 10 * (2 * (8 + 8 * 2) + 56) + 2 * 10 * 100
    for make in (lambda limit: staging.lookup(df, "size_test", limit), lambda limit: staging.stored(df, limit)):
        assert make(exact).small and not make(exact - 1).small
        assert rows(make(exact).table) == rows(df)
    assert staging.lookup(df.where("id < 0"), "empty_test", 0).small


def test_stage_root_comes_from_the_session(spark):
    configured = spark.conf.get(staging.CHECKPOINT_DIR, None)
    root = staging.stage_root(spark)
    if configured:
        assert root.startswith(configured)
    assert spark.sparkContext.applicationId in root


def test_a_cluster_without_a_shared_folder_is_refused(tmp_path):
    context = SimpleNamespace(master="yarn", applicationId="app_1", getCheckpointDir=lambda: None)
    settings = {}
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default: settings.get(key, default))
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.stage_root(session)
    context.master = "local[2]"
    assert staging.stage_root(session) == staging.stage_root(session)
    settings[staging.CHECKPOINT_DIR] = "hdfs:///shared/"
    assert staging.stage_root(session) == "hdfs:///shared/retrocohort-app_1"


def test_separator_is_found_out(spark, tmp_path):
    assert [find_separator(h) for h in ("a,b", "a\tb,c\td", 'x;"a,b,c";y', "one", "a|b|c")] == [",", "\t", ";", ",", "|"]
    for sep in ",\t;|":
        path = tmp_path / f"results{ord(sep)}.csv"
        path.write_text("\ufefftest id{0}p value\n1{0}0.5\n2{0}NA\n".replace("{0}", sep))
        assert rows(load_results(spark, str(path))) == [("1", "0.5"), ("2", None)]
        assert load_results(spark, str(path)).columns == ["test_id", "p_value"]
    with pytest.raises(ValueError, match="no header"):
        (tmp_path / "empty.csv").write_text("")
        load_results(spark, str(tmp_path / "empty.csv"))


def test_rejected_fields_are_counted_and_kept(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(
        "Person ID,Gender,Race,DOB,Start Date,End Date,Treat Start,Treat End\n"
        "1,F,W,1950-01-01,2000-01-01,2002-01-01,2001-01-01,2001-03-01\n"
        "x2,F,W,bad,2000-01-01,2002-01-01,2001-01-01,\n"
        "3,F,W,NA,2000-13-01,2002-01-01,2001-01-01,2001-03-01\n"
    )
    schema = SOURCES["covariates_file"]
    checked = read_checked(spark, str(path), schema)
    assert checked.n_rejected == 3
    assert rows(checked.rows) == rows(read_delimited(spark, str(path), schema))
    found = {(r["column"], r["type"], r["text"]): r["record"] for r in checked.rejected.collect()}
    assert set(found) == {("person_id", "bigint", "x2"), ("dob", "date", "bad"), ("start_date", "date", "2000-13-01")}
    assert '"person_id":"x2"' in found[("dob", "date", "bad")]
    assert read_checked(spark, str(path), schema, max_rejected=3).n_rejected == 3
    with pytest.raises(ValueError, match="3 fields"):
        read_checked(spark, str(path), schema, max_rejected=2)
    with pytest.raises(ValueError, match="lacks"):
        read_checked(spark, str(path), SOURCES["results"])
    path.write_text("Test ID,pval\n")
    empty = read_checked(spark, str(path), SOURCES["results"], max_rejected=0)
    assert (empty.rows.count(), empty.rejected.count(), empty.n_rejected) == (0, 0, 0)
