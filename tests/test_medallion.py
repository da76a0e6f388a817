import csv
import datetime
from dataclasses import replace

import pytest

from tiermill.plans.athletes import BIO, REPORT, RESULT_FIELDS, RESULTS
from tiermill.plans.medallion import layer, refine, run_medallion, summarise
from tiermill.sinks.files import preview, show_preview
from tiermill.sources.files import read_csv

RUN = datetime.datetime(2024, 5, 6, 7, 8, 9)
BIO_COLUMNS = [
    "athlete_id", "name", "sex", "born", "height", "weight", "country", "country_noc", "description", "special_notes",
]
BIOS = [
    (1, "Ann Lee", "Female", "1990-01-02", "180", "70", "New Zealand", "NZL", None, None),
    (2, "Bo-Li", "Male", "1991-05-06", "170.5", "60.25", "China", "CHN", "tall", None),
    (2, "Bo Li", "Male", "1991-05-06", "170.5", "60.25", "China", "CHN", "tall", None),
    (3, "Cy", "Male", "1992-07-08", "na", "80", "Chile", "CHI", None, None),
    (4, "Di", "Female", "1993-09-10", "165", "75-80", "Chile", "CHI", None, None),
    (5, "Ed", "Male", "1994-11-12", None, "80", "Chile", "CHI", None, None),
    (6, "Unused", "Male", "1994-11-12", "200", "100", "Chile", "CHI", None, None),
]
# edition, edition_id, country_noc, sport, event, result_id, athlete, athlete_id, pos, medal, isTeamSport
RESULT_ROWS = [
    ("2020 Summer", 61, "NZL", "Rowing", "Eights, Women", 10, "Ann Lee", 1, "1", "Gold", True),
    ("2020 Summer", 61, "NZL", "Rowing", "Pairs", 11, "Ann Lee", 1, "=3", None, False),
    ("2016 Summer", 60, "NZL", "Rowing", "Pairs", 12, "Ann Lee", 1, "4", None, False),
    ("2016 Summer", 60, "NZL", "Rowing", "Pairs", 12, "Ann Lee", 1, "4", None, False),
    ("2020 Summer", 61, "CHN", "Rowing", "Pairs", 13, "Bo Li", 2, "1", "Gold", False),
    ("2020 Summer", 61, "CHI", "Judo", "Open", 14, "Cy", 3, "5", None, False),
    ("2020 Summer", 61, "CHI", "Judo", "Open", 15, "Nobody", 99, "6", None, False),
]


def write_csv(path, header, rows):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(header)
        writer.writerows([["" if v is None else v for v in row] for row in rows])


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("athletes")
    (base / "landing").mkdir()
    write_csv(base / "landing" / f"{BIO}.csv", BIO_COLUMNS, BIOS)
    write_csv(base / "landing" / f"{RESULTS}.csv", RESULT_FIELDS, RESULT_ROWS)
    run_medallion(spark, str(base / "landing"), str(base / "lake"), REPORT, RUN)
    return str(base / "lake")


def read(spark, lake, tier, name):
    return spark.read.parquet(layer(lake, tier, name))


def test_bronze_keeps_every_row_as_text(spark, lake):
    bio = read(spark, lake, "bronze", BIO)
    assert bio.count() == len(BIOS)
    assert set(dict(bio.dtypes).values()) == {"string"}
    assert set(dict(read(spark, lake, "bronze", RESULTS).dtypes).values()) == {"string"}


def test_inferred_types_give_the_same_report(spark, lake, tmp_path):
    inferring = replace(REPORT, facts=replace(REPORT.facts, infer=True), dimension=replace(REPORT.dimension, infer=True))
    gold = run_medallion(spark, f"{lake}/../landing", str(tmp_path), inferring, RUN)
    bio = read(spark, str(tmp_path), "bronze", BIO)
    assert bio.count() == len(BIOS)
    assert dict(bio.dtypes) | {"athlete_id": "int", "height": "string", "born": "date"} == dict(bio.dtypes)
    assert dict(read(spark, str(tmp_path), "bronze", RESULTS).dtypes)["isTeamSport"] == "boolean"
    assert sorted(gold.collect()) == sorted(read(spark, lake, "gold", "avg_stats").collect())


def test_silver_dimension_is_cleaned_deduped_and_numeric(spark, lake):
    rows = {(r.athlete_id, r.name): r for r in read(spark, lake, "silver", BIO).collect()}
    assert sorted(rows) == [("1", "AnnLee"), ("2", "BoLi"), ("6", "Unused")]
    ann = rows["1", "AnnLee"]
    assert (ann.country, ann.born, ann.description, ann.height) == ("NewZealand", "19900102", "None", "180")


def test_silver_facts_are_cleaned_and_deduped(spark, lake):
    rows = read(spark, lake, "silver", RESULTS).collect()
    assert len(rows) == len(RESULT_ROWS) - 1
    assert {(r.pos, r.medal) for r in rows if r.result_id == "11"} == {("3", "None")}
    assert {r.event for r in rows if r.result_id == "10"} == {"Eights,Women"}


def test_gold_averages_weigh_result_rows(spark, lake):
    gold = read(spark, lake, "gold", "avg_stats")
    assert gold.columns == ["sport", "medal", "sex", "country_noc", "avg_height", "avg_weight", "timestamp"]
    rows = {(r.sport, r.medal, r.sex, r.country_noc): (r.avg_height, r.avg_weight, r.timestamp) for r in gold.collect()}
    assert rows == {
        ("Rowing", "Gold", "Female", "NZL"): (180.0, 70.0, RUN),
        ("Rowing", "None", "Female", "NZL"): (180.0, 70.0, RUN),
        ("Rowing", "Gold", "Male", "CHN"): (170.5, 60.25, RUN),
    }


def test_a_run_replaces_the_one_before(spark, lake, tmp_path):
    landing = f"{lake}/../landing"
    again = run_medallion(spark, landing, str(tmp_path / "lake"), REPORT)
    assert again.count() == 3
    assert run_medallion(spark, landing, str(tmp_path / "lake"), REPORT, RUN).count() == 3


def test_every_result_row_counts(spark):
    results = [("1", "s", None, "X")] * 3 + [("2", "s", None, "X")]
    facts = spark.createDataFrame(results, "athlete_id string, sport string, medal string, country_noc string")
    athletes = [(1, "F", "100", "10"), (2, "F", "200", "20")]
    bios = spark.createDataFrame(athletes, "athlete_id int, sex string, height string, weight string")
    row = summarise(facts, bios, REPORT).first()
    assert (row.medal, row.avg_height, row.avg_weight) == (None, 125.0, 12.5)


def test_number_filter_runs_at_the_scan(spark, tmp_path, plan_of):
    df = spark.createDataFrame([("a b", "1"), ("ab", "1"), ("c", "x")], "t string, n string")
    df.write.parquet(str(tmp_path / "t"))
    refined = refine(spark.read.parquet(str(tmp_path / "t")), ["t"], ["n"])
    plan = plan_of(refined)
    assert plan.rindex("HashAggregate") < plan.index("Filter")
    assert [tuple(r) for r in refined.collect()] == [("ab", "1")]
    assert "PushedFilters: [IsNotNull(n)]" in plan
    assert "Python" not in plan


def test_odd_numbers_pass_the_filter_and_reach_the_average(spark):
    heights = ["180", "180.5", " 180 ", "180d", "NaN", "inf", "na", "", None]
    rows = [(i, f"sex {i}", h, "70") for i, h in enumerate(heights)]
    bios = spark.createDataFrame(rows, "athlete_id int, sex string, height string, weight string")
    facts = spark.range(9).selectExpr("id AS athlete_id", "'s' AS sport", "'m' AS medal", "'X' AS country_noc")
    silver = refine(bios, ["sex"], ["height", "weight"])
    rows = {r.sex: r.avg_height for r in summarise(facts, silver, REPORT).collect()}
    assert str(rows.pop("sex4")) == "nan"
    assert rows == {"sex0": 180.0, "sex1": 180.5, "sex2": 180.0, "sex3": 180.0, "sex5": float("inf")}


def test_csv_with_a_given_schema(spark, tmp_path):
    write_csv(tmp_path / "t.csv", ["id", "s"], [(1, "x"), (2, None)])
    assert read_csv(spark, str(tmp_path / "t.csv")).dtypes == [("id", "int"), ("s", "string")]
    typed = read_csv(spark, str(tmp_path / "t.csv"), "id string, s string")
    assert [tuple(r) for r in typed.collect()] == [("1", "x"), ("2", None)]


def test_previews(spark, capsys):
    df = spark.range(30).repartition(3)
    assert preview(df).count() == 10
    assert [r.id for r in preview(df, 3, order_by="id").collect()] == [0, 1, 2]
    show_preview(df, 2)
    printed = capsys.readouterr().out
    assert "id: long" in printed and "only showing top 2 rows" in printed
