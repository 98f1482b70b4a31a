import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskloom.operators.rollups import aggregate_loans, aggregate_ratings
from riskloom.plans.analysis import analyse, run_analysis_files
from riskloom.plans.bronze import Landed, bronze_tables, loans_have_ids, run_bronze, write_bronze, write_bronze_files
from riskloom.plans.gold import gold_tables, run_gold, run_gold_files
from riskloom.session import _stored_folder, release_stored, releasing, shared_folder, stored, together
from riskloom.sinks.tables import ensure_table, overwrite, upsert, write_csv, write_csv_unless_empty
from riskloom.sources.envelopes import parse_batches
from riskloom.sources.files import read_table_file
from riskloom.sources.feeds import normalise_loans
from riskloom.streaming.refresh import refresh
from riskloom.vocabulary import ANALYSIS_COLUMNS, LOAN_FIELDS, MASTER, _schema
from tests.conftest import values
from tests.test_sources import COUNTRY_PAGE, observation_page

FACTS = "iso3 string, year int, indicator string, value double"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def loan(number, country, date, principal):
    return {"loan_number": number, "country": country, "board_approval_date": date,
            "original_principal_amount": str(principal), "disbursed_amount": str(principal / 2)}


@pytest.fixture
def landed(tmp_path):
    root = str(tmp_path / "landed")
    put(f"{root}/countries/1.json", COUNTRY_PAGE)
    for code, values_ in {"EG.ELC.ACCS.ZS": (90.0, 70.0), "AG.LND.FRST.ZS": (60.0, 24.0)}.items():
        for page, year in ((1, "2022"), (2, "2023")):
            put(f"{root}/indicators/indicator={code}/{page}.json",
                observation_page(page, 2, ("BRA", "Brazil", year, values_[0]), ("IND", "India", year, values_[1]),
                                 ("WLD", "World", year, 50.0), ("USA", "United States", year, None)))
    put(f"{root}/ibrd/1.json", json.dumps({"count": 2, "data": [
        loan("L1", "Federative Republic of Brazil", "2022-03-15", 100.0), loan("L2", "Brazil", "2022-01-10", 50.0)]}))
    put(f"{root}/ida/1.json", json.dumps({"count": 1, "data": [loan("C1", "India", "2022-08-01", 30.0)]}))
    put(f"{root}/ratings/1.json", json.dumps({"count": 3, "data": [
        {"project_id": "P1", "country": "Brazil", "ieg_outcome": "Satisfactory", "exit_fy": "FY2022"},
        {"project_id": "P2", "country": "Brazil", "ieg_outcome": "Unsatisfactory", "exit_fy": "FY2022"},
        {"project_id": None, "country": "India", "ieg_outcome": "Satisfactory", "exit_fy": "2023"}]}))
    return Landed(f"{root}/countries", f"{root}/indicators",
                  {"IBRD": [f"{root}/missing", f"{root}/ibrd"], "IDA": [f"{root}/ida"]}, [f"{root}/ratings"])


# --- storing and writing ---------------------------------------------------------------------------------------------


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = stored(spark.range(5).toDF("n"), "numbers")
    assert df.count() == 5 and all(shared_folder(spark) in f for f in df.inputFiles())


def test_stored_tables_can_be_released(spark):
    folder = stored(spark.range(3).toDF("n"), "numbers").inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    release_stored(spark)
    assert not os.path.exists(folder) and stored(spark.range(3).toDF("n"), "numbers").count() == 3


def test_upsert_replaces_and_adds(spark, database):
    table = f"{database}.facts"
    first = spark.createDataFrame([("BRA", 2022, "X", 1.0), ("BRA", 2022, "X", 1.0), ("IND", 2022, "X", 2.0)], FACTS)
    keys = ["iso3", "year", "indicator"]
    assert upsert(first, table, keys).rows == 2
    second = spark.createDataFrame([("BRA", 2022, "X", 5.0), ("BRA", 2023, "X", 6.0), (None, 2023, "X", 7.0)], FACTS)
    written = upsert(second, table, keys)
    assert written.rows == 2 and values(written.quarantine, "value") == {(7.0,)}
    expected = {("BRA", 2022, 5.0), ("IND", 2022, 2.0), ("BRA", 2023, 6.0)}
    assert values(spark.table(table), "iso3", "year", "value") == expected
    upsert(second, table, keys)
    assert spark.table(table).count() == 3


def test_upsert_rewrites_touched_partitions_only(spark, database):
    table, keys = f"{database}.facts", ["iso3", "year", "indicator"]
    rows = [("BRA", y, "X", float(y)) for y in (2020, 2021, 2022)]
    upsert(spark.createDataFrame(rows, FACTS), table, keys, partition_by=["year"])
    before = {f for f in spark.table(table).inputFiles() if "year=2020" in f}
    upsert(spark.createDataFrame([("BRA", 2022, "X", 1.0), ("IND", 2022, "X", 2.0)], FACTS), table, keys,
           partition_by=["year"])
    assert {f for f in spark.table(table).inputFiles() if "year=2020" in f} == before
    assert values(spark.table(table), "iso3", "year", "value") == {
        ("BRA", 2020, 2020.0), ("BRA", 2021, 2021.0), ("BRA", 2022, 1.0), ("IND", 2022, 2.0),
    }
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_upsert_moves_a_row_between_partitions(spark, database):
    table, ddl = f"{database}.loans", "loan_id string, fiscal_year int, amount double"
    upsert(spark.createDataFrame([("L1", 2020, 1.0), ("L2", 2020, 2.0)], ddl), table, ["loan_id"], partition_by=["fiscal_year"])
    upsert(spark.createDataFrame([("L1", 2021, 9.0)], ddl), table, ["loan_id"], partition_by=["fiscal_year"])
    assert values(spark.table(table), "loan_id", "fiscal_year", "amount") == {("L1", 2021, 9.0), ("L2", 2020, 2.0)}


def test_ensure_table_creates_once(spark, database):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    ensure_table(df, f"{database}.t")
    ensure_table(df.select("n"), f"{database}.t")
    assert spark.table(f"{database}.t").columns == ["n", "s"] and spark.table(f"{database}.t").isEmpty()


def test_overwrite_replaces_rows_and_columns(spark, database):
    assert overwrite(spark.createDataFrame([(1,), (2,)], "n int"), f"{database}.t") == 2
    assert overwrite(spark.createDataFrame([("x",)], "s string"), f"{database}.t") == 1
    assert spark.table(f"{database}.t").collect() == [("x",)]


def test_csv(spark, tmp_path):
    rows = [(1, "Korea, Rep."), (2, None), (3, 'the "old" name'), (4, " padded ")]
    df = spark.createDataFrame(rows, "n int, s string")
    assert write_csv(df, str(tmp_path / "a.csv")) == 4
    assert values(read_table_file(spark, str(tmp_path / "a.csv"), df.schema), "n", "s") == set(rows)
    parts = [f for f in os.listdir(tmp_path / "a.csv") if f.endswith(".csv")]
    text = "".join((tmp_path / "a.csv" / f).read_text() for f in parts)
    assert '3,"the ""old"" name"' in text and "n,s" in text
    assert write_csv_unless_empty(df.limit(0), str(tmp_path / "b.csv")) == 0 and not (tmp_path / "b.csv").exists()


# --- jobs ------------------------------------------------------------------------------------------------------------


def test_bronze_tables(spark, landed):
    tables = bronze_tables(spark, landed, start=2022, end=2022)
    assert values(tables["esg"], "iso3", "year", "pillar") == {
        ("BRA", 2022, "social"), ("IND", 2022, "social"), ("BRA", 2022, "environmental"), ("IND", 2022, "environmental")}
    assert values(tables["loans"], "loan_id", "source", "fiscal_year") == {
        ("L1", "IBRD", 2022), ("L2", "IBRD", 2022), ("C1", "IDA", 2023)}
    assert set(bronze_tables(spark, landed, skip_ratings=True)) == {"esg", "loans"}


def test_a_missing_page_raises(spark, landed):
    put(f"{landed.indicators}/indicator=SI.POV.GINI/1.json", observation_page(1, 2, ("BRA", "Brazil", "2022", 50.0)))
    with pytest.raises(ValueError, match="1 of 2 pages of SI.POV.GINI"):
        bronze_tables(spark, landed)


def test_rows_without_a_key_are_kept(spark, landed, database):
    put(f"{landed.loans['IDA'][0]}/1.json", json.dumps({"count": 2, "data": [
        loan("C1", "India", "2022-08-01", 30.0), loan(None, "Chad", "2022-08-01", 7.0)]}))
    for _ in range(2):
        assert run_bronze(spark, landed, database)["loans"].rows == 3
        assert values(spark.table(f"{database}.loans_quarantine"), "country", "commitment_amount") == {("Chad", 7.0)}
        assert spark.table(f"{database}.loans_quarantine").count() == 1
    put(f"{landed.loans['IDA'][0]}/1.json", json.dumps({"count": 1, "data": [loan("C1", "India", "2022-08-01", 30.0)]}))
    run_bronze(spark, landed, database)
    assert spark.table(f"{database}.loans_quarantine").isEmpty()


def test_whole_pipeline_over_tables(spark, landed, database):
    for _ in range(2):  # a second run changes nothing
        written = run_bronze(spark, landed, database)
        assert {k: v.rows for k, v in written.items()} == {"esg": 8, "loans": 3, "ratings": 2}
    assert spark.table(f"{database}.esg").count() == 8
    counts = run_gold(spark, database)
    assert counts == {"aggregate_esg": 4, "aggregate_loans": 3, "aggregate_ratings": 1, "esg_lending_master": 4}
    master = spark.table(f"{database}.esg_lending_master")
    assert master.columns == MASTER.names
    assert values(master, "iso3", "year", "esg_risk_score", "lending_amount", "success_rate") == {
        ("BRA", 2022, 0.0, 150.0, 50.0), ("BRA", 2023, 0.0, None, None),
        ("IND", 2022, 100.0, None, None), ("IND", 2023, 100.0, 30.0, None)}
    outputs = analyse(master)
    assert values(outputs["top_gap"], "country") == set()
    assert values(outputs["country_summary"], "country", "latest_year", "total_lending_usd", "lending_gap") == {
        ("Brazil", 2023, 150.0, 0), ("India", 2023, 30.0, 0)}
    assert all(df.columns for df in outputs.values())
    for df in outputs.values():
        df.collect()


def left_over(spark):
    folder = _stored_folder(spark)
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_jobs_leave_nothing_stored(spark, landed, database, tmp_path):
    before = left_over(spark)
    run_bronze(spark, landed, database)
    run_bronze(spark, landed, database)
    assert run_gold(spark, database)["esg_lending_master"] == spark.table(f"{database}.esg_lending_master").count()
    write_csv(spark.table(f"{database}.esg_lending_master"), str(tmp_path / "master.csv"))
    run_analysis_files(spark, str(tmp_path / "master.csv"), str(tmp_path))
    assert left_over(spark) == before


def test_a_job_only_releases_its_own_tables(spark):
    df = spark.range(3)
    outer = stored(df, "outer")
    with releasing(spark):
        mine = stored(df, "mine")
        with releasing(spark):
            inner = together(lambda: stored(df, "a"), lambda: stored(df, "b"))
            assert [t.count() for t in inner] == [3, 3]
        assert not {"a", "b"} & {name.split("-")[0] for name in left_over(spark)} and mine.count() == 3
    assert outer.count() == 3 and "mine" not in {name.split("-")[0] for name in left_over(spark)}
    with pytest.raises(RuntimeError), releasing(spark):
        kept = stored(df, "kept")
        raise RuntimeError
    assert kept.count() == 3


def test_gold_without_loans_and_ratings(spark, landed, database):
    tables = bronze_tables(spark, landed)
    write_bronze({"esg": tables["esg"]}, database)
    assert set(run_gold(spark, database)) == {"aggregate_esg", "esg_lending_master"}
    assert spark.table(f"{database}.esg_lending_master").filter("lending_amount IS NOT NULL").isEmpty()


def test_pipeline_over_files(spark, landed, tmp_path):
    bronze = bronze_tables(spark, landed, skip_ratings=True)
    assert write_bronze_files(bronze, str(tmp_path)) == {"esg": 8, "loans": 3}
    counts = run_gold_files(spark, str(tmp_path), str(tmp_path / "out"))
    assert counts["esg_lending_master"] == 4 and counts["aggregate_ratings"] == 0
    assert not (tmp_path / "out" / "aggregate_ratings.csv").exists()
    written = run_analysis_files(spark, str(tmp_path / "out" / "esg_lending_master.csv"), str(tmp_path / "out"))
    assert written == {"analysis": 4, "country_summary": 2}
    header = spark.read.csv(str(tmp_path / "out" / "analysis.csv"), header=True).columns
    assert header == list(ANALYSIS_COLUMNS)


def test_loans_without_ids_are_upserted_per_source(spark, database):
    loans = spark.createDataFrame(
        [(None, "Chad", 2020, 1.0, 1.0, "IDA"), (None, "Chad", 2020, 2.0, 1.0, "IDA")],
        "loan_id string, country string, fiscal_year int, commitment_amount double, disbursement_amount double, source string")
    esg = spark.createDataFrame([("TCD", 2020, "X", 1.0)], FACTS)
    assert not loans_have_ids(loans)
    for _ in range(2):
        write_bronze({"esg": esg, "loans": loans}, database)
    assert values(spark.table(f"{database}.loans"), "country", "commitment_amount") == {("Chad", 3.0)}


def test_gold_tables_equal_their_operators(spark, landed):
    tables = bronze_tables(spark, landed)
    gold = gold_tables(tables["esg"], tables["loans"], tables["ratings"])
    assert sorted(gold["aggregate_loans"].collect()) == sorted(aggregate_loans(tables["loans"]).collect())
    assert sorted(gold["aggregate_ratings"].collect()) == sorted(aggregate_ratings(tables["ratings"]).collect())


def test_refresh_takes_new_pages_only(spark, landed, database, tmp_path):
    fields = [*LOAN_FIELDS["loan_id"][:1], "country", "board_approval_date", "original_principal_amount", "disbursed_amount"]
    layout = _schema(", ".join(f"{f} string" for f in fields))
    parse = lambda pages: normalise_loans(parse_batches(pages, layout), "IBRD")
    folder = landed.loans["IBRD"][1]
    arguments = (spark, folder, str(tmp_path / "progress"), f"{database}.loans", ["loan_id"], parse)
    assert refresh(*arguments) == 1 and spark.table(f"{database}.loans").count() == 2
    assert refresh(*arguments) == 0
    put(f"{folder}/2.json", json.dumps({"count": 3, "data": [
        loan("L2", "Brazil", "2022-01-10", 75.0), loan("L9", "Chad", "2023-09-01", 5.0),
        loan(None, "Mali", "2023-09-01", 6.0)]}))
    assert refresh(*arguments) == 1
    assert values(spark.table(f"{database}.loans"), "loan_id", "fiscal_year", "commitment_amount") == {
        ("L1", 2022, 100.0), ("L2", 2022, 75.0), ("L9", 2024, 5.0)}
    assert values(spark.table(f"{database}.loans_quarantine"), "country") == {("Mali",)}
    assert spark.table(f"{database}.loans").filter(F.col("source") != "IBRD").isEmpty()


# --- upserts by bucket, batches that run again, feeds that land bit by bit ---------------------------------------------

LOAN = "loan_id string, country string, fiscal_year int, commitment_amount double, disbursement_amount double, source string"


def test_upsert_rewrites_touched_buckets_only(spark, database):
    table = f"{database}.loans"
    rows = [(f"L{k}", "Chad", 2020, float(k), 0.0, "IDA") for k in range(200)]
    upsert(spark.createDataFrame(rows, LOAN), table, ["loan_id"], buckets=16)
    before = set(spark.table(table).inputFiles())
    for buckets in (16, 5):  # a table keeps the number of buckets it has
        upsert(spark.createDataFrame([("L7", "Chad", 2020, -1.0, 0.0, "IDA"), ("N1", "Chad", 2020, -2.0, 0.0, "IDA")], LOAN),
               table, ["loan_id"], buckets=buckets)
        assert len(before - set(spark.table(table).inputFiles())) <= 2
    got = values(spark.table(table), "loan_id", "commitment_amount")
    assert got == {(f"L{k}", float(k) if k != 7 else -1.0) for k in range(200)} | {("N1", -2.0)}
    assert spark.table(table).count() == 201


def test_loans_with_ids_then_without_then_mixed(spark, database):
    esg = spark.createDataFrame([("TCD", 2020, "X", 1.0)], FACTS)
    ids = [("L1", "Chad", 2020, 1.0, 1.0, "IDA"), ("L2", "Mali", 2020, 2.0, 1.0, "IDA")]
    none = [(None, "Chad", 2020, 4.0, 1.0, "IBRD"), (None, "Chad", 2020, 5.0, 1.0, "IBRD"), (None, None, 2020, 6.0, 1.0, "IBRD")]
    mixed = [("L2", "Mali", 2020, 9.0, 1.0, "IDA"), (None, "Mali", 2020, 7.0, 1.0, "IDA")]
    for rows, aside in ((ids, None), (none, 6.0), (mixed, 7.0)):
        write_bronze({"esg": esg, "loans": spark.createDataFrame(rows, LOAN)}, database)
        if aside:
            assert values(spark.table(f"{database}.loans_quarantine"), "commitment_amount") == {(aside,)}
    assert values(spark.table(f"{database}.loans"), "loan_id", "country", "commitment_amount") == {
        ("L1", "Chad", 1.0), ("L2", "Mali", 9.0), ("all|Chad|2020|IBRD", "Chad", 9.0)}


def test_a_batch_that_runs_again_sets_its_rows_aside_once(spark, database, tmp_path, monkeypatch):
    from riskloom.streaming import refresh as module

    parse = lambda pages: normalise_loans(parse_batches(pages, _schema(", ".join(f"{f} string" for f in loan(1, "", "", 1)))), "IDA")
    folder, table = str(tmp_path / "pages"), f"{database}.loans"
    put(f"{folder}/1.json", json.dumps({"count": 2, "data": [loan("L1", "Chad", "2022-01-10", 1.0), loan(None, "Mali", "2022-01-10", 2.0)]}))
    arguments = (spark, folder, str(tmp_path / "progress"), table, ["loan_id"], parse)
    write = module.set_aside

    def die(*args):
        write(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(module, "set_aside", die)
    with pytest.raises(Exception, match="lost after the write"):
        refresh(*arguments)
    monkeypatch.setattr(module, "set_aside", write)
    assert refresh(*arguments) == 1
    assert spark.table(f"{table}_quarantine").count() == 1 and spark.table(table).count() == 1
    put(f"{folder}/2.json", json.dumps({"count": 1, "data": [loan(None, "Mali", "2022-01-10", 3.0)]}))
    refresh(*arguments)
    assert values(spark.table(f"{table}_quarantine"), "commitment_amount") == {(2.0,), (3.0,)}


def test_a_feed_is_merged_after_its_last_page(spark, database, tmp_path):
    from riskloom.sources.envelopes import batch_completeness
    from riskloom.streaming.refresh import waiting_pages

    parse = lambda pages: normalise_loans(parse_batches(pages, _schema(", ".join(f"{f} string" for f in loan(1, "", "", 1)))), "IDA")
    folder, table, progress = str(tmp_path / "pages"), f"{database}.loans", str(tmp_path / "progress")
    calls = []

    def counted_parse(pages):
        calls.append(sorted(r.feed for r in pages.select("feed").collect()))
        return parse(pages)

    def run():
        return refresh(spark, folder, progress, table, ["loan_id"], counted_parse,
                       feed=F.regexp_extract("path", "/([a-z]+)/[0-9]+.json$", 1), completeness=batch_completeness)

    def page(feed, k, count, *ids):
        put(f"{folder}/{feed}/{k}.json", json.dumps({"count": count, "data": [loan(i, "Chad", "2022-01-10", 1.0) for i in ids]}))

    page("ida", 1, 3, "A")
    page("ibrd", 1, 1, "X")
    assert run() == 1 and values(spark.table(table), "loan_id") == {("X",)}
    page("ida", 2, 3, "B")
    assert run() == 1 and values(spark.table(table), "loan_id") == {("X",)}
    assert waiting_pages(spark, progress, 2).count() == 2
    page("ida", 3, 3, "C")
    assert run() == 1 and values(spark.table(table), "loan_id") == {("X",), ("A",), ("B",), ("C",)}
    assert calls == [["ibrd"], [], ["ida"] * 3] and waiting_pages(spark, progress, 3).isEmpty()


def test_pages_in_bundles_and_a_batch_without_a_complete_feed(spark, database, tmp_path):
    from riskloom.plans.job_queries import _land
    from riskloom.sources.envelopes import batch_completeness
    from riskloom.streaming.refresh import waiting_pages

    parse = lambda pages: normalise_loans(parse_batches(pages, _schema(", ".join(f"{f} string" for f in loan(1, "", "", 1)))), "IDA")
    folder, table, progress = str(tmp_path / "pages"), f"{database}.loans", str(tmp_path / "progress")

    def land(feed, count, *ids):
        pages = [(feed, json.dumps({"count": count, "data": [loan(i, "Chad\r\n", "2022-01-10", 1.0)]})) for i in ids]
        _land(spark.createDataFrame(pages, "feed string, page string").coalesce(1), folder, "feed", 500)

    def run():
        return refresh(spark, folder, progress, table, ["loan_id"], parse, feed=F.regexp_extract("path", "feed=([^/]+)", 1),
                       completeness=batch_completeness, page_per_line=True)

    land("ibrd", 3, "X", "Y", "Z")
    land("ida", 4, "A", "B")
    assert len(list((tmp_path / "pages").rglob("*.txt"))) == 2
    assert run() == 1 and values(spark.table(table), "loan_id") == {("X",), ("Y",), ("Z",)}
    before = {p: p.stat().st_mtime_ns for p in (Path(f.removeprefix("file:")) for f in spark.table(table).inputFiles())}
    land("ida", 4, "C")
    assert run() == 1 and waiting_pages(spark, progress, 2).count() == 3
    # nothing was complete, so the table was not written again
    assert {p: p.stat().st_mtime_ns for p in (Path(f.removeprefix("file:")) for f in spark.table(table).inputFiles())} == before
    land("ida", 4, "D")
    assert run() == 1 and values(spark.table(table), "loan_id") == {(i,) for i in "XYZABCD"}


def test_missing_rows_of_a_feed_raise(spark, landed):
    put(f"{landed.loans['IDA'][0]}/1.json", json.dumps({"count": 2, "data": [loan("C1", "India", "2022-08-01", 30.0)]}))
    with pytest.raises(ValueError, match="1 of 2 rows of IDA"):
        bronze_tables(spark, landed)


@pytest.mark.parametrize("parts", [(), ("part",)])
def test_an_overwrite_that_dies_leaves_the_table(spark, database, parts):
    table = f"{database}.t"
    df = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    assert overwrite(df, table, partition_by=parts) == 10
    dies = df.withColumn("id", F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("gone")).cast("bigint")))
    with pytest.raises(Exception, match="gone"):
        overwrite(dies, table, partition_by=parts)
    assert spark.table(table).count() == 10
    assert overwrite(df.filter("id < 4"), table, partition_by=parts) == 4 and values(spark.table(table), "id") == {(0,), (1,), (2,), (3,)}
    assert overwrite(df.select("id", "part", F.lit("x").alias("s")), table, partition_by=parts) == 10
    assert set(spark.table(table).columns) == {"id", "part", "s"} and spark.table(table).count() == 10
