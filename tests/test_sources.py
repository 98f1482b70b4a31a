import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from riskloom.sources import star
from riskloom.sources.envelopes import (
    batch_completeness, pair_page_completeness, parse_batches, parse_countries, parse_observations, read_batches,
    read_pages,
)
from riskloom.sources.feeds import (
    esg_bronze, loans_bronze, normalise_loans, normalise_ratings, pillar_of, union_feeds,
)
from riskloom.sources.files import read_managed, read_table_file
from riskloom.sources.resolve import first_non_empty, resolve, resolved
from riskloom.vocabulary import INDICATORS, LOANS, RATINGS, _schema
from tests.conftest import values

COUNTRY_PAGE = json.dumps([
    {"page": 1, "pages": 1, "per_page": 400, "total": 3},
    [
        {"id": "BRA", "iso2Code": "BR", "name": "Brazil", "region": {"value": "Latin America & Caribbean"},
         "incomeLevel": {"value": "Upper middle income"}},
        {"id": "IND", "iso2Code": "IN", "name": "India", "region": {"value": "South Asia"},
         "incomeLevel": {"value": "Lower middle income"}},
        {"id": "WLD", "iso2Code": "1W", "name": "World", "region": {"value": "Aggregates"},
         "incomeLevel": {"value": "Aggregates"}},
    ],
])


def observation_page(page, pages, *rows):
    return json.dumps([
        {"page": page, "pages": pages},
        [{"countryiso3code": c, "country": {"value": n}, "date": y, "value": v, "indicator": {"id": "X"}}
         for c, n, y, v in rows],
    ])


def pages_of(spark, *pages, indicator="EG.ELC.ACCS.ZS"):
    return spark.createDataFrame([(p, indicator) for p in pages], "page string, indicator string")


def raw_loans(spark):
    return spark.createDataFrame(
        [("L001", "Brazil", "2022-03-15", 1_000_000.0, 500_000.0),
         ("L002", "India", "2022-08-01", 2_000_000.0, 1_000_000.0),
         ("L003", "Brazil", "2023-01-10", 500_000.0, 250_000.0)],
        "loan_number string, country string, board_approval_date string, original_principal_amount double, "
        "disbursed_amount double",
    )


def raw_ratings(spark):
    return spark.createDataFrame(
        [("P001", "Brazil", "Satisfactory", "Finance", "2022"),
         ("P002", "Brazil", "Unsatisfactory", "Transport", "2022"),
         ("P003", "India", "Moderately Satisfactory", "Health", "2021"),
         ("P004", "  India  ", "Highly Satisfactory", "Education", "2021")],
        "project_id string, country string, ieg_outcome string, sector_board string, exit_fy string",
    )


def test_country_totals_are_dropped(spark):
    countries = parse_countries(spark.createDataFrame([(COUNTRY_PAGE,)], "page string"))
    assert values(countries, "iso3", "iso2", "country") == {("BRA", "BR", "Brazil"), ("IND", "IN", "India")}
    assert countries.columns == ["iso3", "iso2", "country", "region", "income_level"]


def test_country_without_region_is_kept(spark):
    page = json.dumps([{}, [{"id": "XKX", "iso2Code": "XK", "name": "Kosovo"}]])
    assert values(parse_countries(spark.createDataFrame([(page,)], "page string")), "iso3") == {("XKX",)}


def test_observations_without_value_are_dropped(spark):
    page = observation_page(1, 1, ("BRA", "Brazil", "2022", 0.5), ("IND", "India", "2022", 0.2),
                            ("USA", "United States", "2022", None))
    rows = parse_observations(pages_of(spark, page))
    assert values(rows, "iso3", "year", "value") == {("BRA", 2022, 0.5), ("IND", 2022, 0.2)}
    assert dict(rows.dtypes)["year"] == "int" and dict(rows.dtypes)["value"] == "double"


@pytest.mark.parametrize("page", ['[{"page": 1, "pages": 1}, null]', '[{"message": "bad code"}]', "{}"])
def test_pages_without_rows(spark, page):
    assert parse_observations(pages_of(spark, page)).isEmpty()


@pytest.mark.parametrize("page", ["not json", '[{"page": 1, "pages": 1}, [{"value"'])
def test_damaged_page_raises(spark, page):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse_observations(pages_of(spark, page)).collect()


def test_two_pages_give_all_rows_and_count_as_complete(spark):
    one = observation_page(1, 2, ("BRA", "Brazil", "2022", 0.5))
    two = observation_page(2, 2, ("IND", "India", "2022", 0.2))
    assert parse_observations(pages_of(spark, one, two)).count() == 2
    assert values(pair_page_completeness(pages_of(spark, one, two)), "pages_landed", "complete") == {(2, True)}
    assert values(pair_page_completeness(pages_of(spark, one)), "pages_landed", "complete") == {(1, False)}


def test_batches_from_text_and_from_files(spark, tmp_path):
    batches = [{"count": 3, "data": [{"id": "a"}, {"id": "b"}]}, {"count": 3, "data": [{"id": "c"}]}]
    pages = spark.createDataFrame([(json.dumps(b), "f") for b in batches], "page string, feed string")
    assert values(parse_batches(pages, _schema("id string")), "id") == {("a",), ("b",), ("c",)}
    assert values(batch_completeness(pages), "rows_landed", "rows_announced", "complete") == {(3, 3, True)}
    assert values(batch_completeness(pages.limit(1)), "rows_landed", "complete") == {(2, False)}
    for i, batch in enumerate(batches):
        (tmp_path / f"{i}.json").write_text(json.dumps(batch, indent=1))
    assert values(read_batches(spark, str(tmp_path)), "id") == {("a",), ("b",), ("c",)}
    assert read_batches(spark, str(tmp_path), _schema("id string, other double")).columns == ["id", "other"]
    assert read_pages(spark, str(tmp_path)).count() == 2


def test_first_non_empty(spark, tmp_path):
    empty, full = spark.createDataFrame([], "a int"), spark.createDataFrame([(1,)], "a int")
    missing = str(tmp_path / "missing")
    assert first_non_empty([missing, empty, full], spark, empty.schema).count() == 1
    assert first_non_empty([missing, empty], spark, empty.schema).isEmpty()


def test_resolution_ignores_case_and_keeps_candidate_order(spark):
    df = spark.createDataFrame([(1, 2)], "Second int, FIRST int")
    assert resolve(df, ["first", "second"]) == "FIRST"
    assert resolve(df, ["third"]) is None
    assert df.select(resolved(df, ["third"], "double").alias("x")).dtypes == [("x", "double")]


def test_loans_of_two_feeds_are_not_added_up(spark):
    loans = loans_bronze({"IBRD": raw_loans(spark), "IDA": raw_loans(spark)})
    assert loans.count() == 6 and loans.columns == LOANS.names
    assert values(loans, "source") == {("IBRD",), ("IDA",)}
    assert values(loans, "loan_id", "fiscal_year") == {("L001", 2022), ("L002", 2023), ("L003", 2023)}
    assert loans_bronze({"IBRD": raw_loans(spark)}, start=2023, end=2023).count() == 2


def test_loans_without_required_columns_are_empty(spark):
    loans = normalise_loans(spark.createDataFrame([("X", 1)], "loan_number string, some_col int"), "IBRD")
    assert loans.isEmpty() and loans.columns == LOANS.names


def test_loans_with_bad_values(spark):
    raw = spark.createDataFrame(
        [("1", " Chad\t", "2020-01-01", "abc"), ("2", "Chad", "never", "5"), ("3", None, "2020-08-01", "7.5")],
        "credit_number string, Country_Economy string, agreement_signing_date string, "
        "original_principal_amount_us string",
    )
    loans = normalise_loans(raw, "IDA")
    assert values(loans, "loan_id", "country", "fiscal_year", "commitment_amount", "disbursement_amount") == {
        ("1", "Chad", 2020, None, 0.0), ("3", None, 2021, 7.5, 0.0),
    }


def test_ratings(spark):
    ratings = normalise_ratings(raw_ratings(spark))
    assert ratings.columns == RATINGS.names
    assert [f.dataType for f in ratings.schema] == [f.dataType for f in RATINGS]
    assert values(ratings, "project_id", "country", "closing_year", "is_successful") == {
        ("P001", "Brazil", 2022, 1), ("P002", "Brazil", 2022, 0), ("P003", "India", 2021, 1), ("P004", "India", 2021, 1),
    }


def test_ratings_lacking_all_columns_are_null(spark):
    ratings = normalise_ratings(spark.createDataFrame([(1,)], "other int"))
    assert ratings.collect() == [(None, None, None, None, None, 0)]


def test_esg_bronze(spark):
    page = observation_page(1, 1, ("BRA", "Brazil", "2021", 1.0), ("BRA", "Brazil", "2022", 2.0), ("WLD", "World", "2022", 3.0))
    countries = parse_countries(spark.createDataFrame([(COUNTRY_PAGE,)], "page string"))
    observations = parse_observations(pages_of(spark, page))
    assert values(esg_bronze(observations, countries), "iso3", "year", "pillar") == {
        ("BRA", 2021, "social"), ("BRA", 2022, "social"),
    }
    assert esg_bronze(observations, countries, start=2022, end=2022).count() == 1
    unknown = parse_observations(pages_of(spark, page, indicator="OTHER"))
    assert esg_bronze(unknown, countries).isEmpty()


def test_every_indicator_has_its_pillar(spark):
    df = spark.createDataFrame([(c,) for c in [*INDICATORS, "OTHER"]], "code string")
    got = dict(df.select("code", pillar_of(F.col("code"))).collect())
    assert got == {c: entry[0] for c, entry in INDICATORS.items()} | {"OTHER": None}


def test_union_matches_names(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([("y", 2)], "s string, n int")
    assert values(union_feeds(a, b, a.select("n")), "n", "s") == {(1, "x"), (2, "y"), (1, None)}


def test_csv_scan_matches_columns_by_name(spark, tmp_path):
    (tmp_path / "loans.csv").write_text(
        "country,loan_id,extra,fiscal_year,commitment_amount\nBrazil,L1,z,2022.0,1.5\n\"Korea, Rep.\",L2,z,,abc\n"
    )
    loans = read_table_file(spark, str(tmp_path / "loans.csv"), LOANS)
    assert loans.schema.names == LOANS.names
    assert values(loans, "loan_id", "country", "fiscal_year", "commitment_amount", "source") == {
        ("L1", "Brazil", 2022, 1.5, None), ("L2", "Korea, Rep.", None, None, None),
    }


def test_csv_folder_with_three_headers(spark, tmp_path):
    folder = tmp_path / "some loans"
    folder.mkdir()
    (folder / "a 1.csv").write_text("loan_id,country,fiscal_year\nL1,Brazil,2020\n")
    (folder / "b.csv").write_text("fiscal_year,extra,loan_id,country\n2021,x,L2,\"Korea, Rep.\"\n2022,y,L3,Peru\n")
    (folder / "c.csv").write_text("\ncountry,\"loan_id\"\nChile,L4\n")
    (folder / "d.csv").write_text("loan_id,country,fiscal_year\nL5,Fiji,2019\n")
    (folder / "e.csv").write_text("")
    loans = read_table_file(spark, str(folder), LOANS)
    assert loans.schema.names == LOANS.names
    assert values(loans, "loan_id", "country", "fiscal_year", "source") == {
        ("L1", "Brazil", 2020, None), ("L2", "Korea, Rep.", 2021, None), ("L3", "Peru", 2022, None),
        ("L4", "Chile", None, None), ("L5", "Fiji", 2019, None),
    }
    assert loans.count() == 5 and loans.filter("country = 'Peru'").count() == 1
    wide = [f"/w{i}.csv" for i in range(3)]
    many = tmp_path / "many"
    many.mkdir()
    for i, name in enumerate(wide):
        rows = "".join(f"{i}-{n},{n}\n" if i % 2 else f"{n},{i}-{n}\n" for n in range(5000))
        (many / name[1:]).write_text(("loan_id,fiscal_year\n" if i % 2 else "fiscal_year,loan_id\n") + rows)
    got = read_table_file(spark, str(many), LOANS)
    assert got.filter(F.split("loan_id", "-")[1].cast("int") == F.col("fiscal_year")).count() == 15000 == got.count()


def test_nan_reads_as_null(spark, tmp_path, database):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "fiscal_year int, commitment_amount double")
    df.write.parquet(str(tmp_path / "p"))
    df.write.saveAsTable(f"{database}.loans")
    (tmp_path / "c.csv").write_text("fiscal_year,commitment_amount\n1,NaN\n2,3.0\nNaN,1e400\n1e30,\n")
    expected = {(1, None), (2, 3.0)}
    columns = ("fiscal_year", "commitment_amount")
    assert values(read_table_file(spark, str(tmp_path / "p"), df.schema, fmt="parquet"), *columns) == expected
    assert values(read_managed(spark, f"{database}.loans", LOANS), *columns) == expected
    got = values(read_table_file(spark, str(tmp_path / "c.csv"), LOANS), *columns)
    assert got == expected | {(None, float("inf")), (None, None)}


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    loans = normalise_loans(raw_loans(spark), "IBRD")
    loans.write.format(fmt).save(str(tmp_path / fmt))
    assert sorted(read_table_file(spark, str(tmp_path / fmt), LOANS, fmt=fmt).collect()) == sorted(loans.collect())


def test_missing_files(spark, tmp_path):
    path = str(tmp_path / "none.csv")
    assert read_table_file(spark, path, LOANS, optional=True).isEmpty()
    with pytest.raises(AnalysisException):
        read_table_file(spark, path, LOANS)


def test_missing_managed_table_reads_as_empty(spark, database):
    assert read_managed(spark, f"{database}.loans", LOANS, optional=True).columns == LOANS.names


@pytest.mark.parametrize("build", [star.esg, star.ratings])
def test_line_items_are_joined_once(spark, tmp_path, build):
    from datetime import datetime

    day = datetime(2020, 3, 1)
    rows = {
        "customer": [(1, "A", 0, 0.0, "X"), (2, "B", 0, 0.0, "X"), (None, "C", 0, 0.0, "X")],
        "orders": [(10, 1, "F", 1.0, day, "5-LOW"), (10, 2, "F", 1.0, day, "5-LOW"), (11, None, "F", 1.0, day, "5-LOW"), (None, 1, "F", 1.0, day, "5-LOW")],
        "lineitem": [(k, 1, 1, n, 1.0, 4.0, 0.0, 0.0, "A", "O", day) for k, n in ((10, 1), (10, 2), (11, 1), (None, 1))],
    }
    for name, some in rows.items():
        spark.createDataFrame(some, star.SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = build(spark, str(tmp_path), "customer")
    if build is star.esg:
        assert sorted((r.iso3, r.year, r.value) for r in df.collect()) == [("1", 2020, 4.0), ("2", 2020, 4.0)]
    else:
        assert sorted((r.project_id, r.country) for r in df.collect()) == [("10-1", "A"), ("10-1", "B"), ("10-2", "A"), ("10-2", "B")]
    # texts in the plan hold line breaks of their own
    plan = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if line.lstrip(" :")[:3] == "+- " or ":- " in line]
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    (k,) = [k for k, line in enumerate(plan) if "Relation" in line and "l_orderkey" in line]
    joins, depth = 0, indent(plan[k])
    for line in reversed(plan[:k]):
        if indent(line) < depth:
            depth = indent(line)
            joins += "Join" in line
    assert joins == 1
