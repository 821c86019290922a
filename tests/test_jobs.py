"""The programs, over files in place of database and broker."""

import pytest

from podium import jobs

BIO_CSV = "athlete_id,sex,country_noc,height,weight\n1,M,X,180,80\n2,F,Y,170,60\n"
RESULTS_CSV = "athlete_id,sport,medal,country_noc\n1,Golf,Gold,A\n2,Golf,Gold,A\n2,Golf,,A\n"


@pytest.fixture
def root(spark, tmp_path):
    (tmp_path / "athlete_bio.csv").write_text(BIO_CSV)
    (tmp_path / "athlete_event_results.csv").write_text(RESULTS_CSV)
    root = str(tmp_path / "layers")
    jobs.main(["landing-to-bronze", "--landing", str(tmp_path), "--root", root])
    return root


def test_layers(spark, root, capsys):
    jobs.main(["bronze-to-silver", "--root", root])
    jobs.main(["silver-to-gold", "--root", root, "--preview", "5"])
    assert "avg_height" in capsys.readouterr().out
    assert spark.read.parquet(f"{root}/gold/avg_stats").count() == 3


def test_all_layers_with_a_schema(spark, root, tmp_path):
    other = str(tmp_path / "other")
    ddl = "athlete_id long, sport string, medal string, country_noc string"
    jobs.main(
        ["medallion", "--landing", str(tmp_path), "--root", other,
         "--schema", f"athlete_event_results={ddl}"]
    )
    bronze = spark.read.parquet(f"{other}/bronze/athlete_event_results")
    assert bronze.schema["athlete_id"].dataType.simpleString() == "bigint"
    assert spark.read.parquet(f"{other}/gold/avg_stats").count() == 3


def test_publish_enrich_consume(spark, root, tmp_path, capsys):
    feed, enriched, table, out = (str(tmp_path / p) for p in ("feed", "avg", "table", "out"))
    jobs.main(
        ["publish", "--table", f"{root}/bronze/athlete_event_results", "--topic", feed,
         "--format", "text"]
    )
    jobs.main(
        ["enrich", "--topic", feed, "--format", "text", "--bio", f"{root}/bronze/athlete_bio",
         "--out-topic", enriched, "--out-table", table, "--checkpoint", str(tmp_path / "c"),
         "--available-now", "--console"]
    )
    jobs.main(
        ["consume", "--topic", enriched, "--format", "text", "--path", out,
         "--checkpoint", str(tmp_path / "c2")]
    )
    got = {(r.sport, r.medal, r.sex, r.country_noc, r.avg_height) for r in spark.read.parquet(out).collect()}
    assert got == {
        ("Golf", "Gold", "M", "X", 180.0),
        ("Golf", "Gold", "F", "Y", 170.0),
        ("Golf", None, "F", "Y", 170.0),
    }
    assert spark.read.parquet(table).count() == 3
    jobs.main(["consume", "--topic", enriched, "--format", "text"])
    assert "Batch: 0" in capsys.readouterr().out


def test_ledger(spark, root, tmp_path, capsys):
    ledger = str(tmp_path / "ledger")
    results = f"{root}/bronze/athlete_event_results"
    assert jobs.main(["ledger", "--table", results, "--ledger", ledger, "--pair", "Bronze=Gold"]) == 0
    assert spark.read.parquet(ledger).select("medal_type", "count").collect() == [("Bronze", 2)]
    assert jobs.main(["ledger-check", "--ledger", ledger, "--seconds", "600"]) == 0
    assert "fresh" in capsys.readouterr().out
    assert jobs.main(["ledger-check", "--ledger", ledger, "--seconds", "0"]) == 1


def test_password_comes_from_the_environment(monkeypatch):
    monkeypatch.setenv(jobs.PASSWORD, "hidden")
    args = jobs.parser().parse_args(
        ["publish", "--url", "jdbc:x", "--user", "u", "--table", "t", "--topic", "p"]
    )
    assert jobs.database(args, "t")["password"] == "hidden"
