from __future__ import annotations

import json

import pytest

from conftest import rows
from starloom.cli import main, parse

HEADER = "age,sex,bmi,children,smoker,region,charges\n"
LINES = "19,female,27.9,0,yes,southwest,16884.924\n18,male,33.77,1,no,southeast,1725.5523\n28,male,33,3,no,southeast,nan\n"


@pytest.fixture
def files(tmp_path):
    (tmp_path / "insurance.csv").write_text(HEADER + LINES * 10)
    regions = [{"region": "southwest", "preferred_provider": "A", "network_tier": "t"}]
    (tmp_path / "providers.json").write_text(json.dumps({"regions": regions}))
    return str(tmp_path)


def test_jobs_run_from_files(spark, files, capsys):
    main(["batch", "--insurance", f"{files}/insurance.csv", "--database", "cli_batch"], spark)
    assert spark.table("cli_batch.fact_insurance_silver").count() == 30
    assert rows(spark.table("cli_batch.gold_region_smoker"))[0] == ("southeast", "no", 20, 17255.52, 1725.55)
    main(["mart", "--insurance", f"{files}/insurance.csv", "--providers", f"{files}/providers.json", "--database", "cli_mart"], spark)
    assert spark.table("cli_mart.dim_insured").count() == 3
    assert [r[0] for r in rows(spark.table("cli_mart.fact_claims"), "claim_key")] == sorted(range(1, 31), key=str)
    main(
        ["medallion", "--insurance", f"{files}/insurance.csv", "--database", "cli_medallion", "--base", f"{files}/base",
         "--calendar", "2025-01-01:2026-01-01"],
        spark,
    )
    silver = spark.table("cli_medallion.fact_insurance_silver")
    assert silver.count() == 55 and silver.where("date_key IS NULL").count() == 0
    assert "fact_claims" in capsys.readouterr().out
    spark.sql("USE default")


def test_arguments():
    args = parse(["batch", "--insurance", "x"])
    assert (args.order, args.database, args.calendar) == (None, "default", "2000-01-01:2010-12-31")
    with pytest.raises(SystemExit):
        parse(["other", "--insurance", "x"])
