from layerhouse.__main__ import execute, parse
from layerhouse.sources import landing

import pytest


def test_generate_step(spark, tmp_path, capsys):
    execute(spark, parse(["generate", "--landing", str(tmp_path), "--orders", "50"]))
    assert landing.read_csv_header(spark, f"{tmp_path}/ordini.csv").count() == 50
    assert landing.read_csv_header(spark, f"{tmp_path}/punti_vendita.csv").count() == 50
    execute(spark, parse(["bronze", "--landing", str(tmp_path), "--batch-id", "cli1"]))
    assert "brz_sales.ordini_raw: 50 rows" in capsys.readouterr().out
    # The session and its catalogue are shared with the pipeline tests.
    for table in ("ordini_raw", "vendite_raw"):
        spark.sql(f"DROP TABLE brz_sales.{table}")


def test_landing_is_needed():
    with pytest.raises(SystemExit):
        parse(["run"])
    assert len(parse(["check"]).batch_id) == 8
