from tallyframe.__main__ import main


def test_list_and_sql(capsys):
    main(["--list"])
    out = capsys.readouterr().out
    assert "state_change_gap_percentiles" in out and "payment_schedule" in out
    main(["payment_schedule", "--sql"])
    assert "generate_series" in capsys.readouterr().out


def test_run_to_folder(spark, tmp_path):
    target = str(tmp_path / "res")
    main(["distinct_event_types", "--data", "/root/testdata/sf0.001", "--out", target])
    assert spark.read.parquet(target).count() == 1
