"""Clean, train and promote through the command line, chained by files."""

from tillwatch.__main__ import main
from tillwatch.catalog.inputs import transactions
from tillwatch.session import object_store_conf, scratch_path, shared_dir


def test_chain(spark, folder, tmp_path, capsys):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    transactions(spark, folder).write.csv(raw)
    report = main(["clean", "--input", f"{raw}/*.csv", "--output", clean])
    assert report["clean_rows"] < report["row_count"]
    track = str(tmp_path / "track")
    out = main(["train", "--input", clean, "--tracking", track, "--models", str(tmp_path / "models"),
                "--metrics-output", str(tmp_path / "metrics"), "--sample-fraction", "1.0"])
    assert out["best_auc"] > 0.5
    assert main(["promote", "--tracking", track]) is True
    assert main(["promote", "--tracking", track]) is False


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert object_store_conf("host", ssl=False)["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
