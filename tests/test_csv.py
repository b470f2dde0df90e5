import csv
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.sources import sinks


def test_csv_file_is_written_by_tasks(spark, tmp_path, monkeypatch):
    texts = ["plain", "a,b", 'say "so"', "two\nlines", "dos\r\nend", "cr\r", "", None, "ğ 😀", " x "]
    data = [(i * 37 % 100, texts[i % 10], [None, 1.5, 1e-7][i % 3], [True, None][i % 2]) for i in range(100)]
    df = spark.createDataFrame(data, "n long, t string, d double, b boolean").withColumn("at", F.expr("TIMESTAMP_NTZ'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, n)")).repartition(7)
    want = io.StringIO()
    out = csv.writer(want)
    out.writerow(["t", "d", "b", "at"])
    rows = sorted(df.collect(), key=lambda r: r["n"])
    out.writerows(["" if r[c] is None else r[c] for c in ("t", "d", "b", "at")] for r in rows)

    def to_driver(*_, **__):
        raise AssertionError("rows go to the driver")

    monkeypatch.setattr(type(df), "toLocalIterator", to_driver)
    assert isinstance(df, DataFrame)
    assert sinks.write_csv_file(df, str(tmp_path / "x.csv"), ["t", "d", "b", "at"], ["n"]) == 100
    assert (tmp_path / "x.csv").read_bytes() == want.getvalue().encode("utf-8-sig")
    assert sinks.write_csv_file(df.where("n < 0"), str(tmp_path / "x.csv"), ["t"], ["n"], overwrite=True) == 0
    assert (tmp_path / "x.csv").read_bytes() == b"\xef\xbb\xbft\r\n"
    assert sinks.write_csv_file(df.where("n = 7").select("n", F.lit(None).cast("string").alias("t")), str(tmp_path / "x.csv"), ["t"], ["n"], overwrite=True) == 1
    assert (tmp_path / "x.csv").read_bytes() == b'\xef\xbb\xbft\r\n""\r\n'
