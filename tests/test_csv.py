"""CSV in and out keeps every text; malformed records fail the run."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows
from weirline.sources import files

TEXTS = [
    '5" disc, big', "  padded  ", "two\nlines", "cr\r\nlf", "back\\slash", '\\"', "\\", "", None,
    '"quoted"', "a,b", "é", " ", '""', "'", ",", '"', "NA",
]
HEADER = "customer_id,region,segment,signup_date\nC0,North,SMB,2022-01-01\n"


def test_round_trip_of_every_text(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_clean_csv(spark, str(tmp_path / "out"), df.schema)
    assert {r.i: r.t for r in back.collect()} == dict(enumerate(TEXTS))


def test_round_trip_of_records(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    line = files.csv_line(["i", "t"])
    back = df.select(files.parse_csv_line(line, "i int, t string").alias("r")).select("r.*")
    back = back.withColumn("t", files.real_text(F.col("t")))
    assert {r.i: r.t for r in back.collect()} == dict(enumerate(TEXTS))


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("record", ["C1,North,SMB,2022-01-01,EXTRA", 'C1,"open,SMB,2022'])
def test_malformed_records_fail(spark, tmp_path, record, multi_line):
    path = tmp_path / "c.csv"
    path.write_text(HEADER + record + "\n")
    read = files.read_raw(spark, str(path), "customers", multi_line)
    for result in (read, read.select("segment"), read.groupBy("region").count()):
        with pytest.raises(PySparkException, match="malformed CSV record"):
            result.collect()
    with pytest.raises(PySparkException, match="malformed CSV record"):
        read.count()


def test_line_breaks_need_multi_line(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(HEADER + 'C3,"Ea\nst",SMB,2022-01-02\n')
    with pytest.raises(PySparkException, match="malformed CSV record"):
        files.read_raw(spark, str(path), "customers").collect()
    got = rows(files.read_raw(spark, str(path), "customers", multi_line=True).drop("_pos"))
    assert ("C3", "Ea\nst", "SMB", "2022-01-02") in got and len(got) == 2


def test_short_records_are_padded(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(HEADER + 'C1,No"rth\nC2,"a,b,c","x ""y"", z",NA\n')
    got = rows(files.read_raw(spark, str(path), "customers").drop("_pos"))
    assert got[1:] == [("C1", 'No"rth', None, None), ("C2", "a,b,c", 'x "y", z', None)]
