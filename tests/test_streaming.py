import pandas as pd

from aerowx import contracts as C
from aerowx.streaming.landing import append_landed, same_months

NAMES = list(C.STAGING_NAMES)


def land(folder, name, days):
    data = {n: ["1.5"] * len(days) for n in NAMES}
    data["Date"] = [str(d) for d in days]
    pd.DataFrame(data).to_parquet(folder / name, index=False)


def test_landed_files_are_appended_once(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    rejects, state = str(tmp_path / "rejects"), str(tmp_path / "state")
    folder.mkdir()
    land(folder, "ACK_2023-1.parquet", [1, 2])
    land(folder, "ATL_2023-1.parquet", [1])
    append_landed(spark, str(folder), table, rejects, state).awaitTermination()
    assert spark.read.parquet(table).count() == 3
    # A month landed again under another path, with a day more, and a new month.
    (folder / "late").mkdir()
    land(folder / "late", "ACK_2023-1.parquet", [1, 2, 3])
    land(folder, "ACK_2023-2.parquet", [1, 30])
    append_landed(spark, str(folder), table, rejects, state).awaitTermination()
    found = spark.read.parquet(table)
    assert found.count() == 5
    assert found.groupBy("airport_code", "date_recorded").count().where("count > 1").count() == 0
    append_landed(spark, str(folder), table, rejects, state).awaitTermination()
    assert spark.read.parquet(table).count() == 5
    assert [r["Date"] for r in spark.read.parquet(rejects).collect()] == ["30"]


def test_a_batch_reads_its_own_months_only(spark, tmp_path, plan_of):
    table = str(tmp_path / "t")
    rows = [("2023-01", 1), ("2023-02", 2), ("2023-03", 3)]
    spark.createDataFrame(rows, "year_month string, v int").write.partitionBy("year_month").parquet(table)
    incoming = spark.createDataFrame([("2023-02", 5), ("2023-02", 6)], "year_month string, v int")
    there = same_months(incoming, table)
    assert [r["v"] for r in there.collect()] == [2]
    filters = [line for line in plan_of(there).splitlines() if "PartitionFilters" in line]
    assert filters and "2023-02" in filters[0] and "2023-03" not in filters[0]
