import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from claimtide import sources
from claimtide.session import stage, staging_dir
from helpers import values

SCHEMA = StructType([StructField("id", StringType()), StructField("n", IntegerType()), StructField("d", DateType())])


def test_delimited_round_trip(spark, tmp_path, frame):
    df = frame("id string, n int, d date", ("a|b", 1, dt.date(2017, 1, 1)), ("é", None, None))
    sources.write_delimited(df, str(tmp_path / "out"), sort=["id"])
    back = sources.read_delimited(spark, str(tmp_path / "out"), SCHEMA, encoding="UTF-8")
    assert values(back) == values(df)


def test_kept_lines_do_not_depend_on_the_columns_read(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_bytes("id|n|d\nx|1|2017-01-01\ny|oops|2017-01-01\nshort|7\nlong|3|2017-01-01|4\nend|3|2017-01-01|\n"
                     "\"a|b\"|5|\ncaf\xe9|2|2017-01-02\n".encode("ISO-8859-1"))
    kept, rejected = sources.split_delimited(spark, str(path), SCHEMA)
    d = dt.date(2017, 1, 1)
    want = [("a|b", 5, None), ("café", 2, dt.date(2017, 1, 2)), ("end", 3, d), ("short", 7, None), ("x", 1, d), ("y", None, d)]
    assert values(kept) == sorted(want, key=repr) and kept.count() == len(want)
    for i, c in enumerate(kept.columns):
        assert values(kept, c) == sorted(((w[i],) for w in want), key=repr) and kept.select(c).count() == len(want)
    assert values(rejected, "id", "more") == [("long", "4")] and rejected.count() == 1
    assert values(sources.read_delimited(spark, str(path), SCHEMA)) == values(kept)
    untyped = sources.read_delimited(spark, str(path))
    assert {t for _, t in untyped.dtypes} == {"string"} and ("y", "oops") in values(untyped, "id", "n")


def test_every_field_behind_the_last_column_counts(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_text('a|b\n1|2\n3|4||9\n\n5|6|||\n"x|y"|7\n8|"q|r"|\n9|"half|10\n|11\n12|13|"z"\n14|15|""\n')
    kept, rejected = sources.split_delimited(spark, str(path), encoding="UTF-8")
    want = [("1", "2"), ("5", "6"), ("x|y", "7"), ("8", "q|r"), (None, "11"), ("14", "15")]
    assert [r for r in values(kept) if "half" not in str(r)] == sorted(want, key=repr)
    for i, c in enumerate(kept.columns):
        assert len(values(kept, c)) == kept.count() == kept.select(c).count()
    got = {r.record: (r.a, r.more, r.reason, r.line) for r in rejected.collect()}
    assert got[2] == ("3", "|9", "more fields than columns: 4 for 2", "3|4||9")
    assert got[8][:2] == ("12", '"z"') and kept.count() + rejected.count() == 9
    assert {r.file.rsplit("/", 1)[1] for r in rejected.collect()} == {"in.txt"}


def test_rejected_lines_keep_their_number_over_blocks_and_files(spark, tmp_path):
    for name in ("a", "b"):
        lines = [f"{i}|x|extra" if i % 100 == 0 else f"{i}|x" for i in range(1, 3001)]
        (tmp_path / f"{name}.txt").write_text("\n".join(["n|t", *lines]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        kept, rejected = sources.split_delimited(spark, str(tmp_path), encoding="UTF-8")
        rows = rejected.collect()
        assert len(rows) == 60 and all(r.record == int(r.n) for r in rows) and kept.count() == 5940
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_database_reads_are_split(spark):
    options = sources.jdbc_options("jdbc:x", "select 1", partition_column="id", bounds=(1, 9), partitions=4, user="u")
    assert options == {"url": "jdbc:x", "fetchsize": "10000", "user": "u", "dbtable": "(select 1) q", "partitionColumn": "id",
                       "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    assert sources.jdbc_options("jdbc:x", "select 1", single_task=True)["query"] == "select 1"
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x", "select 1")


def test_unquoted_read_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "codes.txt"
    path.write_bytes(b'\xef\xbb\xbfinsCode|insFC\n7|"half\n8|F\n')
    df = sources.read_delimited(spark, str(path), encoding="UTF-8", quoted=False)
    assert df.columns == ["insCode", "insFC"]
    assert values(df) == [("7", '"half'), ("8", "F")]


def test_reference_sheet_and_date_floor(spark, tmp_path, frame):
    (tmp_path / "dim.csv").write_text(" Code , Group\nC6,CIE\n")
    dim = sources.read_reference(spark, str(tmp_path / "dim.csv"), ["Code"])
    assert values(dim) == [("C6",)]
    df = frame("id int, d date", (1, dt.date(2015, 12, 1)), (2, dt.date(2015, 11, 30)), (3, None))
    assert values(sources.read_since(df, "d", "2015-12-01"), "id") == [(1,)]


def test_date_floor_reaches_the_scan(spark, tmp_path, frame):
    frame("id int, d date", (1, dt.date(2015, 12, 1))).write.parquet(str(tmp_path / "t"))
    df = sources.read_since(spark.read.parquet(str(tmp_path / "t")), "d", "2015-12-01")
    assert "GreaterThanOrEqual(d" in df._jdf.queryExecution().executedPlan().toString()


def test_snapshot(spark, tmp_path, frame):
    path, pulls = str(tmp_path / "snap"), []

    def pull():
        pulls.append(1)
        return frame("id string, n string, d string", ("a", "5", "2017-01-01"))

    fresh = sources.load_snapshot(spark, path, pull, refresh=True, schema=SCHEMA)
    saved = sources.load_snapshot(spark, path, pull, schema=SCHEMA)
    assert pulls == [1] and values(fresh) == values(saved) == [("a", 5, dt.date(2017, 1, 1))]
    assert fresh.dtypes == saved.dtypes == [("id", "string"), ("n", "int"), ("d", "date")]


def test_a_pull_that_fails_leaves_the_snapshot(spark, tmp_path, frame):
    path = str(tmp_path / "snap")
    sources.load_snapshot(spark, path, lambda: frame("id int", (1,), (2,)), refresh=True)

    def breaks():
        return frame("id int", (3,), (4,)).select(F.when(F.col("id") < 4, F.col("id")).otherwise(
            F.raise_error(F.lit("connection lost")).cast("int")).alias("id"))

    with pytest.raises(Exception, match="connection lost"):
        sources.load_snapshot(spark, path, breaks, refresh=True)
    assert values(sources.load_snapshot(spark, path)) == [(1,), (2,)]
    held = sources.load_snapshot(spark, path)
    sources.load_snapshot(spark, path, lambda: frame("id int", (5,)), refresh=True)
    assert values(sources.load_snapshot(spark, path)) == [(5,)] and values(held) == [(1,), (2,)]
    assert [n for n, _ in sources.snapshot_versions(spark, path)] == [1, 2]
    plain = str(tmp_path / "plain")
    frame("id int", (7,)).write.parquet(plain)
    assert values(sources.load_snapshot(spark, plain)) == [(7,)]


def test_contract_tells_what_does_not_fit(frame):
    raw = frame("case_number long, entry_date string, denial_reason string, remark string", (7, "20170101", "007", "x"),
                (8, "2017-1-1", "0", None), (9, " ", None, "y"), (None, None, "45", None))
    loaded = sources.load_appeal(raw)
    assert loaded.extra == ["remark"] and {"level", "letter_date"} <= set(loaded.missing) and "entry_date" not in loaded.missing
    rows = values(loaded.rows, "appeal_case_no", "entry_dt", "den_reason", "level_code")
    assert rows == sorted([("7", dt.date(2017, 1, 1), "7", None), ("8", None, "", None), ("9", None, None, None),
                           (None, None, "45", None)], key=repr)
    assert loaded.misfits() == {"entry_date": 1}
    fields = [sources.Field("a", "a", "id"), sources.Field("b", "b", "money"), sources.Field("c", "c", "whole")]
    typed = sources.apply_contract(frame("a string, b string, c string", ("0.0", "1.5", "x"), ("12.0", "oops", "3.0")), fields)
    assert [(r.a, r.b and float(r.b), r.c) for r in typed.rows.coalesce(1).collect()] == [(None, 1.5, None), ("12", None, "3")]
    assert typed.misfits() == {"b": 1, "c": 1} and typed.missing == typed.extra == []


def test_dictionary(frame):
    df = frame("A string, B string, C string", ("1.5", "x", "y"))
    entries = [{"source": "A", "name": "amount", "type": "float", "usages": ["claims"]},
               {"source": "B", "name": "label", "usages": ["claims", "tickets"]}, {"source": "C", "name": None}]
    out = sources.apply_dictionary(df, entries, "claims")
    assert out.dtypes == [("amount", "decimal(18,2)"), ("label", "string")]
    assert sources.apply_dictionary(df, entries, "tickets").columns == ["label"]
    assert sources.apply_dictionary(df, entries).columns == ["amount", "label"]


def test_case_extract(frame):
    d = dt.date(2017, 2, 1)
    items = frame("order_id int, line int", (1, 1), (2, 1), (3, 1), (4, 1))
    orders = frame("order_id int, account_id int, start_dt date", (1, 9, d), (2, None, d), (3, 9, d), (4, 9, dt.date(2018, 1, 1)))
    cases = frame("order_id int, owner_id int, case_type string", (1, 5, "Missing Data"), (1, 5, "Other"), (3, 5, "Other"))
    out = sources.order_case_extract(items, orders, frame("account_id int, account string", (9, "acc")), cases,
                                     frame("owner_id int, owner string", (5, "own")), "2017-01-07", "2017-04-10")
    assert values(out, "order_id", "account", "case_type", "owner") == [(1, "acc", "Missing Data", "own"), (2, None, None, None)]


def test_refresh_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        sources.refresh_log(spark, path, [("Front page", "claim_to_revenue", "Managed care")])
    log = spark.read.parquet(path)
    assert log.count() == 2 and log.filter(F.col("refreshed_at").isNull()).count() == 0


def test_staging_uses_the_configured_folder(spark, frame):
    assert staging_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = stage(frame("a int", (1,), (2,)), "part")
    assert values(df) == [(1,), (2,)] and df.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(
        spark.conf.get("spark.checkpoint.dir").lstrip("/"))


def test_reports_are_written_in_order_with_control_totals(spark, tmp_path, frame):
    import decimal
    from claimtide.plans import reports
    rows = spark.range(2000).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7919 % 997).cast("string")).alias("oli_id"), (F.col("id") % 13).alias("ticket_no"),
        (F.col("id") % 5).alias("txn_line"), F.col("id").cast("decimal(12,2)").alias("txn_amount"))
    none = rows.limit(0)
    folder = str(tmp_path / "out")
    found = reports.write_reports({"ticket_journal_v2": rows, "ticket_journal_v1": none}, folder, rows_per_file=300)
    assert [(c.report, c.rows, c.sums["txn_amount"]) for c in found] == [
        ("ticket_journal_v2", 2000, decimal.Decimal(1999000)), ("ticket_journal_v1", 0, None)]
    back = spark.read.parquet(f"{folder}/ticket_journal_v2").withColumn("f", F.col("_metadata.file_name"))
    files = {}
    for r in back.withColumn("at", F.monotonically_increasing_id()).orderBy("f", "at").collect():
        files.setdefault(r.f, []).append((r.oli_id is None, r.oli_id or "", r.ticket_no, -r.txn_line))
    whole = [key for f in sorted(files) for key in files[f]]
    assert whole == sorted(whole) and len(whole) == 2000 and max(map(len, files.values())) <= 300
    log = values(spark.read.parquet(f"{folder}/control"), "report", "column_name", "row_cnt", "total")
    assert ("ticket_journal_v2", None, 2000, None) in log and len(log) == 4
    reports.write_reports({"current": rows}, folder, delimited=True)
    text = sorted((tmp_path / "out" / "current").glob("*.csv"))
    first = [line.split("|")[:2] for f in text for line in f.read_text().splitlines()[1:]]
    assert first == sorted(first, key=lambda x: (x[0] in ("", '""'), x[0], int(x[1]))) and len(first) == 2000


def test_table_writer(spark, tmp_path, frame):
    df = frame("p string, v int", ("x", 2), ("y", 1))
    sources.write_table(df, str(tmp_path / "t"), sort=["v"], partition_by=["p"])
    assert values(spark.read.parquet(str(tmp_path / "t")), "p", "v") == [("x", 2), ("y", 1)]
