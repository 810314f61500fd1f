import pytest
from pyspark.sql import functions as F

from cardlens.schema import FRAUD_ALERT, TRANSACTION_FIELDS, transaction_schema
from cardlens.sources.fallback import first_available
from cardlens.sources.files import csv_sources, read_snapshot, read_transactions_csv, register, split_corrupt
from cardlens.plans.import_batch import UNREADABLE, import_csv_folder
from cardlens.schema import TRANSACTION
from cardlens.sinks.segments import read_segments
from cardlens.sources.headers import header_census, read_csv_folder
from cardlens.sources.keyed import read_keyed, read_keyed_or_empty
from cardlens.sources.messages import decode_json, encode_json, malformed, read_topic, well_formed

GOOD = {
    "trans_num": "t1", "trans_date_trans_time": "2019-01-01 00:00:18", "cc_num": "2703186189652095", "merchant": "fraud_Rippin",
    "category": "misc_net", "amt": "4.97", "first": "Jennifer", "last": "Banks", "gender": "F", "street": "561 Perry Cove",
    "city": "Moravian Falls", "state": "NC", "zip": "01234", "lat": "36.0788", "long": "-81.1781", "city_pop": "3495",
    "job": "Psychologist, counselling", "dob": "1988-03-09", "merch_lat": "36.01", "merch_long": "-82.04", "is_fraud": "0",
}


def write_csv(path, names, *rows):
    quoted = [",".join(f'"{r[n]}"' if "," in str(r[n]) else str(r[n]) for n in names) for r in rows]
    path.write_text("\n".join([",".join(names), *quoted]) + "\n")
    return str(path)


def test_csv_types_and_index_column(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", ["", *GOOD], {"": 0, **GOOD})
    df = read_transactions_csv(spark, path)
    assert df.schema == transaction_schema()
    row = df.head()
    assert (row.zip, row.amt, row.city_pop, row.job) == ("01234", 4.97, 3495, "Psychologist, counselling")


def test_csv_files_with_other_column_order_are_unioned_by_name(spark, tmp_path):
    a = write_csv(tmp_path / "a.csv", ["Unnamed: 0", *GOOD], {"Unnamed: 0": 0, **GOOD})
    b = write_csv(tmp_path / "b.csv", [*reversed(GOOD)], {**GOOD, "trans_num": "t2"})
    rows = {r.trans_num: r for r in read_transactions_csv(spark, a, b).collect()}
    assert set(rows) == {"t1", "t2"} and rows["t2"].amt == 4.97 and rows["t2"].zip == "01234"


def test_csv_bad_lines_are_set_apart(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [*GOOD], GOOD, {**GOOD, "trans_num": "t2", "amt": "much"})
    good, bad = split_corrupt(read_transactions_csv(spark, path, keep_corrupt=True))
    assert [r.trans_num for r in good.collect()] == ["t1"]
    assert bad.count() == 1 and "much" in bad.head()[0]


def test_csv_strict_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write_csv(folder / "a.csv", ["", *GOOD], {"": 0, **GOOD})
    strict = read_transactions_csv(spark, str(folder / "a.csv"), strict_header=True)
    assert strict.head().trans_num == "t1" and strict.columns == [*GOOD]
    write_csv(folder / "b.csv", ["", *reversed(GOOD)], {"": 0, **GOOD})
    with pytest.raises(Exception, match="(?i)header"):
        read_transactions_csv(spark, str(folder), strict_header=True).collect()


def mixed_folder(tmp_path):
    folder = tmp_path / "mixed, {a}[b] %41"
    folder.mkdir()
    write_csv(folder / "a.csv", ["", *GOOD], {"": 0, **GOOD}, {"": 1, **GOOD, "trans_num": "t2"})
    write_csv(folder / "b c.csv", ["note", *reversed(GOOD)], {**GOOD, "note": "x", "trans_num": "t3"})
    write_csv(folder / "d.csv", ["", *GOOD], {"": 0, **GOOD, "trans_num": "t4"})
    write_csv(folder / "e.csv", [n for n in GOOD if n != "city"], {**GOOD, "trans_num": "t5"}, {**GOOD, "trans_num": "t6", "amt": "much"})
    write_csv(folder / "f.csv", [*GOOD])
    (folder / "empty.csv").write_text("")
    return folder.as_uri().replace("%7B", "\\{").replace("%7D", "\\}").replace("%5B", "\\[").replace("%5D", "\\]").replace("%20", " ").replace("%25", "%").replace("%2C", ",")


def test_csv_folder_of_different_headers(spark, tmp_path):
    path = mixed_folder(tmp_path)
    groups = header_census(spark, path)
    assert sorted(len(g.files) for g in groups) == [1, 1, 1, 2]
    df = read_csv_folder(spark, path)
    assert df.schema == transaction_schema()
    rows = {r.trans_num: r for r in df.collect()}
    assert set(rows) == {"t1", "t2", "t3", "t4", "t5", "t6"}
    whole = next(iter(read_csv_folder(spark, path).where("trans_num = 't1'").collect())).asDict()
    for number in ("t2", "t3", "t4"):
        assert rows[number].asDict() == {**whole, "trans_num": number}
    assert rows["t5"].asDict() == {**whole, "trans_num": "t5", "city": None}


def test_csv_folder_import_keeps_bad_lines_apart(spark, tmp_path):
    root = f"{tmp_path}/tables"
    summary, unreadable = import_csv_folder(spark, root, mixed_folder(tmp_path), as_of="2020-06-21")
    assert (summary.total, unreadable) == (5, 1)
    bad = spark.read.parquet(f"{root}/{UNREADABLE}").head()
    assert "much" in bad[0] and bad.source_file.endswith("e.csv")
    assert read_segments(spark, TRANSACTION, root).count() == 5


def test_csv_folder_with_a_headless_file_is_an_error(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [*GOOD], GOOD)
    (tmp_path / "b.csv").write_text("1,2,3\n4,5,6\n")
    with pytest.raises(ValueError, match="b.csv"):
        read_csv_folder(spark, str(tmp_path))


def test_csv_folder_long_files_are_split(spark, tmp_path, monkeypatch):
    """Lines in the middle of a file are no headers, however a file is cut up."""
    write_csv(tmp_path / "a.csv", [*GOOD], *[{**GOOD, "trans_num": f"a{i}"} for i in range(400)])
    write_csv(tmp_path / "b.csv", [*reversed(GOOD)], *[{**GOOD, "trans_num": f"b{i}"} for i in range(400)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert len(header_census(spark, str(tmp_path))) == 2
        df = read_csv_folder(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 2
        assert df.where("zip = '01234' AND amt = 4.97").select("trans_num").distinct().count() == 800
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_without_rows(spark, tmp_path):
    assert read_transactions_csv(spark, write_csv(tmp_path / "a.csv", [*GOOD])).isEmpty()


def test_csv_folders_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("cardlens.sources.files.CSV_FOLDERS", (f"{tmp_path}/dataset", f"{tmp_path}/data"))
    (tmp_path / "data").mkdir()
    write_csv(tmp_path / "data" / "a.csv", [*GOOD], GOOD)
    name, df = first_available(zip(("dataset", "data"), csv_sources(spark, "a.csv")))
    assert name == "data" and df.count() == 1


def test_fallback_passes_over_missing_and_empty(spark, tmp_path):
    full = spark.range(3)
    full.write.parquet(f"{tmp_path}/full")
    full.where("id < 0").write.parquet(f"{tmp_path}/empty")
    sources = [(n, lambda n=n: read_snapshot(spark, f"{tmp_path}/{n}")) for n in ("missing", "empty", "full")]
    name, df = first_available(sources)
    assert name == "full" and df.count() == 3
    with pytest.raises(LookupError, match="missing: PATH_NOT_FOUND; empty: empty"):
        first_available(sources[:2])


def test_fallback_does_not_hide_other_errors():
    with pytest.raises(ZeroDivisionError):
        first_available([("broken", lambda: 1 / 0)])


def test_sql_view(spark):
    register(spark.range(4), "some_rows")
    assert spark.sql("SELECT count(*) FROM some_rows").head()[0] == 4


def test_keyed_table_not_written_yet(spark, tmp_path):
    assert read_keyed_or_empty(spark, FRAUD_ALERT, str(tmp_path)).schema == FRAUD_ALERT.schema()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_keyed(spark, FRAUD_ALERT, str(tmp_path))


def test_decode_sends_bad_records_aside(spark):
    texts = [
        '{"trans_num": "t1", "cc_num": 4263982640269299, "amt": 5.5, "zip": "00501", "is_fraud": 1}',
        '{"trans_num": "t2", "amt": null}',
        '{"trans_num": "t3", "amt"',
        "",
        '{"trans_num": "t4", "amt": "much"}',
    ]
    decoded = decode_json(spark.createDataFrame([(t,) for t in texts], "value string"))
    good = {r.trans_num: r for r in well_formed(decoded).collect()}
    assert good["t1"].cc_num == "4263982640269299" and good["t1"].zip == "00501" and good["t2"].amt is None
    assert {r.record for r in malformed(decoded).collect()} >= {texts[2], texts[4]}
    assert well_formed(decoded).count() + malformed(decoded).count() == len(texts)


def test_encode_turns_nan_into_null(spark):
    df = spark.createDataFrame([("t", float("nan"), None, 1.5)], "a string, b double, c double, d double")
    assert encode_json(df).head().value == '{"a":"t","b":null,"c":null,"d":1.5}'


def test_messages_round_trip(spark):
    rows = spark.createDataFrame([tuple(GOOD.values())], ", ".join(f"`{n}` string" for n in GOOD))
    typed = rows.select([F.col(f"`{n}`").cast(t).alias(n) for n, t in TRANSACTION_FIELDS.items()])
    assert well_formed(decode_json(encode_json(typed))).collect() == typed.collect()


@pytest.mark.parametrize("stream", [True, False])
def test_topic_needs_its_connector(spark, stream):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "localhost:9092", "transactions", stream=stream)
