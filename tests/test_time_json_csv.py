"""Time conversion, JSON codec, CSV scan and validation on crafted rows."""

import json

from pyspark.sql import functions as F

from eddy import schema as sc
from eddy.functions.time import epoch_to_iso
from eddy.operators import validate as va
from eddy.operators.latency import latency_rows
from eddy.sources import files as fs
from eddy.sources import json_codec as jc


def test_epoch_to_iso(spark):
    df = spark.createDataFrame([(1400000000.0,), (1400000000.5,), (0.0,)], "t double")
    got = [r[0] for r in df.select(epoch_to_iso(F.col("t"))).collect()]
    assert got == ["2014-05-13T16:53:20", "2014-05-13T16:53:20.500000", "1970-01-01T00:00:00"]


def test_time_validity(spark):
    df = spark.createDataFrame([("1400000000",), ("0",), (None,), ("NaN",), ("abc",)], "t string")
    good, bad = va.split_valid(df, [("missing time", va.time_invalid(F.col("t")))], "convert")
    assert [r.t for r in good.collect()] == ["1400000000"]
    assert bad.count() == 4 and {r.reason for r in bad.collect()} == {"missing time"}


def test_latency_zero_kept_null_skipped(spark):
    df = spark.createDataFrame([("a", 0.0, 1.5, "consumer_0", 1), ("b", None, 2.0, "consumer_1", 2)],
                               "id string, timestamp double, processing_time double, processed_by string, partition int")
    got = latency_rows(df).collect()
    assert [(r.message_id, r.latency_ms) for r in got] == [("a", 1500.0)]


def test_json_nan_double_encoded_and_garbage(spark):
    vals = ['{"1": NaN, "5": NaN}', '{"1": "x", "5": 1.5}', json.dumps('{"5": 1.0}'), "garbage", "{}", None]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    d = jc.decode(df, sc.COMMENT_MESSAGE).collect()
    assert d[0]["1"] is None and d[0]["5"] is None
    assert d[1]["1"] == "x" and d[1]["5"] == 1.5
    assert d[2]["5"] == 1.0
    assert [r["_json_ok"] for r in d] == [True, True, True, False, True, False]
    good, bad = va.split_valid(df, [("empty message", va.message_empty(F.col("value")))], "consume")
    assert good.count() == 4 and bad.count() == 2


def test_csv_quoted_newline_doubled_quote_blank_line(spark, tmp):
    path = f"{tmp}/c.csv"
    with open(path, "w") as f:
        f.write(',1,2,5\n0,"line one\nline two",a,1400000000.0\n\n1,"say ""hi""",b,1.5\n2,plain,c,\n')
    got = fs.read_comments_csv(spark, path).orderBy("row_index").collect()
    assert [r.text for r in got] == ["line one\nline two", 'say "hi"', "plain"]
    assert got[2].created_utc is None


def test_csv_round_trip(spark, tmp):
    df = spark.createDataFrame([(0, ' lead "q"\n x ', "a", 1.25), (1, "b,c", "b", None)], sc.COMMENT_CSV)
    fs.write_comments_csv(df, f"{tmp}/out")
    back = fs.read_comments_csv(spark, f"{tmp}/out").orderBy("row_index").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.collect()]


def test_csv_files_of_one_folder_with_different_headers(spark, tmp):
    with open(f"{tmp}/a.csv", "w") as f:
        f.write(',1,2,5,score\n0,"one, two\nthree",a,1.5,7\n1,x,b,2.5,8\n')
    with open(f"{tmp}/b.csv", "w") as f:
        f.write('5,2,1,\n3.5,c,"other ""text""",2\n')
    with open(f"{tmp}/c.csv", "w") as f:
        f.write('\n,1,2,5,score\n3,y,d,4.5,9\n')
    got = fs.read_comments_csv(spark, tmp)
    assert got.columns == ["row_index", "text", "comment_id", "created_utc", "score"]
    assert sorted(tuple(r) for r in got.collect()) == [
        (0, "one, two\nthree", "a", 1.5, "7"), (1, "x", "b", 2.5, "8"), (2, 'other "text"', "c", 3.5, None), (3, "y", "d", 4.5, "9")]


def test_csv_extra_columns_named_like_ours(spark, tmp):
    with open(f"{tmp}/a.csv", "w") as f:
        f.write(",1,2,5,text,Comment_ID\n0,mine,a,1.5,theirs,z\n")
    got = fs.read_comments_csv(spark, tmp)
    assert got.columns == ["row_index", "text", "comment_id", "created_utc", "other_text", "other_Comment_ID"]
    assert tuple(got.select("text", "other_text", "comment_id").first()) == ("mine", "theirs", "a")
