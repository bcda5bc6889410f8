"""Delimited files with awkward content, read from a fresh folder each."""

import pytest

from stratamart.plans import silver
from stratamart.sources.raw import UnknownTable, read_raw, stamp

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state"


def write(folder, text, name="a.csv"):
    path = folder / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def sellers(spark, path, mode):
    return [tuple(r)[:4] for r in read_raw(spark, "sellers", path, mode).orderBy("seller_id").collect()]


def test_quoted(spark, tmp_path):
    path = write(tmp_path, f'{HEADER}\n"s1","09560","são paulo, centro","SP"\n"s2",00001,"he said ""hi""",RJ\ns3,"",,\n')
    assert sellers(spark, path, "quoted") == [
        ("s1", "09560", "são paulo, centro", "SP"),
        ("s2", "00001", 'he said "hi"', "RJ"),
        ("s3", None, None, None),
    ]


def test_quoted_takes_carriage_returns_as_line_ends(spark, tmp_path):
    assert sellers(spark, write(tmp_path, f"{HEADER}\r\ns1,1,c,SP\r\n"), "quoted") == [("s1", "1", "c", "SP")]


def test_split_keeps_quotes_and_the_rest_of_the_line(spark, tmp_path):
    path = write(tmp_path, f'{HEADER}\n"s1","09560","rio de janeiro","rio de janeiro, brasil",RJ\ns2,1,a\\b,SP\r\ns3,1\n')
    assert sellers(spark, path, "split") == [
        ('"s1"', '"09560"', '"rio de janeiro"', '"rio de janeiro, brasil",RJ'),
        ("s2", "1", "a\\b", "SP\r"),
        ("s3", "1", None, None),
    ]
    cleaned = silver.cleaned(stamp(read_raw(spark, "sellers", path, "split"), 1, "2024-01-01", "a"), "sellers")
    assert {r.seller_id: r.seller_state for r in cleaned.collect()} == {"s1": "RJ", "s2": "SP\r", "s3": None}


def test_header_of_every_file_is_skipped(spark, tmp_path):
    write(tmp_path, f"{HEADER}\ns1,1,a,SP\n", "a.csv")
    write(tmp_path, f"{HEADER}\ns2,2,b,RJ\n", "b.csv")
    for mode in ("quoted", "split"):
        assert [r[0] for r in sellers(spark, str(tmp_path), mode)] == ["s1", "s2"]


@pytest.mark.parametrize("mode", ["quoted", "split"])
def test_odd_rows_are_kept_with_their_line(spark, tmp_path, mode):
    path = write(tmp_path, f"{HEADER}\ns1,1,a,SP\ns2,2\ns3,3,c,d,RJ\ns4,4,x\x01y,SP\n")
    read = {r.seller_id: r for r in read_raw(spark, "sellers", path, mode, with_file=True).collect()}
    assert sorted(read) == ["s1", "s2", "s3", "s4"]
    assert read["s1"].malformed_line is None and read["s2"].malformed_line == "s2,2"
    assert read["s3"].malformed_line == ("s3,3,c,d,RJ" if mode == "quoted" else None), "the last column of a split takes the rest"
    assert read["s4"].seller_city == "x\x01y" and read["s4"].seller_state == "SP" and read["s4"].malformed_line is None
    assert {r._row_file for r in read.values()} == {"a.csv"}


def test_header_in_another_order_fails(spark, tmp_path):
    path = write(tmp_path, "seller_state,seller_id,seller_zip_code_prefix,seller_city\nSP,s1,1,a\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, "sellers", path).collect()


def test_multiline(spark, tmp_path):
    head = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"
    path = write(tmp_path, head + '\nr1,o1,5,"a, b","line one\nline ""two"", end\n\nlast",2018-01-01,2018-01-02\nr2,o2,1,,,x,y\n')
    read = read_raw(spark, "order_reviews", path, "multiline").orderBy("review_id").collect()
    assert [r.review_comment_message for r in read] == ['line one\nline "two", end\n\nlast', None]
    assert [r.review_answer_timestamp for r in read] == ["2018-01-02", "y"]


def test_unknown_table_and_mode(spark, tmp_path):
    with pytest.raises(UnknownTable):
        read_raw(spark, "nothing", str(tmp_path))
    with pytest.raises(ValueError):
        read_raw(spark, "sellers", str(tmp_path), "other")


def test_one_task_never_holds_a_big_quoted_file(spark, tmp_path):
    lines = "".join(f"s{n},{n},city,SP\n" for n in range(20000))
    path = write(tmp_path, HEADER + "\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        for mode in ("quoted", "split"):
            read = read_raw(spark, "sellers", path, mode)
            assert read.rdd.getNumPartitions() > 3
            assert read.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
