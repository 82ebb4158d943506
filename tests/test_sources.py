import pytest
from pyspark.sql import functions as F

from encore.sources import (
    attribute_types,
    line_counts,
    parse_correction_log,
    read_attributes,
    read_delimited,
    read_feature_set,
    read_log_lines,
    row_counts,
    schema_from_attributes,
    write_delimited,
)
from encore.sources.attributes import UnknownAttributeType

GOOD = ("ERROR: <SO0000000000000042 TR0000000000000077> Paper Lanterns  -  Night Bus Home"
        "  !=  Gravel Choir  -  Slow River")


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_well_formed_line(spark):
    parsed, rejected = parse_correction_log(_lines(spark, [GOOD, "INFO: skipped line"]))
    assert rejected.count() == 0
    row = parsed.collect()
    assert [tuple(r) for r in row] == [(
        "SO0000000000000042", "Paper Lanterns", "Night Bus Home",
        "TR0000000000000077", "Gravel Choir", "Slow River",
    )]


def test_accepted_prefix_shifts_offsets(spark):
    line = "< " + GOOD
    parsed, _ = parse_correction_log(_lines(spark, [line, GOOD]), prefix="< ERROR: ")
    rows = parsed.collect()
    assert len(rows) == 1 and rows[0]["song_id"] == "SO0000000000000042"
    assert rows[0]["track_id"] == "TR0000000000000077" and rows[0]["track_title"].endswith("River")


def test_malformed_lines_are_rejected_not_raised(spark):
    head = "ERROR: <SO0000000000000042 TR0000000000000077> "
    bad = [head + "A  -  B", head + "A  -  B  !=  C  -  D  !=  E  -  F", head, head + "A - B  !=  C  -  D"]
    parsed, rejected = parse_correction_log(_lines(spark, bad + [GOOD]))
    assert parsed.count() == 1
    assert sorted(r["value"] for r in rejected.collect()) == sorted(bad)


def test_title_with_single_blank_dash_kept(spark):
    line = "ERROR: <SO0000000000000042 TR0000000000000077> A  -  B - C  !=  D  -  E"
    parsed, _ = parse_correction_log(_lines(spark, [line]))
    r = parsed.collect()[0]
    assert (r["song_artist"], r["song_title"], r["track_artist"], r["track_title"]) == ("A", "B - C", "D", "E")


def test_last_character_is_not_lost(spark, tmp_dir):
    path = f"{tmp_dir}/log.txt"
    with open(path, "w") as f:
        f.write("header line\n" + GOOD)  # no newline at the end
    parsed, _ = parse_correction_log(read_log_lines(spark, path))
    assert parsed.collect()[0]["track_title"] == "Slow River"


def test_read_delimited_permissive(spark, tmp_dir):
    path = f"{tmp_dir}/t.tsv"
    with open(path, "w") as f:
        f.write("u1\ts2\tbad\nu3\ts1\t2\textra\nu4\ts4\t7\n")
    df = read_delimited(spark, path, "user_id string, song_id string, plays int", sep="\t")
    rows = {r["user_id"]: r["plays"] for r in df.collect()}
    assert rows == {"u1": None, "u3": 2, "u4": 7}
    assert df.columns == ["user_id", "song_id", "plays"]


def test_read_without_schema_gives_strings(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    write_delimited(spark.createDataFrame([(1.5, "a")], "x double, id string"), path)
    df = read_delimited(spark, f"{path}/*.csv")
    assert df.dtypes == [("_c0", "string"), ("_c1", "string")]


def test_gzip_round_trip(spark, tmp_dir):
    src = spark.range(100).select(F.col("id").cast("string").alias("user_id"), (F.col("id") % 7).cast("int").alias("plays"))
    path = write_delimited(src, f"{tmp_dir}/gz", sep="\t", compression="gzip")
    back = read_delimited(spark, path, "user_id string, plays int", sep="\t")
    assert sorted(back.collect()) == sorted(src.collect())


def test_schema_from_attributes_order_and_types(spark, tmp_dir):
    path = f"{tmp_dir}/attrs.csv"
    with open(path, "w") as f:
        f.write("b_first,NUMERIC\na_second,real\nTRACK_ID,string\nname,STRING\n")
    schema = schema_from_attributes(read_attributes(spark, path))
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields] == [
        ("b_first", "double", True), ("a_second", "double", True),
        ("TRACK_ID", "string", True), ("name", "string", True)]
    types = {r["type"]: r["n_attributes"] for r in attribute_types(read_attributes(spark, path)).collect()}
    assert types == {"NUMERIC": 1, "real": 1, "string": 1, "STRING": 1}


def test_unknown_attribute_type_names_the_attribute(spark, tmp_dir):
    path = f"{tmp_dir}/attrs.csv"
    with open(path, "w") as f:
        f.write("x,NUMERIC\nweird,INTEGERISH\n")
    with pytest.raises(UnknownAttributeType, match="weird"):
        schema_from_attributes(read_attributes(spark, path))


def test_read_feature_set(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("f1,real\nTRACK_ID,string\n")
    with open(f"{tmp_dir}/d.csv", "w") as f:
        f.write("0.5,'TRA'\nx,'TRB'\n")
    df = read_feature_set(spark, f"{tmp_dir}/a.csv", f"{tmp_dir}/d.csv")
    assert sorted(df.collect(), key=lambda r: r[1]) == [(0.5, "'TRA'"), (None, "'TRB'")]


def test_row_and_line_counts(spark, tmp_dir):
    out = row_counts({"a": spark.range(3), "b": spark.range(5)})
    assert {r["data_set"]: r["n_rows"] for r in out.collect()} == {"a": 3, "b": 5}
    for name, n in (("x.txt", 2), ("y.txt", 4)):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("\n".join(["l"] * n) + "\n")
    counts = {r["file"].rsplit("/", 1)[-1]: r["n_lines"] for r in line_counts(read_log_lines(spark, tmp_dir)).collect()}
    assert counts == {"x.txt": 2, "y.txt": 4}


def test_read_several_feature_sets(spark, tmp_dir):
    import os

    from encore.sources import read_feature_sets

    os.makedirs(f"{tmp_dir}/attributes")
    os.makedirs(f"{tmp_dir}/features/a.csv")
    os.makedirs(f"{tmp_dir}/features/b.csv")
    with open(f"{tmp_dir}/attributes/a.attributes.csv", "w") as f:
        f.write("x,NUMERIC\nTRACK_ID,string\n")
    with open(f"{tmp_dir}/attributes/b.attributes.csv", "w") as f:
        f.write("y1,real\ny2,real\nTRACK_ID,STRING\n")
    with open(f"{tmp_dir}/features/a.csv/part-0", "w") as f:
        f.write("1.5,'TRA'\n2.5,'TRB'\n")
    with open(f"{tmp_dir}/features/b.csv/part-0", "w") as f:
        f.write("1,2,'TRA'\n")
    sets = read_feature_sets(spark, tmp_dir, ["a", "b"])
    assert sets["a"].dtypes == [("x", "double"), ("TRACK_ID", "string")] and sets["a"].count() == 2
    assert sets["b"].columns == ["y1", "y2", "TRACK_ID"] and sets["b"].collect()[0]["y2"] == 2.0


def test_write_single_file(spark, tmp_dir):
    import glob

    df = spark.range(100).repartition(5).selectExpr("CAST(id AS STRING) AS id")
    path = write_delimited(df, f"{tmp_dir}/one", single_file=True)
    assert len(glob.glob(f"{path}/part-*")) == 1
    assert read_delimited(spark, path, "id string").count() == 100


def test_attribute_order_over_files_of_different_sizes(spark, tmp_path):
    from encore.sources.attributes import read_attributes, schema_from_attributes

    (tmp_path / "a.csv").write_text("x1,REAL\n")
    (tmp_path / "b.csv").write_text("".join(f"y{i},REAL\n" for i in range(50)))
    rows = read_attributes(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    names = [r["name"] for r in rows.orderBy("position").collect()]
    assert names == ["x1", *[f"y{i}" for i in range(50)]]
