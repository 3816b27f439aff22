import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows
from plumelake.operators.curate import curate
from plumelake.operators.synthetic import synthetic_readings
from plumelake.sources import readers, schemas, writers

ONE = ('{"station_id":"001","station_name":"A","aqi":2,"pm25":10.5,"pm10":1.0,'
       '"timestamp":"2024-01-01T00:00:00"}')
TWO = ONE.replace('"001"', '"002"')


def put(folder: Path, text: str, name="part.json") -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_plain_json_keeps_good_and_marks_bad(spark, tmp_path):
    wrong_type = ONE.replace('"aqi":2', '"aqi":"x"')
    path = put(tmp_path / "raw", "\n".join([ONE, wrong_type, "no json"]))
    got = rows(readers.read_raw(spark, path).select(
        "station_id", "aqi", "pm25", F.col("_corrupt_record").isNotNull()), "pm25", "aqi")
    assert got == [(None, None, None, True), ("001", None, 10.5, True), ("001", 2, 10.5, False)]


FIVE = "".join(ONE.replace('"001"', f'"00{n}"') for n in range(5))


def test_several_objects_on_one_line(spark, tmp_path):
    path = put(tmp_path / "raw", f"{ONE}{TWO}\n\n{ONE} {TWO}\r\n{FIVE}")
    df = readers.read_raw(spark, path)
    assert rows(df.groupBy("station_id").count(), "station_id") == [
        ("000", 1), ("001", 3), ("002", 3), ("003", 1), ("004", 1)]
    assert df.where("_corrupt_record is not null").count() == 0


def test_five_objects_on_one_line_of_a_stream(spark, tmp_path):
    path = put(tmp_path / "raw", FIVE)
    query = readers.stream_raw(spark, path).writeStream.format("memory").queryName("five").option(
        "checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("five").count() == 5


@pytest.mark.parametrize("text,bad", [
    ("{broken}", ["{broken}"]), ('{"station_id":"x"', ['{"station_id":"x"']), ("\nno json\n", ["no json"]),
    (" behind", ["behind"]), ('{"a":{"b":1}', ['{"a":{"b":1}']), ("} ]", ["} ]"]), (' {"a":"b{"} x', ["x"])])
def test_malformed_pieces_are_quarantined_and_take_nothing_with_them(spark, tmp_path, text, bad):
    path = put(tmp_path / "raw", ONE + text + "\n" + TWO)
    clean, faulty = curate(readers.read_raw(spark, path))
    assert clean.count() == 2
    faulty = faulty.where("reason = 'malformed'")
    assert sorted((r, c.strip()) for r, c in rows(faulty.select("reason", "_corrupt_record"))) == [
        ("malformed", b) for b in sorted(bad)]


def objects_of(line):
    """Records of a line, character by character."""
    out, depth, text, escaped, at = [], 0, False, False, ""
    for c in line:
        if text:
            at += c
            text, escaped = escaped or c != '"', c == "\\" and not escaped
            continue
        if c == "{" and not depth:
            out, at = [*out, at], ""
        at, text = at + c, c == '"'
        if c == "{":
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if not depth:
                out, at = [*out, at], ""
    return [x.strip() for x in [*out, at] if x.strip(" \t,[]")]


def test_records_equal_a_scan_by_character(spark):
    """Nested fields, lists, braces and escapes in texts, many objects on a line, and
    something before, between and behind them."""
    draw = random.Random(1)

    def value(depth):
        kind = draw.randrange(7 if depth < 4 else 4)
        if kind == 4:
            return [value(depth + 1) for _ in range(draw.randrange(4))]
        if kind > 4:
            return {f"k{i}": value(depth + 1) for i in range(draw.randrange(3))}
        return draw.choice([7, True, None, "a{b", "}{", 'x\\y', 'q"{', "", "}", '\\"', "\u00e9{", "\n{"])
    lines = []
    for _ in range(800):
        parts = [json.dumps({"station_id": value(3), "v": value(0)}, separators=draw.choice([(",", ":"), (", ", ": ")]))
                 + draw.choice(["", "", " ", "  ", ", ", " junk ", " }", " ]"]) for _ in range(draw.randrange(1, 6))]
        lines.append(draw.choice(["", "x ", "[", " "]) + "".join(parts))
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    got = df.select("n", readers._records(F.col("value")).alias("r")).collect()
    assert {r.n: [x.strip() for x in r.r] for r in got} == {n: objects_of(x) for n, x in enumerate(lines)}


NESTED = ONE.replace('"aqi":2', '"coord":{"lat":1,"at":{"x":[{},{"y":"}"}]}},"note":"a { \\" }{ b","aqi":2')


def test_nested_fields_and_braces_in_texts(spark, tmp_path):
    """As many readings as the plain JSON reader finds, which reads one object a line."""
    lines = [ONE, NESTED, NESTED.replace('"001"', '"0{1"'), "[" + ONE + ", " + NESTED + "]"]
    path = put(tmp_path / "raw", "\n".join(lines) + "\n" + NESTED + NESTED)
    plain = spark.read.schema(schemas.RAW).json(put(tmp_path / "plain", "\n".join([*lines, NESTED, NESTED])))
    df = readers.read_raw(spark, path)
    assert df.where("_corrupt_record is not null").count() == 0
    names = schemas.columns(schemas.RAW)
    assert rows(df.select(*names), *names) == rows(plain.select(*names), *names)
    assert df.count() == 7 and df.where("station_id = '0{1'").count() == 1


def test_files_without_line_breaks_are_split_inside_if_flat(spark, tmp_path):
    path = put(tmp_path / "raw", FIVE * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = readers.read_raw(spark, path, flat=True)
        assert df.rdd.getNumPartitions() > 5 and df.count() == 10_000
        assert readers.read_raw(spark, path).count() == 10_000
        assert df.where("_corrupt_record is not null").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_folder_partitions_do_not_disturb_the_clean_columns(spark, tmp_path):
    put(tmp_path / "raw/year=2024/month=01/day=01", ONE)
    put(tmp_path / "raw/year=2024/month=01/day=02", TWO)
    clean, _ = curate(readers.read_raw(spark, str(tmp_path / "raw")))
    assert clean.columns == schemas.columns(schemas.CLEAN)
    # the date comes from the reading, not from the folder, without leading zeros
    assert rows(clean.select("year", "month", "day").distinct()) == [("2024", "1", "1")]


def test_clean_table_round_trip_keeps_rows_and_types(spark, clean_of, tmp_path):
    df = clean_of(("001", 0.0, 1, 1.0), ("06", 90000.0, None, 2.0), ("a", None, 3, 3.0))
    path = str(tmp_path / "clean")
    writers.write_clean(df, path)
    back = readers.read_clean(spark, path)
    assert back.schema == schemas.CLEAN
    assert rows(back, "station_id") == rows(df, "station_id")


def test_station_ids_stay_text_as_partition(spark, tmp_path):
    row = ("001", "A", None, 3, 1.0, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0, 1.0, 0.9, "PELIGROSO", "t")
    df = spark.createDataFrame([row, ("a b=%c", *row[1:])], schemas.PREDICTIONS)
    path = str(tmp_path / "pred")
    writers.write_predictions(df, path)
    (Path(path) / "notes.txt").write_text("not a table file")
    back = readers.read_predictions(spark, path)
    assert rows(back.select("station_id"), "station_id") == [("001",), ("a b=%c",)]
    one = [str(p) for p in Path(path).rglob("station_id=001/*.parquet")]
    single = readers.read_predictions(spark, one, base=path)
    assert rows(single.select("station_id")) == [("001",)]
    assert single.first()["source_file"].endswith(".parquet")


def test_touched_days_only(spark, clean_of, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_clean(clean_of(("a", 0.0, 1, 1.0), ("a", 90000.0, 2, 2.0)), path)
    writers.write_clean(clean_of(("b", 90001.0, 3, 3.0)), path, touched_only=True)
    assert rows(readers.read_clean(spark, path).select("station_id", "aqi"), "aqi") == [("a", 1), ("b", 3)]
    writers.write_clean(clean_of(("c", 0.0, 5, 1.0)), path)
    assert rows(readers.read_clean(spark, path).select("station_id")) == [("c",)]


def test_csv_extract_round_trip(spark, clean_of, tmp_path):
    df = clean_of(("a", 3600.5, 1, 1.5), ("b", None, None, 2.0))
    path = str(tmp_path / "csv")
    writers.export_csv(df, path)
    back = readers.read_export(spark, path)
    assert back.columns == [*schemas.columns(schemas.EXTRACT), "fecha", "hora"]
    got = rows(back.select("station_name", F.col("timestamp_parsed").cast("string"), "aqi", "hora"),
               "station_name")
    assert got == [("Station a", "2024-01-01 01:00:00.5", 1, 1), ("Station b", None, None, None)]


def test_registered_table_finds_partitions(spark, clean_of, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_clean(clean_of(("a", 0.0, 1, 1.0), ("a", 90000.0, 2, 2.0)), path)
    table = writers.register_table(spark, "t_clean", path, schemas.CLEAN, schemas.CLEAN_PARTITIONS)
    assert table.count() == 2
    assert spark.sql("SELECT count(*) FROM t_clean WHERE day = '2'").first()[0] == 1
    assert writers.preview(table, 1).count() == 1


def test_synthetic_readings_are_the_same_for_any_layout(spark):
    places = [("A", "a", 6.0, -75.0), ("B", "b", 6.1, -75.1)]
    one = synthetic_readings(spark, 200, places, "2024-02-01 00:00:00", seed=7)
    assert one.schema.fieldNames() == schemas.columns(schemas.RAW)
    more = spark.range(200).repartition(7)
    from plumelake.operators.synthetic import synthesize
    two = synthesize(more, "id", places, "2024-02-01 00:00:00", seed=7)
    assert rows(one, *one.columns) == rows(two, *two.columns)
    ends = one.agg(F.min("pm25") >= 0, F.max("pm25") <= 150, F.min("aqi") >= 1, F.max("aqi") <= 5,
                   F.min("timestamp") >= "2024-01-01T01:00:00", F.max("timestamp") <= "2024-02-01T00:00:00")
    assert rows(ends) == [(True,) * 6]
    assert curate(one)[0].count() > 150


@pytest.mark.parametrize("schema,reader", [
    (schemas.CLEAN, readers.read_clean), (schemas.FEATURES, readers.read_features)])
def test_empty_tables(spark, tmp_path, schema, reader):
    empty = spark.createDataFrame([], schema)
    path = str(tmp_path / "empty")
    (writers.write_clean if schema is schemas.CLEAN else writers.write_features)(empty, path)
    assert reader(spark, path).count() == 0


def test_schema_rows(clean_of):
    got = rows(writers.schema_rows(clean_of(("a", 0.0, 1, 1.0))), "position")
    assert got[0] == (0, "station_id", "string", True) and len(got) == len(schemas.CLEAN.fields)
