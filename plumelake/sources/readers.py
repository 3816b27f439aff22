"""Sources. Every reader passes its schema, so no file is read to infer one and
partition values such as ``001`` keep their text form."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumelake.functions.times import parse_text_time
from plumelake.sources import schemas

# Flat files may also be cut before every opening brace, so that a file without line
# breaks is no single row.
OPEN = "{"

# Characters that stand for marks inside texts while a line is cut. Unicode
# sets them aside for such inner use, so no text holds them.
_OPEN_TEXT, _CLOSE_TEXT, _SLASHES, _QUOTE = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"
_FLAT = r"^\s*\{[^{}]*\}\s*$"        # one object without another brace
_SOMETHING = r"[^\s,\[\]]"          # more than what stands between the objects of a list
_BORDER = r"(?<=\})(?=\s*\{)"        # between two objects; never inside one


def _raw_with_corrupt() -> T.StructType:
    return T.StructType([*schemas.RAW.fields, T.StructField(schemas.CORRUPT, T.StringType())])


def read_raw(spark: SparkSession, path: str | list[str], flat: bool = False) -> DataFrame:
    """Raw readings from JSON files, plus ``_corrupt_record`` for text that is
    malformed or has a field of the wrong type (that field is null).

    Several objects may follow each other on one line; their fields may hold objects,
    lists and braces in texts, as with the plain JSON reader. Folder partitions are
    allowed. A line is read by one task. ``flat`` is for large files without line breaks
    whose objects hold no other brace: they are split inside, at objects.
    """
    if flat:
        return _parsed(_flat_records(spark.read.text(path, lineSep=OPEN)))
    return split_objects(spark.read.text(path))


def _masked(line: Column) -> Column:
    """A line whose braces all stand outside texts; those inside are replaced, and so are
    escaped quotes. What stands between two quotes is a text."""
    plain = F.replace(F.replace(line, F.lit("\\\\"), F.lit(_SLASHES)), F.lit('\\"'), F.lit(_QUOTE))
    parts = F.transform(F.split(plain, '"'), lambda x, i: F.when(
        i % 2 == 1, F.translate(x, "{}", _OPEN_TEXT + _CLOSE_TEXT)).otherwise(x))
    return F.array_join(parts, '"')


def _unmasked(text: Column) -> Column:
    braces = F.translate(text, _OPEN_TEXT + _CLOSE_TEXT, "{}")
    return F.replace(F.replace(braces, F.lit(_QUOTE), F.lit('\\"')), F.lit(_SLASHES), F.lit("\\\\"))


def _by_depth(chunk: Column) -> Column:
    """Objects of a masked text and what stands between them, by the depth of braces."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("open"), F.array().cast("array<string>").alias("done"))

    def step(at: Column, piece: Column) -> Column:
        """``piece``: from an opening brace, or the start, to before the next one."""
        opens = F.startswith(piece, F.lit("{"))
        ends = F.length(piece) - F.length(F.replace(piece, F.lit("}")))
        depth = at["depth"] + F.when(opens, 1).otherwise(0)
        closed = (depth > 0) & (ends >= depth)
        head = F.array_join(F.slice(F.split(piece, r"\}"), F.lit(1), F.greatest(depth, F.lit(1))), "}")
        tail = F.substring(piece, F.length(head) + 2, F.length(piece))
        whole = F.array(F.concat(at["open"], head, F.lit("}")), tail)
        return F.struct(
            F.when(closed, 0).when(depth == 0, 0).otherwise(depth - ends).alias("depth"),
            F.when(closed | (depth == 0), "").otherwise(F.concat(at["open"], piece)).alias("open"),
            F.when(closed, F.concat(at["done"], whole)).when(
                depth == 0, F.concat(at["done"], F.array(piece))).otherwise(at["done"]).alias("done"))

    def finish(at: Column) -> Column:
        return F.concat(at["done"], F.array(at["open"]))
    return F.aggregate(F.split(chunk, r"(?=\{)"), start, step, finish)


def _records(line: Column) -> Column:
    """The records of a line. Two objects that stand side by side outside of texts are
    always two records, which a pattern finds in one pass; only a record that holds another
    object, or has something before or behind it, is looked at brace by brace."""
    chunks = F.split(_masked(line), _BORDER)
    found = F.flatten(F.transform(chunks, lambda c: F.when(F.rlike(c, F.lit(_FLAT)), F.array(c)).otherwise(_by_depth(c))))
    return F.when(F.rlike(line, F.lit(_FLAT)), F.array(line)).otherwise(
        F.filter(F.transform(found, _unmasked), lambda x: F.rlike(x, F.lit(_SOMETHING))))


def split_objects(lines: DataFrame) -> DataFrame:
    """Lines (column ``value``) to raw readings, one per object. Other columns, such as
    folder partitions, are kept.

    What stands before, between or behind objects is a malformed record of its own, so is
    an object without its end, up to the end of its line: nothing is dropped, and other
    objects are not lost with it. The work is in proportion to the length of a line and,
    inside a record, to its length times the objects it holds.
    """
    rest = [c for c in lines.columns if c != "value"]
    blank = ~F.rlike("value", F.lit(r"\S"))
    return _parsed(lines.where(~blank).select(F.explode(_records(F.col("value"))).alias("value"), *rest))


def _flat_records(cut: DataFrame) -> DataFrame:
    """Text cut before every opening brace (without the brace) to records."""
    rest = [c for c in cut.columns if c != "value"]
    lines = F.split("value", r"\r?\n")
    first, later = F.get("_lines", F.lit(0)), F.slice("_lines", 2, F.size("_lines"))
    ends = F.length(first) - F.instr(F.reverse(first), "}") + 1     # place of the last brace
    whole = F.instr(first, "}") > 0
    item = F.when(whole, F.concat(F.lit(OPEN), F.substring(first, F.lit(1), ends))).when(
        F.trim(first) != "", F.concat(F.lit(OPEN), first))
    tail = F.when(whole, F.substring(first, ends + 1, F.length(first)))
    records = F.filter(F.concat(F.array(item, tail), later), lambda x: x.isNotNull() & (F.trim(x) != ""))
    return cut.select(lines.alias("_lines"), *rest).select(F.explode(records).alias("value"), *rest)


def _parsed(records: DataFrame) -> DataFrame:
    parse_options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    rest = [c for c in records.columns if c != "value"]
    parsed = F.from_json("value", _raw_with_corrupt(), parse_options)
    return records.select(parsed.alias("_reading"), *rest).select("_reading.*", *rest)


def stream_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New raw files as they arrive, read like ``read_raw``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return split_objects(reader.text(path))


def _parquet(spark: SparkSession, schema: T.StructType, path: str | list[str],
             base: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
    if base:
        reader = reader.option("basePath", base)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def _in_order(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*schemas.columns(schema))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return _in_order(_parquet(spark, schemas.CLEAN, path), schemas.CLEAN)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def folder_values(spark: SparkSession, path: str, keys: list[str]) -> list[tuple[str, ...]]:
    """Values of the partition folders below ``path`` by their names; no file is opened."""
    if not exists(spark, path):
        return []
    found = [((), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))]
    for key in keys:
        below = []
        for values, folder in found:
            system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            for status in system.listStatus(folder):
                name, _, value = status.getPath().getName().partition("=")
                if name == key:
                    below.append(((*values, value), status.getPath()))
        found = below
    return [values for values, _ in found]


def day_folders(spark: SparkSession, path: str) -> list[date]:
    """Days that a table by ``curated_date`` has folders for, in order."""
    days = [v for (v,) in folder_values(spark, path, ["curated_date"])]
    return sorted(date.fromisoformat(d) for d in days if d[:1].isdigit())


def read_clean_if_there(spark: SparkSession, path: str) -> DataFrame:
    """The clean table, empty before the first write."""
    return read_clean(spark, path) if exists(spark, path) else spark.createDataFrame([], schemas.CLEAN)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return _in_order(_parquet(spark, schemas.FEATURES, path), schemas.FEATURES)


def read_predictions(spark: SparkSession, paths: str | list[str],
                     base: str | None = None) -> DataFrame:
    """Prediction files with their path in ``source_file``; other files are skipped.

    To read single files and still get ``station_id``, name the table folder in
    ``base``.
    """
    df = _parquet(spark, schemas.PREDICTIONS, paths, base)
    return df.select(*schemas.columns(schemas.PREDICTIONS),
                     F.col("_metadata.file_path").alias("source_file"))


def list_files(spark: SparkSession, path: str, suffix: str = "*.parquet") -> DataFrame:
    """The files below a folder in ``source_file``, also those without rows; none is
    opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", suffix).option(
        "recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("source_file"))


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below a folder with time and size; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def _parquet_stream(spark: SparkSession, schema: T.StructType, path: str,
                    max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_clean(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return _parquet_stream(spark, schemas.CLEAN, path, max_files)


def stream_features(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return _parquet_stream(spark, schemas.FEATURES, path, max_files)


def stream_predictions(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    df = _parquet_stream(spark, schemas.PREDICTIONS, path, max_files)
    return df.select(*schemas.columns(schemas.PREDICTIONS),
                     F.col("_metadata.file_path").alias("source_file"))


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The report extract from CSV, with date and hour of each reading."""
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "timestamp_parsed" else f.dataType)
        for f in schemas.EXTRACT.fields
    ])
    df = spark.read.schema(as_text).option("header", True).csv(path)
    time = parse_text_time("timestamp_parsed")
    return df.withColumns({"timestamp_parsed": time, "fecha": F.to_date(time), "hora": F.hour(time)})
