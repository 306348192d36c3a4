"""Raw files to all-text tables, read by Spark's own file sources.

Every reader takes paths and returns text columns plus `_source_file`. File
content is only touched by executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylake.functions.columns import flatten, quoted, sorted_columns, union_by_name, with_declared
from quarrylake.functions.text import path_key, unescaped
from quarrylake.spec import Source

FILE = "_source_file"
ATTRIBUTE, OWN_TEXT = "@", "#text"
CORRUPT = "_corrupt_record"  # where the JSON source puts text it cannot read
RESCUED = "_rescued"  # what a source with declared fields delivered beside them, as JSON text
TEXTS = "map<string,string>"

Paths = str | Sequence[str]


def _many(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumn(FILE, unescaped(F.col("_metadata.file_path")))


def headers(spark: SparkSession, paths: Paths) -> DataFrame:
    """The first line of each file, and whether quoted fields of it run over line ends.

    A line that closes all its quotes holds an even number of them. One row
    per file leaves the scan.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("recursiveFileLookup", "true").text(_many(paths)).select(
        "value",
        unescaped(F.col("_metadata.file_path")).alias(FILE),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("_line"),
        (quotes % 2 == 1).alias("_open"),
    )
    return lines.groupBy(FILE).agg(F.min_by("value", "_line").alias("header"), F.max("_open").alias("runs_over"))


def _scan_csv(spark: SparkSession, paths: list[str], runs_over: bool) -> DataFrame:
    options = {"header": "true", "escape": '"', "encoding": "UTF-8", "recursiveFileLookup": "true"}
    return _with_file(spark.read.options(**options, multiLine=runs_over).csv(paths))


def read_csv(spark: SparkSession, paths: Paths, same_header: bool = False) -> DataFrame:
    """CSV files with a header line, columns matched by name.

    Files may differ in their columns and in the order of them. The headers
    are gathered first; files with equal headers are read together by the CSV
    source and the groups are united by name. Where headers differ the driver
    holds the file names, so very many files are best passed in batches, as
    the bronze load does. Files stay splittable unless a
    quoted field runs over a line end. `same_header` vouches that all files
    are alike and have no such field, and skips that pass.
    """
    if same_header:
        return _scan_csv(spark, _many(paths), False)
    groups = headers(spark, paths).groupBy("header", "runs_over").agg(F.collect_list(FILE).alias("files")).collect()
    if len(groups) == 1:
        return _scan_csv(spark, _many(paths), groups[0]["runs_over"])
    ordered = sorted(groups, key=lambda g: (g["header"], g["runs_over"]))
    return union_by_name(*[_scan_csv(spark, g["files"], g["runs_over"]) for g in ordered])


def read_ndjson(spark: SparkSession, paths: Paths) -> DataFrame:
    """One JSON object per line; numbers and booleans keep their text."""
    raw = spark.read.option("primitivesAsString", "true").option("recursiveFileLookup", "true")
    return flatten(_with_file(raw.json(_many(paths))))


def explode_records(docs: DataFrame, root: str, envelope: bool = False, carry: Sequence[str] = (FILE, CORRUPT)) -> DataFrame:
    """One row per element of the array `root`, flattened to text.

    With `envelope` the document's other fields are repeated on each row; a
    field of the element wins over one of the same name around it. Columns in
    `carry` always come along. An empty array gives no row; a document without
    the array, such as one that could not be read, gives one row that holds
    only what is carried, for the reject rules to find.
    """
    kind = docs.schema[root].dataType if root in docs.columns else None
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        kept = docs.where(quoted(root).isNull()) if kind is not None else docs
        return flatten(kept.select(*[quoted(c) for c in docs.columns if c in carry]))
    around = [c for c in docs.columns if c != root and c not in kind.elementType.names and (envelope or c in carry)]
    some = docs.where(quoted(root).isNull() | (F.size(quoted(root)) > 0))
    rows = some.select(*[quoted(c) for c in around], F.explode_outer(quoted(root)).alias("_record"))
    return flatten(rows.select(*[quoted(c) for c in around], "_record.*"))


def read_documents(
    spark: SparkSession, paths: Paths, root: str, envelope: bool = False, one_per_line: bool = False
) -> DataFrame:
    """JSON documents that hold their rows in the array `root`; one per file, or one per line."""
    reader = (
        spark.read.option("primitivesAsString", "true")
        .option("recursiveFileLookup", "true")
        .option("encoding", "UTF-8")
        .option("multiLine", str(not one_per_line).lower())
    )
    return explode_records(_with_file(reader.json(_many(paths))), root, envelope)


def _xml_columns(df: DataFrame) -> DataFrame:
    """Attributes, child text and child attributes as plain text columns."""
    attributes: dict = {}
    children: dict = {}
    for item in df.schema.fields:
        name, value, kind = item.name, quoted(item.name), item.dataType
        many = isinstance(kind, T.ArrayType)
        kind = kind.elementType if many else kind
        last = F.try_element_at(value, F.lit(-1)) if many else value
        if name.startswith(ATTRIBUTE):
            attributes[name.removeprefix(ATTRIBUTE)] = last
        elif not isinstance(kind, T.StructType):
            children[name] = last
        else:
            children[name] = last.getField(OWN_TEXT) if OWN_TEXT in kind.names else F.lit(None)
            for part in kind.names:
                if part.startswith(ATTRIBUTE):
                    given = F.array_compact(value.getField(part)) if many else None
                    children[f"{name}_{part.removeprefix(ATTRIBUTE)}"] = F.try_element_at(given, F.lit(-1)) if many else value.getField(part)
    return df.select(*[c.cast("string").alias(n) for n, c in {**attributes, **children}.items()])


def read_xml(spark: SparkSession, paths: Paths, row_tag: str) -> DataFrame:
    """One row per `row_tag` element. Of a repeated child the last text counts, and the last of each attribute."""
    reader = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("attributePrefix", ATTRIBUTE)
        .option("valueTag", OWN_TEXT)
        .option("inferSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("encoding", "UTF-8")
    )
    return _xml_columns(_with_file(reader.load(_many(paths))))


def _texts(value: Column) -> Column:
    """A JSON object as a map of its fields' texts, null where it is none."""
    return _last_wins(F.from_json(value, TEXTS))


def _last_wins(found: Column) -> Column:
    """The map, of a repeated field the last one."""
    keys = F.map_keys(found)
    last = F.filter(F.map_entries(found), lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_entries(last)).otherwise(found)


def _tree(fields: Sequence[str]) -> dict[str, dict]:
    """Declared fields by their path: {"a": {}, "b": {"c": {}}}."""
    tree: dict[str, dict] = {}
    for name in fields:
        below = tree
        for part in name.split("."):
            below = below.setdefault(part, {})
    return tree


def _declared(found: Column, tree: dict[str, dict], above: str = "") -> tuple[dict[str, Column], list[Column]]:
    """The declared fields of a map of texts as columns, and maps of what else it holds.

    A field that stands where an object was declared counts as undeclared.
    """
    columns: dict[str, Column] = {}
    beside = [F.map_filter(found, lambda k, _: ~k.isin(list(tree))) if tree else found]
    if above:
        beside = [F.transform_keys(beside[0], lambda k, _: F.concat(F.lit(f"{above}_"), k))]
    for name, below in tree.items():
        path = f"{above}_{name}" if above else name
        value = found[name]
        if not below:
            columns[path] = value
            continue
        inside = _texts(value)
        inner, more = _declared(inside, below, path)
        columns.update(inner)
        beside += [*more, F.when(inside.isNull() & value.isNotNull(), F.create_map(F.lit(path), value))]
    return columns, beside


def _declared_columns(df: DataFrame, found: Column, fields: Sequence[str], carry: Sequence[Column]) -> DataFrame:
    columns, beside = _declared(found, _tree(fields))
    empty = F.from_json(F.lit("{}"), TEXTS)
    rescued = F.map_concat(*[F.coalesce(b, empty) for b in beside]) if len(beside) > 1 else F.coalesce(beside[0], empty)
    text = F.when(F.size(rescued) > 0, F.to_json(rescued, {"ignoreNullFields": "false"}))
    return df.select(*[c.alias(n) for n, c in columns.items()], text.alias(RESCUED), *carry)


def declared_ndjson(spark: SparkSession, paths: Paths, fields: Sequence[str]) -> DataFrame:
    """One JSON object per line, in one pass: declared fields, the rest in `_rescued`.

    Whole numbers keep their text, others the shortest text of their value.
    """
    lines = _with_file(spark.read.option("recursiveFileLookup", "true").text(_many(paths))).where(F.trim("value") != "")
    found = lines.withColumn("_found", _texts(F.col("value")))
    unread = F.when(F.col("_found").isNull(), F.col("value")).alias(CORRUPT)
    return _declared_columns(found, F.col("_found"), fields, [F.col(FILE), unread])


def declared_documents(
    spark: SparkSession, paths: Paths, root: str, fields: Sequence[str], envelope: bool = False, one_per_line: bool = False
) -> DataFrame:
    """The elements of the array `root` of each document, in one pass over the files.

    With `envelope` the document's other fields are repeated on each row; a field of
    the element wins over one of the same name. An empty array gives no row. A document
    that cannot be read, or has no array of objects under `root`, gives one row that
    holds nothing but its text in `_corrupt_record`.
    """
    texts = spark.read.option("recursiveFileLookup", "true").text(_many(paths), wholetext=not one_per_line)
    docs = _with_file(texts).where(F.trim("value") != "")
    if envelope:
        parsed = docs.withColumn("_around", _texts(F.col("value"))).withColumn("_rows", F.from_json(F.col("_around")[root], f"array<{TEXTS}>"))
    else:
        kind = f"struct<`{root}`:array<{TEXTS}>>"
        parsed = docs.withColumn("_rows", F.from_json("value", kind)[root])
    sound = F.coalesce(F.forall("_rows", lambda r: r.isNotNull()), F.lit(False))
    unread = F.when(~sound, F.col("value")).alias(CORRUPT)
    around = [F.map_filter("_around", lambda k, _: k != root).alias("_around")] if envelope else []
    none = F.array(F.lit(None).cast(TEXTS))
    rows = parsed.select(FILE, unread, *around, F.explode(F.when(sound, F.col("_rows")).otherwise(none)).alias("_found"))
    rows = rows.withColumn("_found", _last_wins(F.col("_found")))
    found = F.col("_found")
    if envelope:
        outer = F.map_filter("_around", lambda k, _: ~F.map_contains_key(F.col("_found"), k))
        found = F.when(found.isNotNull(), F.map_concat(outer, found))
    return _declared_columns(rows.withColumn("_found", found), F.col("_found"), fields, [F.col(FILE), F.col(CORRUPT)])


def declared_xml(spark: SparkSession, paths: Paths, row_tag: str, fields: Sequence[str]) -> DataFrame:
    """One row per `row_tag` element, in one pass: declared children and attributes.

    Children that are not declared are kept in `_rescued`, as a list of their XML;
    attributes that are not declared are not read.
    """
    text, beside = T.StringType(), "_beside"
    schema = T.StructType()
    for name, below in _tree(fields).items():
        if name.startswith(ATTRIBUTE):
            schema.add(name, text)
        else:
            child = T.StructType([T.StructField(part, text) for part in (OWN_TEXT, *below)])
            schema.add(name, T.ArrayType(child))
    schema.add(beside, T.ArrayType(text)).add(CORRUPT, text)
    reader = (
        spark.read.format("xml").schema(schema).option("rowTag", row_tag).option("attributePrefix", ATTRIBUTE)
        .option("valueTag", OWN_TEXT).option("wildcardColName", beside).option("recursiveFileLookup", "true").option("encoding", "UTF-8")
    )
    rows = _with_file(reader.load(_many(paths)))
    rescued = F.when(F.size(beside) > 0, F.to_json(beside)).alias(RESCUED)
    carried = rows.select(rescued, FILE, CORRUPT, *[quoted(n) for n in schema.names if n not in (beside, CORRUPT)])
    return _xml_columns(carried)


def read_text(spark: SparkSession, paths: Paths) -> DataFrame:
    """Whole files as UTF-8 text, one row per file."""
    return _with_file(spark.read.option("recursiveFileLookup", "true").text(_many(paths), wholetext=True))


def _ndjson(spark: SparkSession, paths: Paths, source: Source) -> DataFrame:
    return declared_ndjson(spark, paths, source.fields) if source.fields else read_ndjson(spark, paths)


def _documents(spark: SparkSession, paths: Paths, source: Source) -> DataFrame:
    if source.fields:
        return declared_documents(spark, paths, source.root, source.fields, source.envelope)
    return read_documents(spark, paths, source.root, source.envelope)


def _xml(spark: SparkSession, paths: Paths, source: Source) -> DataFrame:
    return declared_xml(spark, paths, source.root, source.fields) if source.fields else read_xml(spark, paths, source.root)


READERS: dict[str, Callable[[SparkSession, Paths, Source], DataFrame]] = {
    "csv": lambda spark, paths, source: read_csv(spark, paths),
    "ndjson": _ndjson,
    "document": _documents,
    "xml": _xml,
}


def read_source(spark: SparkSession, paths: Paths, source: Source) -> DataFrame:
    """Rows of a source as name-sorted text columns, with its declared and folder columns."""
    rows = with_declared(READERS[source.format](spark, paths, source), source.declared)
    rows = rows.withColumns({k: path_key(F.col(FILE), k) for k in source.keys})
    return sorted_columns(rows)
