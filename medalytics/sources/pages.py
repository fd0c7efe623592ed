"""Landed API pages: JSON envelopes {dados: [...] or {...}, links: [{rel}]}."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.skew import join_lookup


def write_pages(pages: DataFrame, path: str, value: str = "value") -> None:
    """One file per page. The tasks move their own files to the folder, so the driver does not move all of them one by one.

    A run that is lost while it writes can leave a part of the files; the folder must be a new one.
    """
    commit = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    pages.select(value).write.options(**commit).option("maxRecordsPerFile", 1).text(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page file: its path and text. A page has a bounded number of records."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("page"), F.col("value"))


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """Pages of several categories, read at once; their directories `name=value` become a column."""
    return spark.read.text(path, wholetext=True)


def payload_kind(value, payload: str = "dados"):
    """list, object, missing (no payload or an empty one) or other."""
    return _kind(_body(value, payload))


def _body(value, payload):
    return F.get_json_object(value, f"$.{payload}")


def _kind(body):
    return (
        F.when(body.isNull() | body.isin("[]", "{}", "", "null"), F.lit("missing"))
        .when(body.startswith("["), F.lit("list"))
        .when(body.startswith("{"), F.lit("object"))
        .otherwise(F.lit("other"))
    )


def explode_envelope(pages: DataFrame, schema: T.StructType, payload: str = "dados", value: str = "value") -> DataFrame:
    """Records of every page: each element of a list, an object as one row; other payloads give none.

    The other columns of `pages` are kept beside the fields of the record. The payload is cut out of the
    page as text once; parsed as a list of records, an object becomes a list of one.
    """
    kept = [c for c in pages.columns if c != value]
    cut = pages.select(*kept, _body(F.col(value), payload).alias("__body"))
    records = F.from_json("__body", T.ArrayType(schema))
    return cut.filter(_kind(F.col("__body")).isin("list", "object")).select(*kept, F.explode(records).alias("__r")).select(*kept, "__r.*")


def explode_records(pages: DataFrame, payload: str = "dados", value: str = "value", out: str = "record") -> DataFrame:
    """The JSON text of every record, beside the other columns of `pages`."""
    kept = [c for c in pages.columns if c != value]
    cut = pages.select(*kept, _body(F.col(value), payload).alias("__body"))
    kind = _kind(F.col("__body"))
    rows = F.when(kind == "list", F.from_json("__body", T.ArrayType(T.StringType()))).when(kind == "object", F.array("__body"))
    return cut.select(*kept, F.explode(rows).alias(out))


def page_report(pages: DataFrame, payload: str = "dados", value: str = "value") -> DataFrame:
    """Pages per kind of payload, so that skipped ones are seen."""
    return pages.groupBy(payload_kind(F.col(value), payload).alias("kind")).agg(F.count(F.lit(1)).alias("n_pages"))


def until_end(pages: DataFrame, by: list[str], page_no: str, payload: str = "dados", value: str = "value") -> DataFrame:
    """Pages of every set before its first page without payload, and up to the first without a next link."""
    links = F.from_json(F.get_json_object(value, "$.links"), "array<struct<rel string>>")
    has_next = F.coalesce(F.exists(links, lambda link: link.rel == "next"), F.lit(False))
    ends = pages.groupBy(*by).agg(
        F.min(F.when(payload_kind(F.col(value), payload) == "missing", F.col(page_no))).alias("__empty"),
        F.min(F.when(~has_next, F.col(page_no))).alias("__last"),
    )
    return (
        join_lookup(pages, ends, by)
        .filter((F.col("__empty").isNull() | (F.col(page_no) < F.col("__empty"))) & (F.col("__last").isNull() | (F.col(page_no) <= F.col("__last"))))
        .drop("__empty", "__last")
    )


def flatten_struct(df: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """Scalar columns as they are, scalar fields of the named structs with a prefix, lists dropped.

    `prefixes` maps the path of a struct to the prefix of its fields.
    """
    nested = (T.StructType, T.ArrayType, T.MapType)
    cols = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, nested)]
    for path, prefix in prefixes.items():
        kind = df.select(path).schema.fields[0].dataType
        cols += [F.col(f"{path}.{f.name}").alias(f"{prefix}{f.name}") for f in kind.fields if not isinstance(f.dataType, nested)]
    return df.select(*cols)


def rescue(df: DataFrame, value: str, schema: T.StructType) -> DataFrame:
    """Typed fields of a JSON record; keys that the schema does not know stay in `_rescued` as JSON."""
    record = F.from_json(value, "map<string,string>")
    known = F.array(*[F.lit(n) for n in schema.fieldNames()])
    extra = F.map_filter(record, lambda k, _: ~F.array_contains(known, k))
    others = [c for c in df.columns if c != value]
    return df.select(
        *others,
        F.from_json(value, schema).alias("__r"),
        F.when(F.size(extra) > 0, F.to_json(extra)).alias("_rescued"),
    ).select(*others, "__r.*", "_rescued")


def merged_schema(records: DataFrame, value: str = "record") -> T.StructType:
    """The schema that holds every JSON record: all keys of all of them, each with a type that takes all its values.

    Keys go by name. A record that is no JSON object, or a null, adds nothing; without any key there are no
    columns. One line with the schema comes to the driver; its size is that of the schema.
    """
    parsed = F.try_parse_json(value)
    merged = records.select(F.schema_of_variant_agg(F.when(F.schema_of_variant(parsed).startswith("OBJECT<"), parsed)).alias("s")).first()["s"]
    if not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return T.StructType()
    kinds = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}
    # names stand in backticks or before a colon, and stay
    text = re.sub(r"`(?:[^`]|``)*`|\b(OBJECT(?=<)|VARIANT(?!:)|VOID(?!:))", lambda m: kinds[m[1]] if m[1] else m[0], merged)
    found = records.sparkSession.sql(f"SELECT from_json(NULL, '{text.replace(chr(39), chr(92) + chr(39))}') AS r").schema["r"].dataType
    return T.StructType(sorted(found.fields, key=lambda f: f.name))


def with_merged_schema(records: DataFrame, value: str = "record", schema: T.StructType | None = None) -> DataFrame:
    """JSON records as columns, those that only later records have included; missing keys are null.

    Read as variants, each key by its merged type: a key whose records disagree is text, nested values are
    JSON there. Other columns are kept before the keys.
    """
    schema = merged_schema(records, value) if schema is None else schema
    others = [c for c in records.columns if c != value]
    parsed = records.select(*others, F.try_parse_json(value).alias("__v"))
    keys = [F.try_variant_get("__v", _path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return parsed.select(*others, *keys)


def _path(name: str) -> str:
    """The path of a key; one that has both kinds of quotes can't be named in a path."""
    if "'" in name and '"' in name:
        raise ValueError(f"a key with both kinds of quotes: {name}")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"
