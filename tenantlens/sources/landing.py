"""Landed API responses as DataFrames.

Responses lie as JSON files, one object per line, either one record or one page
envelope each. Schemas are given, not inferred: an empty folder keeps its
columns, a field no record carries is NULL, and no extra pass reads the data.

Beside the typed fields each record is kept whole as a VARIANT (``RECORD``), made
from the same line in the same scan. A field that the schema does not name yet is
there, and ``record_fields`` types it later without landing anything again. Where
nobody asks for the whole record it is neither made nor read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantlens.schemas import NEXT_PAGE, NEXT_PAGE_OF, REQUESTED_PAGE
from tenantlens.session import scratch_dir

CORRUPT = "_corrupt_record"
RECORD = "_record"  # the record as delivered
FILE = "_file"  # that a page lies in


def record_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def whole_record(text: Column) -> Column:
    """A record as delivered: its JSON, or its text where that is none."""
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def record_lines(lines: DataFrame) -> DataFrame:
    """Lines (column ``value``) with something in them; an array of records is as many lines."""
    text = F.trim("value")
    several = F.from_json("value", "ARRAY<STRING>")
    each = F.when(F.startswith(text, F.lit("[")), F.coalesce(several, F.array("value"))).otherwise(F.array("value"))
    kept = [c for c in lines.columns if c != "value"]
    return lines.where(text != "").select(*kept, F.explode(each).alias("value"))


def records_of(lines: DataFrame, ddl: str) -> DataFrame:
    """Records of text lines; also of a stream of them."""
    whole = record_lines(lines).withColumn(RECORD, whole_record(F.col("value")))
    parsed = parse_records(whole, "value", ddl, [RECORD])
    return parsed.select(*[c for c in parsed.columns if c != RECORD], RECORD)


def landed_files(spark: SparkSession, path: str) -> list[str]:
    """Name, size and time of all files of a landing folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    found, files = [], folder.getFileSystem(conf).listFiles(folder, True)
    while files.hasNext():
        file = files.next()
        found.append(f"{file.getPath().toString()} {file.getLen()} {file.getModificationTime()}")
    return found


def read_records(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Records of a landing folder with the whole record in RECORD; the text of bad
    lines is kept in CORRUPT."""
    return records_of(spark.read.text(path), ddl)


def record_fields(records: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The records with further typed columns, ``name: (path, type)``, taken from the
    whole record: a missing field or one of another type is NULL."""
    typed = {n: F.try_variant_get(RECORD, path, kind) for n, (path, kind) in fields.items()}
    return records.withColumns(typed)


def unnamed_fields(records: DataFrame, ddl: str) -> DataFrame:
    """field, type, records: what the whole records hold beyond the schema."""
    known = set(record_type(ddl).fieldNames())
    keys = F.json_object_keys(F.to_json(RECORD))
    held = records.select(F.explode(keys).alias("field"), RECORD).where(~F.col("field").isin(*known))
    value = F.expr(f"try_variant_get({RECORD}, '$', 'map<string, variant>')[field]")
    kinds = held.select("field", F.schema_of_variant(value).alias("type"))
    return kinds.groupBy("field", "type").agg(F.count(F.lit(1)).alias("records"))


def read_pages(
    spark: SparkSession,
    path: str,
    items_key: str,
    ddl: str,
    parent_keys: Sequence[str] = (),
    token: str = NEXT_PAGE,
    whole: bool = False,
) -> DataFrame:
    """Page envelopes of a landing folder, one row per page. With ``whole`` each record
    of the page carries itself as delivered. NEXT_PAGE is what asks for the next page: the
    field ``token`` or, where a page has none, the token of that name. REQUESTED_PAGE is
    the one that the page answers."""
    schema = T.StructType([T.StructField(key, T.StringType()) for key in parent_keys])
    tokens = list(dict.fromkeys([token, NEXT_PAGE]))
    for field in (*tokens, REQUESTED_PAGE):
        schema = schema.add(field, T.StringType())
    schema = schema.add(items_key, T.ArrayType(record_type(ddl)))
    envelope = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    lines = record_lines(spark.read.text(path).select("value", F.input_file_name().alias(FILE)))
    kept, items = [FILE], F.col(f"`{items_key}`")
    if whole:
        records = F.try_variant_get(F.try_parse_json("value"), f'$["{items_key}"]', "array<variant>")
        lines, kept = lines.withColumn(RECORD, records), [FILE, RECORD]
        fields = schema[items_key].dataType.elementType.fieldNames()
        items = F.transform(
            items, lambda item, i: F.struct(*[item[f].alias(f) for f in fields], F.get(RECORD, i).alias(RECORD))
        )
    return parse_records(lines, "value", envelope, kept).select(
        *parent_keys,
        F.coalesce(*[F.col(f"`{t}`") for t in tokens]).alias(NEXT_PAGE),
        REQUESTED_PAGE,
        items.alias(items_key),
        CORRUPT,
        FILE,
    )


def parse_records(texts: DataFrame, column: str, ddl: str, keep: Sequence[str] = ()) -> DataFrame:
    """Records held as JSON text in a table column, with the ``keep`` columns of
    their row; bad text gives NULL fields and is kept in CORRUPT.

    The record is unpacked by a generator, so filters on its fields run after
    it and do not parse the text once more each.
    """
    fields = record_type(ddl)
    schema = T.StructType(fields.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(column), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return texts.select(*keep, F.inline(F.array(parsed)))


def flatten_pages(pages: DataFrame, items_key: str) -> DataFrame:
    """All records of all pages; a page without the array gives none."""
    return pages.select(F.explode(items_key).alias("_child")).select("_child.*")


def attach_parent_keys(
    responses: DataFrame, items_key: str, parents: Mapping[str, str]
) -> DataFrame:
    """Children of each response with the keys of the parent they belong to.

    ``parents`` maps the new column to the response column. A child's own field
    of the same name gives way to the parent's key.
    """
    children = responses.select(
        *[F.col(source).alias(f"_parent_{name}") for name, source in parents.items()],
        F.explode(items_key).alias("_child"),
    )
    child_fields = responses.schema[items_key].dataType.elementType.fieldNames()
    return children.select(
        *[F.col(f"_parent_{name}").alias(name) for name in parents],
        *[F.col("_child")[f].alias(f) for f in child_fields if f not in parents],
    )


def parents_without_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents no child row names, so that a skipped call leaves a trace.

    Child keys are made distinct before the join: a parent with very many
    children is one row by the time rows are shuffled for it.
    """
    with_children = children.select(key).distinct()
    return parents.join(with_children, key, "left_anti")


def _nothing_parsed(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNull()
    return condition


def usable_records(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Records with at least one field read, ``keep`` columns not among them. A
    line that is bad in one field stays, with NULL there; a line that is no
    record at all is left out (and is counted by ``landing_audit``)."""
    if CORRUPT not in records.columns:
        return records
    fields = [c for c in records.columns if c not in (CORRUPT, RECORD) and c not in keep]
    return records.where(F.col(CORRUPT).isNull() | ~_nothing_parsed(fields)).drop(CORRUPT)


def unusable(records: DataFrame, items_key: str | None = None) -> Column:
    """Lines of which nothing is kept: no record at all, or a page without its array."""
    if items_key:
        return F.col(items_key).isNull()
    fields = [c for c in records.columns if c not in (CORRUPT, RECORD)]
    return F.col(CORRUPT).isNotNull() & _nothing_parsed(fields)


def landing_audit(records: DataFrame, items_key: str | None = None) -> dict[str, Column]:
    """Counts to observe while records are written: all rows, rows with a bad
    field, rows of which nothing is kept."""
    return {
        "rows": F.count(F.lit(1)),
        "bad_rows": F.count_if(F.col(CORRUPT).isNotNull()),
        "lost_rows": F.count_if(unusable(records, items_key)),
    }


def quarantined(records: DataFrame, items_key: str | None = None) -> DataFrame:
    """The text of lines with a bad field or of which nothing is kept."""
    wrong = F.col(CORRUPT).isNotNull() | unusable(records, items_key)
    whole = F.to_json(F.struct(*[c for c in records.columns if c not in (CORRUPT, RECORD, FILE)]))
    return records.where(wrong).select(F.coalesce(CORRUPT, whole).alias("line"))


def broken_lists(pages: DataFrame, parent_keys: Sequence[str] = ()) -> DataFrame:
    """Pieces of page lists that are not whole, as rows (file, parent keys, fault, pages).

    A page is followed by the one that answers its token, in whatever file it lies. A
    piece begins at a page that answers none (a list's first), or one that nobody asked
    for (``start missing``). ``breaks off``: its last page asks for one that is not
    there. ``circle``: pages that ask for each other. So a hole inside a list gives the
    piece before it and the one behind.

    Pages of an extraction that does not write REQUESTED_PAGE cannot be followed over
    files: a file of such pages is whole if one of them asks for no other.

    Only tokens are moved, as digests. Chains are followed by pointer jumping, so the
    longest one costs as many joins as its length has binary digits.
    """
    parents = list(parent_keys)
    parts = [F.coalesce(F.col(p), F.lit("")) for p in parents]

    def digest(token: str) -> Column:
        return F.when(F.col(token).isNotNull(), F.sha2(F.concat_ws("\n", *parts, token), 256))

    links = _stored(
        pages.where(F.col(CORRUPT).isNull()).select(
            F.col(FILE).alias("file"), *parents, digest(NEXT_PAGE).alias("asks"), digest(REQUESTED_PAGE).alias("answers")
        ),
        "page-links",
    )
    asking, answering = links.agg(F.count("asks"), F.count("answers")).first()
    per_file = links.groupBy("file", *parents).agg(
        F.count("answers").alias("_answering"), F.count_if(F.col("asks").isNull()).alias("_last"), F.count(F.lit(1)).alias("pages")
    )
    if not answering:  # nothing to follow
        lists = per_file.where("_last = 0") if asking else per_file.limit(0)
        return lists.select("file", *parents, F.lit("breaks off").alias("fault"), "pages")
    following = links.where("answers IS NOT NULL")
    # a page that was landed twice is one page; of two answers the one that goes on counts
    nexts = following.groupBy("answers").agg(F.max("asks").alias("to"), F.min("file").alias("file"))
    jumps = _last_pages(nexts.withColumn("pages", F.lit(1).cast("bigint")))
    asked = links.select(F.col("asks").alias("answers")).where("answers IS NOT NULL").distinct()
    orphans = following.join(asked, "answers", "left_anti")
    same = [F.col("h.file") == F.col("f.file"), *[F.col(f"h.{p}").eqNullSafe(F.col(f"f.{p}")) for p in parents]]
    condition = same[0]
    for equal in same[1:]:
        condition = condition & equal
    heads = links.where("answers IS NULL").select("file", *parents, "asks").alias("h")
    heads = heads.join(per_file.alias("f"), condition, "left").select("h.*", "_answering", "_last")

    def followed(starts: DataFrame) -> DataFrame:
        ends = jumps.where("NOT moved").select(F.col("answers").alias("asks"), F.col("to"), F.col("pages").alias("_more"))
        return starts.join(ends.withColumn("_found", F.lit(True)), "asks", "left").withColumns(
            {
                "_ends": F.col("asks").isNull() | (F.coalesce("_found", F.lit(False)) & F.col("to").isNull()),
                "pages": F.coalesce("_more", F.lit(0)) + 1,
            }
        )

    open_ended = followed(heads).where("NOT _ends")
    alone = F.col("_found").isNull() & (F.col("_answering") == 0)
    old = open_ended.where(alone & (F.col("_last") == 0)).groupBy("file", *parents).agg(F.sum("pages").alias("pages"))

    def told(rows: DataFrame, fault: str) -> DataFrame:
        return rows.select("file", *parents, F.lit(fault).alias("fault"), F.col("pages").cast("bigint"))

    circles = jumps.where("moved").join(following.select("answers", *parents).distinct(), "answers")
    circles = circles.groupBy("file", *parents).agg(F.count(F.lit(1)).alias("pages"))
    lost = followed(orphans.select("file", *parents, "asks").distinct())
    pieces = told(open_ended.where(~alone), "breaks off").unionByName(told(old, "breaks off"))
    return pieces.unionByName(told(lost, "start missing")).unionByName(told(circles, "circle"))


def count_broken(lists: DataFrame) -> int:
    """How many lists are not whole: each hole has a piece before it, behind it, or both."""
    counts = {r["fault"]: r["count"] for r in lists.groupBy("fault").count().collect()}
    return max(counts.get("breaks off", 0), counts.get("start missing", 0)) + (counts.get("circle", 0) > 0)


def _last_pages(nexts: DataFrame) -> DataFrame:
    """Of each page (``answers``) the token that the last page of its chain asks for, and
    the pages up to it. ``moved`` marks pages that never come to an end."""
    jumps, moved = _stored(nexts.withColumn("moved", F.lit(True)), "page-jumps"), 1
    rounds = math.ceil(math.log2(jumps.count() + 1)) + 1
    for _ in range(rounds):
        if not moved:
            break
        target = jumps.select(
            F.col("answers").alias("to"), F.col("to").alias("_to"), F.col("pages").alias("_pages"), F.lit(True).alias("_hit")
        )
        asking = jumps.where("to IS NOT NULL").join(target, "to", "left").select(
            "answers",
            F.when(F.col("_hit"), F.col("_to")).otherwise(F.col("to")).alias("to"),
            "file",
            (F.col("pages") + F.coalesce("_pages", F.lit(0))).alias("pages"),
            F.coalesce("_hit", F.lit(False)).alias("moved"),
        )
        done = jumps.where("to IS NULL").withColumn("moved", F.lit(False))
        jumps = _stored(asking.unionByName(done), "page-jumps")
        moved = jumps.where("moved").limit(1).count()
    return jumps


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the scratch folder: a loop reads each round's rows, not their history."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def import_tabular(
    rows: DataFrame,
    names: Mapping[str, str],
    types: Mapping[str, str],
    constants: Mapping[str, object] | None = None,
) -> DataFrame:
    """Rows of another model's query result: new names, casts, constant columns.

    Columns without a new name keep theirs.
    """
    renamed = rows.withColumnsRenamed(dict(names))
    return renamed.select(
        *[
            F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
            for c in renamed.columns
        ],
        *[F.lit(value).alias(name) for name, value in (constants or {}).items()],
    )
