"""Sources: JSON of either root, packets, records, manifests of several shapes, reservation logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.images import image_facts
from ..operators.tables import last_wins

BLOCK = "struct<label:string,block_id:string,type:string,bbox:array<double>,text:string,page:int,figure_id:string,order:int>"
PACKET = f"run_id string, page int, namespace string, blocks array<{BLOCK}>"
IMAGE = "run_id string, article_url string, title string, index int, url string, path string, width int, height int, mode string, format string, bytes long, phase string"
RESERVATION = "bucket string, ts double, tokens int, label string, pid int"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return bool(found is not None and len(found))


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table at path has data files, in it or in its partitions; other failures are not taken for a missing table."""
    return any(exists(spark, f"{path}/{depth}*.parquet") for depth in ("", "*/", "*/*/"))


def read_json(spark: SparkSession, path: str, schema: str | T.StructType, default: DataFrame | None = None) -> DataFrame:
    """Whole-file JSON; a missing path is the default, or an error without one."""
    if not exists(spark, path):
        if default is None:
            raise FileNotFoundError(path)
        return default
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """Packets of page_*.json files, with their file for the order."""
    return spark.read.schema(PACKET).option("multiLine", True).option("pathGlobFilter", "page_*.json").json(path).withColumn("file", F.col("_metadata.file_name"))


def packet_blocks(packets: DataFrame) -> DataFrame:
    """A block a label, the last file's last one winning; unlabelled blocks go."""
    rows = packets.select("file", F.posexplode("blocks").alias("at", "b")).select("file", "at", "b.*").where("trim(coalesce(label, '')) <> ''")
    return last_wins(rows, ["label"], ["file", "at"])


def read_records(spark: SparkSession, path: str, schema: str, numbers: list[int] | None = None) -> DataFrame:
    """Question records of a file that is a list or an object with `questions`; by number, only those asked for."""
    text = spark.read.text(path, wholetext=True)
    root = F.trim("value")
    rows = F.when(F.startswith(root, F.lit("[")), root).otherwise(F.get_json_object(root, "$.questions"))
    out = text.select(F.explode(F.from_json(rows, f"array<struct<{schema_colons(schema)}>>")).alias("r")).select("r.*")
    if numbers:
        out = out.where(F.col("question_no").isin(numbers))
    return out.orderBy("question_no")


def schema_colons(schema: str) -> str:
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return fields.simpleString().removeprefix("struct<").removesuffix(">")


def read_standardized(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files named q and two digits; those without a whole number go."""
    d = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "q*.json").option("recursiveFileLookup", True).json(path)
    return d.where(F.rlike("_metadata.file_name", F.lit(r"^q\d{2}\.json$")) & F.col("question_no").try_cast("int").isNotNull())


def two_keys(items: DataFrame, *columns: str) -> DataFrame:
    """Items once under each of the key columns that is not blank."""
    keys = F.array_distinct(F.filter(F.array(*columns), lambda k: k.isNotNull() & (k != "")))
    return items.withColumn("key", F.explode(keys))


def unified_images(spark: SparkSession, path: str) -> DataFrame:
    """Image rows of article manifests in any known shape, as IMAGE."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("m"))
    get = lambda c, *paths: F.coalesce(*(F.get_json_object(c, p) for p in paths))
    items = F.from_json(get("m", "$.images", "$.image_assets", "$.assets"), "array<string>")
    d = raw.select("m", F.posexplode(items).alias("at", "i"))
    num = lambda *paths: get("i", *paths).try_cast("int")
    return d.select(
        get("m", "$.run_id", "$.article_id").alias("run_id"), get("m", "$.article_url", "$.source_article", "$.url").alias("article_url"), get("m", "$.article_title", "$.title").alias("title"),
        F.coalesce(num("$.index"), F.col("at")).alias("index"), get("i", "$.url", "$.attrs['data-src']", "$.attrs.src").alias("url"), get("i", "$.path", "$.download.path").alias("path"),
        num("$.width", "$.probe.width", "$.attrs['data-w']").alias("width"), num("$.height", "$.probe.height").alias("height"),
        get("i", "$.mode", "$.probe.mode").alias("mode"), get("i", "$.format", "$.probe.format", "$.type").alias("format"),
        get("i", "$.bytes", "$.download.bytes").try_cast("long").alias("bytes"), F.coalesce(get("i", "$.phase"), F.lit("unknown")).alias("phase"),
    )


def image_phases(images: DataFrame, sequence: DataFrame) -> DataFrame:
    """Phases of article images: from the sequence where it has both, else paper where the title says so, else unknown."""
    seq = sequence.where("kind = 'image'").select("url", F.col("imageIndex").try_cast("int").alias("_i"), F.col("phase").alias("_phase")).where("_i is not null")
    both = seq.groupBy("url").agg((F.bool_or(F.col("_phase") == "paper") & F.bool_or(F.col("_phase") == "answer")).alias("_both"))
    j = images.join(both.withColumnRenamed("url", "article_url"), "article_url", "left").join(
        seq.withColumnsRenamed({"url": "article_url", "_i": "index"}), ["article_url", "index"], "left"
    )
    paper = F.rlike("title", F.lit("试题|试卷|练习|模拟")) & ~F.rlike("title", F.lit("答案|解析|评分"))
    return j.withColumn("phase", F.when(F.coalesce("_both", F.lit(False)), F.coalesce("_phase", F.lit("unknown"))).when(paper, "paper").otherwise("unknown")).drop("_both", "_phase")


def first_nonempty(*sources: DataFrame, key: str) -> DataFrame:
    """Rows of the first source that has any for a key."""
    out, seen = None, None
    for s in sources:
        part = s if seen is None else s.join(seen, key, "left_anti")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        keys = s.select(key).distinct()
        seen = keys if seen is None else seen.unionByName(keys).distinct()
    return out


def import_items(rules: DataFrame, listing: DataFrame) -> DataFrame:
    """Import manifest of rules (run_id, .., paper_pdf, answer_pdf): errors for files that are not in the listing, ready without errors."""
    have = listing.select(F.col("path").alias("_p")).distinct()
    out = rules
    for c in ("paper_pdf", "answer_pdf"):
        h = have.withColumnRenamed("_p", f"_{c}")
        out = out.join(h, out[c] == h[f"_{c}"], "left")
    lost = lambda c: F.when(F.col(c).isNotNull() & F.col(f"_{c}").isNull(), F.concat(F.lit(f"missing {c}: "), F.col(c)))
    errors = F.array_compact(F.array(lost("paper_pdf"), lost("answer_pdf")))
    return out.withColumn("errors", errors).withColumn("ready", F.size("errors") == 0).drop("_paper_pdf", "_answer_pdf")


def page_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Binary files with their paths, lengths and contents."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def run_ids(listing: DataFrame, marker: str) -> DataFrame:
    """Distinct runs that hold the marker file, in order."""
    name = F.regexp_extract("path", rf"([^/]+)/{marker}$", 1)
    return listing.select(name.alias("run_id")).where("run_id <> ''").distinct().orderBy("run_id")


def split_pages(pages: DataFrame, wanted: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pages whose number is in the wanted list; a wanted page that a document (keys) lacks is an error when the rows are read."""
    last = pages.groupBy(*keys).agg(F.max("page").alias("_last"))
    # Without keys, `last` is one row.
    rows = pages.join(last, list(keys)) if keys else pages.join(F.broadcast(last), F.lit(True))
    out_of = F.exists(wanted, lambda p: (p < 1) | (p > F.col("_last")))
    checked = F.when(out_of, F.raise_error(F.lit("page out of range")).cast("int")).otherwise(F.col("page"))
    return rows.withColumn("page", checked).where(F.array_contains(wanted, F.col("page"))).drop("_last")


def choose_article(images: DataFrame, index: int | None = None, method: str | None = None) -> DataFrame:
    """Images of an article: of one index, or all; of one download method, or any."""
    keep = (F.lit(index is None) | F.col("index").eqNullSafe(F.lit(index))) & (F.lit(method is None) | F.col("mode").eqNullSafe(F.lit(method)))
    return images.where(keep)


def image_source(url: Column, listing_hit: Column) -> Column:
    """Where an image's size can be read: data for data URIs, file for known paths, else null."""
    return F.when(F.startswith(url, F.lit("data:")), F.lit("data")).when(F.coalesce(listing_hit, F.lit(False)), F.lit("file"))


def answer_text(full: Column, blocks: Column) -> Column:
    """An answer's OCR text: the whole text if there is one, else its blocks as numbered sections."""
    some = F.filter(blocks, lambda t: F.trim(t) != "")
    parts = F.transform(some, lambda t, i: F.concat(F.lit("## OCR block "), (i + 1).cast("string"), F.lit("\n"), t))
    return F.coalesce(F.nullif(full, F.lit("")), F.array_join(parts, "\n\n"))


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, format, width, height) of the image files under a path; only their headers are looked at, no pixel is decoded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), image_facts(F.col("content")).alias("f")).select("path", "bytes", "f.*")


def dom_order(images: DataFrame, sequence: DataFrame, article: str = "article_url") -> DataFrame:
    """Images (article, url, index) with `place`, their order on the page: those in its sequence (article, url, at) by their first place there, then the rest by index.

    Both orders are a page's, so a window holds one article's images.
    """
    first = sequence.where("url is not null").groupBy(article, "url").agg(F.min("at").alias("_at"))
    order = Window.partitionBy(article).orderBy(F.col("_at").asc_nulls_last(), "index", "url")
    return images.join(first, [article, "url"], "left").withColumn("place", F.row_number().over(order)).drop("_at")
