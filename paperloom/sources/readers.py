"""Sources: JSON collections, manifests, media listings, captions, labels and vector stores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import constants as K
from paperloom.functions.text import clean_caption, milliseconds, squeeze, stem, strip_data_uri


def faq_rows(raw: DataFrame) -> DataFrame:
    """Questions and answers by language of FAQ files given as (path, value) (SRC1): a row for each language that has text.

    A file that doesn't parse gives no rows.
    """
    kind = "struct<faqs: array<struct<id: string, question_ar: string, answer_ar: string, question_en: string, answer_en: string, tags: array<string>>>>"
    files = raw.select(stem(F.col("path")).alias("file"), F.try_variant_get(F.try_parse_json("value"), "$", kind).alias("j"))
    each = files.select("file", F.posexplode("j.faqs").alias("pos", "f"))
    both = each.select("file", F.coalesce("f.id", "file").alias("faq_id"), F.explode(F.array(*(F.struct(F.lit(x).alias("lang"), squeeze(F.col(f"f.question_{x}")).alias("question"), squeeze(F.col(f"f.answer_{x}")).alias("answer")) for x in ("ar", "en")))).alias("e"), F.coalesce("f.tags", F.array().cast("array<string>")).alias("tags"))
    out = both.select(F.concat_ws("::", "faq_id", "e.lang").alias("id"), "faq_id", "e.lang", "e.question", "e.answer", "tags", F.col("file").alias("source_file"))
    return out.where("question <> '' or answer <> ''")


def read_faqs(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(F.col("_metadata.file_path").alias("path"), "value")
    return faq_rows(raw)


def manifest_rows(raw: DataFrame) -> DataFrame:
    """document_id, images, document_type of manifests given as ``value``: an array, or an object that holds one (SRC2).

    A document without images is an error; a blank type is "default".
    """
    kind = "array<struct<document_id: string, document_type: string, images: array<string>>>"
    v = F.try_parse_json("value")
    rows = raw.select(F.explode(F.coalesce(F.try_variant_get(v, "$", kind), F.try_variant_get(v, "$.pipeline_manifest", kind))).alias("d"))
    images = F.when(F.size("d.images") > 0, F.col("d.images")).otherwise(F.raise_error(F.concat(F.lit("no images: "), F.coalesce("d.document_id", F.lit("?")))).cast("array<string>"))
    return rows.select("d.document_id", images.alias("images"), F.coalesce(F.nullif(F.trim("d.document_type"), F.lit("")), F.lit("default")).alias("document_type"))


def is_image(path: Column, suffixes: Sequence[str] = K.IMAGE_SUFFIXES) -> Column:
    """Whether a path has one of the suffixes, in any case (FLT1)."""
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1)).isin(*suffixes)


def list_images(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Paths and sizes of a folder's images, in order; contents aren't read (SRC3, SRC4)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.select("path", "length").where(is_image(F.col("path"))).orderBy("path")


def typed_documents(listings: dict[str, DataFrame]) -> DataFrame:
    """Listings by type as one, ids led by the type only if there is more than one (SRC5)."""
    many = len(listings) > 1
    parts = [df.select(F.concat(F.lit(f"{t}_" if many else ""), stem(F.col("path"))).alias("document_id"), "path", F.lit(t).alias("document_type")) for t, df in listings.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("document_id")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(document_id, payload) of JSON files, the id from the file's name (SRC7)."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json")
    return raw.select(stem(F.col("_metadata.file_path")).alias("document_id"), F.col("value").alias("payload"))


def read_labels(spark: SparkSession, path: str, drop: Sequence[str] = ()) -> DataFrame:
    return spark.read.csv(path, header=True).drop(*drop)


def column_roles(columns: Sequence[str]) -> tuple[str, str]:
    """The file and the label column of a table whose names vary (SRC9)."""
    lower = [c.lower() for c in columns]
    pick = lambda cues, but=None: next((c for c, x in zip(columns, lower, strict=True) if c != but and any(q in x for q in cues)), None)
    file = pick(("file", "image", "img")) or columns[0]
    label = pick(("label", "text", "word", "name", "medicine"), file) or next((c for c in columns if c != file), columns[-1])
    return file, label


def label_pairs(rows: DataFrame) -> DataFrame:
    """(file, label) with .png where there is no suffix, without blank labels."""
    file, label = column_roles(rows.columns)
    name = F.trim(F.col(file).cast("string"))
    return rows.select(F.when(name.contains("."), name).otherwise(F.concat(name, F.lit(".png"))).alias("file"), F.trim(F.col(label).cast("string")).alias("label")).where("label <> '' and lower(label) <> 'nan'")


def caption_cues(raw: DataFrame) -> DataFrame:
    """(path, pos, start_ms, end_ms, text) of SRT or WebVTT files given as (path, value); cues without text are left out (SRC11, SRC12)."""
    blocks = raw.select("path", F.posexplode(F.split(F.replace("value", F.lit("\r"), F.lit("")), r"\n[ \t]*\n+")).alias("pos", "block"))
    times = r"(?m)^\s*((?:\d+:)?\d+:\d+[.,]\d+)\s*-->\s*((?:\d+:)?\d+:\d+[.,]\d+)[^\n]*$"
    text = clean_caption(F.regexp_replace("block", r"(?s)^.*?-->[^\n]*\n?", ""))
    cues = blocks.where(F.contains("block", F.lit("-->"))).select("path", "pos", milliseconds(F.regexp_extract("block", times, 1)).alias("start_ms"), milliseconds(F.regexp_extract("block", times, 2)).alias("end_ms"), text.alias("text"))
    return cues.where("text <> ''")


def read_captions(spark: SparkSession, folder: str) -> DataFrame:
    return caption_cues(spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"))


def embedding_rows(raw: DataFrame) -> DataFrame:
    """Stored vectors out of replies given as ``value``: a list, or an object with embeddings or data (SRC14).

    Rows without a vector are left out; the vector's bytes stay base64-decoded.
    """
    kind = "array<struct<requestId: string, userIdHash: string, imagePath: string, imageHash: string, fileSizeBytes: bigint, embedding: string>>"
    v = F.try_parse_json("value")
    rows = raw.select(F.explode(F.coalesce(F.try_variant_get(v, "$", kind), F.try_variant_get(v, "$.embeddings", kind), F.try_variant_get(v, "$.data", kind))).alias("e")).select("e.*")
    return rows.where("embedding is not null and embedding <> ''").withColumn("embedding", F.try_to_binary("embedding", F.lit("base64")))


def of_user(store: DataFrame, user: str) -> DataFrame:
    """A user's rows; the filter reaches the scan (SRC15)."""
    return store.where(F.col("user") == user)


def by_key(store: DataFrame, column: str, value: object) -> DataFrame:
    """One row of a key, or none (SRC16)."""
    return store.where(F.col(column) == value).limit(1)


def json_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array file's rows; none if it can't be read (SRC18, SRC20)."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).json(path, multiLine=True, mode="DROPMALFORMED")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def templates(spark: SparkSession, by_category: dict[str, list[str]]) -> DataFrame:
    """(category, pos, question) (SRC21)."""
    rows = [(c, i, q) for c, qs in by_category.items() for i, q in enumerate(qs)]
    return spark.createDataFrame(rows, "category string, pos int, question string")


def job_inputs(jobs: DataFrame) -> DataFrame:
    """A job's voice and images under their several names; images that aren't base64, data URIs or paths are left out (SRC22)."""
    voice = F.coalesce("audio_base64", "voice_base64")
    images = F.coalesce("images_base64", "images", F.array().cast("array<string>"))
    bare = F.transform(images, strip_data_uri)
    fit = F.filter(bare, lambda x: F.coalesce((x != "") & (F.try_to_binary(x, F.lit("base64")).isNotNull() | F.rlike(x, F.lit(r"(?i)\.(png|jpe?g|tiff?|bmp|webp)$"))), F.lit(False)))
    return jobs.select("*", strip_data_uri(voice).alias("voice"), fit.alias("image_inputs"), (F.size(images) - F.size(fit)).alias("skipped"))


def batch_images(batches: DataFrame) -> DataFrame:
    """(id, user_id, image_path) of image lists, with names by place where there are none (SRC23, WIN6)."""
    each = batches.select(F.posexplode("images").alias("pos", "i"))
    return each.select(F.coalesce("i.id", F.format_string("image_%d", F.col("pos") + 1)).alias("id"), F.coalesce("i.user_id", F.lit("unknown")).alias("user_id"), "i.image_path")


def by_id_list(rows: DataFrame, key: str, listed: str, limit: int | None = None) -> DataFrame:
    """Rows of a comma-separated list of ids, all if it is blank, then a limit (SRC26)."""
    ids = [x.strip() for x in listed.split(",") if x.strip()]
    out = rows.where(F.col(key).cast("string").isin(ids)) if ids else rows
    return out.orderBy(key).limit(limit) if limit is not None else out


def load_or_build(spark: SparkSession, path: str, build) -> DataFrame:
    """A stored table, built and stored if it isn't there (SRC25, SNK9)."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        build().write.parquet(path)
        return spark.read.parquet(path)
