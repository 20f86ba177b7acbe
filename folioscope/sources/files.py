"""Scans of the scraped tree, sidecars, shards, id lists and evaluation sets; snapshot and shard sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T

SHARD_GLOB = "shard-[0-9][0-9][0-9][0-9][0-9].jsonl"


def _path() -> Column:
    return F.col("_metadata.file_path")


def congresses(paths: DataFrame) -> DataFrame:
    """Distinct numeric congress directories of a ``path`` column that hold bills, in order."""
    c = F.regexp_extract("path", r"(?:^|/)([0-9]+)/bills/", 1)
    return paths.select(c.try_cast("int").alias("congress")).where("congress is not null").distinct().orderBy("congress")


def bill_tree(spark: SparkSession, root: str, least_congress: int = 0) -> DataFrame:
    """``{congress}/bills/{type}/{type}{n}/data.json``: fields from the file, identity from the path; bad JSON gives the id only."""
    rows = spark.read.schema(schemas.BILL_DATA).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(f"{root}/*/bills/*/*/data.json")
    rows = rows.withColumn("_p", _path())
    part = lambda k: F.regexp_extract("_p", r"/([0-9]+)/bills/([a-z]+)/[a-z]+([0-9]+)/data\.json$", k)
    rows = rows.withColumn("congress", part(1).try_cast("int")).withColumn("type", part(2)).withColumn("number", part(3)).where("congress is not null and number <> ''")
    made = T.build_bill_id(F.col("type"), F.col("number"), F.col("congress"))
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("short_title", "official_title", "status")]
    return rows.where(F.col("congress") >= least_congress).select(F.coalesce(F.nullif("bill_id", F.lit("")), made).alias("bill_id"), "congress", "type", "number", *text)


def sidecars(spark: SparkSession, root: str) -> DataFrame:
    """All ``*.meta.json`` below ``root``, but for hidden paths; adds directory and stem."""
    rows = spark.read.schema(schemas.SIDECAR).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.meta.json").json(root)
    rows = rows.withColumn("_p", _path()).where(~F.col("_p").rlike(r"/\.[^/]*"))
    return rows.withColumn("dir", F.regexp_extract("_p", r"^(.*)/[^/]+$", 1)).withColumn("stem", F.regexp_extract("_p", r"/([^/]+)\.meta\.json$", 1)).drop("_p")


def contents(spark: SparkSession, root: str) -> DataFrame:
    """(dir, stem, ext, content): raw bill files as bytes; XML keeps its declared encoding."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{xml,htm,txt}").load(root)
    p = F.col("path")
    return rows.where(~p.rlike(r"/\.[^/]*")).select(
        F.regexp_extract(p, r"^(.*)/[^/]+$", 1).alias("dir"), F.regexp_extract(p, r"/([^/]+)\.[^./]+$", 1).alias("stem"), F.regexp_extract(p, r"\.([^./]+)$", 1).alias("ext"), "content"
    )


def with_content(meta: DataFrame, content: DataFrame) -> DataFrame:
    """Sidecars joined to their files on (directory, stem, extension by format)."""
    ext = F.when(F.col("format") == "xml", "xml").when(F.col("format") == "html", "htm").otherwise("txt")
    return meta.withColumn("ext", ext).join(content, ["dir", "stem", "ext"])


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of ids, or an object with ``changed_bill_ids``; anything else is an error."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value"))
    plain = F.from_json("value", "array<string>")
    nested = F.from_json("value", "changed_bill_ids array<string>")["changed_bill_ids"]
    is_list = F.trim("value").startswith("[")
    ids = F.when(is_list, plain).when(nested.isNotNull(), nested)
    checked = F.when(ids.isNull(), F.raise_error(F.lit("id list: neither a list nor an object with changed_bill_ids"))).otherwise(ids)
    return raw.select(F.explode(checked).alias("bill_id"))


def pruned_scan(meta: DataFrame, ids: DataFrame, key: str = "bill_id") -> DataFrame:
    """The rows of the given ids; if any id has no row, all rows: a miss means that the id list can't be trusted."""
    wanted = ids.select(key).distinct()
    missed = wanted.join(meta.select(key), key, "left_anti").limit(1).count()
    return meta if missed else meta.join(wanted, key, "left_semi")


def shards(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """JSON lines of the files named shard-NNNNN.jsonl; blank lines are skipped."""
    return spark.read.schema(schema).option("pathGlobFilter", SHARD_GLOB).option("recursiveFileLookup", True).json(root)


def votes(spark: SparkSession, root: str) -> DataFrame:
    """``{congress}/votes/{session}/{chamber}{n}/data.json`` as flat records; member lists are never read."""
    rows = spark.read.schema(schemas.VOTE_DATA).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(f"{root}/*/votes/*/*/data.json")
    return parsed_votes(rows)


def parsed_votes(rows: DataFrame) -> DataFrame:
    """Drops bad JSON, votes without an id, and votes with neither question nor subject."""
    t = lambda c: F.trim(T.text_value(F.col(c)))
    names = ("chamber", "session", "date", "category", "type", "question", "subject", "result", "requires", "source_url")
    out = rows.where("_corrupt_record is null") if "_corrupt_record" in rows.columns else rows
    bill = T.build_bill_id(F.col("bill.type"), F.col("bill.number"), F.col("bill.congress"))
    out = out.select(t("vote_id").alias("vote_id"), T.safe_int(F.col("congress")).alias("congress"), T.safe_int(F.col("number")).alias("number"), *(t(c).alias(c) for c in names), bill.alias("bill_id"))
    return out.where("vote_id <> '' and (question <> '' or subject <> '')")


def desired_state(spark: SparkSession, path: str, schema: str = schemas.CHUNK) -> DataFrame:
    """A JSON list of chunks that must not be empty."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    if df.limit(1).count() == 0:
        raise ValueError(f"{path}: the desired state is empty")
    return df


def eval_set(spark: SparkSession, path: str, only_fixtures: bool = False) -> DataFrame:
    """Evaluation queries that expect something."""
    raw = spark.read.text(path, wholetext=True)
    one = "struct<" + ", ".join(x.replace(" ", ": ", 1) for x in schemas.EVAL_QUERY.split(", ")) + ">"
    items = F.coalesce(F.from_json("value", f"queries array<{one}>")["queries"], F.from_json("value", f"array<{one}>"))
    df = raw.select(F.explode(items).alias("q")).select("q.*").where(F.size("expected_bill_ids") > 0)
    return df.where("fixture") if only_fixtures else df


def checksums(spark: SparkSession, root: str, glob: str = SHARD_GLOB) -> DataFrame:
    """(file, bytes, sha256) of the shard files."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    return rows.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def completed_shards(manifest: DataFrame, current: DataFrame, model: str, dimensions: int) -> DataFrame:
    """Files that need no work: nothing left to embed, same checksum, same model and dimension."""
    done = manifest.where((F.col("to_embed") == 0) & F.col("sha256").isNotNull() & (F.col("model") == model) & (F.col("dimensions") == dimensions))
    return current.join(done.select("file", "sha256"), ["file", "sha256"], "left_semi")


def write_shards(df: DataFrame, path: str, shard: str = "shard_id") -> None:
    """JSON lines, a directory per shard: the commit protocol makes each write whole or absent."""
    df.repartition(shard).write.mode("overwrite").partitionBy(shard).json(path)


def write_snapshot(df: DataFrame, root: str, name: str, partition: str | None = None) -> str:
    """Writes a new snapshot beside the old one; ``promote`` makes it current."""
    path = f"{root}/{name}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return path


def promote(spark: SparkSession, root: str, name: str) -> None:
    """Flips the pointer to a finished snapshot in one rename, so that readers always find one; refuses one without _SUCCESS."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(conf)
    if not fs.exists(Path(f"{root}/{name}/_SUCCESS")):
        raise ValueError(f"{root}/{name} is not finished")
    out = fs.create(Path(f"{root}/CURRENT.next"), True)
    out.write(bytearray(name.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(Path(f"{root}/CURRENT.next")), fs.makeQualified(Path(f"{root}/CURRENT")), overwrite)


def write_files(df: DataFrame, root: str) -> None:
    """Writes (path, content) rows as files below ``root``, each whole: under a name of its attempt, then renamed."""
    import uuid
    from collections.abc import Iterator

    import pyarrow as pa

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as files

        fs, base = files.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else "file://" + root)
        n = 0
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                to = f"{base}/{path}"
                fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
                own = f"{to}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(own) as f:
                    f.write(content)
                fs.move(own, to)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    df.selectExpr("cast(path as string) path", "cast(content as binary) content").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def current(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot that the pointer names."""
    name = spark.read.text(f"{root}/CURRENT", wholetext=True).first()[0].strip()
    return spark.read.parquet(f"{root}/{name}")
