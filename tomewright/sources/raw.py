"""Raw provider responses: create-only, content-hashed artifacts, and what selects among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewright.functions.identity import sha256_text
from tomewright.sources.schemas import RAW


def content_hash(response) -> "F.Column":
    """Hash of the response as canonical JSON; variants keep their keys sorted."""
    return sha256_text(F.to_json(response))


def read_raw(spark: SparkSession, path: str, verify: bool = True, lines: bool = False) -> DataFrame:
    """All artifacts below a folder: path, provider, topic, retrieved_at, parameters and response; hashes are checked.

    A file is one artifact, as responses are preserved; with lines, as `write_raw` leaves them, a line is one.
    """
    rows = spark.read.option("wholetext", not lines).option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt" if lines else "*.json").text(path)
    v = F.parse_json("value")
    field = lambda name, kind="string": F.try_variant_get(v, f"$.{name}", kind)
    out = rows.select(
        F.col("_metadata.file_path").alias("path"), field("provider").alias("provider"), field("topic").alias("topic"), field("requested_limit", "int").alias("requested_limit"),
        F.to_timestamp(field("retrieved_at")).alias("retrieved_at"), F.try_variant_get(v, "$.request_parameters", "variant").alias("request_parameters"),
        F.try_variant_get(v, "$.response", "variant").alias("response"), field("content_hash").alias("content_hash"),
    )
    if verify:
        ok = F.col("content_hash") == content_hash(F.col("response"))
        out = out.withColumn("content_hash", F.when(ok, F.col("content_hash")).otherwise(F.raise_error(F.concat(F.lit("content hash differs: "), "path"))))
    return out


def latest_artifacts(raw: DataFrame) -> DataFrame:
    """The latest artifact of each provider and topic, by time, then path."""
    return raw.groupBy("provider", "topic").agg(F.max_by("path", F.struct("retrieved_at", "path")).alias("path"))


def write_raw(rows: DataFrame, folder: str) -> None:
    """Artifacts as JSON lines below provider=.../topic=.../, each with its content hash; an existing folder is never written to again."""
    own = rows.withColumn("content_hash", content_hash(F.col("response")))
    line = F.to_json(F.struct(*[c for c in RAW.names if c in own.columns]))
    files = own.select(line.alias("value"), F.col("provider"), F.col("topic")).repartition("provider", "topic")
    files.write.mode("errorifexists").partitionBy("provider", "topic").format("text").save(folder)


#: Files up to this size are hashed by the executors, each as one value; larger ones as a stream.
HASHED_BYTES = 256 << 20


def verify_files(spark: SparkSession, path: str, sha1: str | None = None, size: int | None = None) -> DataFrame:
    """(path, length, sha1, ok) of dump files. Without a digest to compare only their lengths are looked at.

    A digest can't be split, so that a file too large for one value is read as a stream, in constant memory. An empty
    file gives no row.
    """
    found = spark.read.format("binaryFile").load(path)
    rows = found.select("path", "length", F.lit(None).cast("string").alias("sha1"))
    if sha1:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        small = found.where(F.col("length") <= HASHED_BYTES).select("path", "length", F.sha1("content").alias("sha1"))
        hashed = []
        for r in found.where(F.col("length") > HASHED_BYTES).select("path", "length").toLocalIterator():
            at = jvm.org.apache.hadoop.fs.Path(r.path)
            stream = at.getFileSystem(conf).open(at)
            try:
                hashed.append((r.path, r.length, jvm.org.apache.commons.codec.digest.DigestUtils.sha1Hex(stream)))
            finally:
                stream.close()
        rows = small.unionByName(spark.createDataFrame(hashed, "path string, length long, sha1 string"))
    ok = F.lit(True)
    if sha1:
        ok = ok & (F.col("sha1") == sha1.lower())
    if size is not None:
        ok = ok & (F.col("length") == size)
    return rows.select("path", "length", "sha1", ok.alias("ok"))


def plan_matches(fetched: "F.Column", planned: "F.Column") -> "F.Column":
    """Whether fetched pages are a prefix of the planned ones (arrays of JSON parameters)."""
    pairs = F.zip_with(fetched, F.slice(planned, 1, F.greatest(F.size(fetched), F.lit(0))), lambda a, b: F.coalesce(a == b, F.lit(False)))
    return (F.size(fetched) > 0) & (F.size(fetched) <= F.size(planned)) & F.forall(pairs, lambda x: x)


def page_plan(total: int, size: int, most: int | None = None) -> list[dict[str, int]]:
    """Start and size of each page for so many rows."""
    starts = range(0, total, size)
    return [{"start": s, "size": min(size, total - s)} for s in list(starts)[:most]]


def without_credentials(value, secret=("key", "token", "secret", "password", "apikey", "api_key", "ttbkey", "cert_key")):
    """A JSON value without any field that carries a credential."""
    if isinstance(value, dict):
        return {k: without_credentials(v, secret) for k, v in value.items() if k.lower() not in secret}
    return [without_credentials(v, secret) for v in value] if isinstance(value, list) else value


def stream_latest(spark: SparkSession, folder: str, schema: str, checkpoint: str, target: str):
    """Append-only raw rows as a stream: each available file once, the latest row a key kept in a table at `target`."""
    from tomewright.streaming.latest import keep_latest

    rows = spark.readStream.schema(schema).json(folder)
    return keep_latest(rows, ["provider", "topic"], ["retrieved_at"], checkpoint, target)
