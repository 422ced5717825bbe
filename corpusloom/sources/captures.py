"""Readers of captures, sidecars, directories and sessions' shared folders."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators import integrity
from corpusloom.sources import strict


def ensure_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the folder that the cluster names; only where it names none, and on one machine, to a local one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="corpusloom-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """The URI of a new folder beside the checkpoints, which driver and executors share."""
    ensure_checkpoints(spark)
    base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return re.sub(r"^file:/+", "file:///", f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")


_L, _S = T.LongType(), T.StringType()
#: Fields that a sidecar or a catalog may leave out; all others have to be there, in the order of the type.
OPTIONAL = ("charset", "unitLabel", "reason")


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


#: Sidecar of a capture.
SIDECAR = _struct(
    formatVersion=_L, slug=_S, requestedHandle=_struct(authorityId=_L, versionId=_L), template=_struct(id=_S, fingerprint=_S), request=_struct(method=_S, endpoint=_S),
    response=_struct(status=_L, contentType=_struct(mediaType=_S, charset=_S), capturedAt=_S), captureTool=_struct(name=_S, version=_S),
    artifacts=_struct(gzipPath=_S, sidecarPath=_S, rawSha256=_S, gzipSha256=_S, uncompressedBytes=_L),
    observedHandlers=_struct(fichaAnchors=_L, parsedHandlers=_L, articleKind=_L, transitoryKind=_L, zeroFicha=_L, authorityFicha=_L, versionMatched=_L, distinctSourceUnitIds=_L),
)
LEDGER = _struct(kind=_S, sourceUnitId=_L, domOrder=_L, caption=_S, unitLabel=_S, reason=_S)
_AUTHORITY = _struct(
    slug=_S, authorityId=_L, versionId=_L, profileMembership=_struct(app=T.BooleanType(), mcp=T.BooleanType()), template=_struct(id=_S, fingerprint=_S, allowsZeroFicha=T.BooleanType()),
    capture=_struct(gzipPath=_S, sidecarPath=_S, rawSha256=_S, gzipSha256=_S, uncompressedBytes=_L),
    expectations=_struct(frontMatter=_S, classifications=_struct(emittedArticles=_L, emittedTransitories=_L, knownGaps=_L, reviewedExclusions=_L, total=_L), sourceUnitCoordinates=_L, ledger=T.ArrayType(LEDGER)),
)
CATALOG = _struct(formatVersion=_L, totals=T.MapType(_S, _L), authorities=T.ArrayType(_AUTHORITY))


def captures(spark: SparkSession, path: str) -> DataFrame:
    """(path, html, sha256, bytes, problem) of JSON captures, one file each.

    ``html`` wins if the key is there, a JSON null then being the text null;
    else TextoNorma if it isn't empty. Broken JSON and captures with neither
    are rows with a problem, which names no content.
    """
    raw = spark.read.format("binaryFile").load(path).select("path", F.col("content").cast("string").alias("json"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    keys = F.json_object_keys("json")
    parsed = F.from_json("json", "html string, TextoNorma string, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = raw.withColumn("_k", keys).withColumn("_p", parsed)
    first = F.when(F.array_contains("_k", "html"), F.coalesce(F.col("_p.html"), F.lit("null")))
    html = F.coalesce(first, F.when(F.col("_p.TextoNorma") != "", F.col("_p.TextoNorma")))
    problem = F.when(F.col("_k").isNull() | F.col("_p._bad").isNotNull(), "json").when(html.isNull(), "payload")
    return rows.select("path", F.when(problem.isNull(), html).alias("html"), "sha256", "bytes", problem.alias("problem"))


def required(kind: T.DataType, optional: tuple[str, ...] = OPTIONAL) -> T.DataType:
    """A type of which nothing but the optional fields may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, required(f.dataType, optional), f.name in optional) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(required(kind.elementType, optional), False)
    return T.MapType(kind.keyType, required(kind.valueType, optional), False) if isinstance(kind, T.MapType) else kind


def sidecars(spark: SparkSession, path: str, suffix: str = ".capture.json") -> tuple[DataFrame, DataFrame]:
    """(path, sha256, and the fields of SIDECAR) of the sidecars below a folder, and the refusals of the others (path, code, at, line, column), all by the strict reader."""
    return _strictly(spark, path, SIDECAR, suffix)


def catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ordinal, slug, ..., expectations) for each authority of a catalog, and its refusal, if it isn't read."""
    rows, refused = _strictly(spark, path, CATALOG, ".json")
    return rows.select(F.posexplode("authorities").alias("ordinal", "a")).select("ordinal", "a.*"), refused


def _strictly(spark: SparkSession, path: str, shape: T.StructType, suffix: str) -> tuple[DataFrame, DataFrame]:
    rows = strict.read(spark, path, required(shape), suffix)
    return strict.values(rows, shape), rows.filter("code is not null").select("path", "code", "at", "line", "column")


def ledger(authorities: DataFrame) -> DataFrame:
    return authorities.select("slug", F.posexplode("expectations.ledger").alias("ordinal", "l")).select("slug", "ordinal", "l.*")


def files(spark: SparkSession, path: str, recursive: bool = True, without: tuple[str, ...] = ()) -> DataFrame:
    """(path, name, bytes) of the files below a folder, but for the names given; contents aren't read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))
    return rows.filter(~F.col("name").isin(*without)) if without else rows


def missing_files(expected: DataFrame, name: str, present: DataFrame) -> DataFrame:
    """Expected names without a file."""
    return expected.join(present.select(F.col("name").alias("_n")), F.col(name) == F.col("_n"), "left_anti")


def sidecar_faults(rows: DataFrame) -> DataFrame:
    """(slug, fault) where a sidecar's counts don't agree."""
    h = F.col("observedHandlers")
    total = h["fichaAnchors"]
    checks: list[tuple[str, Column]] = [
        ("parsed", h["parsedHandlers"] != total), ("kinds", h["articleKind"] + h["transitoryKind"] != total), ("fichas", h["zeroFicha"] + h["authorityFicha"] != total),
        ("version", h["versionMatched"] != total), ("distinct", h["distinctSourceUnitIds"] != total),
        ("path", F.col("artifacts.sidecarPath") != F.format_string("corpus-sources/v1/%s/%d-%d.capture.json", "slug", "requestedHandle.authorityId", "requestedHandle.versionId")),
        ("sha256", ~F.col("artifacts.rawSha256").rlike("^[0-9a-f]{64}$")),
    ]
    return rows.select("slug", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks]))).alias("fault"))


def coverage_faults(authorities: DataFrame, documents: DataFrame) -> DataFrame:
    """(path, fault) where sidecars aren't those of a catalog, one for one and in its order.

    ``documents`` are sidecars with ``path``, relative as in the catalog, and
    ``ordinal``, their place among them. Keys that occur twice are found by
    grouping, all else by one join on the path.
    """
    d, a = F.struct(*documents.columns).alias("d"), F.struct(*authorities.columns).alias("a")
    both = authorities.select(a).join(documents.select(d), F.col("a.capture.sidecarPath") == F.col("d.path"), "full_outer")
    path = F.coalesce("d.path", "a.capture.sidecarPath")
    rows = F.col("a.expectations.ledger")
    transitory = F.size(F.filter(rows, lambda r: (r["kind"] == "emitted-transitory") | ((r["kind"] == "known-gap") & r["reason"].startswith("transitorio-"))))
    differs = lambda x, y: ~F.col(x).eqNullSafe(F.col(y))
    parts = ("gzipPath", "sidecarPath", "rawSha256", "gzipSha256", "uncompressedBytes")
    checks: list[tuple[str, Column]] = [
        ("ordinal", differs("a.ordinal", "d.ordinal")), ("slug", differs("a.slug", "d.slug")), ("handle", differs("a.authorityId", "d.requestedHandle.authorityId") | differs("a.versionId", "d.requestedHandle.versionId")),
        ("template", differs("a.template.id", "d.template.id") | differs("a.template.fingerprint", "d.template.fingerprint")),
        ("artifacts", F.exists(F.array(*[differs(f"a.capture.{p}", f"d.artifacts.{p}") for p in parts]), lambda x: x)),
        ("total", differs("d.observedHandlers.parsedHandlers", "a.expectations.classifications.total")),
        ("kinds", (F.col("d.observedHandlers.transitoryKind") != transitory) | (F.col("d.observedHandlers.articleKind") != F.size(rows) - transitory)),
        ("zero-ficha", ~F.col("a.template.allowsZeroFicha") & (F.col("d.observedHandlers.zeroFicha") != 0)),
    ]
    paired = F.col("a").isNotNull() & F.col("d").isNotNull()
    notes = [F.when(F.col("d").isNull(), "missing"), F.when(F.col("a").isNull(), "extra"), *[F.when(paired & c, F.lit(n)) for n, c in checks]]
    out = both.select(path.alias("path"), F.explode(F.array_compact(F.array(*notes))).alias("fault"))
    handle = F.concat_ws("/", "requestedHandle.authorityId", "requestedHandle.versionId")
    keys = {"path": F.col("path"), "slug": F.col("slug"), "handle": handle, "gzip-path": F.col("artifacts.gzipPath"), "sidecar-path": F.col("artifacts.sidecarPath")}
    each = documents.select("path", F.explode(F.array(*[F.struct(F.lit(n).alias("what"), c.alias("value")) for n, c in keys.items()])).alias("k")).select("path", "k.*")
    again = integrity.repeated_keys(each, ["what", "value"]).drop("n")
    return out.unionByName(each.join(again, ["what", "value"]).select("path", F.concat(F.lit("repeated-"), "what").alias("fault")))


def listing_faults(listed: DataFrame, name: str, present: DataFrame) -> DataFrame:
    """(name, violation) where a list and the files aren't the same, each once: lost, unknown, repeated_line or repeated_event."""
    return integrity.marker_bijection(present.select(F.col("name").alias("_n")), listed.select(F.col(name).alias("_n")), "_n").withColumnRenamed("_n", "name")


def metadata_faults(registry: DataFrame, metadata: DataFrame) -> DataFrame:
    """(slug, fault) where optional metadata (slug, id, version_id) doesn't agree with the registry; slugs without metadata are fine."""
    meta = metadata.select(F.col("slug").alias("_s"), F.col("id").alias("_i"), F.col("version_id").alias("_v"))
    joined = registry.select("slug", "id", "version_id").join(meta, F.col("slug") == F.col("_s"), "right")
    what = F.when(F.col("slug").isNull(), "unknown").when(~F.col("id").eqNullSafe(F.col("_i")), "id").when(~F.col("version_id").eqNullSafe(F.col("_v")), "version")
    return joined.select(F.col("_s").alias("slug"), what.alias("fault")).filter("fault is not null")
