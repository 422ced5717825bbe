"""Writing a release: staged, read again, checked, and only then made current.

All file access goes through Spark or Hadoop, so that any file system works
that the cluster reads.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import ed25519
from corpusloom.functions.canonical import canonical
from corpusloom.operators import gates, manifest as M


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, replaced by a rename."""
    fs, p = _fs(spark, path)
    _, t = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(t, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(t, p):
        raise gates.Refused("write")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def export(tables: dict[str, DataFrame], folder: str) -> None:
    """Each relation as Parquet, those with norma_id sorted by it within files, for pruning by statistics."""
    for name, df in tables.items():
        (df.sortWithinPartitions("norma_id") if "norma_id" in df.columns else df).write.mode("errorifexists").parquet(f"{folder}/{name}")


def load(spark: SparkSession, folder: str, like: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    names = list(like) if like else ["norma", "hierarchy_node", "article", "transitory_provision", "source_gap", "norma_front_matter"]
    return {n: (spark.read.schema(like[n].schema) if like else spark.read).parquet(f"{folder}/{n}") for n in names}


def publish(spark: SparkSession, tables: dict[str, DataFrame], make_manifest, root: str, profile: list[dict] | None = None, fixture_set: str | None = None) -> dict:
    """Export to a new version folder, read it back, check it, write the manifest, then switch the pointer.

    ``make_manifest`` takes the relations read back; ``profile`` is what the
    manifest is held against. A release that fails leaves the pointer as it
    was, and its folder is removed.
    """
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    try:
        export(tables, folder)
        back = load(spark, folder, tables)
        made = make_manifest(back)
        gates.require_none(M.check(made, back, profile, fixture_set))
        write_text(spark, f"{folder}/corpus-manifest.json", M.text(made))
        write_text(spark, f"{root}/CURRENT", version)
    except Exception:
        fs, p = _fs(spark, folder)
        fs.delete(p, True)
        raise
    return made


def current(spark: SparkSession, root: str) -> tuple[dict, dict[str, DataFrame]]:
    """The manifest and relations of the current release, checked again; Refused with a fixed code for whatever is wrong."""
    version = read_text(spark, f"{root}/CURRENT")
    if not version:
        raise gates.Refused("manifest-missing")
    folder = f"{root}/versions/{version.strip()}"
    text = read_text(spark, f"{folder}/corpus-manifest.json")
    if text is None:
        raise gates.Refused("manifest-missing")
    try:
        made = json.loads(text)
    except ValueError:
        raise gates.Refused("manifest-json") from None
    tables = load(spark, folder)
    gates.require_none(M.check(made, tables))
    return made, tables


def is_newer(a: int, b: int) -> bool:
    """Whether channel version a comes after b: by number only, never by tag."""
    if not all(isinstance(v, int) and 0 <= v <= gates.MAX_SAFE for v in (a, b)):
        raise gates.Refused("channel-version")
    return a > b


def channel(spark: SparkSession, folder: str, corpus_version: int, release_tag: str, key_id: str | None = None, sign: Callable[[bytes], bytes] | bytes | None = None) -> dict:
    """channel.json over the files of a folder: sizes and SHA-256 by name, in canonical form; with ``sign`` also channel.json.sig.<key id>.

    Hashes are made by Spark, a file at a time. ``sign`` is the seed of an
    Ed25519 key, or a function from bytes to a signature.
    """
    if not 0 <= corpus_version <= gates.MAX_SAFE or not release_tag or sign and not key_id:
        raise gates.Refused("channel-version")
    made = {"corpusVersion": corpus_version, "releaseTag": release_tag, "files": _digests(spark, folder)} | ({"keyId": key_id} if key_id else {})
    text = canonical(made)
    write_text(spark, f"{folder}/channel.json", text)
    if sign:
        signature = ed25519.sign(sign, text.encode()) if isinstance(sign, bytes) else sign(text.encode())
        write_text(spark, f"{folder}/channel.json.sig.{key_id}", signature.hex())
    return made


def _digests(spark: SparkSession, folder: str) -> dict[str, dict]:
    """SHA-256 and size of the files of a folder by name, without the channel's own."""
    rows = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    return {r.name: {"sha256": r.sha256, "bytes": r.bytes} for r in rows.filter("name <> 'channel.json' and not startswith(name, 'channel.json.sig.')").orderBy("name").collect()}


def verified_channel(spark: SparkSession, folder: str, keys: dict[str, bytes], than: int | None = None) -> dict:
    """The channel of a folder, or Refused: its signature by one of the known public keys, its version and its files are checked.

    Codes: channel-missing, channel-json, key-unknown, signature-missing,
    signature, channel-version (not newer than ``than``), files (other sizes or
    digests, files missing or unknown).
    """
    text = read_text(spark, f"{folder}/channel.json")
    if text is None:
        raise gates.Refused("channel-missing")
    try:
        made = json.loads(text)
        if canonical(made) != text or not isinstance(made, dict):
            raise ValueError
        version, key_id, files = made["corpusVersion"], made.get("keyId"), made["files"]
    except (ValueError, KeyError):
        raise gates.Refused("channel-json") from None
    if key_id not in keys:
        raise gates.Refused("key-unknown")
    signature = read_text(spark, f"{folder}/channel.json.sig.{key_id}")
    if signature is None:
        raise gates.Refused("signature-missing")
    if not re.fullmatch("[0-9a-f]{128}", signature.strip()) or not ed25519.verify(keys[key_id], text.encode(), bytes.fromhex(signature.strip())):
        raise gates.Refused("signature")
    if than is not None and not is_newer(version, than):
        raise gates.Refused("channel-version")
    if _digests(spark, folder) != files:
        raise gates.Refused("files")
    return made
