"""Validators of scalars, ledger rows and catalogs, as columns that say what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import numbers
from corpusloom.functions import text as X
from corpusloom.operators import integrity
from corpusloom.operators.extraction import EMITTED_ARTICLE, EMITTED_PROVISION, EXCLUSION, GAP

MAX_SAFE = integrity.MAX_SAFE
#: Grammars of slugs, digests, fingerprints, seeds and timestamps, and the reasons a ledger may give.
SLUG, SHA256, FNV, FINGERPRINT, SEED = r"\A[a-z0-9]+(?:-[a-z0-9]+)*\z", r"\A[0-9a-f]{64}\z", r"\A[0-9a-f]{16}\z", r"\Asha256:[0-9a-f]{64}\z", r"\A[0-9a-fA-F]{64}\z"
STAMP = r"\A([0-9]{4})-([0-9]{2})-([0-9]{2})T([0-9]{2}):([0-9]{2}):([0-9]{2})\.([0-9]{3})Z\z"
CAPTION, PROVISION_ENDING = "Ficha Artículo ", " Transitorio"
ARTICLE_REASONS = ("source-text-unavailable", "unconsumed-article-terminator")
PROVISION_REASONS = ("transitorio-inside-article-body", "transitorio-terminator-without-standalone-unit")
EXCLUSION_REASONS = ("source-elimination-notice", "source-renumber-redirect-notice")
DENIED = r"(?i)dictamen|criterio|pronunciamiento|consulta|opinion|ruling|private"


def safe_integer(value: Column, least: int = 0) -> Column:
    return F.coalesce(value.between(least, MAX_SAFE), F.lit(False))


def integer_text(value: Column) -> Column:
    """The positive integer that a text is, or null."""
    number = F.when(value.rlike(r"\A[0-9]{1,16}\z"), value.try_cast("long"))
    return F.when(number.between(1, MAX_SAFE), number)


def shaped(value: Column, shape: str) -> Column:
    """Whether a text has one of the shapes of this module as a whole; null hasn't."""
    return F.coalesce(value.rlike(shape), F.lit(False))


def one_of(value: Column, allowed: tuple) -> Column:
    """Whether a value is one of a closed list; null isn't."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def constant(value: Column, wanted: object) -> Column:
    """Whether a value is just this one."""
    return value.eqNullSafe(F.lit(wanted))


def slug(value: Column) -> Column:
    return F.coalesce(value.rlike(SLUG) & (F.length(value) <= 64), F.lit(False))


def timestamp(value: Column) -> Column:
    """An exact UTC time in milliseconds of a day that exists; no leap seconds."""
    part = lambda i: F.regexp_extract(value, STAMP, i).try_cast("int")
    day = F.make_date(F.greatest(part(1), F.lit(1)), F.greatest(F.least(part(2), F.lit(12)), F.lit(1)), F.lit(1))
    fits = part(2).between(1, 12) & (part(1) >= 1) & (part(3) >= 1) & (part(3) <= F.dayofmonth(F.last_day(day)))
    return F.coalesce(value.rlike(STAMP) & fits & (part(4) <= 23) & (part(5) <= 59) & (part(6) <= 59), F.lit(False))


def day(value: Column) -> Column:
    """The date that a text dd/MM/yyyy is, or null if there is no such day."""
    shape = r"\A([0-9]{2})/([0-9]{2})/([0-9]{4})\z"
    part = lambda i: F.regexp_extract(value, shape, i)
    return F.when(value.rlike(shape), F.concat_ws("-", part(3), part(2), part(1)).try_cast("date"))


def human(value: Column) -> Column:
    """A trimmed NFC text of 1 to 512 UTF-16 units without control or format characters."""
    clean = ~value.rlike(r"[\p{Cc}\p{Cf}\p{Cs}]") & (X.trim(value) == value) & (value != "") & (X.utf16_length(value) <= 512)
    return F.coalesce(clean & (X.normalise(value) == value), F.lit(False))


def caption(value: Column) -> Column:
    return F.coalesce(value.startswith(CAPTION) & (X.caption(value) == value), F.lit(False))


def unit_label(value: Column) -> Column:
    """A number without leading zeros that normalising leaves as it is."""
    return F.coalesce(numbers.is_catalog(value) & (numbers.cited_number(value) == value), F.lit(False))


def exact_keys(json: Column, keys: list[str]) -> Column:
    """Whether a JSON object has just these keys, in this order."""
    return F.coalesce(F.json_object_keys(json) == F.array(*map(F.lit, keys)), F.lit(False))


def sum_within(*parts: Column) -> Column:
    """A sum of counts, or null beyond the safe integers."""
    total = sum((p.cast("decimal(38,0)") for p in parts), F.lit(0).cast("decimal(38,0)"))
    return F.when(total <= MAX_SAFE, total.cast("long"))


def ledger_fault(index: Column) -> Column:
    """What is wrong with a ledger row (kind, sourceUnitId, domOrder, caption, unitLabel, reason), or null; the kind decides what it may have."""
    kind, label, reason = F.col("kind"), F.col("unitLabel"), F.col("reason")
    emitted = kind.isin(EMITTED_ARTICLE, EMITTED_PROVISION)
    ending = F.coalesce(F.col("caption").endswith(PROVISION_ENDING), F.lit(False))
    about_provision = (kind == EMITTED_PROVISION) | (kind == GAP) & reason.isin(*PROVISION_REASONS)
    allowed = F.when(kind == GAP, reason.isin(*ARTICLE_REASONS, *PROVISION_REASONS)).when(kind == EXCLUSION, reason.isin(*EXCLUSION_REASONS)).otherwise(True)
    return (
        F.when(~F.coalesce(kind.isin(EMITTED_ARTICLE, EMITTED_PROVISION, GAP, EXCLUSION), F.lit(False)), "kind")
        .when(~safe_integer(F.col("sourceUnitId"), 1), "sourceUnitId")
        .when(~F.col("domOrder").eqNullSafe(index), "domOrder")
        .when(~caption(F.col("caption")), "caption")
        .when(emitted & (label.isNull() | reason.isNotNull()) | ~emitted & (reason.isNull() | label.isNotNull()), "keys")
        .when(~F.coalesce(allowed, F.lit(False)), "reason")
        .when(F.coalesce(about_provision, F.lit(False)) != ending, "ending")
        .when((kind == EMITTED_ARTICLE) & ~unit_label(label), "unitLabel")
    )


def context_fault(version: Column, ficha: Column, authority: Column, expected_version: Column, allows_zero: Column) -> Column:
    """Why a source event doesn't belong to its capture, or null."""
    return F.when(version != expected_version, "version").when((ficha == 0) & ~allows_zero, "zero-ficha").when((ficha != 0) & (ficha != authority), "ficha")


def authority_faults(authorities: DataFrame, ledger: DataFrame) -> DataFrame:
    """(slug, fault): counts of a ledger against what its authority declares."""
    kinds = {"emittedArticles": EMITTED_ARTICLE, "emittedTransitories": EMITTED_PROVISION, "knownGaps": GAP, "reviewedExclusions": EXCLUSION}
    counted = ledger.groupBy(F.col("slug").alias("_s")).agg(*[F.count_if(F.col("kind") == k).alias(f"_{n}") for n, k in kinds.items()], F.count(F.lit(1)).alias("_total"), F.count_distinct("sourceUnitId").alias("_ids"))
    rows = authorities.join(counted, F.col("slug") == F.col("_s"), "left").na.fill(0, [f"_{n}" for n in kinds] + ["_total", "_ids"])
    c = F.col("expectations.classifications")
    checks = [(n, c[n] != F.col(f"_{n}")) for n in kinds]
    checks += [("total", (c["total"] != F.col("_total")) | (c["total"] != sum_within(*[c[n] for n in kinds]))), ("ids", F.col("_ids") != F.col("_total"))]
    checks += [("coordinates", F.col("expectations.sourceUnitCoordinates") != c["emittedArticles"] + c["emittedTransitories"] + c["knownGaps"]), ("membership", ~(F.col("profileMembership.app") | F.col("profileMembership.mcp"))), ("slug", ~slug(F.col("slug")))]
    return rows.select("slug", F.explode(F.array_compact(F.array(*[F.when(v, F.lit(n)) for n, v in checks]))).alias("fault"))


def catalog_faults(authorities: DataFrame) -> DataFrame:
    """(slug, fault) over a whole catalog: ids that don't increase, repeated slugs and paths."""
    if "ordinal" in authorities.columns:  # the place before is found by a join, however large the catalog is
        rows = authorities.select("ordinal", "slug", "authorityId", "capture")
        before = rows.select((F.col("ordinal") + 1).alias("ordinal"), F.col("authorityId").alias("_before"))
        falling = rows.join(before, "ordinal").filter(F.col("authorityId") <= F.col("_before"))
    else:
        rows = authorities.select(F.lit(0).alias("one"), F.monotonically_increasing_id().alias("at"), "slug", "authorityId", "capture")
        falling = integrity.not_increasing(rows, ["one"], ["at"], "authorityId")
    falling = falling.select("slug", F.lit("authorityId").alias("fault"))
    out = falling
    for name, column in (("slug", "slug"), ("gzipPath", "capture.gzipPath"), ("sidecarPath", "capture.sidecarPath")):
        again = integrity.repeated_keys(rows.select(F.col(column).alias("v")), ["v"])
        out = out.unionByName(rows.join(again, F.col(column) == F.col("v"), "left_semi").select("slug", F.lit(name).alias("fault")))
    return out


def inventory(files: DataFrame, authorities: DataFrame, catalog_path: str) -> DataFrame:
    """(path, verdict, reason) of files: the first rule that holds decides, denied names first."""
    side = authorities.select(F.col("capture.sidecarPath").alias("_sp"), F.lit(True).alias("_side"))
    gz = authorities.select(F.col("capture.gzipPath").alias("_gp"), F.lit(True).alias("_gz"))
    rows = files.join(side, F.col("path") == F.col("_sp"), "left").join(gz, F.col("path") == F.col("_gp"), "left")
    name = F.element_at(F.split("path", "/"), -1)
    reason = F.when(name.rlike(DENIED), "deny-private-ruling-basename").when(F.col("_side"), "reviewed-capture").when(F.col("_gz") | F.col("path").endswith(".raw.json.gz"), "raw-capture-quarantine").when(F.col("path") == catalog_path, "reviewed-catalog").otherwise("unmatched-rule")
    verdict = F.when(reason.isin("reviewed-capture", "reviewed-catalog"), "public").when(reason == "raw-capture-quarantine", "quarantined").otherwise("deny")
    return rows.select("path", verdict.alias("verdict"), reason.alias("reason"))


def imports(sources: DataFrame) -> DataFrame:
    """(src, specifier, kind) of import and export lines in sources (path, text); kinds are relative, builtin and package."""
    found = F.regexp_extract_all("text", F.lit(r"(?m)^\s*(?:import|export)\b[^;'\"]*?(?:from\s*)?['\"]([^'\"]+)['\"]"), F.lit(1))
    rows = sources.select(F.col("path").alias("src"), F.explode(found).alias("specifier"))
    kind = F.when(F.col("specifier").startswith("."), "relative").when(F.col("specifier").startswith("node:"), "builtin").otherwise("package")
    package = F.regexp_extract("specifier", r"\A(@[^/]+/[^/]+|[^/]+)", 1)
    return rows.select("src", F.when(kind == "package", package).otherwise(F.col("specifier")).alias("specifier"), kind.alias("kind")).distinct()
